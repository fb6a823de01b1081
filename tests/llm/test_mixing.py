import math
from collections import Counter, defaultdict

import pytest
from conftest_llm import ODD_TEXTS, WORD
from pyspark.sql import functions as F

from wareloom.llm import mixing


def corpus(frame, sizes, extra=()):
    texts, sources = [], []
    for source, n in sizes.items():
        for i in range(n):
            texts.append("w " * (1 + i % 5) + f"{source}{i}")
            sources.append(source)
    return frame(texts, sources=sources, extra=extra), texts, sources


def read_tokens(out, texts, sources):
    tokens, docs = Counter(), defaultdict(Counter)
    for r in out.collect():
        tokens[sources[r.doc_id]] += len(WORD.findall(texts[r.doc_id]))
        docs[r.doc_id][r.epoch] += 1
    return tokens, docs


def test_repeats_are_limited_and_nothing_is_lost(frame):
    docs, texts, sources = corpus(frame, {"big": 600, "mid": 150, "small": 20, None: 40})
    plan = mixing.plan_mixture(docs, max_repeats=3.0)
    out = mixing.mix(docs, plan)
    tokens, read = read_tokens(out, texts, sources)
    natural = Counter()
    for t, s in zip(texts, sources):
        natural[s] += len(WORD.findall(t))
    total = sum(natural.values())
    powers = {s: (n / total) ** plan.exponent for s, n in natural.items()}
    most = max(natural.values())
    budget = most / (powers["big"] / sum(powers.values()))
    assert len(read) == len(texts)
    for s, n in natural.items():
        want = powers[s] / sum(powers.values()) * budget
        assert abs(tokens[s] - want) <= 3 + 1e-6 * want  # half of the longest document
        assert want / n <= 3.0 + 1e-6
    assert max(powers[s] / n for s, n in natural.items()) / min(powers[s] / n for s, n in natural.items()) == pytest.approx(3.0, rel=1e-6)
    for epochs in read.values():
        assert sorted(epochs) == list(range(1, len(epochs) + 1)) and set(epochs.values()) == {1}


def test_the_last_epoch_takes_blocks_in_the_order_of_its_permutation(frame):
    docs, texts, sources = corpus(frame, {"big": 500, "small": 200})
    plan = mixing.plan_mixture(docs, max_repeats=1.5)
    full = {r.source: r.full for r in plan.sources.collect()}
    out = mixing.mix(docs, plan).where("source = 'small'")
    last = {r.block for r in out.where(F.col("epoch") == full["small"] + 1).collect()}
    every = (
        docs.where("source = 'small'")
        .select(F.pmod(F.xxhash64(F.lit(mixing.SEED), "doc_id", "text"), F.lit(plan.blocks)).alias("b"))
        .distinct()
        .select("b", mixing.block_order(F.lit("small"), F.lit(full["small"] + 1), F.col("b")).alias("o"))
        .orderBy("o")
        .collect()
    )
    order = [r.b for r in every]
    assert last == set(order[: len(last)]) and 0 < len(last) < len(order)


def test_target_entropy_and_budget(frame):
    docs, texts, sources = corpus(frame, {"a": 400, "b": 100, "c": 10})
    plan = mixing.plan_mixture(docs, target_entropy=0.9, max_repeats=None, budget=2000.0)
    weights = [r.weight for r in plan.sources.collect()]
    assert sum(weights) == pytest.approx(1) and -sum(w * math.log(w) for w in weights) == pytest.approx(0.9, abs=1e-6)
    tokens, _ = read_tokens(mixing.mix(docs, plan), texts, sources)
    for r in plan.sources.collect():
        assert abs(tokens[r.source] - 2000 * r.weight) <= 3
    assert mixing.plan_mixture(docs, target_entropy=5.0, max_repeats=None).exponent == 0.0
    with pytest.raises(ValueError):
        mixing.plan_mixture(docs, budget=1e9, max_repeats=2.0)


def test_odd_rows_and_clashing_columns(frame):
    docs = frame([*ODD_TEXTS, "same text twice, same text twice"], [*range(len(ODD_TEXTS)), 5], extra=("epoch", "weight", "_h", "n"))
    out = mixing.mix_sources(docs)
    assert out.columns == ["doc_id", "text", "source", "_h", "n", "epoch", "block", "block_order", "weight"]
    assert Counter(r.doc_id for r in out.collect()) == Counter([*range(len(ODD_TEXTS)), 5])
    assert mixing.mix_sources(frame([])).count() == 0
    blank = mixing.mix_sources(frame([None, "", " "]))
    assert sorted(r.doc_id for r in blank.collect()) == [0, 1, 2]
