import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest_llm import ODD_TEXTS, lower_ascii
from wareloom.llm import divergence, transducer

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return [lower_ascii(t) for t in TERM.findall(text or "")]


def look_up(machine, terms):
    data = np.frombuffer(b"".join(terms), np.uint8)
    sizes = np.array([len(t) for t in terms], np.int64)
    return machine.ordinals(data, np.cumsum(sizes) - sizes, sizes).tolist()


words = st.binary(min_size=1, max_size=6).map(lambda b: bytes(97 + x % 4 for x in b))


@settings(max_examples=200, deadline=None)
@given(st.sets(words, max_size=60), st.lists(words, max_size=30))
def test_ordinals_are_places_among_sorted_terms(kept, others):
    order = sorted(kept)
    machine = transducer.build(order)
    place = {t: i for i, t in enumerate(order)}
    asked = [*order, *others]
    assert look_up(machine, asked) == [place.get(t, -1) for t in asked]


def test_no_two_states_go_on_alike():
    terms = sorted({f"{a}{b}ing".encode() for a in "abc" for b in "xyz"} | {f"{a}{b}".encode() for a in "abc" for b in "xyz"})
    machine = transducer.build(terms)
    # Root, three first letters as one state, three second ones as one, then i, n, g.
    assert machine.states == 6
    assert look_up(machine, terms) == list(range(len(terms)))


@pytest.mark.parametrize("terms", [[b"b", b"a"], [b"a", b"a"], [b"ab", b"a"]])
def test_terms_out_of_order_are_refused(terms):
    with pytest.raises(ValueError):
        transducer.build(terms)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBé中 1-<\n", max_size=15)), max_size=8))
def test_terms_of_a_batch(texts):
    found = divergence.find_terms(pa.array(texts, pa.string()))
    data = found.data.tobytes()
    got = [(int(o), data[s : s + n].decode()) for o, s, n in zip(found.owner, found.starts, found.sizes)]
    assert got == [(i, t) for i, text in enumerate(texts) for t in terms_of(text)]


def by_hand(rows, min_documents, top):
    """Audit of (lang, source, text) rows by plain counting."""
    rows = [tuple(x or "" for x in r) for r in rows]
    held, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        held[lang].update(set(terms_of(text)))
        counts[lang, source].update(terms_of(text))
    kept = {lang: sorted((t for t, n in c.items() if n >= min_documents), key=str.encode) for lang, c in held.items()}

    def rates(lang, count):
        terms = kept[lang]
        total = sum(count[t] for t in terms)
        return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(terms)) for t in terms}

    out = []
    for lang, source in counts:
        p = rates(lang, counts[lang, source])
        q = rates(lang, sum((c for (x, _), c in counts.items() if x == lang), Counter()))
        others = [(sum(abs(p[t] - o[t]) for t in p), s) for x, s in counts if x == lang and s != source for o in [rates(lang, counts[x, s])]]
        above = [(p[t] - q[t], t) for t in p if counts[lang, source][t] and p[t] > q[t]]
        for part, found, most in (("pair", others, None), ("term", above, top)):
            ordered = sorted(found, key=lambda v: (-v[0], v[1].encode()))[:most]
            out += [(lang, source, part, item, value, rank) for rank, (value, item) in enumerate(ordered, 1)]
    return sorted(out)


def corpus():
    """Three sources of unequal size, a language without kept terms, and odd rows."""
    some = "alpha beta Gamma delta été naïve 中文 zeta eta theta iota kappa".split()
    rows = []
    for i in range(240):
        source = ["big", "big", "small", "other"][i % 4]
        rows.append(("en" if i % 3 else "fr", source, " ".join(some[(i * k) % (7 if source == "big" else 12)] for k in range(1, 12))))
    rows += [("xx", s, "rare words") for s in ("a", "b")] + [(None, None, None), ("en", None, "12 34"), ("en", "empty", "")]
    rows += [("en", "big", t) for t in ODD_TEXTS] + [("en", "big", "same row again")] * 6
    return rows


@pytest.fixture
def table(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, source string, text string, term string, n int")

    return make


def result(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect())


def test_audit_as_by_hand(table):
    rows = corpus()
    assert result(divergence.audit(table(rows), 5, 4)) == by_hand(rows, 5, 4)


def test_small_blocks_waves_and_chunks_change_nothing(table, monkeypatch):
    rows = corpus()
    docs = table(rows)
    whole = divergence.recount(docs, divergence.transducers(divergence.kept_terms(docs, 5)))
    parts = divergence.recount(docs.repartition(5), divergence.transducers(divergence.kept_terms(docs, 5), 3), 1)
    assert sorted(whole.collect()) == sorted(parts.collect())
    rates = whole.select("lang", "source", "ordinal", (F.col("n") * 1000).alias("p"))
    groups = whole.select("lang", "source").distinct().join(whole.groupBy("lang").agg((F.max("ordinal") + 1).alias("terms")), "lang")
    groups = groups.withColumn("none", F.lit(7).cast("long"))
    assert sorted(divergence.distances(rates, groups).collect()) == sorted(divergence.distances(rates, groups, 1).collect())


def test_counts_beyond_64_bits_stay_exact(spark):
    n, total, terms = 4 * 10**17, 9 * 10**17, 10**6
    got = spark.range(1).select(divergence.rate(f"{n}L", f"{total}L", f"{terms}L").alias("p")).first().p
    assert got == 1 + 10**9 * (n + 5) // (total + 5 * terms)


def test_nothing_kept_and_empty_table(table):
    rows = [("en", "a", "x"), ("en", "b", "y"), ("en", "c", None)]
    assert result(divergence.audit(table(rows))) == by_hand(rows, 30, 50)
    assert divergence.audit(table([])).collect() == []
