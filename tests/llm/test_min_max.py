import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
from conftest_llm import ODD_TEXTS, WORD, lower_ascii

from wareloom.llm import min_max as M


def brute_sets(texts, length=4):
    out = []
    for t in texts:
        w = WORD.findall(lower_ascii(t or ""))
        shingles = [tuple(w[i : i + length]) for i in range(len(w) - length + 1)] or [tuple(w)] * bool(w)
        out.append(frozenset(shingles))
    return out


class Union:
    def __init__(self, n):
        self.p = list(range(n))

    def find(self, x):
        while self.p[x] != x:
            self.p[x] = self.p[self.p[x]]
            x = self.p[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.p[b] = a


def brute(texts, length=4):
    sets, u = brute_sets(texts, length), Union(len(texts))
    for a in range(len(texts)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if i and 100 * i >= 80 * len(sets[a] | sets[b]):
                u.join(a, b)
    return [(i, len(s), u.find(i), u.find(i) == i) for i, s in enumerate(sets)]


def near_copies(seed=3):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rng.randrange(20, 200))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(0, 12)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4, 8])):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return texts


def test_components_match_brute_force(frame):
    texts = [*ODD_TEXTS, "ONE", "A  b\tC", *near_copies()]
    rows = M.near_duplicates(frame(texts, extra=("set_id", "bucket", "label")).repartition(5)).collect()
    assert sorted(tuple(r) for r in rows) == brute(texts)


def test_a_chain_of_versions_in_one_bucket_is_followed(frame):
    """Each version is near the next, the ends are far apart, and no hub is near all."""
    base = [f"v{i}" for i in range(120)]
    texts = []
    for step in range(12):
        texts.append(" ".join(base))
        base = [f"n{step}" if i == 10 * step % 120 else w for i, w in enumerate(base)]
        base[(10 * step + 5) % 120] = f"m{step}"
    assert sorted(tuple(r) for r in M.near_duplicates(frame(texts)).collect()) == brute(texts)


def test_a_large_group_emits_few_pairs(frame, monkeypatch):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for k in range(300):
        copy = list(base)
        copy[rng.randrange(150)] = f"x{k}"
        texts.append(" ".join(copy))
    texts.append(" ".join(base))
    seen = []
    for name in ("hub_pairs", "front_pairs"):
        monkeypatch.setattr(M, name, lambda *a, real=getattr(M, name): seen.append(real(*a)) or seen[-1])
    rows = M.near_duplicates(frame(texts)).collect()
    assert {r.component_id for r in rows} == {0} and sum(r.kept for r in rows) == 1
    assert sum(p.count() for p in seen) < 20 * len(texts)


def test_a_family_without_links_makes_few_candidates(frame, monkeypatch):
    """Texts that share most of a passage, each with a fifth of its own: alike enough for a bucket, not for a link."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for k in range(150):
        at = rng.randrange(150)
        texts.append(" ".join([*base[:at], *[f"own{k}x{j}" for j in range(50)], *base[at + 50 :]]))
    texts += [t.replace(f"own{k}x3", "changed") for k, t in enumerate(texts[:20])]
    seen = []
    monkeypatch.setattr(M, "front_pairs", lambda *a, real=M.front_pairs: seen.append(real(*a)) or seen[-1])
    assert sorted(tuple(r) for r in M.near_duplicates(frame(texts)).collect()) == brute(texts)
    assert sum(p.count() for p in seen) < 4 * len(texts)


def test_front_pairs_hold_every_link_between_components(spark, frame):
    """All members open, each its own component: no pair that overlaps enough is missing."""
    texts = near_copies(8) + [" ".join(f"p{(i * k) % 23}" for i in range(30)) for k in range(1, 23)]
    sets = [(bytes([i]) * 16, s.tobytes(), len(s)) for i, s in enumerate(M.shingle_sets(pa.array(texts))) if len(s)]
    table = spark.createDataFrame(sets, "set_id binary, shingles binary, n int").repartition(4)
    members = table.selectExpr("set_id", "cast(n as long) as n_shingles", "hex(set_id) as label", "cast(conv(hex(substr(set_id, 1, 1)), 16, 10) as long) as id")
    found = {(r.a[0], r.b[0]) for r in M.front_pairs(members, table.select("set_id", "shingles")).collect()}
    wanted, own = set(), brute_sets(texts)
    for a in range(len(texts)):
        for b in range(a + 1, len(texts)):
            i = len(own[a] & own[b])
            if i and 100 * i >= 80 * len(own[a] | own[b]):
                wanted.add((a, b))
    assert wanted and wanted <= found


def test_minimum_and_maximum_estimate_the_overlap():
    rng = np.random.default_rng(0)
    hits = total = 0
    for _ in range(40):
        both, own = rng.integers(0, 2**64, 400, dtype=np.uint64), rng.integers(0, 2**64, (2, 50), dtype=np.uint64)
        sets = [np.unique(np.concatenate([both, o])) for o in own]  # overlap 400 / 500
        for k in range(len(M.FLIPS)):
            with np.errstate(over="ignore"):
                a, b = ((s ^ M.FLIPS[k]) * M.FACTORS[k] for s in sets)
            hits += int(a.min() == b.min()) + int(a.max() == b.max())
            total += 2
    assert abs(hits / total - 0.8) < 0.02


def test_short_and_equal_sets_hash_alike():
    sets = M.shingle_sets(pa.array(["a b", "b a", "A B", "a b c d", "a b c d a b c d", None]))
    assert sets[0].tolist() == sets[2].tolist() != sets[1].tolist() and len(sets[3]) == 1
    assert len(sets[4]) == 4 and len(sets[5]) == 0


def test_slices_of_a_batch_hash_like_whole_texts():
    texts = pa.array([f"Ünï{i} é WORD{i} ß {i} straße" for i in range(50)])
    part = texts.slice(17, 20)
    assert [s.tolist() for s in M.shingle_sets(part)] == [s.tolist() for s in M.shingle_sets(pa.array(part.to_pylist()))]


def test_connected_components(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(100, 140)]
    rng.shuffle(chain)
    edges = [*chain, *[(rng.randrange(60), rng.randrange(60)) for _ in range(40)], (5, 5)]
    u = Union(200)
    for a, b in edges:
        u.join(a, b)
    rows = M.connected(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.label for r in rows} == {i: u.find(i) for i in range(200) if u.find(i) != i}
    assert len(rows) == len({r.node for r in rows})
    assert M.connected(spark.createDataFrame([], "u long, v long")).count() == 0


def test_missing_and_repeated_ids(frame):
    text = "one two three four five six seven"
    rows = M.near_duplicates(frame([text, text, text, text, "other words stand here now", None], [None, 4, 4, 9, 9, 11])).collect()
    got = defaultdict(set)
    for r in rows:
        got[r.doc_id].add((r.component_id, r.kept))
    assert len(rows) == 6 and got[None] == {(None, True)} and got[4] == {(4, True)}
    assert got[9] == {(4, False), (9, True)} and got[11] == {(11, True)}
    assert M.near_duplicates(frame([])).count() == 0


def test_shingles_of_five_words_can_be_asked_for(frame):
    # Two changed words leave 70 of 86 four-word shingles common, but 67 of 87 of five.
    words = [f"w{k}" for k in range(81)]
    docs = frame([" ".join(words), " ".join(f"x{k}" if k in (20, 60) else w for k, w in enumerate(words))])
    assert M.near_duplicates(docs).where("kept").count() == 1
    assert M.near_duplicates(docs, 5).where("kept").count() == 2
