import itertools
import zlib

import numpy as np
import pyarrow as pa
from conftest_llm import ODD_TEXTS
from pyspark.sql import functions as F

from wareloom.llm import line_crf as L


def test_marginals_match_enumeration():
    rng = np.random.default_rng(2)
    first = np.array([0, 4, 5, 8])
    score, trans = rng.normal(size=(8, 2)), rng.normal(size=(2, 2))
    log_z, marginal, pair = L.forward_backward(score, trans, first)
    pairs = np.zeros((2, 2))
    for d, (a, b) in enumerate(zip(first[:-1], first[1:])):
        weights, near = {}, np.zeros((b - a, 2))
        for path in itertools.product((0, 1), repeat=b - a):
            s = sum(score[a + i, y] for i, y in enumerate(path)) + sum(trans[x, y] for x, y in itertools.pairwise(path))
            weights[path] = np.exp(s)
        z = sum(weights.values())
        assert np.isclose(np.log(z), log_z[d])
        for path, w in weights.items():
            for i, y in enumerate(path):
                near[i, y] += w / z
            for x, y in itertools.pairwise(path):
                pairs[x, y] += w / z
        np.testing.assert_allclose(marginal[a:b], near)
    np.testing.assert_allclose(pair, pairs)


def test_features_of_lines_and_neighbours():
    x, length, first = L.line_features(pa.array(["ab cd\nAB CD\nab cd", None, "", "| a | b |"]))
    assert first.tolist() == [0, 3, 4, 5, 6] and length.tolist() == [5, 5, 5, 0, 0, 9]
    upper, repeats, bar = L.BASE.index("upper"), L.BASE.index("repeats_line"), L.BASE.index("bar")
    assert x[1, upper] == 0.8 and x[2, repeats] == 1 and x[0, repeats] == 0 and x[5, bar] == 3 / 5
    assert x[0, 2 * L.N_BASE + upper] == 0.8 and x[2, L.N_BASE + upper] == 0.8 and x[3, L.N_BASE + upper] == 0


def test_held_out_accuracy(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    scored = L.score_documents(docs, L.train(docs, labels))
    rows = scored.join(labels.select("doc_id", "quality"), "doc_id").collect()
    out = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(out) > 80 and np.mean([(r.score >= 0.5) == r.quality for r in out]) > 0.95
    assert scored.count() == docs.count()


def test_labels_of_the_held_out_fold_change_nothing(frame, spark):
    texts = [("good words here\n" * 3 + f"line {i}") if i % 2 else f"### {i} ***\n%%% $$$ &&&" for i in range(60)]
    docs = frame(texts)
    labels = [(i, i % 2) for i in range(60)]
    other = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    a, b = (L.train(docs, spark.createDataFrame(x, "doc_id long, quality int")) for x in (labels, other))
    np.testing.assert_array_equal(a["weights"], b["weights"])
    rows = L.score_documents(docs, a).collect()
    assert all((r.score >= 0.5) == (r.doc_id % 2 == 1) for r in rows)


def test_odd_rows(frame, spark):
    docs = frame([*ODD_TEXTS, "again"], [*range(len(ODD_TEXTS)), None], extra=("score", "label", "quality"))
    labels = spark.createDataFrame([(1, None), (None, 1), (4, 1), (4, 1), (7, 0), (9, 1)], "doc_id long, quality int")
    rows = L.score_documents(docs, L.train(docs, labels)).collect()
    assert len(rows) == len(ODD_TEXTS) + 1 and all(0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r.score for r in rows}
    assert by_id[0] == by_id[1] and by_id[5] == by_id[6]
    untrained = L.train(docs, labels.where(F.lit(False)))
    assert {r.score for r in L.score_documents(docs, untrained).collect()} == {0.5}
    assert L.score_documents(docs.limit(0), untrained).count() == 0
