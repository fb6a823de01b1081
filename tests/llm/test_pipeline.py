from collections import Counter, defaultdict

import pytest
from conftest_llm import WORD
from test_min_max import brute as brute_groups
from test_quality_rules import brute as brute_quality
from test_sanitise import brute as brute_spans

import corpus_pipeline
from wareloom.llm import quality_rules as Q
from wareloom.llm.common import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(materialize(stage(spark, frames[-1], SF), "test-stage"))
    return [f.collect() for f in frames], [f.columns for f in frames]


def test_columns_stay_until_the_last_stage(steps):
    _, columns = steps
    assert all(c == columns[0] for c in columns[:-1])


def test_quality_keeps_what_no_rule_rejects(steps, spark):
    (docs, kept, *_), _ = steps
    assert {r.doc_id for r in kept} <= {r.doc_id for r in docs if not brute_quality(r.text)[-1]}
    report = Q.quality_report(spark.read.parquet(f"{SF}/documents.parquet"))
    assert {r.doc_id for r in kept} == {r.doc_id for r in report.where("kept").collect()}


def test_one_document_of_each_group_stays(steps):
    (_, docs, kept, *_), _ = steps
    docs = sorted(docs, key=lambda r: r.doc_id)
    groups = brute_groups([r.text for r in docs], corpus_pipeline.SHINGLE_WORDS)
    assert sorted(r.doc_id for r in kept) == [docs[i].doc_id for i, _, _, first in groups if first]
    text = {r.doc_id: r.text for r in docs}
    assert all(r.text == text[r.doc_id] for r in kept)


def test_personal_data_is_masked_and_clean_texts_stay(steps):
    (_, _, docs, clean, *_), _ = steps
    before = {r.doc_id: r.text for r in docs}
    assert len(clean) == len(docs)
    for r in clean:
        assert not brute_spans(r.text) and r.n_chars == len(r.text)
        if not brute_spans(before[r.doc_id]):
            assert r.text == before[r.doc_id]


def test_every_document_is_read_at_least_once(steps):
    (_, _, _, docs, mixed, _), _ = steps
    assert {r.doc_id for r in mixed} == {r.doc_id for r in docs}
    tokens = Counter()
    for r in docs:
        tokens[r.source] += len(WORD.findall(r.text))
    read = Counter()
    for r in mixed:
        read[r.source] += len(WORD.findall(r.text))
    assert all(read[s] / tokens[s] < 3.5 for s in tokens)


def test_sequences_hold_every_reading(steps):
    (*_, mixed, packed), _ = steps
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r.doc_id for r in mixed)
    places = defaultdict(list)
    for r in packed:
        places[r.sequence_id].append((r.offset, r.length))
    for rows in places.values():
        rows.sort()
        assert [o for o, _ in rows] == [sum(n for _, n in rows[:i]) for i in range(len(rows))]
        assert sum(n for _, n in rows) <= 4096


def test_odd_documents_pass_all_stages(spark):
    rows = [(1, None, "en", None, 0), (1, None, "en", None, 0), (None, "", None, "s", None), (2, "word " * 5, "en", "s", 25)]
    rows += [(10 + i, " ".join(f"w{i}x{k}" for k in range(30)), "en", "s", 1) for i in range(4)] + [(10, " ".join(f"w0x{k}" for k in range(30)), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            frame = materialize(stage(spark, frame, SF), "test-odd")
        found = {r.doc_id for r in frame.collect()}
        assert found in ({10, 11, 12, 13}, set())


def test_rows_that_share_a_doc_id_stay_or_go_by_their_own_text(spark):
    text = lambda name, n=40: " ".join(f"{name}{k}" for k in range(n))
    near = text("n") + " end"
    rows = [(1, text("a")), (5, text("a")), (5, text("b")), (2, text("n")), (6, near), (6, text("c")), (7, text("d")), (7, text("e")), (7, text("e"))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted((r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect())
    assert kept == [(1, text("a")), (2, text("n")), (5, text("b")), (6, text("c")), (7, text("d")), (7, text("e"))]
