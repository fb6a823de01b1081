import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import ODD_TEXTS
from pyspark.sql import functions as F

from wareloom.llm import packing, separator_scan, tokens

END = 49407
WEIRD = [
    *ODD_TEXTS,
    "it's don't I'll  THE x\x1cy İstanbul ΣΑΣ ß ﬁ é K 123abc a.b.c <|endoftext|> x\xa0y　z",
    "ÀÖØÞßéÿ,, Ab!? ab... !!! %%%\n\n\ttab\x0bvt\x0cff\rcr\x85nel",
    "日本語 テキスト 한국어 😀😀 a😀 é ño",
]


def true_ids(vocabulary, texts):
    coder = tokens.word_tokenizer(vocabulary).tokenizer
    return [e.ids for e in coder.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_ids_equal_the_tokenizers(vocabulary):
    coder = tokens.WordTokenizer(vocabulary)
    for _ in range(2):  # the second time from memory
        ids, begin = coder.encode_texts(pa.array(WEIRD))
        assert [ids[a:b].tolist() for a, b in zip(begin[:-1], begin[1:])] == true_ids(vocabulary, WEIRD)
    coder.clear()
    assert coder.encode_texts(pa.array([], pa.string()))[0].tolist() == []


@pytest.mark.parametrize("block", [1, 7, 5000])
def test_counts_are_stitched_over_blocks(frame, vocabulary, monkeypatch, block):
    monkeypatch.setattr(separator_scan, "BLOCKS_PER_GROUP", 3)
    texts = [t[:400] if t else t for t in WEIRD]
    docs = frame(texts, extra=("file", "n")).repartition(3)
    rows = separator_scan.count_documents(docs, vocabulary, END, block_tokens=block).collect()
    want = {i: len(x) for i, x in enumerate(true_ids(vocabulary, texts))}
    assert {r.doc_id: r.n_tokens for r in rows} == want and len(rows) == len(texts)
    by_file = defaultdict(list)
    for r in rows:
        by_file[r.file].append((r.ordinal, r.start, r.n_tokens))
    for places in by_file.values():
        at = 0
        for k, (ordinal, start, n) in enumerate(sorted(places)):
            assert (ordinal, start) == (k, at)
            at += n + 1


def test_flat_files_and_an_unclosed_rest(spark, tmp_path):
    rng = random.Random(1)
    want = {}
    for name, closed in (("a", True), ("b", False), ("c", True)):
        sizes = [rng.randrange(0, 30) for _ in range(50)]
        stream = [t for n in sizes for t in [*[5] * n, END]]
        stream = stream if closed else stream[:-1] + [7, 7]
        np.array(stream, "<u2").tofile(tmp_path / f"{name}.bin")
        want[name] = sizes if closed else [*sizes[:-1], sizes[-1] + 2]
    blocks = separator_scan.file_blocks(spark, str(tmp_path), block_tokens=11)
    rows = separator_scan.count_tokens(blocks, END).collect()
    got = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.ordinal):
        got[r.file.rsplit("/", 1)[1][0]].append(r.n_tokens)
    assert dict(got) == want
    assert [r.closed for r in rows if not r.closed] == [False]


def test_a_file_is_read_in_ranges_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(separator_scan, "RUN_BYTES", 1000)
    monkeypatch.setattr(separator_scan, "TASK_BYTES", 1000)
    rng = random.Random(2)
    sizes = [rng.randrange(0, 90) for _ in range(400)]
    stream = np.array([t for n in sizes for t in [*[5] * n, END]], "<u4")
    (tmp_path / "with blank").mkdir()
    stream.tofile(tmp_path / "with blank" / "one.bin")
    blocks = separator_scan.file_blocks(spark, str(tmp_path / "with blank"), 4, 64)
    placed = blocks.select("block", "tokens", F.spark_partition_id().alias("task")).collect()
    assert len({r.task for r in placed}) > 8 and max(len(r.tokens) for r in placed) == 256
    assert b"".join(bytes(r.tokens) for r in sorted(placed, key=lambda r: r.block)) == stream.tobytes()
    rows = sorted(separator_scan.count_tokens(blocks, END, 4).collect(), key=lambda r: r.ordinal)
    assert [r.n_tokens for r in rows] == sizes


def test_files_of_lost_attempts_are_not_counted(frame, vocabulary, tmp_path):
    folder = f"file://{tmp_path}/files"
    names = separator_scan.write_files(frame(["a b", "c"]).repartition(1), vocabulary, END, folder)
    np.array([1, 2, END], "<u2").tofile(tmp_path / "files" / "000000-999.bin")
    files = {r.file for r in names.select("file").collect()}
    assert len(files) == 1 and "000000-999.bin" not in files


def test_no_documents(frame, vocabulary):
    assert separator_scan.count_documents(frame([]), vocabulary, END).count() == 0
    assert packing.pack_documents(frame([]), vocabulary).count() == 0


def fewest(pieces, capacity):
    """Optimal number of sequences by trying all placements."""
    best = len(pieces)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(pieces):
            best = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms)}.values():
            if rooms[k] >= pieces[i]:
                place(i + 1, [r - pieces[i] if j == k else r for j, r in enumerate(rooms)])
        place(i + 1, [*rooms, capacity - pieces[i]])

    pieces = sorted(pieces, reverse=True)
    place(0, [])
    return best


def counted(pieces):
    return {n: pieces.count(n) for n in set(pieces)}


def test_small_packings_are_optimal():
    rng = random.Random(5)
    for _ in range(60):
        pieces = [rng.randrange(1, 21) for _ in range(rng.randrange(1, 11))]
        patterns = packing.pack_lengths(counted(pieces), 20)
        used = [n for filling, copies in patterns for n, times in filling for _ in range(times * copies)]
        assert sorted(used) == sorted(pieces)
        assert all(sum(n * times for n, times in filling) <= 20 for filling, _ in patterns)
        assert packing.sequences(patterns) == fewest(pieces, 20)
        assert packing.lower_bound(counted(pieces), 20) <= fewest(pieces, 20)


def test_bin_completion_beats_best_fit():
    counts = {1500: 7, 1400: 9, 1300: 11, 1200: 8, 1000: 5, 2000: 6, 2100: 3}
    greedy = packing.dive(counts, 4096, lambda s: packing.best_fit(s, 4096))
    assert packing.sequences(packing.pack_lengths(counts)) < packing.sequences(greedy)


def test_dominated_fillings_are_left_out():
    stock = packing.Stock({60: 1, 40: 1, 30: 1, 25: 1})
    fillings = [f for _, f in packing.completions(stock, 100)]
    assert fillings[0] == ((60, 1), (40, 1)) and ((60, 1), (30, 1)) not in fillings


def test_packed_pieces_are_whole_and_gapless(frame, vocabulary):
    texts = [*WEIRD, *[f"word{i} " * (i % 37) for i in range(300)], *["tie tie tie"] * 50]
    ids = [None, *range(1, len(texts) - 1), 5]  # a null and a repeated id
    rows = packing.pack_documents(frame(texts, ids, extra=("length", "piece")), vocabulary, capacity=256).collect()
    want = [[*x, 1] for x in true_ids(vocabulary, texts)]
    pieces = sorted((bytes(r.ids), r.length) for r in rows)
    cut = [np.array(x[k : k + 256], "<u4") for x in want for k in range(0, len(x), 256)]
    assert pieces == sorted((x.tobytes(), len(x)) for x in cut)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        assert r.start == 256 * r.piece
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    counts = counted([len(x) for x in cut])
    assert len(sequences) == packing.sequences(packing.pack_lengths(counts, 256))
    assert len(sequences) <= packing.lower_bound(counts, 256) + 1


def test_payload_replaces_the_ids(frame, vocabulary):
    import zlib

    rows = packing.pack_documents(frame(["a b c", None]), vocabulary, payload=F.crc32("ids").alias("crc")).collect()
    want = [zlib.crc32(np.array([*x, 1], "<u4").tobytes()) for x in true_ids(vocabulary, ["a b c", ""])]
    assert {r.doc_id: r.crc for r in rows} == dict(enumerate(want))


def test_without_bounds_the_search_is_complete():
    rng = random.Random(9)
    for _ in range(25):
        pieces = [rng.randrange(3, 31) for _ in range(rng.randrange(6, 12))]
        patterns = packing.pack_lengths(counted(pieces), 30, effort=10**6, look=None)
        assert packing.sequences(patterns) == fewest(pieces, 30)


def test_helper_names_do_not_clash(spark):
    pieces = spark.createDataFrame([(i, 0, 1 + i % 3, 7, 8, 9) for i in range(20)], "doc_id long, piece int, length long, _salt int, _rank int, _n int")
    rows = packing.pack(pieces, 4).collect()
    assert len(rows) == 20 and all((r._salt, r._rank, r._n) == (7, 8, 9) for r in rows)
