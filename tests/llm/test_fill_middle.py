import hashlib
import re

import numpy as np
import pytest
from conftest_llm import ODD_TEXTS
from hypothesis import given, settings
from hypothesis import strategies as st
import pyarrow as pa

from wareloom.llm import fill_middle as fim


def by_hand(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by string slices."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    return (len(units), *laid_out(text, units, h))


def laid_out(text, units, h):
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, n)))
    if h[3] % 100 < 20:
        return "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_odd_rows_as_by_hand(frame):
    texts = [*ODD_TEXTS, "with <P> inside", "<M>", "<", "<P", "P>", "é1é", "\n", "ab\x00cd", *[f"Text {i}: été 中 {i}!" for i in range(60)]]
    ids = [None, *range(1, len(texts))]
    rows = fim.restore(fim.fill_in_middle(frame(texts, ids, extra=("n", "form", "output")))).collect()
    got = {r.doc_id: (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in rows}
    assert got == {i: by_hand(i, t) for i, t in zip(ids, texts)}
    assert {r.doc_id: r.restored for r in rows} == {i: t or "" for i, t in zip(ids, texts)}
    assert {form for _, form, *_ in got.values()} == {"plain", "psm", "spm"}


def test_repeated_rows_and_digests(frame):
    docs = frame(["same text"] * 3 + ["other"], [5, 5, 5, 5])
    rows = fim.digests(fim.fill_in_middle(docs)).collect()
    assert len(rows) == 4 and len({r for r in rows}) == 2
    for r in rows:
        assert r.restored_sha256 in {hashlib.sha256(t).hexdigest() for t in (b"same text", b"other")}


def test_empty_table(frame):
    assert fim.digests(fim.fill_in_middle(frame([]))).collect() == []


pieces = st.lists(st.sampled_from(["a", "Bc", "<", ">", "P", "<P>", "<S", "M>", " ", "é", "中", "😀", "\n", "1"]), max_size=12)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(pieces.map("".join), *[st.integers(0, 2**32 - 1)] * 4), min_size=1, max_size=8), st.integers(0, 3))
def test_batches_as_by_hand_and_back(rows, skip):
    texts = pa.array([None] * skip + [r[0] for r in rows])[skip:]
    draws = np.array([r[1:] for r in rows], np.int64).T
    n, form, prefix, middle, out = fim.rearrange(texts, draws)
    for i, (text, *h) in enumerate(rows):
        units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
        assert n[i].as_py() == len(units)
        assert (form[i].as_py(), prefix[i].as_py(), middle[i].as_py(), out[i].as_py()) == laid_out(text, units, h)
    data, at = fim.flat_bytes(out)
    codes = np.array([fim.FORMS.index(f) for f in form.to_pylist()])
    assert fim.strings(*fim.gather(data, at, codes)).to_pylist() == [r[0] for r in rows]


def test_an_output_without_its_marks_is_refused():
    data, at = fim.flat_bytes(pa.array(["<P>only one mark"]))
    with pytest.raises(ValueError):
        fim.gather(data, at, np.array([fim.PSM]))
