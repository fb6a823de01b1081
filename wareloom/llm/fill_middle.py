"""Fill-in-the-middle by displacement scatter.

A text is cut at two of its tokens into prefix, middle and suffix; marked pieces are
put together in another order, so a model learns to write the middle last. No piece
is copied on its own: for a batch of texts, the cuts are found by one scan of the
bytes, a difference array gets at each cut by how much the bytes behind it move, its
cumulative sum is every byte's displacement, and one scatter builds all outputs.
``restore`` finds the marks in the outputs alone and gathers the texts back by the
inverse displacement.

Tokens are runs of ASCII letters, every other code point is one. Null and empty texts
stay plain, as do texts that contain a mark. Cuts come from the sha256 of
``seed:doc_id`` (a null doc_id is the empty string), so repeated ids are cut by the
same draws and repeated rows alike. Other columns are not looked at. An empty table
gives no rows. Texts are handled in slices of about ``SLICE_BYTES``, a longer one by
itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareloom.llm.tokens import flat_bytes, text_batches

# Marks, seed of the draws, hundredths that stay plain and that put the suffix first.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
PLAIN_FROM = 90
SUFFIX_FIRST = 20

SLICE_BYTES = 4_000_000
MARK = len(PREFIX)
FORMS = ("plain", "psm", "spm")
PLAIN, PSM, SPM = range(3)

_BYTES = np.arange(256)
IS_LETTER = ((_BYTES >= ord("A")) & (_BYTES <= ord("Z"))) | ((_BYTES >= ord("a")) & (_BYTES <= ord("z")))
STARTS_POINT = (_BYTES & 0xC0) != 0x80


def mark_positions(data: np.ndarray) -> np.ndarray:
    """Where a mark begins, texts taken as one."""
    if len(data) < MARK:
        return np.zeros(0, np.int64)
    name = data[1:-1]
    named = (name == ord("P")) | (name == ord("S")) | (name == ord("M"))
    return np.flatnonzero((data[:-2] == ord("<")) & named & (data[2:] == ord(">")))


def marked(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which texts contain a mark."""
    hits = mark_positions(data)
    owner = np.searchsorted(at, hits, side="right") - 1
    found = np.zeros(len(at) - 1, bool)
    found[owner[hits + MARK <= at[owner + 1]]] = True
    return found


def token_starts(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where tokens begin, and how many there are before each text (one more at the end)."""
    starts, letter = STARTS_POINT[data], IS_LETTER[data]
    starts[1:] &= ~(letter[1:] & letter[:-1])
    starts[at[:-1][at[:-1] < at[1:]]] = True
    found = np.flatnonzero(starts)
    return found, np.searchsorted(found, at)


def displacements(n: int, at: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """For each of ``n`` places the move of the last boundary at or before it; boundaries and moves in order."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, at, np.diff(moves, prepend=0))
    return np.cumsum(steps[:n])


def scatter(data: np.ndarray, at: np.ndarray, one: np.ndarray, two: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Outputs one after the other and where each begins; ``one`` and ``two`` are the cuts as places in ``data``."""
    changed = form != PLAIN
    begin, size = at[:-1], np.diff(at)
    out_at = np.concatenate([[0], np.cumsum(size + 3 * MARK * changed)])
    base, a, b = out_at[:-1] - begin, one - begin, two - begin
    tail = size - b
    # By how much each piece moves inside its own text.
    prefix = np.select([form == PSM, form == SPM], [MARK + 0 * a, 2 * MARK + tail], 0)
    middle = np.where(changed, 3 * MARK + tail, 0)
    suffix = np.select([form == PSM, form == SPM], [2 * MARK + a - b, MARK - b], 0)
    bounds = np.stack([begin, one, two], 1).ravel()
    moves = np.stack([base + prefix, base + middle, base + suffix], 1).ravel()
    out = np.empty(out_at[-1], np.uint8)
    out[np.arange(len(data)) + displacements(len(data), bounds, moves)] = data
    heads = {
        PREFIX: np.where(form == PSM, 0, MARK + tail),
        SUFFIX: np.where(form == PSM, MARK + a, 0),
        MIDDLE: 2 * MARK + a + tail,
    }
    for mark, head in heads.items():
        place = (out_at[:-1] + head)[changed]
        for k, char in enumerate(mark.encode()):
            out[place + k] = char
    return out, out_at


def gather(out: np.ndarray, out_at: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts behind outputs, found from outputs and forms alone, and where each begins."""
    changed = np.flatnonzero(form != PLAIN)
    hits = mark_positions(out)
    owner = np.searchsorted(out_at, hits, side="right") - 1
    own = (form[owner] != PLAIN) & (hits + MARK <= out_at[owner + 1])
    hits = hits[own]
    if len(hits) != 3 * len(changed) or not np.array_equal(owner[own], np.repeat(changed, 3)):
        raise ValueError("an output does not hold its three marks")
    begin, end = out_at[:-1], out_at[1:]
    first, second, third = (begin.copy() for _ in range(3))
    if len(changed):
        first[changed], second[changed], third[changed] = hits.reshape(-1, 3).T
    lead, follow, middle = second - first - MARK, third - second - MARK, end - third - MARK
    psm, plain = form == PSM, form == PLAIN
    prefix_at, suffix_at = np.where(psm, first, second) + MARK, np.where(psm, second, first) + MARK
    prefix = np.where(plain, end - begin, np.where(psm, lead, follow))
    suffix = np.where(plain, 0, np.where(psm, follow, lead))
    middle = np.where(plain, 0, middle)
    prefix_at = np.where(plain, begin, prefix_at)
    at = np.concatenate([[0], np.cumsum(prefix + middle + suffix)])
    one, two = at[:-1] + prefix, at[:-1] + prefix + middle
    bounds = np.stack([at[:-1], one, two], 1).ravel()
    moves = np.stack([prefix_at - at[:-1], third + MARK - one, suffix_at - two], 1).ravel()
    return out[np.arange(at[-1]) + displacements(at[-1], bounds, moves)], at


def strings(data: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data)))


def rearrange(texts: pa.Array, draws: np.ndarray) -> list[pa.Array]:
    """n, form, prefix_chars, middle_chars and output of each text; ``draws`` are four numbers each."""
    data, at = flat_bytes(texts)
    starts, before = token_starts(data, at)
    n = np.diff(before)
    h1, h2, h3, h4 = draws
    low, high = np.minimum(h1 % (n + 1), h2 % (n + 1)), np.maximum(h1 % (n + 1), h2 % (n + 1))
    plain = (n == 0) | marked(data, at) | (h3 % 100 >= PLAIN_FROM)
    form = np.where(plain, PLAIN, np.where(h4 % 100 < SUFFIX_FIRST, SPM, PSM))
    starts = np.append(starts, len(data))
    place = lambda unit: np.where(unit == n, at[1:], starts[before[:-1] + unit])
    one, two = place(low), place(high)
    points = np.concatenate([[0], np.cumsum(STARTS_POINT[data])])
    out, out_at = scatter(data, at, one, two, form)
    return [
        pa.array(n, pa.int64()),
        pa.array(np.array(FORMS)[form], pa.string()),
        pa.array(points[one] - points[at[:-1]], pa.int64(), mask=plain),
        pa.array(points[two] - points[one], pa.int64(), mask=plain),
        strings(out, out_at),
    ]


def draw(doc_id: Column) -> list[Column]:
    """Four numbers from the first 32 digits of a sha256."""
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every document."""
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_batches(whole, 1, SLICE_BYTES):
                draws = np.stack([c.to_numpy() for c in batch.columns[2:]])
                yield pa.RecordBatch.from_arrays([batch.column(0), *rearrange(batch.column(1), draws)], names)

    columns = docs.select("doc_id", "text", *draw(F.col("doc_id")))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return columns.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(changed: DataFrame) -> DataFrame:
    """The rows of ``fill_in_middle`` with ``restored``, the text rebuilt from ``output`` and ``form``."""
    kept = [c for c in changed.columns if c != "restored"]
    rows = changed.select("output", "form", *[c for c in kept if c not in ("output", "form")])
    schema = T.StructType([*rows.schema.fields, T.StructField("restored", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_batches(whole, 0, SLICE_BYTES):
                out, out_at = flat_bytes(batch.column(0))
                form = np.array([FORMS.index(f) for f in batch.column(1).to_pylist()], np.int64)
                texts, at = gather(out, out_at, form)
                yield pa.RecordBatch.from_arrays([*batch.columns, strings(texts, at)], schema.names)

    return rows.mapInArrow(run, schema).select(*kept, "restored")


def digests(changed: DataFrame) -> DataFrame:
    """Digest columns of outputs and of the texts restored from them."""
    return restore(changed).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


ORACLE = f"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS d
  FROM documents
), drawn AS (
  SELECT doc_id, t, u, len(u) AS n,
         ('0x' || substr(d, 1, 8))::BIGINT % (len(u) + 1) AS x, ('0x' || substr(d, 9, 8))::BIGINT % (len(u) + 1) AS y,
         CASE WHEN t = '' OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}') OR contains(t, '{MIDDLE}')
                OR ('0x' || substr(d, 17, 8))::BIGINT % 100 >= {PLAIN_FROM} THEN 'plain'
              WHEN ('0x' || substr(d, 25, 8))::BIGINT % 100 < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
  FROM units
), cut AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:least(x, y)], '') AS p,
         array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m, array_to_string(u[greatest(x, y) + 1:], '') AS s
  FROM drawn
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
                        ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
       sha256(p || m || s) AS restored_sha256
FROM cut
"""
