"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are shares of character kinds, word
statistics and repetition within the document, together with the same features
of the line before and after. Learned from documents with a quality label, whose
lines take the label of their document, by maximum likelihood. A document's
score is the mean forward-backward marginal of its lines, weighted by length.

Null texts count as empty; an empty text is one line without characters. Without
labelled rows all weights are zero and every score is 0.5. Repeated rows score
alike, and no other column than the text enters a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: At most so many labelled documents, of at most so many lines each, are learned from.
TRAIN_DOCS = 2000
TRAIN_LINES = 200

BASE = (
    "upper lower digit symbol bang bar stop other high words no_words word_length repeats_line repeats_word "
    "repeats_window one_word"
).split()
N_BASE = len(BASE)
N_FEATURES = 3 * N_BASE + 3  # the line, the one before, the one after; bias, first, last


def kinds_of_bytes() -> np.ndarray:
    """Kind of each byte: 0 blank, then as in BASE."""
    kind = np.full(256, 8, np.uint8)
    kind[ord("A") : ord("Z") + 1] = 1
    kind[ord("a") : ord("z") + 1] = 2
    kind[ord("0") : ord("9") + 1] = 3
    kind[list(b"#*$%&<>@^~=+\\/{}[]_`")] = 4
    kind[list(b"!?")] = 5
    kind[ord("|")] = 6
    kind[list(b".,;:")] = 7
    kind[128:] = 9
    kind[list(b" \t\n\r\x0b\x0c")] = 0
    return kind


KINDS = kinds_of_bytes()


def segment_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[ends] - total[starts]


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, their lengths in bytes and the first line of each document (one more at the end)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lines = pc.split_pattern(texts, "\n")
    first = lines.offsets.to_numpy()
    first = first - first[0]
    flat = lines.flatten()
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    n = len(flat)

    ends = np.cumsum(pc.binary_length(flat).to_numpy(zero_copy_only=False))
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    length = ends - starts
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + n + 1]
    data = flat.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and n else np.zeros(0, np.uint8)
    kind = KINDS[raw]

    x = np.zeros((n, N_BASE))
    size = np.maximum(length, 1)
    for k in range(1, 10):
        x[:, k - 1] = segment_sums(kind == k, starts, ends) / size

    split = pc.ascii_split_whitespace(flat)
    at = split.offsets.to_numpy()
    at = (at - at[0]).astype(np.int64)
    tokens = split.flatten().filter(pc.greater(pc.binary_length(split.flatten()), 0))
    counted = pc.greater(pc.binary_length(split.flatten()), 0).to_numpy(zero_copy_only=False)
    at = np.concatenate([[0], np.cumsum(counted)])[at].astype(np.int64)
    words = np.diff(at)
    per_word = np.maximum(words, 1)[:, None]
    x[:, 3:7] = np.minimum(x[:, 3:7] * size[:, None] / per_word, 2)  # symbols, bangs, bars and stops per word
    x[:, 9] = np.log1p(words) / 5
    x[:, 10] = words == 0
    x[:, 11] = segment_sums(kind != 0, starts, ends) / np.maximum(words, 1) / 10

    codes = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    x[:, 12] = repeated(doc * (n + 1) + codes, earlier_only=True) & (words > 0)

    m = len(tokens)
    if m:
        code = tokens.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.uint64)
        token_line = np.repeat(np.arange(n), words)
        token_doc = doc[token_line]
        again = np.zeros(m, bool)
        again[1:] = (code[1:] == code[:-1]) & (token_doc[1:] == token_doc[:-1])
        x[:, 13] = segment_sums(again, at[:-1], at[1:]) / np.maximum(words, 1)
        x[:, 14] = segment_sums(in_repeated_window(code, token_doc), at[:-1], at[1:]) / np.maximum(words, 1)
    x[:, 15] = words == 1

    whole = np.zeros((n, N_FEATURES))
    whole[:, :N_BASE] = x
    inner = np.ones(n, bool)
    inner[first[:-1]] = False
    whole[1:, N_BASE : 2 * N_BASE][inner[1:]] = x[:-1][inner[1:]]
    whole[:-1, 2 * N_BASE : 3 * N_BASE][inner[1:]] = x[1:][inner[1:]]
    whole[:, -3] = 1
    whole[first[:-1], -2] = 1
    whole[first[1:] - 1, -1] = 1
    return whole, length.astype(np.float64), first.astype(np.int64)


def repeated(keys: np.ndarray, earlier_only: bool = False) -> np.ndarray:
    """Whether a key occurs elsewhere, or before, in the array."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:]] = same
    if not earlier_only:
        out[order[:-1]] |= same
    return out


def in_repeated_window(code: np.ndarray, doc: np.ndarray, width: int = 5) -> np.ndarray:
    """Whether a word is part of a window of five words that its document has twice."""
    m = len(code)
    out = np.zeros(m, bool)
    if m < width:
        return out
    with np.errstate(over="ignore"):
        h = doc[: m - width + 1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(width):
            h = (h ^ code[k : m - width + 1 + k]) * np.uint64(0xC2B2AE3D27D4EB4F)
            h ^= h >> np.uint64(29)
    whole = doc[: m - width + 1] == doc[width - 1 :]
    hit = repeated(h) & whole
    for k in range(width):
        out[k : m - width + 1 + k] |= hit
    return out


def step_order(first: np.ndarray) -> list[np.ndarray]:
    """For each position the documents that have a line there."""
    counts = np.diff(first)
    longest = np.argsort(-counts, kind="stable")
    alive = np.searchsorted(-counts[longest], -np.arange(int(counts.max(initial=0))), side="left")
    return [longest[:k] for k in alive]


def forward_backward(score: np.ndarray, trans: np.ndarray, first: np.ndarray):
    """Log-partition, line marginals and summed pair marginals of documents of two-label chains."""
    n, steps = len(score), step_order(first)
    alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
    for t, docs in enumerate(steps):
        at = first[docs] + t
        if t == 0:
            alpha[at] = score[at]
        else:
            alpha[at] = score[at] + np.logaddexp(
                alpha[at - 1][:, :1] + trans[0], alpha[at - 1][:, 1:] + trans[1]
            )
    for t in range(len(steps) - 2, -1, -1):
        at = first[steps[t + 1]] + t
        ahead = score[at + 1] + beta[at + 1]
        beta[at] = np.logaddexp(ahead[:, :1] + trans[:, 0], ahead[:, 1:] + trans[:, 1])
    last = first[1:] - 1
    log_z = np.logaddexp(alpha[last, 0], alpha[last, 1])
    per_line = np.repeat(log_z, np.diff(first))
    marginal = np.exp(alpha + beta - per_line[:, None])
    inner = np.ones(n, bool)
    inner[first[:-1]] = False
    i = np.flatnonzero(inner)
    pair = np.exp(
        alpha[i - 1][:, :, None] + trans[None] + (score[i] + beta[i])[:, None, :] - per_line[i][:, None, None]
    )
    return log_z, marginal, pair.sum(0)


def fit(x: np.ndarray, length: np.ndarray, first: np.ndarray, quality: np.ndarray, rounds: int = 120, ridge: float = 1.0) -> dict:
    """Weights by maximum likelihood with a ridge penalty (Adam, all documents each round)."""
    weights, trans = np.zeros((x.shape[1], 2)), np.zeros((2, 2))
    model = {"weights": weights, "trans": trans, "scale": (1.0, 0.0)}
    if not len(quality):
        return model
    label = np.repeat(quality, np.diff(first))
    gold = np.eye(2)[label]
    seen = x.T @ gold
    inner = np.ones(len(x), bool)
    inner[first[:-1]] = False
    pairs = np.zeros((2, 2))
    np.add.at(pairs, (label[:-1][inner[1:]], label[1:][inner[1:]]), 1)
    moments = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(trans), np.zeros_like(trans)]
    for r in range(1, rounds + 1):
        _, marginal, pair = forward_backward(x @ weights, trans, first)
        for value, grad, k in (
            (weights, x.T @ marginal - seen + ridge * weights, 0),
            (trans, pair - pairs + ridge * trans, 2),
        ):
            grad = grad / len(x)
            moments[k] = 0.9 * moments[k] + 0.1 * grad
            moments[k + 1] = 0.99 * moments[k + 1] + 0.01 * grad**2
            value -= 0.1 * (moments[k] / (1 - 0.9**r)) / (np.sqrt(moments[k + 1] / (1 - 0.99**r)) + 1e-9)
    model["scale"] = calibrate(mean_marginals(x, length, first, model), quality)
    return model


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def calibrate(mean: np.ndarray, quality: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """Slope and shift that turn mean marginals into document probabilities (Newton's method).

    A bad document often has clean lines too, so its mean lies above a half.
    """
    z = np.column_stack([logit(mean), np.ones(len(mean))])
    start = np.array([1.0, 0.0])
    w = start.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hess = z.T @ (z * (p * (1 - p))[:, None]) + ridge * np.eye(2)
        w = w - np.linalg.solve(hess, z.T @ (p - quality) + ridge * (w - start))
    return float(max(w[0], 1e-3)), float(w[1])


def mean_marginals(x: np.ndarray, length: np.ndarray, first: np.ndarray, model: dict) -> np.ndarray:
    """Marginal of the good label, averaged over the lines by length."""
    _, marginal, _ = forward_backward(x @ model["weights"], model["trans"], first)
    weight = length + 1e-6
    total = segment_sums(weight * marginal[:, 1], first[:-1], first[1:])
    return np.clip(total / segment_sums(weight, first[:-1], first[1:]), 0.0, 1.0)


def scores(texts: pa.Array, model: dict) -> np.ndarray:
    """Calibrated length-weighted marginal of the good label for each text."""
    if not len(texts):
        return np.zeros(0)
    mean = mean_marginals(*line_features(texts), model)
    slope, shift = model["scale"]
    return 1 / (1 + np.exp(-(slope * logit(mean) + shift)))


def fold(doc_id, folds: int = 3):
    """Remainder of crc32 of the id as text; null ids count as fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds, F.lit(0))


def train(docs: DataFrame, labels: DataFrame, held_out: int = 1, max_docs: int = TRAIN_DOCS) -> dict:
    """Fit on a bounded pseudo-random sample of labelled rows outside the held-out fold."""
    order = F.xxhash64(F.lit(11), "doc_id")
    sample = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != held_out))
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
        .orderBy(order, "doc_id")
        .limit(max_docs)
    )
    # At most max_docs small rows: the only table sent to every task.
    joined = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n"))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, length, first = line_features(batch.column(0))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1),
                        batch.column(2),
                        pa.array(np.diff(first), pa.int32()),
                        pa.array([x[a:b].astype(np.float32).tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary()),
                        pa.array([length[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary()),
                    ],
                    ["doc_id", "quality", "n", "x", "length"],
                )

    rows = (
        joined.where(n_lines <= TRAIN_LINES)
        .select("text", "doc_id", "quality")
        .mapInArrow(featurise, f"doc_id {dict(labels.dtypes)['doc_id']}, quality int, n int, x binary, length binary")
        .collect()
    )
    rows.sort(key=lambda r: (r.doc_id, r.x))
    if not rows:
        return fit(np.zeros((0, N_FEATURES)), np.zeros(0), np.zeros(1, np.int64), np.zeros(0, int))
    x = np.concatenate([np.frombuffer(r.x, np.float32).reshape(r.n, N_FEATURES) for r in rows]).astype(np.float64)
    first = np.concatenate([[0], np.cumsum([r.n for r in rows])]).astype(np.int64)
    length = np.concatenate([np.frombuffer(r.length, np.float64) for r in rows])
    return fit(x, length, first, np.array([r.quality for r in rows]))


def score_documents(docs: DataFrame, model: dict, batch_rows: int = 512) -> DataFrame:
    """``doc_id, score`` for every row."""
    columns = docs.select("doc_id", "text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, batch_rows):
                batch = whole.slice(k, batch_rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(scores(batch.column(1), model), pa.float64())], ["doc_id", "score"]
                )

    return columns.mapInArrow(score, f"doc_id {dict(columns.dtypes)['doc_id']}, score double")
