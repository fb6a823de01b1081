"""How the sources of a language differ in their words.

Per language the terms of enough documents are kept. They are sorted, and every
block of them becomes a minimal acyclic transducer that gives a term its lexicographic
ordinal; all texts are streamed through it and counted again by ordinal. Counts become
smoothed whole-number rates per group of language and source, and rates are compared
between sources and with the language. Ties are broken by ordinal.

Terms are counted per slice of texts before they are shuffled, so neither a frequent
term nor a source with a third of all rows reaches one task. A block holds at most
``BLOCK_TERMS`` terms and is built in a task of its own. Blocks are sent to the tasks
in waves of at most ``WAVE_BYTES`` of tables (or one block); a vocabulary beyond that
takes a further pass over the texts of its languages. Rates of all sources are
compared in chunks of ordinals that hold at most ``CHUNK_CELLS`` rates or one term.

Null text, lang and source are the empty string. Repeated rows count as often as they
occur. A language without kept terms has distances of 0. Rates are exact up to counts
of 10^18. Other columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wareloom.llm import transducer
from wareloom.llm.common import materialize, placed
from wareloom.llm.tokens import flat_bytes, text_batches

MIN_DOCUMENTS = 30
TOP_TERMS = 50
BLOCK_TERMS = 100_000
WAVE_BYTES = 128_000_000
CHUNK_CELLS = 50_000
# Fixed values of the rates.
SCALE, SMOOTHING = 1_000_000_000, 5

_BYTES = np.arange(256)
_UPPER = (_BYTES >= ord("A")) & (_BYTES <= ord("Z"))
IN_TERM = _UPPER | ((_BYTES >= ord("a")) & (_BYTES <= ord("z"))) | (_BYTES >= 0x80)
LOWER = np.where(_UPPER, _BYTES + 32, _BYTES).astype(np.uint8)


@dataclass(frozen=True)
class Terms:
    """Terms of many texts: lower-cased bytes, where each begins and its size, and the text it stands in."""

    data: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    owner: np.ndarray


def find_terms(texts: pa.Array) -> Terms:
    data, at = flat_bytes(texts)
    inside = IN_TERM[data]
    opens, closes = inside.copy(), inside.copy()
    edges = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))]
    edge = np.zeros(len(data) + 1, bool)
    edge[edges] = True
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    first, last = np.flatnonzero(opens), np.flatnonzero(closes)
    sizes = last - first + 1
    owner = np.searchsorted(at, first, side="right") - 1
    return Terms(LOWER[data[inside]], np.cumsum(sizes) - sizes, sizes, owner)


def coded(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    encoded = column.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        yield from text_batches(whole, 2)


def document_counts(batch: pa.RecordBatch) -> list[pa.Array]:
    """lang, term and the number of documents of the slice that hold it."""
    lang, langs = coded(batch.column(0))
    terms = find_terms(batch.column(2))
    offsets = np.append(terms.starts, len(terms.data)).astype(np.int64)
    spelled = pa.LargeStringArray.from_buffers(len(terms.starts), pa.py_buffer(offsets), pa.py_buffer(terms.data))
    code, distinct = coded(spelled)
    width = max(1, len(distinct))
    once = np.unique(terms.owner * width + code)
    pairs, n = np.unique(lang[once // width] * width + once % width, return_counts=True)
    return [langs.take(pa.array(pairs // width)), distinct.take(pa.array(pairs % width)).cast(pa.string()), pa.array(n, pa.int64())]


def normal(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])


def kept_terms(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``lang, term, ordinal`` of the terms that enough documents of a language hold, ordinals from 0 in byte order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays(document_counts(batch), ["lang", "term", "n"])

    counts = normal(docs).mapInArrow(run, "lang string, term string, n long")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_documents)
    return placed(materialize(kept.select("lang", "term"), "terms"), ["lang"], ["term"], "ordinal")


BLOCK_SCHEMA = (
    "lang string, block long, first long, states long, longest long, table_bytes long, "
    "final binary, source binary, label binary, target binary, output binary"
)
ARRAYS = {"final": bool, "source": np.int32, "label": np.uint8, "target": np.int32, "output": np.int32}


def transducers(kept: DataFrame, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """One row per block of a language's terms: the first ordinal and the arcs."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("ordinal")
        built = transducer.build(pc.cast(table.column("term"), pa.binary()).to_pylist())
        row = {
            "lang": table.column("lang")[0].as_py(),
            "block": table.column("block")[0].as_py(),
            "first": table.column("ordinal")[0].as_py(),
            "states": built.states,
            "longest": built.longest,
            "table_bytes": built.table_bytes(),
            **{name: getattr(built, name).tobytes() for name in ARRAYS},
        }
        return pa.Table.from_pylist([row])

    rows = kept.withColumn("block", F.floor(F.col("ordinal") / block_terms).cast("long"))
    return rows.groupBy("lang", "block").applyInArrow(run, BLOCK_SCHEMA)


def waves_of(blocks: list, most: int) -> Iterator[list]:
    """Blocks in order, as many at a time as have tables of ``most`` bytes together, or one."""
    wave, total = [], 0
    for block in blocks:
        if wave and total + block["table_bytes"] > most:
            yield wave
            wave, total = [], 0
        wave.append(block)
        total += block["table_bytes"]
    if wave:
        yield wave


def count_wave(texts: DataFrame, blocks: list) -> DataFrame:
    """``lang, source, ordinal, n`` per slice of texts for the terms of some blocks."""
    by_lang: dict[str, list] = {}
    for b in blocks:
        arrays = {name: np.frombuffer(b[name], kind) for name, kind in ARRAYS.items()}
        by_lang.setdefault(b["lang"], []).append((b["first"], transducer.Transducer(b["states"], b["longest"], **arrays)))
    shared = texts.sparkSession.sparkContext.broadcast(by_lang)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            lang, langs = coded(batch.column(0))
            source, sources = coded(batch.column(1))
            terms = find_terms(batch.column(2))
            for code, name in enumerate(langs.to_pylist()):
                own = np.flatnonzero(lang[terms.owner] == code)
                for first, machine in shared.value[name]:
                    ordinal = machine.ordinals(terms.data, terms.starts[own], terms.sizes[own])
                    held = ordinal >= 0
                    width = int(ordinal.max(initial=0)) + 1
                    cells, n = np.unique(source[terms.owner[own[held]]] * width + ordinal[held], return_counts=True)
                    columns = [
                        pa.array([name] * len(cells), pa.string()),
                        sources.take(pa.array(cells // width)),
                        pa.array(first + cells % width, pa.int64()),
                        pa.array(n, pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "ordinal", "n"])

    chosen = texts.where(F.col("lang").isin(list(by_lang)))
    return chosen.mapInArrow(run, "lang string, source string, ordinal long, n long")


def recount(docs: DataFrame, blocks: DataFrame, wave_bytes: int = WAVE_BYTES) -> DataFrame:
    """``lang, source, ordinal, n``: occurrences of kept terms, from texts streamed through the transducers."""
    blocks = materialize(blocks, "transducers")
    plan = blocks.select("lang", "block", "table_bytes").orderBy("lang", "block").collect()
    texts, found = normal(docs), None
    for wave in waves_of(plan, wave_bytes):
        ours = reduce(or_, [(F.col("lang") == b["lang"]) & (F.col("block") == b["block"]) for b in wave])
        counted = count_wave(texts, blocks.where(ours).collect())
        counted = counted.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))
        found = counted if found is None else found.unionByName(counted)
    if found is None:
        return docs.sparkSession.createDataFrame([], "lang string, source string, ordinal long, n long")
    return materialize(found, "term-counts")


def rate(n: str, total: str, terms: str):
    """``1 + floor(SCALE * (n + 5) / (total + 5 * terms))`` in whole numbers."""
    return F.expr(
        f"1L + (cast({SCALE} as decimal(10, 0)) * cast({n} + {SMOOTHING} as decimal(20, 0)))"
        f" div cast({total} + {SMOOTHING} * {terms} as decimal(20, 0))"
    )


def distances(counts: DataFrame, groups: DataFrame, chunk_cells: int = CHUNK_CELLS) -> DataFrame:
    """``lang, one, two, value``: summed differences of the rates of two sources, each pair once.

    ``counts`` has ``lang, source, ordinal, p``; ``groups`` has ``lang, source, terms`` and ``none``,
    the rate of a term that does not occur.
    """
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    width = max(1, chunk_cells // most)
    chunk = F.floor(F.col("ordinal") / width).cast("long")
    left = counts.select("lang", chunk.alias("chunk"), (F.col("ordinal") - chunk * width).alias("at"), "source", "p")
    last = F.greatest(F.lit(0).cast("long"), F.ceil(F.col("terms") / width) - 1)
    right = groups.select("lang", "source", "none", "terms", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("chunk"))
    # Columns of their own, also where counts and groups come from one table.
    right = right.toDF(*right.columns).select(*[F.col(c).alias(c) for c in right.columns])
    right = right.withColumn("terms", F.least(F.lit(width).cast("long"), F.col("terms") - F.col("chunk") * width))

    def run(key: tuple, cells: pa.Table, rows: pa.Table) -> pa.Table:
        names = rows.column("source").combine_chunks().sort()
        none = rows.column("none").combine_chunks().take(pc.sort_indices(rows.column("source"))).to_numpy(zero_copy_only=False)
        matrix = np.repeat(none[:, None], rows.column("terms")[0].as_py(), 1)
        if cells.num_rows:
            row = pc.index_in(cells.column("source").combine_chunks(), names).to_numpy(zero_copy_only=False)
            matrix[row, cells.column("at").to_numpy()] = cells.column("p").to_numpy()
        ones, twos, values = [], [], []
        for k in range(len(names) - 1):
            values.append(np.abs(matrix[k + 1 :] - matrix[k]).sum(1))
            ones.append(np.full(len(values[-1]), k))
            twos.append(np.arange(k + 1, len(names)))
        pick = lambda parts: names.take(pa.array(np.concatenate(parts) if parts else [], pa.int64()))
        one = pick(ones)
        columns = [pa.array([key[0].as_py()] * len(one), pa.string()), one, pick(twos)]
        value = np.concatenate(values) if values else np.zeros(0, np.int64)
        return pa.Table.from_arrays([*columns, pa.array(value, pa.int64())], ["lang", "one", "two", "value"])

    grouped = left.groupBy("lang", "chunk").cogroup(right.groupBy("lang", "chunk"))
    parts = grouped.applyInArrow(run, "lang string, one string, two string, value long")
    return parts.groupBy("lang", "one", "two").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: other sources by distance, and terms above the language's rate."""
    kept = materialize(kept_terms(docs, min_documents), "vocabulary")
    counts = recount(docs, transducers(kept))

    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    nothing = F.lit(0).cast("long")
    groups = normal(docs).select("lang", "source").distinct().join(sizes, "lang", "left").join(totals, ["lang", "source"], "left")
    groups = groups.select("lang", "source", F.coalesce("terms", nothing).alias("terms"), F.coalesce("total", nothing).alias("total"))
    none = F.when(F.col("terms") > 0, rate("0L", "total", "terms")).otherwise(nothing)
    groups = materialize(groups.withColumn("none", none), "groups")

    whole = counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("n_lang"))
    lang_totals = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("terms").alias("terms"))
    whole = whole.join(lang_totals, "lang").select("lang", "ordinal", rate("n_lang", "total", "terms").alias("q"))
    rates = counts.join(groups, ["lang", "source"]).select("lang", "source", "ordinal", rate("n", "total", "terms").alias("p"))
    rates = materialize(rates, "rates")

    by_group = Window.partitionBy("lang", "source")
    above = rates.join(whole, ["lang", "ordinal"]).where("p > q").select("lang", "source", "ordinal", (F.col("p") - F.col("q")).alias("value"))
    ranked = above.withColumn("rank", F.row_number().over(by_group.orderBy(F.desc("value"), "ordinal"))).where(F.col("rank") <= top)
    terms = ranked.join(kept, ["lang", "ordinal"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")

    apart = distances(rates, groups)
    both = apart.select("lang", F.col("one").alias("source"), F.col("two").alias("item"), "value").unionByName(
        apart.select("lang", F.col("two").alias("source"), F.col("one").alias("item"), "value")
    )
    rank = F.row_number().over(by_group.orderBy(F.desc("value"), "item"))
    pairs = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))
    return pairs.unionByName(terms)


ORACLE = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), words AS (
  SELECT row, lang, source, unnest(regexp_extract_all(t, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= {MIN_DOCUMENTS}
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), counted AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
  FROM groups g JOIN kept k USING (lang)
  LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL) c USING (lang, source, term)
), rates AS (
  SELECT lang, source, term, n,
         1 + {SCALE}::HUGEINT * (n + {SMOOTHING}) // (sum(n) OVER g + {SMOOTHING} * count(*) OVER g) AS p
  FROM counted WINDOW g AS (PARTITION BY lang, source)
), whole AS (
  SELECT lang, term, 1 + {SCALE}::HUGEINT * (sum(n) + {SMOOTHING}) //
         (sum(sum(n)) OVER (PARTITION BY lang) + {SMOOTHING} * count(*) OVER (PARTITION BY lang)) AS q
  FROM counted GROUP BY lang, term
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM rates a JOIN rates b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
), terms AS (
  SELECT r.lang, r.source, r.term AS item, p - q AS value FROM rates r JOIN whole USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM (
  SELECT *, 'pair' AS part, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL BY NAME
  SELECT *, 'term' AS part, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms
) WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
