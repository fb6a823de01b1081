"""Personal data and the terms that give it away.

Base spans (e-mail and IP addresses, card and phone numbers) are found by fixed
patterns, leftmost first, and checked. The words of their texts are then weighed:
for a term ``t`` in a text with an entity ``e``, texts with ``t`` count as evidence, and

    disclosure(t, e) = log(P(e | t) / P(e)) / -log P(e)

is the share of the entity's information that the term reveals, from co-occurrence
over the distinct texts of the whole corpus. A term counts if its disclosure at the
lower end of the confidence interval of P(e | t) reaches a threshold, so an entity of
a single text can be revealed too. That share of information tends to one for any
P(e | t) as the corpus grows, so the term's own texts decide as well, which do not
depend on the corpus: either all of them hold the entity, or by one standard error
more than ``MOST_TEXTS`` of them do. Such terms are generalised to a mark wherever they occur, those
whose disclosure is above a second threshold are removed.

Null texts count as empty and have no spans. Equal texts count once as evidence
and get equal spans, so copies and repeated rows neither raise nor hide a term.
Other columns pass through; helper names avoid them. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wareloom.llm.common import free_names, let, materialize

# The patterns of the four kinds, in their order. Possessive repeats give the same matches, since
# what follows never begins with a character of the repeat, and need no stack on long runs.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*PATTERNS, "term"]
#: What a text needs for a pattern to be tried.
HINTS = {"email": "@", "phone": "+"}
TERM = r"\p{L}{3,}+"
#: Standard errors that the share of a term's texts with an entity is lowered by before it counts as shown.
CONFIDENCE = 1.96
#: A term that also stands without the entity must stand with it in this share of its texts, one standard error allowed for.
MOST_TEXTS = 0.5
#: At most so many of the most common words are left out before a join on words.
COMMON = 1 << 16
GENERALISE, REMOVE = 0.7, 0.95

#: Values of an array that are scanned together.
BLOCK = 256
#: Above every place in a text.
FAR = (1 << 62) - 1

SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string,value:string>>"


def no_spans() -> Column:
    return F.array().cast(SPAN)


def scan(values: Column, zero: Column, merge) -> Column:
    """What ``merge`` makes of all values before each one, in blocks, so that long arrays cost little more than short ones."""

    def before(part: Column, first: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(part) - 1)
        return F.transform(places, lambda k: F.aggregate(F.slice(part, F.lit(1), k), first, merge))

    def blocks(v: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")), lambda k: F.slice(v, k * BLOCK + 1, F.lit(BLOCK)))

    def of_blocks(parts: Column) -> Column:
        whole = F.transform(parts, lambda part: F.aggregate(part, zero, merge))
        return let(whole, lambda w: F.flatten(F.zip_with(parts, before(w, zero), before)))

    return let(values, lambda v: F.when(F.size(v) == 0, v).otherwise(let(blocks(v), of_blocks)))


def add(x: Column, y: Column) -> Column:
    return x + y


def find_all(text: Column, pattern: Column, kind: str) -> Column:
    """Spans of all matches: the gaps between matches and the matches give every place."""
    rank = KINDS.index(kind)

    def spans(gaps: Column, found: Column) -> Column:
        steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, v: (F.char_length(g) + F.char_length(v)).cast("bigint"))
        ends = let(steps, lambda n: F.zip_with(scan(n, F.lit(0).cast("bigint"), add), n, add))
        return F.zip_with(
            ends,
            found,
            lambda end, v: F.struct(
                (end - F.char_length(v)).alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), v.alias("value")
            ),
        )

    return let(
        F.regexp_extract_all(text, pattern, F.lit(0)),
        lambda found: F.when(F.size(found) == 0, no_spans()).otherwise(spans(F.split(text, pattern, -1), found)),
    )


def passes_luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(F.reverse(digits), i, F.lit(1)).try_cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add) % 10 == 0


def is_valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        small = lambda part: (F.char_length(F.ltrim(part, F.lit("0"))) <= 3) & (
            F.coalesce(F.ltrim(part, F.lit("0")).try_cast("int"), F.lit(0)) <= 255
        )
        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        return F.when(F.char_length(digits).between(12, 19), passes_luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    return F.lit(True)


def spans_of_kind(text: Column, kind: str) -> Column:
    found = find_all(text, F.lit(PATTERNS[kind]), kind)
    valid = F.filter(found, lambda s: is_valid(kind, s["value"]))
    hint = F.contains(text, F.lit(HINTS[kind])) if kind in HINTS else text.rlike("[0-9]")
    return F.when(hint, valid).otherwise(no_spans())


def base_spans(text: Column) -> Column:
    """Valid matches of all kinds by start, then kind as listed."""
    return F.sort_array(F.concat(*[spans_of_kind(text, kind) for kind in PATTERNS]))


def entity(span: Column) -> Column:
    """One name for the ways to write a value."""
    plain = F.when(span["kind"].isin("card", "phone"), F.regexp_replace(span["value"], "[^0-9]", "")).otherwise(
        F.lower(span["value"])
    )
    return F.concat(span["kind"], F.lit(":"), plain)


def cut_at(text: Column, spans: Column, put) -> Column:
    """The text with ``put(span, fresh, gap)`` for every span and the gap before it; ``fresh`` if it begins behind all earlier ones.

    The text is turned into four bytes a character once, so a gap is cut where it lies.
    """
    ends = F.transform(spans, lambda s: s["end"])
    nothing = F.lit(0).cast("bigint")

    def piece(raw: Column, start: Column, end: Column) -> Column:
        size = F.greatest(nothing, end - start)
        return F.decode(F.substring(raw, (4 * start + 1).cast("int"), (4 * size).cast("int")), "UTF-32")

    def joined(raw: Column) -> Column:
        # Where the spans before each one end.
        reached = scan(ends, nothing, lambda x, y: F.greatest(x, y))
        parts = F.zip_with(spans, reached, lambda s, at: put(s, s["start"] >= at, piece(raw, at, s["start"])))
        rest = piece(raw, F.array_max(ends), F.char_length(text).cast("bigint"))
        return F.concat(F.array_join(parts, ""), rest)

    return F.when(F.size(spans) == 0, text).otherwise(let(F.encode(text, "UTF-32"), joined))


def outside(text: Column, spans: Column) -> Column:
    """The text with a blank in place of every span."""
    return cut_at(text, spans, lambda span, fresh, gap: F.concat(gap, F.lit(" ")))


def terms_of(text: Column) -> Column:
    """Distinct lower-case letter runs."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def detect(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, row, text_id, spans, entities, terms`` of every row, written once; terms stand outside the spans."""
    body = F.coalesce(F.col(text), F.lit(""))
    found = docs.select("doc_id", body.alias("body")).select("doc_id", "body", F.md5("body").alias("text_id"), base_spans(F.col("body")).alias("spans"))
    entities = F.array_distinct(F.transform("spans", entity))
    terms = terms_of(outside(F.col("body"), F.col("spans")))
    row = F.monotonically_increasing_id().alias("row")
    return materialize(found.select("doc_id", row, "text_id", "spans", entities.alias("entities"), terms.alias("terms")), "spans")


def distinct_texts(found: DataFrame) -> DataFrame:
    """The first row of each text; only row numbers are compared, so lists of terms stay in place."""
    firsts = found.groupBy("text_id").agg(F.min("row").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    copies = materialize(found.select("text_id", "row").join(firsts, "text_id").where("row != first").select("row"), "copies")
    return found.join(copies, "row", "left_anti")


def disclosure(share: Column, held: Column, total: int) -> Column:
    """Share of an entity's information that a term reveals: ``share`` of the term's texts hold it, ``held`` of all."""
    prior = F.least(held / total, F.lit(1 - 1e-9))
    return F.ln(share / prior) / -F.ln(prior)


def least_share(both: Column, texts: Column, errors: float = CONFIDENCE) -> Column:
    """Lower end of Wilson's interval of P(e | t), from ``both`` of ``texts``; never 0 for ``both`` above 0."""
    p, z2 = both / texts, errors**2
    half = errors * F.sqrt(p * (1 - p) / texts + z2 / (4 * texts * texts))
    return F.greatest((p + z2 / (2 * texts) - half) / (1 + z2 / texts), F.lit(1e-12))


def without_common(rows: DataFrame, frequency: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rows`` less the words that most texts are made of, unless wanted: few words, so what is left moves cheaply."""
    sizes = {r.power: r.n for r in frequency.groupBy(F.floor(F.log2("texts")).alias("power")).agg(F.count("*").alias("n")).collect()}
    left, cut = COMMON, max(sizes, default=0) + 1
    for power in sorted(sizes, reverse=True):
        left -= sizes[power]
        if left < 0:
            break
        cut = power
    common = frequency.where(F.col("texts") >= 2**cut).select("term").join(wanted.select("term"), "term", "left_anti")
    return rows.join(F.broadcast(common), "term", "left_anti")


def revealing_terms(found: DataFrame, threshold: float = GENERALISE) -> DataFrame | None:
    """``text_id, terms``: distinct texts with revealing terms, each with its disclosure. None if no term reveals.

    A term and an entity meet in every distinct text that holds both, wherever they
    stand. Document frequencies come first; a term of a text is paired with the
    text's entities only if it could reveal the most or least frequent of them with
    as many texts in common as there can be, which rules out common words without
    changing the result.
    """
    texts = distinct_texts(found)
    holders = texts.where(F.size("entities") > 0)
    total = max(2, texts.count())
    held = holders.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("held"))
    entities = materialize(
        holders.select("text_id", F.explode("entities").alias("entity"))
        .join(held, "entity")
        .groupBy("text_id")
        .agg(F.collect_list(F.struct("entity", "held")).alias("entities"), F.max("held").alias("most"), F.min("held").alias("least")),
        "entities",
    )
    if entities.isEmpty():
        return None
    most = entities.agg(F.max("most")).first()[0]

    def possible(most: Column, least: Column) -> Column:
        """No entity held by ``least`` to ``most`` texts is revealed more than this."""
        share = least_share(F.least(most, F.col("texts")), F.col("texts"))
        return disclosure(share, least, total)

    frequency = texts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("texts"))
    frequency = materialize(frequency, "frequency")
    rare = frequency.where(possible(F.lit(most), F.lit(1)) >= threshold)
    pairs = (
        without_common(holders.select("text_id", F.explode("terms").alias("term")), frequency, rare)
        .join(rare, "term")
        .join(entities, "text_id")
        .where(possible(F.col("most"), F.col("least")) >= threshold)
        .select("term", "texts", F.inline("entities"))
        .where(disclosure(least_share(F.least("held", "texts"), F.col("texts")), F.col("held"), total) >= threshold)
        .groupBy("entity", "held", "term", "texts")
        .agg(F.count("*").alias("both"))
    )
    # The lower end says whether the term reveals at all, the share itself how much.
    mostly = (F.col("both") == F.col("texts")) | (least_share(F.col("both"), F.col("texts"), 1.0) > MOST_TEXTS)
    weighed = materialize(
        pairs.where(mostly & (disclosure(least_share(F.col("both"), F.col("texts")), F.col("held"), total) >= threshold))
        .select("term", disclosure(F.col("both") / F.col("texts"), F.col("held"), total).alias("disclosure"))
        .groupBy("term")
        .agg(F.max("disclosure").alias("disclosure")),
        "revealing-terms",
    )
    if weighed.isEmpty():
        return None
    return materialize(
        without_common(found.select("text_id", F.explode("terms").alias("term")), frequency, weighed)
        .join(weighed, "term")
        .groupBy("text_id")
        .agg(F.sort_array(F.collect_set(F.struct("term", "disclosure"))).alias("terms")),
        "revealed",
    )


def term_spans(text: Column, terms: Column) -> Column:
    """Whole-word occurrences of the terms."""
    alternatives = F.array_join(F.transform(terms, lambda t: t["term"]), "|")
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), alternatives, F.lit(r")(?!\p{L})"))
    return find_all(text, pattern, "term")


def with_terms(base: Column, terms: Column) -> Column:
    """Base spans and the term spans that touch none of them, in order."""
    term = KINDS.index("term")
    nothing, far = F.lit(0).cast("bigint"), F.lit(FAR).cast("bigint")

    def free(every: Column) -> Column:
        # How far the base spans before reach, and where those behind begin.
        reached = scan(F.transform(every, lambda s: F.when(s["rank"] == term, nothing).otherwise(s["end"])), nothing, lambda x, y: F.greatest(x, y))
        begins = F.reverse(F.transform(every, lambda s: F.when(s["rank"] == term, far).otherwise(s["start"])))
        following = F.reverse(scan(begins, far, lambda x, y: F.least(x, y)))
        marked = F.zip_with(
            every, F.arrays_zip(reached.alias("before"), following.alias("after")), lambda s, n: F.struct(s.alias("span"), n.alias("near"))
        )
        kept = F.filter(
            marked,
            lambda m: (m["span"]["rank"] != term) | ((m["near"]["before"] <= m["span"]["start"]) & (m["near"]["after"] >= m["span"]["end"])),
        )
        return F.transform(kept, lambda m: m["span"])

    return F.when(terms.isNull() | (F.size(terms) == 0), base).otherwise(let(F.sort_array(F.concat(base, terms)), free))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_spans(docs: DataFrame) -> DataFrame:
    """Counts per kind, digest of the base spans and all spans of every document.

    Texts are looked at where they are read; only those with revealing terms can move.
    """
    found = detect(docs)
    hits = revealing_terms(found)
    rows = found.select("doc_id", "text_id", F.col("spans").alias("base"))
    if hits is None:
        rows = rows.withColumn("every", F.col("base"))
    else:
        texts = docs.select(F.coalesce("text", F.lit("")).alias("body")).withColumn("text_id", F.md5("body"))
        terms = (
            texts.join(hits, "text_id")
            .select("text_id", term_spans(F.col("body"), F.col("terms")).alias("terms"))
            .dropDuplicates(["text_id"])
        )
        rows = rows.join(terms, "text_id", "left").withColumn("every", with_terms(F.col("base"), F.col("terms")))
    every = F.col("every")
    count = lambda kind: F.size(F.filter(every, lambda s: s["kind"] == kind)).cast("long")
    return rows.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in PATTERNS],
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(every).alias("spans"),
        count("term").alias("n_term"),
    )


def masked(text: Column, spans: Column, terms: Column, remove: float = REMOVE) -> Column:
    """The text with base spans as their kind's mark, terms generalised or removed."""

    def mark(span: Column) -> Column:
        revealed = F.filter(terms, lambda t: t["term"] == F.lower(span["value"]))
        gone = F.coalesce(F.get(revealed, F.lit(0))["disclosure"] > remove, F.lit(False))
        return F.when(span["kind"] != "term", F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))).when(gone, "").otherwise("[TERM]")

    return cut_at(text, spans, lambda span, fresh, gap: F.when(fresh, F.concat(gap, mark(span))).otherwise(""))


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span masked in the text; a null text stays null."""
    spans, terms, key, text_id = free_names(docs, "_spans", "_terms", "_key", "_text_id")
    hits = revealing_terms(detect(docs, text))
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs
    if hits is None:
        rows = rows.withColumn(terms, F.lit(None).cast("array<struct<term:string,disclosure:double>>"))
    else:
        hits = hits.select(F.col("text_id").alias(key), F.col("terms").alias(terms))
        rows = rows.withColumn(text_id, F.md5(body)).join(hits, F.col(text_id) == F.col(key), "left")
    found = F.when(F.col(terms).isNotNull(), term_spans(body, F.col(terms)))
    rows = rows.withColumn(spans, with_terms(base_spans(body), found))
    clean = masked(F.col(text), F.col(spans), F.col(terms))
    return rows.withColumn(text, F.when(F.col(text).isNull(), F.col(text)).otherwise(clean)).select(*docs.columns)
