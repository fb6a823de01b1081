"""Quality rules as a short-circuit cascade.

Every rule is an expression that is true for a text to be rejected. On a sample
each rule is timed and its share of rejections counted; rules run in the order
of rejections per second, and a text that one rule rejects is not looked at by
the next. The order changes the cost only: a text is kept if no rule rejects it.

Null and empty texts have no words and are rejected by ``few_words``. Repeated
rows and doc_ids are judged row by row. Other columns pass through untouched;
a column already named like a result is replaced.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wareloom.llm.common import WORD, free_names, let, materialize, words

SAMPLE_ROWS = 2000
RUNS = 2
#: What a rule costs at least, below what can be timed.
LEAST_SECONDS = 1e-3
WINDOW = 5
SYMBOLS = "#*$%&|<>"
# A blank-separated bar, as in flattened tables.
BAR = " | "


def char_count(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are in the class ``chars``."""
    return F.regexp_count(text, F.lit(f"[{chars}]")).cast("long")


def filled_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(filled_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def window_hashes(tokens: Column) -> Column:
    """A hash of each window of five words, in order."""

    def windows(h: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(h) - WINDOW)
        hashed = F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))
        return F.when(F.size(h) >= WINDOW, hashed).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(tokens, lambda w: F.xxhash64(w)), windows)


def covered_words(hashes: Column) -> Column:
    """Words inside windows whose hash occurs again, the first occurrence included.

    Texts without a repeated window, most of them, are settled by counting the
    distinct hashes; the others sort their windows to find the repeated ones and
    add up the union of the intervals.
    """

    def union_length(positions: Column) -> Column:
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("total"))
        return F.aggregate(
            positions,
            start,
            lambda s, p: F.struct(
                p.alias("last"), (s["total"] + F.least(F.lit(WINDOW), p - s["last"])).alias("total")
            ),
            lambda s: s["total"],
        )

    def repeated(tagged: Column) -> Column:
        again = F.filter(
            tagged,
            lambda x, i: (x["h"] == F.get(tagged, i + 1)["h"]) | (x["h"] == F.get(tagged, i - 1)["h"]),
        )
        return union_length(F.array_sort(F.transform(again, lambda x: x["i"])))

    def count(h: Column) -> Column:
        tagged = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            let(tagged, repeated)
        )

    return let(hashes, count)


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def repeats_next(tokens: Column) -> Column:
    """Words that the next word repeats."""
    same = F.filter(tokens, lambda w, i: w == F.get(tokens, i + 1))
    return F.size(same).cast("long")


#: What rules look at, as expressions over a text that is not null.
MEASURES: dict[str, Callable[[Column], Column]] = {
    "n_words": word_count,
    "word_chars": lambda t: char_count(t, r"^\x20\x09-\x0D"),
    "n_symbols": lambda t: char_count(t, SYMBOLS),
    "n_bars": lambda t: ((F.char_length(t) - F.char_length(F.replace(t, F.lit(BAR), F.lit("")))) / len(BAR)).cast("long"),
    "n_shouted": lambda t: F.regexp_count(t, F.lit(r"\p{Lu}{2,}+")).cast("long"),
    "n_lines": lambda t: F.size(filled_lines(t)).cast("long"),
    "n_dup_lines": duplicate_lines,
    "n_repeat_words": lambda t: let(words(t), lambda w: covered_words(window_hashes(w))),
    "n_stutter": lambda t: let(words(t), repeats_next),
}


def fails_base(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


@dataclass(frozen=True)
class Rule:
    """``rejects`` maps a lookup of measures by name to a boolean."""

    name: str
    rejects: Callable[[Callable[[str], Column]], Column]


BASE_RULES = (
    Rule("few_words", lambda m: m("n_words") < 10),
    Rule("repeated_words", lambda m: 100 * m("n_repeat_words") > 20 * m("n_words")),
)
# Fixed limits, in hundredths of a text's words or lines.
EXTRA_RULES = (
    Rule("symbols", lambda m: 100 * m("n_symbols") > 50 * m("n_words")),
    Rule("list_bars", lambda m: 100 * m("n_bars") > 10 * m("n_words")),
    Rule("shouting", lambda m: 100 * m("n_shouted") > 40 * m("n_words")),
    Rule("repeated_lines", lambda m: 100 * m("n_dup_lines") > 50 * m("n_lines")),
    Rule(
        "word_length",
        lambda m: (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 20 * m("n_words")),
    ),
    Rule("stuttering", lambda m: 100 * m("n_stutter") > 40 * m("n_words")),
)
RULES = BASE_RULES + EXTRA_RULES


def lookup(text: Column, known: dict[str, Column]) -> Callable[[str], Column]:
    """Measures by name: the ``known`` columns, the others computed from ``text`` where a rule asks."""
    return lambda name: known[name] if name in known else MEASURES[name](text)


def rejects(rule: Rule, measure: Callable[[str], Column]) -> Column:
    return F.coalesce(rule.rejects(measure), F.lit(False))


def order_rules(docs: DataFrame, rules=RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by rejections per second on a random sample of about ``sample_rows`` rows.

    A rule's cost is its fastest of ``RUNS`` runs after one that warms up, less that of a
    rule that looks at nothing. The sample decides the order only. An empty table keeps
    the given order.
    """
    n = docs.count()
    if n == 0:
        return list(rules)
    sample = materialize(
        docs.select(F.col(text).alias("text")).sample(fraction=min(1.0, sample_rows / n), seed=7), "rule-sample"
    )
    found = sample.select("text", word_count(F.coalesce("text", F.lit(""))).alias("n_words"))
    measure = lookup(F.coalesce("text", F.lit("")), {"n_words": F.col("n_words")})

    def timed(rejected: Column) -> tuple[int, float]:
        count, seconds = found.agg(F.count_if(rejected)), []
        for _ in range(1 + RUNS):
            began = time.perf_counter()
            hits = count.first()[0]
            seconds.append(time.perf_counter() - began)
        return hits, min(seconds[1:])

    _, idle = timed(F.col("n_words") < 0)
    rate = {}
    for rule in rules:
        hits, seconds = timed(rejects(rule, measure))
        rate[rule.name] = hits / max(seconds - idle, LEAST_SECONDS)
    return sorted(rules, key=lambda r: -rate[r.name])


def first_rejection(rules: list[Rule], measure: Callable[[str], Column]) -> Column:
    """Name of the first rule that rejects, null if none does; later rules are not evaluated."""
    if not rules:
        return F.lit(None).cast("string")
    verdict = F.when(rejects(rules[0], measure), F.lit(rules[0].name))
    for rule in rules[1:]:
        verdict = verdict.when(rejects(rule, measure), F.lit(rule.name))
    return verdict


def word_measures(w: Column) -> Column:
    """What rules need of the word array, in one pass over it."""
    return F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.aggregate(w, F.lit(0).cast("long"), lambda n, x: n + F.char_length(x)).alias("word_chars"),
        covered_words(window_hashes(w)).alias("n_repeat_words"),
        repeats_next(w).alias("n_stutter"),
    )


def needs_words(rule: Rule) -> bool:
    """Whether a rule looks at more of the words than their number."""
    asked: list[str] = []
    rule.rejects(lambda name: asked.append(name) or F.lit(1))
    return bool({"word_chars", "n_repeat_words", "n_stutter"} & set(asked))


def cascade(
    docs: DataFrame, rules=RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS, verdict: str = "rejected_by"
) -> DataFrame:
    """``docs`` with a column ``verdict``: the rule that turned the text away, null for a text to keep.

    A rejected text gets the name of the first of ``rules``, as given, that it
    breaks, so names do not depend on the order found.
    """
    ordered = order_rules(docs, rules, text, sample_rows)

    def named(body: Column) -> Column:
        first = let(words(body), lambda w: let(word_measures(w), lambda m: first_rejection(list(rules), fields_of(m, body))))
        return F.when(rejection(body, ordered).isNotNull(), first)

    return docs.withColumn(verdict, let(F.coalesce(text, F.lit("")), named))


def passing(docs: DataFrame, rules=RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows that no rule rejects; the cascade is one expression of the filter, so nothing in it is computed twice."""
    ordered = order_rules(docs, rules, text, sample_rows)
    return docs.where(let(F.coalesce(text, F.lit("")), lambda body: rejection(body, ordered)).isNull())


def rejection(body: Column, ordered: list[Rule]) -> Column:
    """Name of the rule that rejects a text first, null if none does.

    A text is split into words once. Rules that scan it otherwise come first, in
    their order; for a text that they pass the words are counted through, and the
    rules about words read those counts, in their order.
    """
    scans, about_words = [r for r in ordered if not needs_words(r)], [r for r in ordered if needs_words(r)]

    def tried(w: Column) -> Column:
        scanned = first_rejection(scans, lookup(body, {"n_words": F.size(w).cast("long")}))
        late = let(word_measures(w), lambda m: first_rejection(about_words, fields_of(m, body)))
        return F.coalesce(scanned, late) if about_words else scanned

    return let(words(body), tried)


def fields_of(measures: Column, body: Column) -> Callable[[str], Column]:
    return lookup(body, {c: measures[c] for c in ("n_words", "word_chars", "n_repeat_words", "n_stutter")})


def quality_report(docs: DataFrame) -> DataFrame:
    """Base counts of every document and the verdict of the cascade.

    The contract wants the base counts of every row, so the rules take them from
    the row; what only the cascade needs is computed for rows that come to it.
    """
    ordered = order_rules(docs, EXTRA_RULES)
    body = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text = F.col("text")

    counted = body.select(
        "doc_id",
        "text",
        let(words(text), word_measures).alias("c"),
        MEASURES["n_symbols"](text).alias("n_symbols"),
        let(
            filled_lines(text),
            lambda x: F.struct(
                F.size(x).cast("long").alias("n_lines"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            ),
        ).alias("l"),
    ).select("doc_id", "text", "c.*", "n_symbols", "l.*")
    base = counted.withColumn("base_failed", fails_base(F.col("n_words"), F.col("n_repeat_words")))
    known = {c: F.col(c) for c in ("n_words", "word_chars", "n_repeat_words", "n_stutter", "n_symbols", "n_lines", "n_dup_lines")}
    # Tried in the order found; a rejected text is named after the first rule as declared.
    measure = lookup(text, known)
    broken = F.when(first_rejection(ordered, measure).isNotNull(), first_rejection(list(EXTRA_RULES), measure))
    verdict = F.when(F.col("base_failed"), F.lit("base")).otherwise(broken)
    return base.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        verdict.alias("rejected_by"),
    ).select("*", F.col("rejected_by").isNull().alias("kept"))
