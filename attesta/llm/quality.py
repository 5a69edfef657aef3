"""Quality rules as a short-circuit cascade, in DataFrame functions only.

A rule is a list of measures and a rejecting condition over them. The cascade runs every rule on a bounded sample,
takes its time there as cost and its share of rejected rows as selectivity, and orders the rules by rejection per cost.
Then each row goes through the rules in that order; the measures of a rule are only computed for rows that no earlier
rule has rejected. A row is kept when no rule rejects it, so the order decides the time and never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.functions.text import let
from attesta.llm.common import SPACES, query, table, word_count
from attesta.session import stored

SAMPLE_ROWS = 2000
TEXT = "_text"
BLANK = " \t\n\x0b\f\r"


def c(name: str) -> Column:
    return F.col(name)


def _windows(words: Column) -> Column:
    """Hashes of the 3-word windows: one per word but the last two."""
    return let(words, lambda w: F.slice(F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))), 1, F.greatest(F.lit(0), F.size(w) - 2)))


def _covered(windows: Column) -> Column:
    """Words in windows that occur twice or more.

    Few repeated windows are looked up in a list of them; with many, windows are sorted with their places and
    compared with their neighbours. Both give the same places. A repeated window covers its three words; one that
    starts less than three words before the next shares some.
    """
    again = let(F.sort_array(windows), lambda s: F.array_distinct(F.filter(s, lambda x, i: x == F.get(s, i + 1))))
    few = lambda d: F.filter(F.transform(windows, lambda x, i: F.when(F.array_contains(d, x), i)), lambda p: p.isNotNull())
    pairs = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    beside = lambda v, e, i: F.coalesce((e["x"] == F.get(v, i - 1)["x"]) | (e["x"] == F.get(v, i + 1)["x"]), F.lit(False))
    many = let(pairs, lambda v: F.sort_array(F.transform(F.filter(v, lambda e, i: beside(v, e, i)), lambda e: e["i"])))
    places = let(again, lambda d: F.when(F.size(d) > 16, many).otherwise(few(d)))
    return let(places, lambda p: F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3)))), F.lit(0).cast("long"), lambda t, x: t + x))


def repeat_words(text: Column, n_words: Column) -> Column:
    """Words in 3-word windows found twice or more in the text."""
    words = F.split(F.btrim(text, F.lit(BLANK)), SPACES)
    repeats = lambda w: F.size(w) > F.size(F.array_distinct(w))
    counted = let(_windows(words), lambda w: F.when(repeats(w), _covered(w)).otherwise(F.lit(0).cast("long")))
    return F.when(n_words > 2, counted).otherwise(F.lit(0).cast("long"))


def _kept_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def line_words(text: Column, n_words: Column) -> Column:
    """(n, dup, words): lines with a word, those of them equal to an earlier line, and the words in these. No word crosses a line."""
    once = lambda d: word_count(F.array_join(d, "\n"))
    held = lambda x, d: F.when(F.size(d) < F.size(x), n_words - once(d)).otherwise(F.lit(0).cast("long"))
    made = lambda x, d: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(d)).cast("long").alias("dup"), held(x, d).alias("words"))
    return let(_kept_lines(text), lambda x: let(F.array_distinct(x), lambda d: made(x, d)))


def fresh_repeat_words(text: Column, n_words: Column) -> Column:
    """Words in 3-word windows found twice or more in the text without its repeated lines."""
    once = F.array_join(F.array_distinct(F.split(text, "\n")), "\n")
    return let(once, lambda t: repeat_words(t, n_words))


def neighbours(text: Column, n_words: Column) -> Column:
    """Words equal to the one before, of a text too short to repeat whole windows; 0 for others."""
    words = F.split(F.btrim(text, F.lit(BLANK)), SPACES)
    counted = let(words, lambda w: F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1))).cast("long"))
    return F.when(n_words < SHORT, counted).otherwise(F.lit(0).cast("long"))


@dataclass(frozen=True)
class Rule:
    """``measure`` makes a column of the text and its word count; ``rejects`` judges that column and the word count."""

    name: str
    column: str
    measure: Callable[[Column, Column], Column]
    rejects: Callable[[Column, Column], Column]


SHORT = 50  # words

SYMBOLS = Rule("symbols", "n_symbols", lambda t, n: F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long"), lambda m, n: m * 10 > n)
LENGTH = Rule("word length", "word_chars", lambda t, n: (F.length(t) - F.regexp_count(t, F.lit(r"[\x20\x09-\x0D]"))).cast("long"), lambda m, n: (m < n * 2) | (m > n * 12))
# By the words that repeats hold: by line count, repeated headings would reject clean texts of few lines. One or two say nothing.
LINES = Rule("repeated lines", "lines", line_words, lambda m, n: (m["dup"] >= 3) & (m["words"] * 5 > n))
SHOUTING = Rule("shouting", "n_upper_words", lambda t, n: F.regexp_count(t, F.lit(r"\p{Lu}{2,}")).cast("long"), lambda m, n: (m >= 4) & (m * 10 > n * 3))


def standard_rules() -> tuple[Rule, ...]:
    """Rules for texts of any length: a short text is not rejected for being short."""
    return (
        Rule("no words", "n_words", lambda t, n: n, lambda m, n: n == 0),
        SYMBOLS, LENGTH, LINES, SHOUTING,
        Rule("repeated windows", "n_fresh_repeats", fresh_repeat_words, lambda m, n: m * 100 > n * 50),
        Rule("repeated neighbours", "n_neighbours", neighbours, lambda m, n: (m >= 3) & (m * 4 > n)),
    )


def contract_rules() -> tuple[Rule, ...]:
    """The rules of op9: its base rules, few words and repeated windows, and four others."""
    return (
        Rule("few words", "n_words", lambda t, n: n, lambda m, n: n < SHORT),
        SYMBOLS, LENGTH, LINES, SHOUTING,
        Rule("repeated windows", "n_repeat_words", repeat_words, lambda m, n: m * 100 > n * 50),
    )


def _rejects(rule: Rule) -> Column:
    return let(rule.measure(c(TEXT), c("n_words")), lambda m: rule.rejects(m, c("n_words")))


def rule_costs(docs: DataFrame, rules: Sequence[Rule], text: str = "text", rows: int = SAMPLE_ROWS, seed: int = 7) -> list[tuple[Rule, float, float]]:
    """(rule, seconds, share rejected) of each rule on a sample of about ``rows`` rows, which is kept in the shared folder."""
    total = docs.count()
    if not total:
        return [(r, 0.0, 0.0) for r in rules]
    picked = docs.select(c(text).alias(TEXT)).sample(fraction=min(1.0, rows / total), seed=seed)
    sample = stored(picked.select(F.coalesce(c(TEXT), F.lit("")).alias(TEXT)).withColumn("n_words", word_count(c(TEXT))), "sample")

    def timed(rule: Rule | None) -> tuple[float, float]:
        rejected = _rejects(rule) if rule else c("n_words") < 0
        begun = time.perf_counter()
        share = sample.agg(F.avg(rejected.cast("double"))).first()[0]
        return time.perf_counter() - begun, share or 0.0

    timed(None)
    least = timed(None)[0]
    out = []
    for rule in rules:
        seconds, share = timed(rule)
        out.append((rule, max(seconds - least, 1e-4), share))
    return out


def order(costs: Sequence[tuple[Rule, float, float]]) -> list[Rule]:
    """Rules by rejection per cost, highest first; equal ones by name."""
    return [r for r, seconds, share in sorted(costs, key=lambda x: (-x[2] / max(x[1], 1e-9), x[0].name))]


def cascade(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text", report: Sequence[str] = (), sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(_row, measures, rejected_by) of every row; ``rejected_by`` is null for kept rows.

    The columns named in ``report`` are measured for every row; the other measures only where no earlier rule has
    rejected. Null text counts as empty. Empty tables give no rows, repeated rows are judged each on its own, and the
    caller's columns travel in the struct ``_row``, so no name clashes.
    """
    chosen = order(rule_costs(docs, rules or standard_rules(), text, sample_rows))
    df = docs.select(F.struct("*").alias("_row"), F.coalesce(c(text), F.lit("")).alias(TEXT)).withColumn("n_words", word_count(c(TEXT)))
    reported = [r for r in chosen if r.column in report and r.column != "n_words"]
    df = df.select("_row", TEXT, "n_words", *[r.measure(c(TEXT), c("n_words")).alias(r.column) for r in reported])
    # Other measures stand inside their condition: they are only evaluated where no earlier rule has rejected.
    judged = [(r, r.rejects(c(r.column), c("n_words")) if r in reported or r.column == "n_words" else _rejects(r)) for r in chosen]
    verdict = F.lit(None).cast("string")
    for rule, rejects in reversed(judged):
        verdict = F.when(rejects, F.lit(rule.name)).otherwise(verdict)
    return df.withColumn("rejected_by", verdict).drop(TEXT)


def keep(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text") -> DataFrame:
    """The rows that no rule rejects, with the caller's columns."""
    return cascade(docs, rules, text).filter("rejected_by IS NULL").select("_row.*")


@query(
    "op9_quality_cascade",
    r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
    x AS (SELECT doc_id, unnest(generate_series(1, len(w) - 2)) AS i, w FROM w WHERE len(w) > 2),
    y AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win FROM x),
    z AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS held FROM y) WHERE held > 1),
    r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM z) GROUP BY 1),
    m AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
            CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
            len(w) - len(regexp_extract_all(array_to_string(list_distinct(l), chr(10)), '[^\x20\x09-\x0D]+')) AS n_line_words,
            CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, len(regexp_extract_all(t, '\p{Lu}{2,}')) AS n_upper
          FROM w LEFT JOIN r USING (doc_id)),
    b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 12 * n_words OR (n_dup_lines >= 3 AND 5 * n_line_words > n_words) OR (n_upper >= 4 AND 10 * n_upper > 3 * n_words)) AS kept
    FROM b
    """,
)
def op9_quality_cascade(spark, sf_dir):
    report = ("n_words", "n_symbols", "word_chars", "lines", "n_repeat_words")
    judged = cascade(table(spark, sf_dir, "documents").select("doc_id", "text"), contract_rules(), report=report)
    base = (c("n_words") < 50) | (c("n_repeat_words") * 100 > c("n_words") * 50)
    return judged.select(c("_row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", c("lines.dup").alias("n_dup_lines"), "n_repeat_words", base.alias("base_failed"), c("rejected_by").isNull().alias("kept"))
