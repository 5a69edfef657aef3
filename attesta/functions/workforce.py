"""Headcounts stated in report text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from attesta import lexicon as lx
from attesta.functions.text import let

# The phrases that state a headcount, by priority and measure. A scanner may have read a zero as the letter O.
PHRASES = [
    (0, "full_time_equivalents", r"(?i)(?:antall|tal\s+p[aå])\s+(?:aarsverk|arsverk|årsverk)\s+i\s+(?:regnskapsaret|rekneskapsaret)\s*(?:er|:|=)?\s*((?-i:\b[0-9O][0-9O .,-]{0,8}))"),
    (0, "full_time_equivalents", r"(?i)antall\s+(?:aarsverk|arsverk|årsverk)(?:\s+sysselsatt\s+i\s+regnskapsaret)?\s*(?:er|:|=)?\s*((?-i:\b[0-9O][0-9O .,-]{0,8}))"),
    (0, "full_time_equivalents", r"(?i)selskapet\s+har(?:\s+[i1]\s+\d{4})?\s+sysselsatt\s+((?-i:\b[0-9O][0-9O .,-]{0,8}))\s+(?:aarsverk|arsverk|årsverk)"),
    (0, "full_time_equivalents", r"(?i)selskapet\s+har\s+((?-i:\b[0-9O][0-9O .,-]{0,8}))\s+(?:aarsverk|arsverk|årsverk)"),
    (0, "full_time_equivalents", r"(?i)antall\s+(?:aarsverk|arsverk|årsverk)\s+(?:sysselsatt|syssetsatt)\s+i\s+regnskapsaret\s*(?:er|:|=)?\s*((?-i:\b[0-9O][0-9O .,-]{0,8}))"),
    (1, "employees", r"(?i)gjennomsnittlig(?:e)?\s+antall\s+ansatte(?:\s+i\s+regnskapsaret)?\s*(?:er|:|=)?\s*((?-i:\b[0-9O][0-9O .,-]{0,8}))"),
    (1, "employees", r"(?i)antall\s+ansatte\s*(?:er|:|=)?\s*((?-i:\b[0-9O][0-9O .,-]{0,8}))"),
    (2, "employees", r"(?i)((?-i:\b[0-9O][0-9O .,-]{0,8}))\s+(?:heltids)?ansatte\b"),
]
WORDED = r"(?i)\b(?:det\s+er|selskapet\s+har)\s+(ingen|en|ett|to|tre|fire|fem)\s+ansatte\b"
ZERO = (
    r"(?i)\b(?:selskapet|stiftelsen|legatet|sameiet|det)\s+(?:har\s+ingen\s+(ansatte|(?:aarsverk|arsverk|årsverk))|"
    r"har\s+ikke\s+hatt\s+(?:noen\s+)?ansatte|hadde\s+ingen\s+ansatte|ikke\s+har\s+ansatte)\b"
)
GROUP_LINE = r"(?im)^.*(?:konsern|group).*$"
MOST = 100_000


def _all(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def number_value(raw: Column) -> Column:
    """The number that text states the Norwegian way: blanks and points group digits, a comma is the decimal sign, and so is a point before one or two last digits."""
    bare = F.regexp_replace(F.translate(raw, "O ", "0"), r"^[.,\-]+|[.,\-]+$", "")
    # A point before the last one or two digits of a number without comma is read as a comma.
    marked = F.when(~F.contains(bare, F.lit(",")), F.regexp_replace(bare, r"\.(\d{1,2})$", ",$1")).otherwise(bare)
    value = F.round(F.translate(marked, ",.", ".").try_cast("double"), 2)
    return F.when(value >= 0, value)


def workforce_from_text(text: Column) -> Column:
    """struct(value, measure, span, status): the best-placed phrase, or why there is none.

    Lines about the whole group are blanked first. Phrases of one priority that give
    different numbers cancel each other. A number above MOST is no headcount; a text that states nothing else is refused for it.
    """
    body = F.regexp_replace(F.regexp_replace(text, r"[\t\r ]+", " "), GROUP_LINE, "")
    plausible = lambda every: F.filter(every, lambda h: h["value"] <= MOST)
    return let(body, lambda lines: let(_phrases(lines), lambda every: let(plausible(every), lambda kept: _verdict(lines, kept, F.size(kept) < F.size(every)))))


def _phrases(body: Column) -> Column:
    """Every stated number in order of trust."""

    def found(priority: int, measure: str, place: int, values: Column) -> Column:
        wrap = lambda v: F.struct(  # noqa: E731 - a column helper, not a function of rows
            F.lit(priority).alias("priority"), F.lit(0 if measure == "full_time_equivalents" else 1).alias("later"), F.lit(place).alias("place"),
            v.cast("double").alias("value"), F.lit(measure).alias("measure"),
        )
        return F.transform(F.filter(values, lambda v: v.isNotNull()), wrap)

    hits = [found(p, m, i, F.transform(_all(body, pattern, 1), number_value)) for i, (p, m, pattern) in enumerate(PHRASES)]
    counts = F.create_map(*[F.lit(v) for pair in lx.WORD_COUNTS.items() for v in pair])
    hits.append(found(2, "employees", len(PHRASES), F.transform(_all(body, WORDED, 1), lambda w: F.try_element_at(counts, F.lower(w)))))
    zeros = _all(body, ZERO, 1)
    man_years = F.filter(zeros, lambda z: z.rlike("(?i)verk"))
    persons = F.filter(zeros, lambda z: ~z.rlike("(?i)verk"))
    hits.append(found(0, "full_time_equivalents", len(PHRASES) + 1, F.transform(man_years, lambda _: F.lit(0.0))))
    hits.append(found(0, "employees", len(PHRASES) + 1, F.transform(persons, lambda _: F.lit(0.0))))
    return F.array_sort(F.concat(*hits))


def _verdict(body: Column, every: Column, too_large: Column) -> Column:
    first = F.try_element_at(every, F.lit(1))
    best = F.filter(every, lambda h: h["priority"] == first["priority"])
    agreed = F.size(F.array_distinct(F.transform(best, lambda h: h["value"]))) == 1
    # The line, or lines, the chosen phrase stands in.
    patterns = [p for _, _, p in PHRASES] + [WORDED, ZERO]
    span = F.coalesce(*[F.when(first["place"] == i, F.trim(F.regexp_extract(body, "[^\\n]*(?:" + p + ")[^\\n]*", 0))) for i, p in enumerate(patterns)])
    status = F.when((F.size(every) == 0) & too_large, "employee_count_out_of_range").when(F.size(every) == 0, "no_employee_phrase").when(~agreed, "conflicting_employee_counts").otherwise("accepted")
    good = (F.size(every) > 0) & agreed
    return F.struct(
        F.when(good, first["value"]).alias("value"), F.when(good, first["measure"]).alias("measure"), F.when(good, span).alias("span"), status.alias("status")
    )


def needs_ocr(text: Column) -> Column:
    """Too little text, or none about staff: the report's images still have to be read."""
    return (F.length(F.trim(text)) < 100) | ~text.rlike(r"(?i)ansatt|aarsverk|arsverk|årsverk|sysselsatt")
