"""Name and text columns: folding, tokens, phrases, identifiers, spans.

Everything here is a native expression, so it stays inside generated code;
``fold_exact`` is the one Python fallback, for scripts the native table omits.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType, StringType

from attesta import lexicon as lx


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it.

    Column functions repeat their arguments; a one-element transform names them, which
    keeps plans small.
    """
    return F.transform(F.array(value), body)[0]


def lit_strings(values: list[str]) -> Column:
    """A string list as one array literal."""
    return F.array(*[F.lit(v) for v in values])


@lru_cache(maxsize=1)
def _ascii_table() -> tuple[str, str]:
    """Every BMP character whose compatibility form is exactly one ASCII character."""
    source, target = [], []
    for code in range(0x80, 0x10000):
        if 0xD800 <= code <= 0xDFFF:
            continue
        plain = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            source.append(chr(code))
            target.append(plain)
    return "".join(source), "".join(target)


@lru_cache(maxsize=1)
def _wide_forms() -> list[tuple[str, str]]:
    """Common characters whose compatibility form is several ASCII characters."""
    wide = "…™½¼¾ﬁﬂﬀﬃﬄĳĲ№℃ŉǆǉǌ"
    return [(c, unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()) for c in wide]


def to_ascii(text: Column) -> Column:
    """Compatibility-decompose to ASCII and drop the rest."""
    for wide, plain in _wide_forms():
        text = F.replace(text, F.lit(wide), F.lit(plain))
    source, target = _ascii_table()
    return F.regexp_replace(F.translate(text, source, target), r"[^\x00-\x7F]+", "")


def fold(text: Column) -> Column:
    """Lower-case ASCII with the Nordic letters written out: ø→o, å→a, æ→ae."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    text = F.replace(F.replace(text, F.lit("æ"), F.lit("ae")), F.lit("Æ"), F.lit("AE"))
    return F.lower(to_ascii(F.translate(text, "øØåÅ", "oOaA")))


def fold_lead(text: Column, double: bool = False) -> Column:
    """Folding for domain leads; ``double`` writes ø as oe and å as aa."""
    text = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    for letter, plain in (("ø", "oe" if double else "o"), ("å", "aa" if double else "a"), ("æ", "ae"), ("ß", "ss")):
        text = F.replace(text, F.lit(letter), F.lit(plain))
    return to_ascii(text)


def fold_job_board(text: Column) -> Column:
    """Folding for job-board names: ``aa`` also becomes ``a``; punctuation becomes a space."""
    text = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    for letter, plain in (("æ", "ae"), ("ø", "o"), ("å", "a"), ("aa", "a"), ("ß", "ss")):
        text = F.replace(text, F.lit(letter), F.lit(plain))
    source, target = _ascii_table()
    text = F.regexp_replace(F.translate(text, source, target), r"\p{M}+", "")
    text = F.regexp_replace(text, r"(?U)[^\w\s]", " ")
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


@F.pandas_udf(StringType())
def fold_exact(text: pd.Series) -> pd.Series:
    """Full Unicode folding in Arrow batches, for text outside the native table."""
    nordic = str.maketrans({"ø": "o", "Ø": "O", "å": "a", "Å": "A", "æ": "ae", "Æ": "AE"})
    plain = text.fillna("").str.translate(nordic).str.normalize("NFKD")
    return plain.str.encode("ascii", "ignore").str.decode("ascii").str.lower()


def words(text: Column) -> Column:
    """Folded alphanumeric words in order."""
    return F.regexp_extract_all(fold(text), F.lit("([a-z0-9]+)"), F.lit(1))


def word_line(text: Column) -> Column:
    """Folded words joined by single spaces; the form phrase tests run on."""
    return F.array_join(words(text), " ")


def long_words(text: Column) -> Column:
    """Folded words of two letters or more."""
    return F.regexp_extract_all(fold(text), F.lit("([a-z0-9]{2,})"), F.lit(1))


def _telling(found: Column) -> Column:
    base = F.array_except(found, lit_strings(lx.NAME_NOISE_BASE))
    return let(F.array_except(found, lit_strings(lx.NAME_NOISE)), lambda strict: F.when(F.size(strict) > 0, strict).otherwise(base))


def name_tokens(name: Column) -> Column:
    """Distinct telling words of a legal name, in order."""
    return let(long_words(name), _telling)


def text_tokens(text: Column) -> Column:
    """``name_tokens`` of a whole text; one that is ASCII as it stands is not folded letter by letter."""
    folded = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(fold(text))
    return let(F.regexp_extract_all(folded, F.lit("([a-z0-9]{2,})"), F.lit(1)), _telling)


def _without(array: Column, noise: list[str]) -> Column:
    """Drop noise words but keep repeats, unlike array_except."""
    return F.filter(array, lambda w: ~w.isin(noise))


def owner_tokens(text: Column) -> Column:
    """Words of two letters or more that are not generic, repeats kept."""
    return _without(long_words(text), lx.OWNER_GENERIC)


def exact_name_tokens(name: Column) -> Column:
    """As owner tokens but keeping single letters, which tell sister companies apart."""
    return _without(words(name), [w for w in lx.OWNER_GENERIC if w not in ("b", "v")])


def lead_words(text: Column, double: bool = False) -> Column:
    found = F.regexp_extract_all(fold_lead(text, double), F.lit("([a-z0-9]+)"), F.lit(1))
    return _without(found, lx.LEAD_LEGAL + ["og", "and", "the"])


def normalize_employer(name: Column) -> Column:
    """Employer name without its trailing legal forms."""
    plain = F.lower(to_ascii(F.coalesce(name.cast("string"), F.lit(""))))
    line = F.concat(F.lit(" "), F.array_join(F.regexp_extract_all(plain, F.lit("([a-z0-9]+)"), F.lit(1)), " "))
    line = F.regexp_replace(line, "( (" + "|".join(lx.EMPLOYER_SUFFIX_PAIRS) + "))+$", "")
    return F.trim(F.regexp_replace(line, "( (" + "|".join(lx.EMPLOYER_SUFFIXES) + "))+$", ""))


def strip_legal_form(folded: Column) -> Column:
    """Drop one trailing legal form unless it is the whole name."""
    return F.regexp_replace(folded, "(?<=\\S) (" + "|".join(lx.JOB_BOARD_LEGAL_FORMS) + ")$", "")


def strip_branch(folded: Column) -> Column:
    """Drop a branch tail such as ``avd bergen``, then the legal form."""
    return strip_legal_form(F.trim(F.regexp_replace(folded, r"(?U)\b(?:avd|avdeling)\b.*$", "")))


def names_match(legal_name: Column, candidate: Column) -> Column:
    """Equality of job-board names, each side also tried without legal form or branch."""

    def same(folded: Column) -> Column:
        a, b = folded["a"], folded["b"]
        a_forms = F.array(a, strip_legal_form(a))
        b_forms = F.array(b, strip_legal_form(b))
        return (F.length(a) > 0) & (F.length(b) > 0) & (F.arrays_overlap(a_forms, b_forms) | F.array_contains(a_forms, strip_branch(b)))

    return let(F.struct(fold_job_board(legal_name).alias("a"), fold_job_board(candidate).alias("b")), same)


def has_phrase(line: Column, phrase: Column) -> Column:
    """Whole-word phrase test between two ``word_line`` columns."""
    hit = F.contains(F.concat(F.lit(" "), line, F.lit(" ")), F.concat(F.lit(" "), phrase, F.lit(" ")))
    return (F.length(phrase) > 0) & F.coalesce(hit, F.lit(False))


def token_hits(tokens: Column, text: Column) -> Column:
    """Tokens found in folded text: long ones anywhere, short ones as whole words only."""

    def hits(bounded: Column) -> Column:
        return F.filter(
            tokens,
            lambda t: F.when(F.length(t) <= 3, F.contains(bounded, F.concat(F.lit(" "), t, F.lit(" ")))).otherwise(F.contains(text, t)),
        )

    return let(F.concat(F.lit(" "), F.regexp_replace(text, "[^a-z0-9_]+", " "), F.lit(" ")), hits)


def digits(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"\D+", "")


def find_org_numbers(text: Column) -> Column:
    """Distinct nine-digit identifiers: bare, in triples, or in VAT form."""
    grouped = F.regexp_extract_all(text, F.lit(r"(?U)(\b\d{3}[\s. ]?\d{3}[\s. ]?\d{3}\b)"), F.lit(1))
    vat = F.regexp_extract_all(text, F.lit(r"(?Ui)\bNO\s?(\d{9})\s?MVA\b"), F.lit(1))
    return F.array_distinct(F.concat(F.transform(grouped, lambda n: F.regexp_replace(n, r"\D", "")), vat))


# The check-digit weights.
ORG_WEIGHTS = [3, 2, 7, 6, 5, 4, 3, 2]


def mod11_valid(org: Column) -> Column:
    """Check digit of a nine-digit organisation number."""
    total = F.lit(0)
    for place, weight in enumerate(ORG_WEIGHTS, start=1):
        total = total + F.substring(org, place, 1).try_cast("int") * weight
    expected = F.pmod(F.lit(11) - total % 11, F.lit(11))
    matches = (expected < 10) & (expected == F.substring(org, 9, 1).try_cast("int"))
    return F.coalesce(org.rlike(r"^[0-9]{9}$") & matches, F.lit(False))


def valid_org_numbers(text: Column) -> Column:
    return F.filter(find_org_numbers(text), mod11_valid)


def number_in_text(number: Column, text: Column) -> Column:
    """The number itself, its digits at most spaced or dotted, never glued to other digits."""
    spaced = F.regexp_replace(number, r"(\d)(?=\d)", r"$1[\\s.]*")
    pattern = F.concat(F.lit(r"(?<!\d)"), spaced, F.lit(r"(?!\d)"))
    return F.coalesce((F.length(number) > 0) & F.rlike(text, pattern), F.lit(False))


def proof_span(text: Column, needle: Column, width: int = 120) -> Column:
    """The words around the first hit of ``needle``, or NULL."""
    direct = F.position(F.lower(needle), F.lower(text))
    place = F.when(direct > 0, direct).otherwise(F.position(F.lower(needle), fold(text)))
    start = F.greatest(F.lit(1), place - width // 2)
    length = place + F.length(needle) + width // 2 - start
    span = F.trim(F.regexp_replace(F.substr(text, start, length), r"(?U)\s+", " "))
    return F.when(place > 0, span)


def any_marker(text: Column, markers: list[str]) -> Column:
    """Whether any literal marker occurs; one pass through an alternation."""
    escaped = "|".join("".join("\\" + c if c in r".^$*+?()[]{}|\/-" else c for c in m) for m in markers)
    return F.coalesce(text.rlike(escaped), F.lit(False))


def headline_sentiment(title: Column) -> Column:
    """Label from the two headline word lists; both or neither is neutral."""
    text = F.lower(F.coalesce(title, F.lit("")))
    good, bad = any_marker(text, lx.POSITIVE_WORDS), any_marker(text, lx.NEGATIVE_WORDS)
    return F.when(good & ~bad, "positive").when(bad & ~good, "negative").otherwise("neutral")


def rating_polarity(rating: Column, scale: Column) -> Column:
    """Label of one review from its rating's share of the scale."""
    ratio = rating / F.nullif(scale, F.lit(0.0))
    return F.when(ratio.isNull(), None).when(ratio >= 0.8, "positive").when(ratio <= 0.4, "negative").otherwise("neutral")


def star_polarity(stars: Column) -> Column:
    return F.when(stars.isNull(), None).when(stars <= 2, "negative").when(stars >= 4, "positive").otherwise("neutral")


def format_amount_compact(value: Column) -> Column:
    """1.25B / 3.40M / 7.5k / 12, with the sign in front and the currency behind."""
    size = F.abs(value)
    sign = F.when(value < 0, "-").otherwise("")
    body = (
        F.when(size >= 1e9, F.concat(F.format_string("%.2f", size / 1e9), F.lit("B")))
        .when(size >= 1e6, F.concat(F.format_string("%.2f", size / 1e6), F.lit("M")))
        .when(size >= 1e3, F.concat(F.format_string("%.1f", size / 1e3), F.lit("k")))
        .otherwise(F.floor(size).cast("string"))
    )
    return F.when(value.isNull(), "N/A").otherwise(F.concat(sign, body, F.lit(" NOK")))


def format_amount_grouped(value: Column, currency: Column) -> Column:
    grouped = F.replace(F.format_number(value, 0), F.lit(","), F.lit(" "))
    return F.when(value.isNotNull(), F.concat(F.coalesce(currency, F.lit("NOK")), F.lit(" "), grouped))


def format_address(street: Column, postcode: Column, town: Column, country: Column) -> Column:
    place = F.trim(F.concat_ws(" ", F.nullif(postcode, F.lit("")), F.nullif(town, F.lit(""))))
    return F.concat_ws(
        ", ",
        F.nullif(street, F.lit("")),
        F.nullif(place, F.lit("")),
        F.coalesce(F.nullif(country, F.lit("")), F.lit("Norge")),
    )


@F.pandas_udf(DoubleType())
def fuzzy_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity, which no built-in expression measures; NULL where either side is."""
    from difflib import SequenceMatcher

    both = left.notna() & right.notna()
    return pd.Series([SequenceMatcher(None, a, b).ratio() if ok else None for a, b, ok in zip(left, right, both)], dtype="float64")
