"""Domain labels derived from a legal name, and the features that rank them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from attesta import lexicon as lx
from attesta.functions.text import lead_words, let, lit_strings, words
from attesta.functions.urls import host


def _joined(parts: Column, separator: str = "") -> Column:
    return F.array_join(parts, separator)


def _size_at_least(parts: Column, n: int) -> Column:
    return F.size(parts) >= n


def candidate_labels(name: Column, limit: int) -> Column:
    """Likely domain labels, best first: telling words joined, all words, hyphenated, stems, leading words, initials."""
    ending = "(" + "|".join(lx.LABEL_STEM_ENDINGS) + ")$"

    def stem(t: Column) -> Column:
        cut = F.regexp_replace(t, ending, "")
        return F.when(F.length(cut) >= 3, cut).otherwise(t)

    def ordered(tokens: Column, core: Column, stems: Column) -> Column:
        first = F.try_element_at(core, F.lit(1))
        several, stemmed = _size_at_least(core, 2), stems != core
        listed = F.array(
            _joined(core), _joined(tokens), _joined(core, "-"),
            F.when(stemmed, _joined(stems)), F.when(stemmed, _joined(stems, "-")),
            F.when(several, _joined(F.slice(core, 1, 2))),
            F.when(~several | (F.length(first) >= 4), first),
            F.when(several, _joined(F.transform(core, lambda t: F.substring(t, 1, 1)))),
        )
        kept = F.filter(F.array_compact(listed), lambda label: F.length(label) >= 3)
        return F.slice(F.array_distinct(kept), 1, limit)

    def telling(tokens: Column) -> Column:
        core = F.filter(tokens, lambda t: ~t.isin(lx.LABEL_FILLER))
        return let(F.when(F.size(core) > 0, core).otherwise(tokens), lambda c: let(F.transform(c, stem), lambda s: ordered(tokens, c, s)))

    return let(words(name), telling)


def candidate_hosts(name: Column, legal_form: Column, limit: int) -> Column:
    """Labels under .no and .com first; country endings the name hints at come last."""
    return let(candidate_labels(name, limit), lambda labels: _hosts(name, legal_form, labels))


def _hosts(name: Column, legal_form: Column, labels: Column) -> Column:
    plain = F.split(F.lower(F.coalesce(name, F.lit(""))), r"\s+")

    def under(ending: str) -> Column:
        return F.transform(labels, lambda label: F.concat(label, F.lit(ending)))

    def tail(ending: str, word: str, form: str | None) -> Column:
        hint = F.array_contains(plain, word)
        hint = hint | (F.coalesce(legal_form, F.lit("")) == form) if form else hint
        return F.when(hint, under(ending)).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(
        F.concat(under(".no"), under(".com"), tail(".se", "ab", "NUF"), tail(".dk", "aps", None), tail(".as", "as", "AS"))
    )


def domain_guesses(name: Column, town: Column, limit: int) -> Column:
    """Guessed homepages in priority order; equal priorities keep their listed order."""
    def made(found: Column) -> Column:
        return _guesses(found["tokens"], found["place"], found["other"], limit)

    found = F.struct(lead_words(name).alias("tokens"), lead_words(town).alias("place"), _joined(lead_words(name, double=True)).alias("other"))
    return let(found, made)


def _guesses(tokens: Column, place: Column, other: Column, limit: int) -> Column:
    size = F.size(tokens)
    joined = _joined(tokens)
    last, first = F.try_element_at(tokens, F.lit(-1)), F.try_element_at(tokens, F.lit(1))
    several = size > 1
    without_last = _joined(F.slice(tokens, F.lit(1), F.greatest(F.lit(0), size - 1)))
    n = F.size(place)
    ends_in_place = (n > 0) & (size >= n) & (F.slice(tokens, F.greatest(F.lit(1), size - n + 1), F.greatest(F.lit(1), n)) == place)
    without_place = _joined(F.slice(tokens, F.lit(1), F.greatest(F.lit(0), size - n)))
    tail = several & last.isin(lx.LEAD_TAILS)
    own_first = several & ~first.isin(lx.LEAD_GENERIC_FIRST)
    nursery = F.arrays_overlap(tokens, lit_strings(["barnehage", "barnehager"]))
    short = F.transform(tokens, lambda t: F.when(t.isin("barnehage", "barnehager"), "bhg").otherwise(t))

    plan = [
        (F.lit(True), joined, "no", 100), (size <= 4, joined, "com", 96),
        (several, _joined(tokens, "-"), "no", 94), (tail, without_last, "no", 98), (tail, without_last, "com", 92),
        (several & ends_in_place, without_place, "no", 97), (own_first, first, "no", 90), (own_first, first, "com", 88),
        (size >= 3, _joined(F.slice(tokens, 1, 2)), "no", 91), (nursery, _joined(short, "-"), "no", 95), (nursery, _joined(short), "no", 95),
        (F.lit(True), F.concat(joined, F.lit("as")), "no", 80), (F.lit(True), F.concat(joined, F.lit("-as")), "no", 79),
        (other != joined, other, "no", 93),
    ]
    entries = []
    for turn, (wanted, stem, ending, priority) in enumerate(plan):
        usable = wanted & (size > 0) & F.length(stem).between(3, 60) & stem.rlike("^[a-z0-9]+(?:-[a-z0-9]+)*$")
        url = F.concat(F.lit("https://"), stem, F.lit(f".{ending}/"))
        entries.append(F.when(usable, F.struct(F.lit(-priority).alias("p"), F.lit(turn).alias("i"), url.alias("url"))))
    ranked = F.array_sort(F.array_compact(F.array(*entries)))
    return F.slice(F.array_distinct(F.transform(ranked, lambda e: e["url"])), 1, limit)


def employee_bucket(staff: Column) -> Column:
    n = F.coalesce(staff.cast("int"), F.lit(0))
    return F.when(n == 0, "0").when(n < 5, "1-4").when(n < 20, "5-19").when(n < 100, "20-99").otherwise("100+")


def trigrams(text: Column) -> Column:
    """Distinct three-letter pieces; none for shorter text."""
    pieces = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text) - 2)), lambda i: F.substr(text, i, F.lit(3)))
    return F.when(F.length(text) >= 3, F.array_distinct(pieces)).otherwise(F.array().cast("array<string>"))


# The ranker's inputs.
NUMERIC_FEATURES = [
    "rank", "variant_index", "is_top_variant", "tld_no", "label_len", "label_is_full_slug", "label_is_single_token",
    "name_token_count", "name_single_token", "trigram_jaccard", "char_coverage", "has_hyphen", "employees", "bankrupt", "has_accounts",
]
CATEGORICAL_FEATURES = ["employee_bucket", "legal_form"]


def candidate_features(name: Column, site: Column, staff: Column, legal_form: Column, bankrupt: Column, accounts: Column) -> Column:
    """struct of the seventeen features of one (entity, host) pair, for training and scoring alike."""
    def parts(label: Column) -> Column:
        dotted = F.contains(label, F.lit("."))
        core = F.when(dotted, F.regexp_replace(label, r"\.[^.]*$", "")).otherwise(label)
        ending = F.when(dotted, F.concat(F.lit("."), F.substring_index(label, ".", -1))).otherwise("")
        tokens = words(name)
        return F.struct(core.alias("core"), ending.alias("ending"), tokens.alias("tokens"), _joined(tokens).alias("slug"), candidate_labels(name, 6).alias("variants"))

    def grams(p: Column) -> Column:
        place = F.array_position(p["variants"], p["core"]).cast("int") - 1
        return F.struct(p.alias("p"), trigrams(p["core"]).alias("mine"), trigrams(p["slug"]).alias("theirs"), place.alias("place"))

    def bit(test: Column) -> Column:
        return F.coalesce(test, F.lit(False)).cast("int")

    def made(g: Column) -> Column:
        p, place = g["p"], g["place"]
        core, slug, tokens = p["core"], p["slug"], p["tokens"]
        union = F.size(F.array_union(g["mine"], g["theirs"]))
        overlap = F.when(union > 0, F.size(F.array_intersect(g["mine"], g["theirs"])) / union).otherwise(0.0)
        return F.struct(
            F.greatest(F.lit(1), place + 1).alias("rank"), place.alias("variant_index"), bit(place == 0).alias("is_top_variant"),
            bit(p["ending"] == ".no").alias("tld_no"), F.length(core).alias("label_len"), bit(core == slug).alias("label_is_full_slug"),
            bit(F.array_contains(tokens, core)).alias("label_is_single_token"), F.size(tokens).alias("name_token_count"),
            bit(F.size(tokens) <= 1).alias("name_single_token"), F.round(overlap, 4).alias("trigram_jaccard"),
            F.round(F.length(core) / F.greatest(F.lit(1), F.length(slug)), 4).alias("char_coverage"),
            bit(F.contains(core, F.lit("-"))).alias("has_hyphen"), F.coalesce(staff.cast("int"), F.lit(0)).alias("employees"),
            employee_bucket(staff).alias("employee_bucket"),
            F.coalesce(F.nullif(legal_form, F.lit("")), F.lit("?")).alias("legal_form"), bit(bankrupt).alias("bankrupt"),
            bit(F.length(F.coalesce(accounts.cast("string"), F.lit(""))) > 0).alias("has_accounts"),
        )

    full = F.when(F.contains(site, F.lit("://")), site).otherwise(F.concat(F.lit("http://"), site))
    return let(let(let(host(full), parts), grams), made)


def search_queries(name: Column, org: Column, town: Column, operating_name: Column) -> Column:
    """The three-step search ladder, repeats dropped ignoring case."""
    def tidy(text: Column) -> Column:
        return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))

    full, place, number = tidy(name), tidy(town), F.regexp_replace(F.coalesce(org, F.lit("")), r"\D", "")
    suffix = r"(?i)\s+(?:" + "|".join(lx.QUERY_LEGAL_SUFFIXES) + r")\.?$"
    brand = F.trim(F.regexp_replace(F.trim(F.regexp_replace(full, suffix, "")), suffix, ""))

    def quoted(text: Column) -> Column:
        return F.concat(F.lit('"'), text, F.lit('"'))

    local = (
        F.when(F.length(tidy(operating_name)) > 0, F.concat(quoted(tidy(operating_name)), F.lit(" "), quoted(place)))
        .when((brand != "") & (place != ""), F.concat(quoted(brand), F.lit(" "), quoted(place)))
        .otherwise(F.concat(quoted(brand), F.lit(" Norway")))
    )
    anchored = F.when((number != "") & (full != ""), F.concat(quoted(number), F.lit(" "), quoted(full))).otherwise(quoted(number))
    ladder = F.array(F.concat(quoted(full), F.lit(" -site:proff.no -site:1881.no -site:dnb.com")), local, anchored)
    lowered = F.transform(ladder, F.lower)
    return F.filter(ladder, lambda q, i: F.array_position(lowered, F.lower(q)) == i + 1)


def discovery_query(name: Column, org: Column, town: Column) -> Column:
    def tidy(text: Column) -> Column:
        return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))

    place = F.when(tidy(town) != "", F.concat(F.lit(" "), tidy(town))).otherwise("")
    return F.concat(F.lit('"'), tidy(name), F.lit('" '), F.regexp_replace(org, r"\D", ""), place)


