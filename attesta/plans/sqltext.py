"""SQL pieces the oracles share: folding, tokens, hosts and paths in DuckDB's own terms."""

from __future__ import annotations

from attesta import lexicon as lx


def listed(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def fold(x: str) -> str:
    nordic = f"replace(replace(translate(coalesce({x}, ''), 'øØåÅ', 'oOaA'), 'æ', 'ae'), 'Æ', 'AE')"
    return f"lower(regexp_replace(strip_accents({nordic}), '[^\\x00-\\x7F]+', '', 'g'))"


def words(x: str) -> str:
    return f"regexp_extract_all({fold(x)}, '[a-z0-9]+')"


def long_words(x: str) -> str:
    return f"regexp_extract_all({fold(x)}, '[a-z0-9]{{2,}}')"


def distinct_without(tokens: str, noise: list[str]) -> str:
    """Tokens in order, repeats and noise dropped; ``tokens`` must be a column name."""
    return f"list_filter({tokens}, lambda t, i: NOT list_contains({listed(noise)}, t) AND list_position({tokens}, t) = i)"


def without(tokens: str, noise: list[str]) -> str:
    return f"list_filter({tokens}, lambda t: NOT list_contains({listed(noise)}, t))"


def name_tokens(raw: str) -> str:
    """Name tokens from a column of long words."""
    strict = distinct_without(raw, lx.NAME_NOISE)
    return f"CASE WHEN len({strict}) > 0 THEN {strict} ELSE {distinct_without(raw, lx.NAME_NOISE_BASE)} END"


def host(x: str) -> str:
    return f"regexp_replace(lower(regexp_extract({x}, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '^www\\.', '')"


def path(x: str) -> str:
    return f"regexp_extract({x}, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)"


def strip_tags(x: str) -> str:
    bare = f"regexp_replace({x}, '(?is)<script[^>]*>.*?</script>', ' ', 'g')"
    bare = f"regexp_replace({bare}, '(?is)<style[^>]*>.*?</style>', ' ', 'g')"
    bare = f"regexp_replace({bare}, '(?is)<noscript[^>]*>.*?</noscript>', ' ', 'g')"
    return f"trim(regexp_replace(regexp_replace({bare}, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))"


def title(html: str) -> str:
    return strip_tags(f"regexp_extract({html}, '(?is)<title[^>]*>(.*?)</title>', 1)")


def footer(html: str) -> str:
    return strip_tags(f"array_to_string(regexp_extract_all({html}, '(?is)<footer\\b[^>]*>(.*?)</footer>', 1), ' ')")
