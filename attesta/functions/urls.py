"""URL and host columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from attesta import lexicon as lx
from attesta.functions.text import let, lit_strings

HOST_PATTERN = r"^[a-z0-9.-]+\.[a-z]{2,}$"


def _with_scheme(url: Column) -> Column:
    url = F.trim(F.coalesce(url, F.lit("")))
    return F.when(url.rlike(r"(?i)^https?://"), url).otherwise(F.concat(F.lit("https://"), url))


def host(url: Column) -> Column:
    """Lower-case host without ``www.``, user, port; empty when there is none."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.regexp_replace(F.lower(raw), r"^www\.", "")


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def normalize_homepage(url: Column) -> Column:
    """Scheme, host and path of an HTTP(S) address; NULL when it is none."""
    full = _with_scheme(url)
    scheme = F.lower(F.regexp_extract(full, r"^(?i)(https?)://", 1))
    place = F.regexp_extract(full, r"^(?i)https?://([^/?#]*)", 1)
    path = url_path(full)
    clean = F.concat(scheme, F.lit("://"), place, F.when(F.length(path) > 0, path).otherwise("/"))
    blank = F.length(F.trim(F.coalesce(url, F.lit("")))) == 0
    return F.when(~blank & (F.length(host(full)) > 0), clean)


def normalize_site(url: Column) -> Column:
    """``https://host`` of a register website field; NULL for blanks, dashes and non-hosts."""
    value = F.trim(F.coalesce(url, F.lit("")))
    bare = F.regexp_replace(F.regexp_replace(value, r"(?i)^\s*(https?://)?", ""), r"^[/ \t]+|[/ \t]+$", "")
    name = F.regexp_replace(F.lower(F.regexp_extract(bare, r"^([^/]*)", 1)), r"^www\.", "")
    good = ~value.isin("", "-", "n/a") & ~F.contains(bare, F.lit(" ")) & name.rlike(HOST_PATTERN)
    return F.when(good, F.concat(F.lit("https://"), name))


def canonical_url(url: Column) -> Column:
    """Comparison form: lower host, no trailing slash, no fragment, no tracking parameters."""
    url = F.coalesce(url, F.lit(""))
    scheme = F.lower(F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1))
    place = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_replace(url_path(url), r"/+$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.filter(
        F.split(query, "&"),
        lambda p: p.rlike("^[^=]+=.") & ~p.startswith("utm_") & ~p.rlike("^fbclid="),
    )
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.concat(scheme, F.lit("://"), place, path, tail)


def candidate_key(url: Column) -> Column:
    """Host and path that make two leads the same lead."""
    home = normalize_homepage(url)
    return F.coalesce(F.concat(host(home), F.regexp_replace(url_path(home), r"/+$", "")), F.lit(""))


def host_suffixes(name: Column) -> Column:
    """``a.b.c`` → [``a.b.c``, ``b.c``, ``c``]: block lists become equality tests."""
    parts = F.split(name, r"\.")
    size = F.size(parts)
    return F.transform(F.sequence(F.lit(1), size), lambda i: F.array_join(F.slice(parts, i, size), "."))


def host_listed(name: Column, listed: list[str]) -> Column:
    """Host equals, or is a subdomain of, an entry of a fixed list."""
    return F.coalesce(F.arrays_overlap(host_suffixes(name), lit_strings(listed)), F.lit(False))


def is_directory_host(name: Column) -> Column:
    below = F.slice(host_suffixes(name), 2, 20)
    return host_listed(name, lx.DIRECTORY_HOSTS) | F.arrays_overlap(below, lit_strings(lx.PUBLIC_SECTOR_SUFFIXES))


def is_listing_host(name: Column) -> Column:
    return host_listed(name, lx.LISTING_HOSTS)


def registered_domain(name: Column, suffixes: list[str] | None = None) -> Column:
    """The label above the longest known public suffix, with that suffix."""
    known = lit_strings(suffixes or lx.PUBLIC_SUFFIXES)
    chain = host_suffixes(name)
    place = F.array_position(F.transform(chain, lambda s: F.array_contains(known, s)), True)
    return F.when(place > 1, F.element_at(chain, (place - 1).cast("int"))).otherwise("")


def with_registered_domain(df: DataFrame, name: str, suffixes: DataFrame, out: str = "registered_domain") -> DataFrame:
    """As above against a suffix table of any size: explode, equi-join, keep the longest."""
    hosts = df.select(F.col(name).alias("_host")).distinct()
    places = hosts.select("_host", host_suffixes(F.col("_host")).alias("_chain")).select(
        "_host", "_chain", F.posexplode("_chain").alias("_place", "suffix")
    )
    best = (
        places.join(suffixes.select("suffix").distinct(), "suffix")
        .groupBy("_host")
        .agg(F.min_by(F.struct("_place", "_chain"), "_place").alias("_hit"))
        .select(
            F.col("_host").alias(name),
            F.when(F.col("_hit._place") > 0, F.element_at("_hit._chain", F.col("_hit._place"))).alias(out),
        )
    )
    return df.join(best, name, "left").withColumn(out, F.coalesce(out, F.lit("")))


def mail_host(address: Column) -> Column:
    """Host part of an e-mail address, empty when there is none."""
    part = F.lower(F.trim(F.element_at(F.split(F.coalesce(address, F.lit("")), "@"), -1)))
    return F.when(F.contains(F.coalesce(address, F.lit("")), F.lit("@")), part).otherwise("")


# First path parts that are never a profile.
SOCIAL_NOISE = {
    "facebook": ["sharer", "sharer.php", "share.php", "dialog", "policy.php", "privacy", "events", "groups",
                 "plugins", "login", "signup", "profile.php"],
    "instagram": ["p", "reel", "reels", "stories", "explore", "about"],
    "x": ["intent", "share", "home", "search", "i", "privacy"],
    "linkedin": ["sharearticle", "sharing", "login", "signup", "feed"],
}
SOCIAL_URL = r"(?i)(?:" + "|".join(h.replace(".", r"\.") for h in lx.SOCIAL_HOSTS) + ")"


def _profile_address(platform: Column, parts: Column) -> Column:
    """struct(platform, url) of a platform and its path parts; NULL when they name no profile."""

    def made(first: Column) -> Column:
        handle = first.startswith("@")
        noise = F.lit(False)
        for label, banned in SOCIAL_NOISE.items():
            noise = noise | ((platform == label) & first.isin(banned))
        wrong_shape = (
            ((platform == "linkedin") & ((first != "company") | (F.size(parts) < 2)))
            | ((platform == "youtube") & ~first.isin("channel", "user", "c") & ~handle)
            | ((platform == "tiktok") & ~handle)
            | ((platform == "x") & (F.size(parts) != 1))
        )
        paged = (platform == "facebook") & (first == "pages") & (F.size(parts) > 1)
        depth = (
            F.when(platform == "linkedin", 2)
            .when(platform == "youtube", F.when(handle, 1).otherwise(2))
            .when(platform.isin("facebook", "instagram", "x"), 1)
            .otherwise(100)
        )
        path = F.array_join(F.slice(parts, F.when(paged, 2).otherwise(1), depth), "/")
        address = F.concat(F.lit("https://"), platform, F.lit(".com/"), path)
        good = platform.isNotNull() & (F.size(parts) > 0) & ~noise & ~wrong_shape
        return F.when(good, F.struct(platform.alias("platform"), address.alias("url")))

    return let(F.lower(F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit(""))), made)


def normalize_social_url(url: Column) -> Column:
    """struct(platform, url) of a profile address; NULL for share, login and post links."""
    trimmed = F.regexp_replace(F.trim(F.coalesce(url, F.lit(""))), r"[.,)\"']+$", "")

    def absolute(text: Column) -> Column:
        return F.when(text.startswith("//"), F.concat(F.lit("https:"), text)).otherwise(_with_scheme(text))

    def unwrapped(text: Column) -> Column:
        # A page plug-in carries the real profile address in its query.
        plugin = (host(text) == "facebook.com") & url_path(text).startswith("/plugins/")
        return F.when(plugin, F.url_decode(F.regexp_extract(text, r"[?&]href=([^&#]*)", 1))).otherwise(text)

    def platform(chain: Column) -> Column:
        return F.coalesce(*[F.when(F.array_contains(chain, h), F.lit(label)) for h, label in lx.SOCIAL_HOSTS.items()])

    def parts(text: Column) -> Column:
        return F.filter(F.transform(F.split(url_path(text), "/"), F.trim), lambda p: F.length(p) > 0)

    def profile(text: Column) -> Column:
        found = F.struct(let(host_suffixes(host(text)), platform).alias("platform"), parts(text).alias("parts"))
        return let(found, lambda f: _profile_address(f["platform"], f["parts"]))

    return let(let(let(trimmed, absolute), unwrapped), profile)
