"""Column functions over whole tables: folding, names, identifiers, URLs, dates, labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from attesta import lexicon as lx
from attesta.functions import dates, ids, labels, markup, text, urls
from attesta.plans import sqltext as sql, views
from attesta.plans.catalog import bind, table
from attesta.plans.views import PROFILES_SQL


@bind("fold", "G1", f"SELECT doc_id, {sql.fold('text')} AS folded FROM documents")
def fold(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.fold(F.col("text")).alias("folded"))


@bind("fold_exact", "G1", f"SELECT page_id, {sql.fold('url')} AS folded FROM pages")
def fold_exact(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.fold_exact("url").alias("folded"))


@bind(
    "name_tokens",
    "G2",
    f"WITH r AS (SELECT doc_id, {sql.long_words('text')} AS w FROM documents), t AS (SELECT doc_id, {sql.name_tokens('w')} AS t FROM r) SELECT doc_id, len(t) AS n, array_to_string(t, ' ') AS tokens FROM t",
)
def name_tokens(spark, sf):
    found = table(spark, sf, "documents").select("doc_id", text.name_tokens(F.col("text")).alias("t"))
    return found.select("doc_id", F.size("t").alias("n"), F.array_join("t", " ").alias("tokens"))


@bind(
    "owner_tokens",
    "G2",
    f"WITH r AS (SELECT item_id, {sql.long_words('text')} AS w FROM benchmark) SELECT item_id, array_to_string({sql.without('w', lx.OWNER_GENERIC)}, ' ') AS tokens FROM r",
)
def owner_tokens(spark, sf):
    return table(spark, sf, "benchmark").select("item_id", F.array_join(text.owner_tokens(F.col("text")), " ").alias("tokens"))


SUFFIXED = "p_name || ' ' || CASE p_type WHEN 'MEDIUM' THEN 'AS' WHEN 'LARGE' THEN 'Stiftelsen AS' WHEN 'PROMO' THEN 'FL I' WHEN 'SMALL' THEN 'avd. Bergen' ELSE '' END"


def _suffixed():
    kind = F.col("p_type")
    tail = F.when(kind == "MEDIUM", "AS").when(kind == "LARGE", "Stiftelsen AS").when(kind == "PROMO", "FL I").when(kind == "SMALL", "avd. Bergen").otherwise("")
    return F.concat("p_name", F.lit(" "), tail)


@bind(
    "normalize_employer",
    "G3",
    f"""SELECT p_partkey, trim(regexp_replace(regexp_replace(' ' || array_to_string(regexp_extract_all(lower({SUFFIXED}), '[a-z0-9]+'), ' '), '( fl i)+$', ''),
  '( ({'|'.join(lx.EMPLOYER_SUFFIXES)}))+$', '')) AS name_key FROM part""",
)
def normalize_employer(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.normalize_employer(_suffixed()).alias("name_key"))


@bind(
    "names_match",
    "G3",
    f"""SELECT p_partkey, p_type <> 'LARGE' AND p_type <> 'PROMO' AS same_employer FROM part""",
)
def names_match(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.names_match(F.concat("p_name", F.lit(" AS")), _suffixed()).alias("same_employer"))


NUMBERED = """'Ordre ' || o_orderkey || ' Org.nr. ' || substr(lpad((o_orderkey * 7919 % 1000000000)::VARCHAR, 9, '0'), 1, 3) || ' ' || substr(lpad((o_orderkey * 7919 % 1000000000)::VARCHAR, 9, '0'), 4, 3)
 || ' ' || substr(lpad((o_orderkey * 7919 % 1000000000)::VARCHAR, 9, '0'), 7, 3) || ' NO' || lpad(o_custkey::VARCHAR, 9, '1') || 'MVA tlf 22 33 44 55'"""


def _numbered():
    number = F.lpad((F.col("o_orderkey") * 7919 % 1000000000).cast("string"), 9, "0")
    spaced = F.concat_ws(" ", F.substring(number, 1, 3), F.substring(number, 4, 3), F.substring(number, 7, 3))
    return F.concat(
        F.lit("Ordre "), F.col("o_orderkey").cast("string"), F.lit(" Org.nr. "), spaced, F.lit(" NO"), F.lpad(F.col("o_custkey").cast("string"), 9, "1"), F.lit("MVA tlf 22 33 44 55")
    )


def _mod11_sql(x: str) -> str:
    total = " + ".join(f"substr({x}, {i}, 1)::INTEGER * {w}" for i, w in enumerate(text.ORG_WEIGHTS, start=1))
    return f"((11 - ({total}) % 11) % 11) = substr({x}, 9, 1)::INTEGER"


@bind(
    "find_org_numbers",
    "G4",
    f"""WITH t AS (SELECT o_orderkey, {NUMBERED} AS x FROM orders),
f AS (SELECT o_orderkey, list_concat(list_transform(regexp_extract_all(x, '\\b\\d{{3}}[\\s. ]?\\d{{3}}[\\s. ]?\\d{{3}}\\b'), lambda m: regexp_replace(m, '\\D', '', 'g')), regexp_extract_all(x, '(?i)\\bNO\\s?(\\d{{9}})\\s?MVA\\b', 1)) AS l FROM t),
u AS (SELECT DISTINCT o_orderkey, unnest(l) AS number FROM f)
SELECT o_orderkey, number, {_mod11_sql('number')} AS valid FROM u""",
)
def find_org_numbers(spark, sf):
    found = table(spark, sf, "orders").select("o_orderkey", F.explode(text.find_org_numbers(_numbered())).alias("number"))
    return found.withColumn("valid", text.mod11_valid(F.col("number")))


@bind(
    "number_in_text",
    "G4",
    "SELECT o_orderkey, TRUE AS own, contains(o_orderkey::VARCHAR, '12') AS twelve FROM orders",
)
def number_in_text(spark, sf):
    line = F.concat(F.lit("nr. "), F.array_join(F.split(F.col("o_orderkey").cast("string"), ""), " "), F.lit(" kr"))
    return table(spark, sf, "orders").select(
        "o_orderkey", text.number_in_text(F.col("o_orderkey").cast("string"), line).alias("own"), text.number_in_text(F.lit("12"), line).alias("twelve")
    )


CANONICAL = f"""lower(regexp_extract(url, '^([a-z]+):', 1)) || '://' || lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) || regexp_replace({sql.path('url')}, '/+$', '')
 || CASE WHEN url LIKE '%?page=2&ref=x%' THEN '?page=2&ref=x' ELSE '' END"""


@bind(
    "url_forms",
    "G5",
    f"""SELECT page_id, {sql.host('url')} AS host, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || CASE WHEN {sql.path('url')} = '' THEN '/' ELSE {sql.path('url')} END AS homepage,
  'https://' || {sql.host('url')} AS site, {CANONICAL} AS canonical, {sql.host('url')} || regexp_replace({sql.path('url')}, '/+$', '') AS lead FROM pages""",
)
def url_forms(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", urls.host(u).alias("host"), urls.normalize_homepage(u).alias("homepage"), urls.normalize_site(F.regexp_replace(u, r"[?#].*$", "")).alias("site"),
        urls.canonical_url(u).alias("canonical"), urls.candidate_key(u).alias("lead"),
    )


@bind("registered_domain", "G6", f"SELECT page_id, regexp_extract({sql.host('url')}, '([^.]+\\.[^.]+)$', 1) AS domain FROM pages")
def registered_domain(spark, sf):
    return table(spark, sf, "pages").select("page_id", urls.registered_domain(urls.host(F.col("url"))).alias("domain"))


@bind("registered_domain_table", "G6", f"SELECT page_id, regexp_extract({sql.host('url')}, '([^.]+\\.example\\.[^.]+)$', 1) AS domain FROM pages")
def registered_domain_table(spark, sf):
    """The suffix table here is every two-label ending in use, so the domain is the label above it."""
    pages = table(spark, sf, "pages").select("page_id", urls.host(F.col("url")).alias("host"))
    suffixes = pages.select(F.substring_index("host", ".", -2).alias("suffix")).distinct()
    return urls.with_registered_domain(pages, "host", suffixes, "domain").select("page_id", "domain")


@bind(
    "directory_filter",
    "B8",
    f"""WITH b AS (SELECT DISTINCT regexp_extract({sql.host('url')}, '([^.]+\\.example\\.org)$', 1) AS h FROM pages WHERE url LIKE '%example.org%')
SELECT page_id FROM pages WHERE NOT EXISTS (SELECT 1 FROM b WHERE {sql.host('url')} = b.h OR {sql.host('url')} LIKE '%.' || b.h)""",
)
def directory_filter(spark, sf):
    from attesta.operators.resolve import exclude_directory_hosts

    pages = table(spark, sf, "pages")
    blocked = pages.select(F.regexp_extract(urls.host(F.col("url")), r"([^.]+\.example\.org)$", 1).alias("host")).filter("host <> ''")
    return exclude_directory_hosts(pages, blocked).select("page_id")


DOC_EMAILS = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"


@bind(
    "emails",
    "G8",
    f"""WITH r AS (SELECT doc_id, list_transform(regexp_extract_all(text, '{DOC_EMAILS}'), lambda m: lower(m)) AS l FROM documents)
SELECT doc_id, array_to_string(list_filter(l, lambda m, i: list_position(l, m) = i), ',') AS emails FROM r WHERE len(l) > 0""",
)
def emails(spark, sf):
    found = table(spark, sf, "documents").select("doc_id", markup.emails(F.col("text")).alias("e"))
    return found.filter(F.size("e") > 0).select("doc_id", F.array_join("e", ",").alias("emails"))


@bind(
    "page_signals",
    "G9",
    f"SELECT page_id, {sql.title('html')} AS title, {sql.footer('html')} AS footer_text, {sql.strip_tags('html')} AS body_text, '' AS meta_description, '' AS contact_text FROM pages",
)
def page_signals(spark, sf):
    return table(spark, sf, "pages").select("page_id", *markup.page_signals(F.col("html")))


@bind(
    "iso_dates",
    "G11",
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) BETWEEN 1995 AND 2000 THEN strftime(o_orderdate, '%Y-%m-%d') END AS found, strftime(o_orderdate, '%Y-%m-%d') AS mail_date FROM orders""",
)
def iso_dates(spark, sf):
    day = F.col("o_orderdate")
    months = F.array(*[F.lit(m) for m in lx.NORWEGIAN_MONTHS])
    english = F.array(*[F.lit(m[:3].title()) for m in lx.ENGLISH_MONTHS])
    written = (
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("Publisert "), F.date_format(day, "dd.MM.yyyy")))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit("Oslo, "), F.date_format(day, "d"), F.lit(". "), F.element_at(months, F.month(day)), F.lit(" "), F.date_format(day, "yyyy")))
        .otherwise(F.concat(F.lit("x "), F.date_format(day, "yyyy/MM/dd"), F.lit(" y")))
    )
    mail = F.concat(F.lit("Tue, "), F.date_format(day, "dd"), F.lit(" "), F.element_at(english, F.month(day)), F.lit(" "), F.date_format(day, "yyyy"), F.lit(" 10:00:00 GMT"))
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.extract_iso_date(written, 1995, 2000).alias("found"), dates.date_only(mail).alias("mail_date")
    )


@bind(
    "proof_span",
    "G12",
    """SELECT doc_id, CASE WHEN p > 0 THEN trim(regexp_replace(substr(text, greatest(1, p - 60), p + 4 + 60 - greatest(1, p - 60)), '\\s+', ' ', 'g')) END AS span FROM (SELECT doc_id, text, strpos(lower(text), 'ther') AS p FROM documents)""",
)
def proof_span(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.proof_span(F.col("text"), F.lit("ther")).alias("span"))


GUESS_SQL = """
w AS (SELECT p_partkey, string_split(p_name, ' ') AS t FROM part),
g AS (SELECT p_partkey, array_to_string(t, '') AS j, array_to_string(t, '-') AS h, t[1] AS f FROM w),
l AS (SELECT p_partkey, ['https://' || j || '.no/', 'https://' || j || '.com/', 'https://' || h || '.no/', 'https://' || f || '.no/', 'https://' || f || '.com/', 'https://' || j || 'as.no/', 'https://' || j || '-as.no/'] AS u FROM g)
"""


@bind("domain_guesses", "G13", f"WITH {GUESS_SQL} SELECT p_partkey, array_to_string(u, ' ') AS guesses FROM l")
def domain_guesses(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.array_join(labels.domain_guesses(F.concat("p_name", F.lit(" AS")), F.lit("Oslo"), 14), " ").alias("guesses"))


@bind(
    "candidate_labels",
    "G13",
    "SELECT p_partkey, array_to_string([replace(p_name, ' ', ''), replace(p_name, ' ', '') || 'as', replace(p_name, ' ', '-')] || CASE WHEN length(split_part(p_name, ' ', 1)) >= 4 THEN [split_part(p_name, ' ', 1)] ELSE [] END, ' ') AS labels FROM part",
)
def candidate_labels(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.array_join(labels.candidate_labels(F.concat("p_name", F.lit(" AS")), 5), " ").alias("labels"))


@bind(
    "candidate_features",
    "G14",
    """WITH a AS (SELECT p_partkey, replace(p_name, ' ', '') AS slug, lower(p_type) AS core, split_part(p_name, ' ', 1) AS first_word, p_size FROM part),
g AS (SELECT *, list_distinct([substr(core, i, 3) FOR i IN range(1, length(core) - 1)]) AS x, list_distinct([substr(slug, i, 3) FOR i IN range(1, length(slug) - 1)]) AS y FROM a)
SELECT p_partkey, length(core) AS label_len, round(len(list_intersect(x, y)) / (len(x) + len(y) - len(list_intersect(x, y))), 4) AS trigram_jaccard, round(length(core) / length(slug), 4) AS char_coverage,
  CASE WHEN p_size < 5 THEN '1-4' WHEN p_size < 20 THEN '5-19' ELSE '20-99' END AS employee_bucket, 1 AS tld_no, CASE WHEN first_word = core AND length(core) >= 4 THEN 2 ELSE -1 END AS variant_index FROM g""",
)
def candidate_features(spark, sf):
    made = labels.candidate_features(
        F.col("p_name"), F.concat(F.lower("p_type"), F.lit(".no")), F.col("p_size"), F.lit("AS"), F.lit(False), F.lit("2024")
    )
    return table(spark, sf, "part").select("p_partkey", made.alias("f")).select(
        "p_partkey", "f.label_len", "f.trigram_jaccard", "f.char_coverage", "f.employee_bucket", "f.tld_no", "f.variant_index"
    )


@bind("stable_ids", "G15", "SELECT event_id, 'ev-' || substr(sha256(user_id || '|' || event_type || '|' || coalesce(CASE WHEN value > 10 THEN 'x' END, '')), 1, 24) AS id, sha256(props) AS content_sha256 FROM events")
def stable_ids(spark, sf):
    flag = F.when(F.col("value") > 10, "x")
    return table(spark, sf, "events").select(
        "event_id", ids.stable_id(F.col("user_id"), F.col("event_type"), flag, prefix="ev-").alias("id"), ids.content_sha256(F.col("props")).alias("content_sha256")
    )


def _any(words: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower(text), '{w}')" for w in words) + ")"


@bind(
    "headline_sentiment",
    "G17",
    f"""SELECT doc_id, CASE WHEN {_any(lx.POSITIVE_WORDS)} AND NOT {_any(lx.NEGATIVE_WORDS)} THEN 'positive' WHEN {_any(lx.NEGATIVE_WORDS)} AND NOT {_any(lx.POSITIVE_WORDS)} THEN 'negative' ELSE 'neutral' END AS label FROM documents""",
)
def headline_sentiment(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.headline_sentiment(F.col("text")).alias("label"))


@bind(
    "rating_polarity",
    "G17",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity / 50 >= 0.8 THEN 'positive' WHEN l_quantity / 50 <= 0.4 THEN 'negative' ELSE 'neutral' END AS label,
  CASE WHEN l_linenumber <= 2 THEN 'negative' WHEN l_linenumber >= 4 THEN 'positive' ELSE 'neutral' END AS stars FROM lineitem""",
)
def rating_polarity(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", text.rating_polarity(F.col("l_quantity"), F.lit(50.0)).alias("label"), text.star_polarity(F.col("l_linenumber")).alias("stars")
    )


@bind(
    "search_queries",
    "G18",
    f"""WITH {PROFILES_SQL} SELECT org, unnest(['"' || name || ' AS" -site:proff.no -site:1881.no -site:dnb.com', '"' || name || '" "' || municipality || '"', '"' || org || '" "' || name || ' AS"']) AS query FROM profiles""",
)
def search_queries(spark, sf):
    made = labels.search_queries(F.concat("name", F.lit("  AS")), F.col("org"), F.col("municipality"), F.lit(None).cast("string"))
    return views.profiles(spark, sf).select("org", F.explode(made).alias("query"))


@bind(
    "format_amounts",
    "G19",
    """SELECT o_orderkey, CASE WHEN o_totalprice >= 1000 THEN printf('%.1f', floor(o_totalprice / 100) / 10) || 'k NOK' ELSE (floor(o_totalprice / 100) * 100)::BIGINT || ' NOK' END AS compact,
  'NOK ' || replace(format('{:,}', (floor(o_totalprice / 100) * 100)::BIGINT), ',', ' ') AS grouped FROM orders""",
)
def format_amounts(spark, sf):
    # Whole hundreds print alike under every rounding rule.
    whole = (F.floor(F.col("o_totalprice") / 100) * 100).cast("double")
    return table(spark, sf, "orders").select(
        "o_orderkey", text.format_amount_compact(whole).alias("compact"), text.format_amount_grouped(whole, F.lit(None).cast("string")).alias("grouped")
    )


@bind("format_addresses", "G19", f"WITH {PROFILES_SQL} SELECT org, name || ', ' || municipality_number || ' ' || municipality || ', Norge' AS address FROM profiles")
def format_addresses(spark, sf):
    made = text.format_address(F.col("name"), F.col("municipality_number"), F.col("municipality"), F.lit(None).cast("string"))
    return views.profiles(spark, sf).select("org", made.alias("address"))
