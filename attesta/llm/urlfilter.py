"""URL filters by a temporal list join.

A list's dated entries (key, action, date) become validity intervals: an entry holds from its date until the key's next
one. A key is a host, one of its parent domains ("*.example.org") or a host with a first path part ("example.org/en").
Every capture looks up its keys as of its fetch time; the most specific key with an active entry decides, and no entry
means the capture passes.

Keys meet by equality. Intervals are cut at the edges of fixed time buckets and captures carry their bucket, so a key
with a long history is compared with the few entries of one bucket only, and a host that holds a third of all captures is
an equi-join side that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.llm.common import query, table

BUCKET_DAYS = 30


def host_of(url: Column) -> Column:
    """Lower-cased host without user, port and a final dot; null where there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+?)\.?(?::[0-9]*)?(?:[/?#]|$)", 1)), F.lit(""))


def keys_of(url: Column) -> Column:
    """(key, specificity) of a URL: host and first path part, host, then parent domains from long to short."""
    host = host_of(url)
    part = F.nullif(F.regexp_extract(url, r"^[^?#]*?://[^/?#]+/([^/?#]+)", 1), F.lit(""))
    labels = F.split(host, r"\.")
    up = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(F.concat(F.lit("*."), F.array_join(F.slice(labels, i, F.size(labels)), ".")).alias("key"), (F.size(labels) - i).cast("long").alias("rank")))
    own = F.array(F.struct(F.concat(host, F.lit("/"), part).alias("key"), F.lit(1001).cast("long").alias("rank")), F.struct(host.alias("key"), F.lit(1000).cast("long").alias("rank")))
    return F.when(host.isNotNull(), F.filter(F.concat(own, up), lambda x: x["key"].isNotNull()))


def intervals(entries: DataFrame) -> DataFrame:
    """(key, action, valid_from, valid_to) of dated entries; ``valid_to`` is null while an entry holds.

    Entries without key, action or date are no entries. Repeated entries are one. Of several actions of one key on one
    day the last by name holds, so input order never matters.
    """
    clean = entries.select(F.col("key"), F.col("action"), F.col("date").cast("date").alias("date")).dropna()
    daily = clean.groupBy("key", "date").agg(F.max("action").alias("action"))
    following = F.lead("date").over(Window.partitionBy("key").orderBy("date"))
    return daily.select("key", "action", F.col("date").alias("valid_from"), following.alias("valid_to"))


def _bucket(date: Column) -> Column:
    return F.floor(F.datediff(date, F.lit("1970-01-01")) / F.lit(BUCKET_DAYS))


def as_of_filter(captures: DataFrame, entries: DataFrame, key: str, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """(id, url, fetched, n_active, matched_key, action, allowed) of every row of ``captures``.

    ``n_active`` counts the keys with an entry active at the fetch time; the most specific one decides. Rows with a null
    or host-less URL or without a fetch time match nothing and pass. A row is judged by its own URL and time: two captures of one page
    at two dates have two verdicts, repeated rows the same one each, and a null id makes no difference. Other columns are not read.
    """
    spans = intervals(entries)
    # An open interval is cut at the last fetch bucket, a figure of one row.
    bounds = captures.agg(F.max(_bucket(F.col(fetched).cast("date"))).alias("_last"))
    spans = spans.crossJoin(F.broadcast(bounds)).withColumn("_first", _bucket(F.col("valid_from")))
    spans = spans.withColumn("_end", F.least(F.col("_last"), F.when(F.col("valid_to").isNull(), F.col("_last")).otherwise(_bucket(F.date_sub("valid_to", 1))))).filter("_end >= _first")
    spans = spans.select("key", "action", "valid_from", "valid_to", F.explode(F.sequence("_first", "_end")).alias("bucket"))
    rows = captures.select(F.col(key).alias("id"), F.col(url).alias("url"), F.col(fetched).cast("date").alias("at"))
    # A URL and a date are judged once, however many captures have them.
    looked = rows.select("url", "at").distinct().select("url", "at", _bucket(F.col("at")).alias("bucket"), F.explode(keys_of(F.col("url"))).alias("k")).select("url", "at", "bucket", "k.key", "k.rank")
    held = looked.join(spans, ["key", "bucket"]).filter((F.col("valid_from") <= F.col("at")) & (F.col("valid_to").isNull() | (F.col("at") < F.col("valid_to"))))
    best = held.groupBy("url", "at").agg(F.count("*").alias("n_active"), F.max(F.struct("rank", "key", "action")).alias("top"))
    joined = rows.join(best, ["url", "at"], "left")
    return joined.select("id", "url", F.col("at").alias("fetched"), F.coalesce("n_active", F.lit(0)).alias("n_active"), F.col("top.key").alias("matched_key"), F.col("top.action").alias("action"), F.coalesce(F.col("top.action") != "block", F.lit(True)).alias("allowed"))


def fetch_date(page_id: Column) -> Column:
    """The given pages carry no fetch time: a day of 2024 made from the id stands for it."""
    return F.date_add(F.lit("2024-01-01"), F.pmod(page_id * 37 + F.floor(page_id / 1000) * 11, F.lit(366)).cast("int"))


def derived_entries(pages: DataFrame) -> DataFrame:
    """A dated list made from the pages themselves: hosts, hosts with a language folder, and parent domains.

    Dates come from the smallest and largest page id of a key, so both sides of every change have captures.
    """
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), F.nullif(F.regexp_extract("url", r"^[^?#]*?://[^/?#]+/([^/?#]+)", 1), F.lit("")).alias("part")).filter("host IS NOT NULL")
    levels = rows.select("page_id", F.explode(F.array(
        F.struct(F.col("host").alias("key"), F.lit(0).alias("level")),
        F.struct(F.concat("host", F.lit("/"), "part").alias("key"), F.lit(1).alias("level")),
        F.struct(F.concat(F.lit("*."), F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)).alias("key"), F.lit(2).alias("level")),
    )).alias("k")).select("page_id", "k.key", "k.level").filter("key IS NOT NULL")
    facts = levels.groupBy("key", "level").agg(F.min("page_id").alias("low"), F.max("page_id").alias("high"))
    day = lambda n: F.date_add(F.lit("2024-01-01"), F.pmod(n, F.lit(366)).cast("int"))
    dated = F.array(
        F.struct(F.when(F.col("level") == 1, "allow").otherwise("block").alias("action"), day(F.col("low") * 13).alias("date")),
        F.struct(F.when(F.col("level") == 1, "block").otherwise("allow").alias("action"), day(F.col("high") * 17 + 120).alias("date")),
        F.struct(F.lit("block").alias("action"), day(F.col("low") + F.col("high") + 250).alias("date")),
    )
    return facts.select("key", F.explode(dated).alias("e")).select("key", "e.action", "e.date")


@query(
    "op10_url_lists_as_of",
    r"""
    WITH p AS (SELECT page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+?)\.?(?::[0-9]*)?(?:[/?#]|$)', 1)), '') AS host,
                 nullif(regexp_extract(url, '^[^?#]*?://[^/?#]+/([^/?#]+)', 1), '') AS part,
                 DATE '2024-01-01' + CAST((page_id * 37 + (page_id // 1000) * 11) % 366 AS INTEGER) AS seen FROM pages),
    k AS (SELECT page_id, host AS key, 0 AS level FROM p WHERE host IS NOT NULL
          UNION ALL SELECT page_id, host || '/' || part, 1 FROM p WHERE host IS NOT NULL AND part IS NOT NULL
          UNION ALL SELECT page_id, '*.' || regexp_extract(host, '([^.]+\.[^.]+)$', 1), 2 FROM p WHERE host IS NOT NULL),
    f AS (SELECT key, level, min(page_id) AS low, max(page_id) AS high FROM k GROUP BY 1, 2),
    d AS (SELECT key, CASE WHEN level = 1 THEN 'allow' ELSE 'block' END AS action, DATE '2024-01-01' + CAST((low * 13) % 366 AS INTEGER) AS date FROM f
          UNION ALL SELECT key, CASE WHEN level = 1 THEN 'block' ELSE 'allow' END, DATE '2024-01-01' + CAST((high * 17 + 120) % 366 AS INTEGER) FROM f
          UNION ALL SELECT key, 'block', DATE '2024-01-01' + CAST((low + high + 250) % 366 AS INTEGER) FROM f),
    o AS (SELECT key, date, max(action) AS action FROM d GROUP BY 1, 2),
    i AS (SELECT key, action, date AS a, lead(date) OVER (PARTITION BY key ORDER BY date) AS b FROM o),
    s AS (SELECT page_id, seen, host || '/' || part AS key, 1001 AS rank FROM p WHERE part IS NOT NULL
          UNION ALL SELECT page_id, seen, host, 1000 FROM p
          UNION ALL SELECT page_id, seen, '*.' || array_to_string(string_split(host, '.')[n:], '.'), len(string_split(host, '.')) - n FROM p, LATERAL (SELECT unnest(generate_series(1, len(string_split(host, '.')))) AS n) u),
    h AS (SELECT s.page_id, s.key, s.rank, i.action FROM s JOIN i ON s.key = i.key AND i.a <= s.seen AND (i.b IS NULL OR s.seen < i.b)),
    t AS (SELECT page_id, count(*) AS n, max_by(key, rank) AS key, max_by(action, rank) AS action FROM h GROUP BY 1)
    SELECT p.page_id, coalesce(t.n, 0) AS n_active, t.key AS matched_key, t.action, coalesce(t.action <> 'block', true) AS allowed FROM p LEFT JOIN t USING (page_id)
    """,
)
def op10_url_lists_as_of(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = as_of_filter(pages.withColumn("fetched", fetch_date(F.col("page_id"))), derived_entries(pages), "page_id")
    return judged.drop("url", "fetched").withColumnRenamed("id", "page_id")
