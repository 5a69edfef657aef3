"""Merkle manifest of a dataset by sibling-shift self-joins.

Every row is a leaf. Leaves of one group stand in the order of their key; runs of ``arity`` nodes become their parent, until
one node is left, the group's subroot. The subroots, ordered by group, are the leaves of one more tree, whose root
covers the dataset.

A level is one table of (tree, place, digest) of all trees. Its nodes are joined with their siblings by computed places: place XOR 1
for two to a run, otherwise the place shifted by 1 to ``arity`` - 1 slots around the run. Nodes at slot zero then emit the
parents, which are the next level. All joins are on (tree, place), so a group that holds a third of all rows is spread like
any other. There are as many levels as the logarithm of the largest group.

Proofs run the other way: a node's path is its own siblings and its parent's path. One chain of joins from the roots down to
the leaves builds them, each level being three times smaller than the one below it.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.llm.common import query, table
from attesta.operators.ordering import number_within, with_totals
from attesta.session import stored

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before: string, after: string>>"


class Tree(NamedTuple):
    """Stored levels (tree, place, n, digest, before, after), lowest first, and the roots (tree, height, digest)."""

    levels: list[DataFrame]
    roots: DataFrame


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value as its count of UTF-8 bytes, a colon and the value; a dash for null. So no two rows read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes (tree, place, n, digest) with the digests of their run before and after them, '' where there are none."""
    slot = F.pmod("place", F.lit(arity))
    shifts = range(1, arity)
    out = nodes
    for k in shifts:
        at = F.col("place").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("place") - slot + F.pmod(slot + k, F.lit(arity))
        other = nodes.select(F.col("tree").alias("_tree"), F.col("place").alias("_place"), F.col("digest").alias(f"_{k}"))
        out = out.withColumn("_at", at).join(other, (F.col("tree") == F.col("_tree")) & (F.col("_at") == F.col("_place")), "left").drop("_tree", "_place", "_at")
    wrapped = lambda k, inside: F.when((slot + k >= arity) == F.lit(inside), F.col(f"_{k}"))
    side = lambda inside: F.concat_ws("", *[wrapped(k, inside) for k in shifts])  # noqa: E731  concat_ws skips nulls
    return out.select("tree", "place", "n", "digest", side(True).alias("before"), side(False).alias("after"))


def climb(nodes: DataFrame, arity: int = ARITY) -> Tree:
    """All levels over the nodes (tree, place, digest), whose places run from 0 in each tree."""
    sizes = nodes.groupBy("tree").agg(F.max("place").alias("n"))
    now = nodes.join(sizes.select(F.col("tree").alias("_tree"), (F.col("n") + 1).alias("n")), F.col("tree") == F.col("_tree")).select("tree", "place", "n", "digest")
    most = sizes.agg(F.max("n")).first()[0]
    height = 0  # of the tallest tree
    while most:
        most, height = most // arity, height + 1
    single = lambda df, k: df.filter("n = 1").select("tree", F.lit(k).alias("height"), "digest")
    roots, levels = single(now, 0), []
    for k in range(1, height + 1):
        levels.append(stored(siblings(now.filter("n > 1"), arity), "merkle-level"))
        parents = levels[-1].filter(F.pmod("place", F.lit(arity)) == 0)
        now = parents.select("tree", F.floor(F.col("place") / arity).alias("place"), F.ceil(F.col("n") / arity).alias("n"), digest(F.col("digest"), F.col("after")).alias("digest"))
        roots = roots.unionByName(single(now, k))
    return Tree(levels, stored(roots, "merkle-roots"))


def paths(tree: Tree, above: DataFrame, arity: int = ARITY, keep: Sequence[str] = (), leaves: DataFrame | None = None) -> DataFrame:
    """(tree, place, digest, path, kept columns) of the lowest level; ``above`` holds (tree, path, kept columns) that continue each tree's own paths.

    The columns of ``leaves`` (tree, place, ...) are joined before the paths are, which are the wide part.
    """
    facts = [] if leaves is None else [c for c in leaves.columns if c not in ("tree", "place")]
    tops = tree.roots.join(above, "tree")
    told = lambda df, k: df if k or leaves is None else df.join(leaves, ["tree", "place"])
    at = lambda k: told(tops.filter(F.col("height") == k).withColumn("place", F.lit(0).cast("long")), k)
    names = lambda k: ["tree", "place", "digest", "path", *keep, *([] if k else facts)]
    below = at(len(tree.levels)).select(names(len(tree.levels)))
    for k in range(len(tree.levels) - 1, -1, -1):
        parents = below.select(F.col("tree").alias("_tree"), F.col("place").alias("_parent"), "path", *keep)
        own = told(tree.levels[k], k).withColumn("_up", F.floor(F.col("place") / arity))
        met = own.join(parents, (F.col("tree") == F.col("_tree")) & (F.col("_up") == F.col("_parent")))
        path = F.concat(F.array(F.struct("before", "after")), F.col("path")).cast(PATH)
        below = met.withColumn("path", path).select(names(k)).unionByName(at(k).select(names(k)))
    return below


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its siblings lead to."""
    return F.aggregate(path, start, lambda acc, step: digest(step["before"], acc, step["after"]))


def proof(path: Column) -> Column:
    """All siblings of a path, lowest level first, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


def manifest(rows: DataFrame, arity: int = ARITY) -> DataFrame:
    """(id, leaf, facts, subroot, root, path) of every row of (id, group, leaf, facts).

    Rows of a group are ordered by id, null first, then by leaf; groups by UTF-8 bytes, null first. Rows equal in all three have
    equal leaves and take neighbouring places. ``facts`` is any column and rides along. An empty table gives no rows.
    """
    spark = rows.sparkSession
    placed = stored(number_within(rows.select("id", "group", "leaf", "facts"), [], ["group", "id", "leaf"], "_at"), "merkle-leaves")
    groups = placed.groupBy("group").agg(F.min("_at").alias("_first"))
    groups = stored(number_within(groups, [], ["group"], "_tree").select(F.col("group").alias("_of"), "_first", (F.col("_tree") - 1).cast("long").alias("tree")), "merkle-groups")
    leaves = placed.join(groups, F.col("group").eqNullSafe(F.col("_of"))).select("tree", (F.col("_at") - F.col("_first")).cast("long").alias("place"), "leaf", "id", "facts")
    leaves = stored(leaves, "merkle-places")
    lower = climb(leaves.select("tree", "place", F.col("leaf").alias("digest")), arity)
    upper = climb(lower.roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), "digest"), arity)
    start = spark.range(1).select(F.lit(0).cast("long").alias("tree"), F.array().cast(PATH).alias("path"))
    tops = paths(upper, start, arity).select(F.col("place").alias("tree"), "path", F.col("digest").alias("subroot"))
    found = paths(lower, tops, arity, ["subroot"], leaves.select("tree", "place", "id", "facts")).withColumnRenamed("digest", "leaf")
    return with_totals(found, upper.roots.select(F.col("digest").alias("root"))).select("id", "leaf", "facts", "subroot", "root", "path")


@query(
    "op12_merkle_manifest",
    r"""
    WITH RECURSIVE d AS (
        SELECT doc_id, source, text,
            coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
            list_reduce(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i AS INTEGER), 1)) AS BIGINT)),
                lambda c, b: list_reduce(range(8), lambda x, k: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END), xor(c, b)), CAST(4294967295 AS BIGINT)) AS crc
        FROM documents),
    l AS (
        SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
            CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) END AS bent
        FROM d),
    p AS (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
            dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS n FROM l),
    low AS (
        SELECT CAST(0 AS BIGINT) AS lev, tree, place, n, leaf AS h FROM p
        UNION ALL
        SELECT lev + 1, tree, place // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY place)) FROM low WHERE n > 1 GROUP BY lev, tree, place // 3, n),
    subs AS (SELECT tree, h FROM low WHERE n = 1),
    high AS (
        SELECT CAST(0 AS BIGINT) AS lev, tree AS place, count(*) OVER () AS n, h FROM subs
        UNION ALL
        SELECT lev + 1, place // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY place)) FROM high WHERE n > 1 GROUP BY lev, place // 3, n),
    lows AS (
        SELECT a.lev, a.tree, a.place, coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS bef, coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS aft
        FROM low a JOIN low b ON a.lev = b.lev AND a.tree = b.tree AND a.place // 3 = b.place // 3 WHERE a.n > 1 GROUP BY 1, 2, 3),
    highs AS (
        SELECT a.lev, a.place, coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS bef, coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS aft
        FROM high a JOIN high b ON a.lev = b.lev AND a.place // 3 = b.place // 3 WHERE a.n > 1 GROUP BY 1, 2),
    up AS (
        SELECT CAST(0 AS BIGINT) AS lev, tree, place, place AS first, coalesce(bent, leaf) AS h, '' AS proof FROM p
        UNION ALL
        SELECT u.lev + 1, u.tree, u.place // 3, u.first, sha256(s.bef || u.h || s.aft), u.proof || s.bef || s.aft FROM up u JOIN lows s ON s.lev = u.lev AND s.tree = u.tree AND s.place = u.place),
    done AS (SELECT tree, first, max_by(h, lev) AS h, max_by(proof, lev) AS proof FROM up GROUP BY 1, 2),
    top AS (
        SELECT CAST(0 AS BIGINT) AS lev, tree, first, tree AS place, h, proof FROM done
        UNION ALL
        SELECT t.lev + 1, t.tree, t.first, t.place // 3, sha256(s.bef || t.h || s.aft), t.proof || s.bef || s.aft FROM top t JOIN highs s ON s.lev = t.lev AND s.place = t.place),
    ends AS (SELECT tree, first, max_by(h, lev) AS h, max_by(proof, lev) AS proof FROM top GROUP BY 1, 2)
    SELECT p.doc_id, p.leaf, s.h AS subroot, r.h AS root, sha256(e.proof) AS proof_sha256, e.h AS folded_root, e.h = r.h AS verified
    FROM p JOIN subs s USING (tree) JOIN ends e ON e.tree = p.tree AND e.first = p.place CROSS JOIN (SELECT h FROM high WHERE n = 1) r
    """,
)
def op12_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    bent = F.when(altered & F.col("text").contains("\n"), leaf(*[F.translate("text", "\n", "") if c == "text" else F.col(c) for c in FIELDS]))
    rows = docs.select(F.col("doc_id").alias("id"), F.col("source").alias("group"), leaf(*[F.col(c) for c in FIELDS]).alias("leaf"), bent.alias("facts"))
    found = manifest(stored(rows, "merkle-rows"))
    folded = found.withColumn("folded_root", fold(F.coalesce("facts", "leaf"), F.col("path")))
    return folded.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(proof(F.col("path")).cast("binary"), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
