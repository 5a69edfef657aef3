"""MinHash near-duplicates by an inverted join of signature coordinates.

1. One pass gives every document its shingle count, a digest of its shingle set and K minimum hashes. Documents with
   equal digests form a class; its smallest id stands for it from here on.
2. Representatives are partitioned by set size, as sets of very different sizes cannot be near. In each partition a
   document is posted under each of its K (coordinate, value) pairs. Two sets with the wanted similarity share at least
   MATCHES of the K pairs but for one link in a million (binomial bound), so
   * values held by one document are skipped; who has fewer than MATCHES shared values is out;
   * ordered by frequency, rarest first, two such sets meet in the first K - MATCHES + 1 values: only that prefix is
     merged. Frequent values, such as those of passages that many texts carry, are skipped in the merge.
3. Round one compares each member of a posting with the posting's hub, the member whose values are the most frequent:
   in a family of copies that is close to the text all were made from. Collisions are counted on four bits of every
   coordinate, which loses none, and links are confirmed on full shingle sets. Components follow.
4. Round two joins what round one left in different components. Two members compared with one hub are near exactly when
   their differences from the hub share enough shingles; such pairs come from an inverted join on those few shingles,
   again by prefixes, rarest first. Members that are too unlike their hub meet the others of their posting directly.
   So nothing is lost, and pairs inside a settled component are never made.

A copy group of any size is linked by one pair per member; no group is gathered in one task or one row.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import free_name, query, table
from attesta.llm.wordhash import U, buffers, mix, packed, shingles, unpacked, words
from attesta.session import stored

K = 64
MISS = 1e-6
FAMILY = 41  # seed of the coordinate hashes


def match_threshold(similarity: float, k: int = K, miss: float = MISS) -> int:
    """The largest count of equal coordinates that a pair with this similarity falls short of with probability at most ``miss``."""
    below, t = 0.0, 0
    while t < k:
        below += math.comb(k, t) * similarity**t * (1 - similarity) ** (k - t)
        if below > miss:
            return t
        t += 1
    return k


def _coordinates(k: int) -> np.ndarray:
    return np.random.default_rng(FAMILY).integers(1, 2**63, k, dtype=np.uint64) * U(2) + U(1)


def signatures(values: np.ndarray, offsets: np.ndarray, k: int = K) -> np.ndarray:
    """K minimum hashes (32 bits each) of every non-empty run of shingle hashes; zeros for empty ones."""
    n = len(offsets) - 1
    out = np.zeros((n, k), dtype=np.uint32)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if not len(full):
        return out
    starts = offsets[full]
    for first in range(0, len(full), 2048):
        part = starts[first : first + 2048]
        last = offsets[full[min(first + 2048, len(full)) - 1] + 1]
        run = values[part[0] : last]
        for j, factor in enumerate(_coordinates(k)):
            with np.errstate(over="ignore"):
                h = ((run * factor) >> U(32)).astype(np.uint32)
            out[full[first : first + 2048], j] = np.minimum.reduceat(h, part - part[0])
    return out


def quarters(k: int) -> list[str]:
    return [f"q{i}" for i in range(-(-k // 16))]


def _nibbles(signature: np.ndarray) -> list[np.ndarray]:
    """Four bits of every coordinate, sixteen coordinates to a 64-bit number."""
    out = []
    for first in range(0, signature.shape[1], 16):
        word = np.zeros(len(signature), dtype=np.uint64)
        for j, column in enumerate(signature[:, first : first + 16].T):
            word |= (column.astype(np.int64).view(np.uint64) & U(15)) << U(4 * j)
        out.append(word.view(np.int64))
    return out


def collisions(k: int, a: str, b: str) -> Column:
    """Coordinates whose four bits are equal, of columns with suffixes ``a`` and ``b``: never fewer than the equal coordinates."""
    unequal = F.lit(0)
    for q in quarters(k):
        x = F.col(q + a).bitwiseXOR(F.col(q + b))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        unequal = unequal + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return F.lit(k) - unequal


def _sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = buffers(column)
    h, owners = words(data, offsets)
    return shingles(h, owners, len(column), size)


def sketch(docs: DataFrame, key: str, text: str, size: int, k: int = K) -> DataFrame:
    """(id, n, digest, signature, four-bit signature) of every row: shingle count, digest of the set, minimum hashes."""

    def run(batches):
        for batch in batches:
            values, offsets = _sets(batch.column(1), size)
            raw = memoryview(values.tobytes())
            digests = [hashlib.blake2b(raw[a * 8 : b * 8], digest_size=16).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            flat = signatures(values, offsets, k).view(np.int32).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, k, dtype=np.int32)), pa.array(flat))
            nibbles = [pa.array(q) for q in _nibbles(flat.reshape(-1, k))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), pa.array(digests, pa.binary()), lists, *nibbles], names=["id", "n", "digest", "signature", *quarters(k)])

    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"id {docs.schema[key].dataType.simpleString()}, n long, digest binary, signature array<int>, " + ", ".join(f"{q} long" for q in quarters(k)))


def shingle_sets(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(id, set): the sorted 64-bit hashes of a document's shingles as bytes."""

    def run(batches):
        for batch in batches:
            values, offsets = _sets(batch.column(1), size)
            yield pa.RecordBatch.from_arrays([batch.column(0), packed(values, offsets).cast(pa.binary())], names=["id", "set"])

    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {docs.schema[key].dataType.simpleString()}, set binary")


def prefixes(reps: DataFrame, matches: int, similarity: float) -> DataFrame:
    """(id, part, weight, prefix) of representatives that share enough values with others of their size; ``prefix`` is ordered rarest first.

    Size partitions double. A set is in the partition of its size, and in the next one too if a near set could be there.
    """
    own = F.floor(F.log2("n")).cast("int")
    parts = F.array_compact(F.array(own, F.when(F.col("n") >= F.pow(F.lit(2.0), own + 1) * similarity - 1e-9, own + 1)))
    postings = reps.select("id", F.explode(parts).alias("part"), "signature").select("id", "part", F.posexplode("signature").alias("j", "v"))
    # Coordinate, partition and value in one number.
    value = F.shiftleft(F.col("part").cast("long"), 48).bitwiseOR(F.shiftleft(F.col("j").cast("long"), 32)).bitwiseOR(F.col("v").bitwiseAND(F.lit(0xFFFFFFFF)))
    postings = postings.select("id", value.alias("value"))
    shared = postings.groupBy("value").agg(F.count("*").alias("held")).filter("held > 1")
    ranked = postings.join(shared, "value").groupBy("id", F.shiftright("value", 48).alias("part")).agg(F.sort_array(F.collect_list(F.struct("held", "value"))).alias("all"))  # at most K
    ranked = ranked.filter(F.size("all") >= matches)
    keep = F.slice("all", 1, F.size("all") - matches + 1)
    weight = F.aggregate("all", F.lit(0.0), lambda a, x: a + F.log2(x["held"]))
    return ranked.select("id", "part", weight.alias("weight"), F.transform(keep, lambda x: x["value"]).alias("prefix"))


def only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is in ``ids`` (distinct).

    A bitmap of fixed size (8 million bits, at most 131,072 rows) is broadcast first and drops most other rows before their
    texts are shuffled; the exact join follows. With very many ids the bitmap fills up and lets everything pass.
    """
    spot = F.xxhash64("id").bitwiseAND(F.lit((1 << 23) - 1))
    bits = ids.select(spot.alias("_spot")).groupBy(F.shiftright("_spot", 6).alias("_row")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_spot & 63 AS INT))")).alias("_bits"))
    near = docs.withColumn("_spot", spot).withColumn("_row", F.shiftright("_spot", 6)).join(F.broadcast(bits), "_row")
    near = near.filter(F.expr("(shiftrightunsigned(_bits, cast(_spot & 63 AS INT)) & 1L) = 1")).select(*docs.columns)
    # An inner join with distinct ids: a semi-join would be moved below the bitmap, and all texts would be shuffled for it.
    return near.join(ids, "id")


def _confirm(pairs: DataFrame, sets: DataFrame, differences: bool = False) -> DataFrame:
    """Pairs (a, b) with the sizes of their sets' intersection and union, counted on the full sets; optionally what a lacks and adds."""

    def run(batches):
        for batch in batches:
            va, oa = unpacked(batch.column(2))
            vb, ob = unpacked(batch.column(3))
            one = [va[x:y] for x, y in zip(oa[:-1].tolist(), oa[1:].tolist(), strict=True)]
            two = [vb[x:y] for x, y in zip(ob[:-1].tolist(), ob[1:].tolist(), strict=True)]
            both = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(one, two, strict=True)], dtype=np.int64)
            columns = [batch.column(0), batch.column(1), pa.array(both), pa.array(np.diff(oa) + np.diff(ob) - both)]
            if differences:
                odd = [np.setxor1d(x, y, assume_unique=True).view(np.int64) for x, y in zip(one, two, strict=True)]
                ends = np.cumsum([0, *map(len, odd)])
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate([*odd, np.zeros(0, np.int64)])))
                columns += [pa.array(np.diff(ob) - both), pa.array(np.diff(oa) - both), lists]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["a", "b", "common", "joint", *(["lacks", "adds", "odd"] if differences else [])]
    left = sets.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    kind = pairs.schema["a"].dataType.simpleString()
    schema = f"a {kind}, b {kind}, common long, joint long" + (", lacks long, adds long, odd array<bigint>" if differences else "")
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b").mapInArrow(run, schema)


def family_links(seen: DataFrame, settled: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) of members that were compared with one hub and are in different components.

    With x lacking l and adding d of the hub's c shingles, x and y are near exactly when their differences share at least
    need = (2r - 1) c + (1 - r) (l_x + l_y) + r (d_x + d_y) shingles, r = s / (1 + s). One of the two is a minor, a member
    that is not near the hub. A minor's partners share at least what it needs with the hub itself; other members
    share at least (1 - r) l + r d with a minor. So the first common difference, rarest first, is inside both prefixes, and
    what is left after it must still reach the pair's need. The differences of the pairs that remain are counted in full.
    """
    r = similarity / (1 + similarity)
    label = settled.select(F.col("id"), "component")
    own = seen.join(label.withColumnRenamed("id", "a"), "a", "left").withColumn("own", F.coalesce("component", "a")).drop("component")
    own = own.join(label.withColumnRenamed("id", "b"), "b", "left").withColumn("main", F.coalesce("component", "b")).drop("component")
    own = own.withColumn("gap", F.col("lacks") * (1 - r) + F.col("adds") * r).withColumn("minor", F.col("own") != F.col("main"))
    own = own.withColumn("spare", (F.col("common") + F.col("lacks")) * (1 - 2 * r))
    least = F.greatest(F.lit(1.0), F.ceil(F.when(F.col("minor"), F.col("gap") - F.col("spare")).otherwise(F.col("gap")) - 1e-9)).cast("int")
    open_ = own.join(own.filter("minor").select("b").distinct(), "b", "left_semi").select("a", "b", "own", "minor", "gap", "spare", least.alias("least"), F.size("odd").alias("n_odd"), "odd").filter("n_odd >= least")
    open_ = stored(open_, "family")
    spread = open_.select("a", "b", F.explode("odd").alias("x"))
    held = spread.groupBy("b", "x").agg(F.count("*").alias("held")).filter("held > 1")
    ranked = spread.join(held, ["b", "x"]).groupBy("a", "b").agg(F.sort_array(F.collect_list(F.struct("held", "x"))).alias("all"))
    ranked = ranked.join(open_.drop("odd"), ["a", "b"]).filter(F.size("all") >= F.col("least"))
    facts = ("own", "minor", "gap", "n_odd")
    # Differences that no other member has come first; ``left`` counts what follows, itself included.
    prefix = F.slice("all", 1, F.size("all") - F.col("least") + 1)
    posted = ranked.select("a", "b", "spare", *facts, F.size("all").alias("n_all"), F.posexplode(prefix).alias("at", "e")).select("a", "b", "spare", *facts, (F.col("n_all") - F.col("at")).alias("left"), "e.x")
    one = posted.filter("minor").select("b", "x", "spare", F.col("a").alias("one"), *[F.col(c).alias(f"{c}_1") for c in (*facts, "left")])
    two = posted.select("b", "x", F.col("a").alias("two"), *[F.col(c).alias(f"{c}_2") for c in (*facts, "left")])
    reach = F.least("left_1", "left_2") >= F.col("gap_1") + F.col("gap_2") - F.col("spare") - 1e-9
    pairs = one.join(two, ["b", "x"]).filter((F.col("own_1") != F.col("own_2")) & (~F.col("minor_2") | (F.col("one") < F.col("two"))) & reach)
    pairs = pairs.select("b", "one", "two", (F.col("gap_1") + F.col("gap_2") - F.col("spare")).alias("need")).distinct()
    lists = open_.select("b", "a", "odd")
    pairs = pairs.join(lists.select("b", F.col("a").alias("one"), F.col("odd").alias("odd_1")), ["b", "one"]).join(lists.select("b", F.col("a").alias("two"), F.col("odd").alias("odd_2")), ["b", "two"])
    near = pairs.filter(F.size(F.array_intersect("odd_1", "odd_2")) >= F.col("need") - 1e-9)
    return near.select(F.least("one", "two").alias("a"), F.greatest("one", "two").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of ``edges`` (a, b): the smallest id reachable.

    Alternating large-star and small-star steps, each written to the shared folder. A star's centre is its smallest
    neighbour, found by an aggregate that combines before the shuffle, so a hub costs no more than its edges.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    state = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(mark) == state:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        state = tuple(mark)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        centre = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(centre, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        now = stored(small.distinct(), "edges")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, similarity: float = 0.8, k: int = K) -> DataFrame:
    """One row per row of ``docs``: (id, n_shingles, component_id, kept).

    Two documents are linked when the Jaccard similarity of their sets of ``size``-word shingles is at least
    ``similarity``; ``component_id`` is the smallest id reachable over links, ``kept`` marks it. A text of fewer words has
    its whole sequence as its only shingle. Null, empty and word-less texts have an empty set and link with nothing.
    Rows that share an id are one node, which holds the links of all of them. Rows without an id have no component and are kept.
    Only the two named columns are read, so no other name can clash. Empty tables give no rows.
    """
    matches = match_threshold(similarity, k)
    percent = round(similarity * 100)
    nibbles = quarters(k)
    marks = stored(sketch(docs, key, text, size, k), "sketches")
    named = marks.filter("n > 0 AND id IS NOT NULL")
    first = named.groupBy("digest").agg(F.min("id").alias("rep"))
    reps = named.join(first.select(F.col("digest").alias("_d"), "rep"), (F.col("digest") == F.col("_d")) & (F.col("id") == F.col("rep")), "left_semi").dropDuplicates(["id", "digest"])
    reps = stored(reps.drop("digest"), "representatives")
    heads = prefixes(reps, matches, similarity).join(reps.drop("signature"), "id")
    posted = stored(heads.select(F.explode("prefix").alias("value"), "weight", "id", "n", *nibbles), "postings")
    linked = F.col("common") * 100 >= F.col("joint") * percent
    fits = (F.col("n_a") * 100 >= F.col("n_b") * percent) & (F.col("n_b") * 100 >= F.col("n_a") * percent)
    collide = collisions(k, "_a", "_b") >= matches
    columns = ("id", "n", *nibbles)

    def side(df: DataFrame, suffix: str, *more: str) -> DataFrame:
        return df.select("value", *[F.col(c).alias(c + suffix) for c in (*columns, *more)])

    source = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))

    def sets_of(pairs: DataFrame, name: str) -> DataFrame:
        ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
        return stored(shingle_sets(only(source, ids), "id", "text", size), name)

    # Round one: one hub per posting that two or more share.
    hubs = posted.groupBy("value").agg(F.max(F.struct("weight", *columns)).alias("top"), F.count("*").alias("held")).filter("held > 1").select("value", "held", "top.*").drop("weight")
    stars = side(posted, "_a").join(side(hubs, "_b"), "value").filter((F.col("id_a") != F.col("id_b")) & fits & collide)
    stars = stored(stars.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct(), "stars")
    seen = stored(_confirm(stars, sets_of(stars, "sets"), differences=True), "seen")
    found = seen.filter(linked).select("a", "b")
    settled = stored(components(found), "settled")

    # Round two, members with one hub.
    family = stored(family_links(seen, settled, similarity), "family-links")
    # Members that were not compared with their posting's hub, against the posting's other members.
    label = posted.drop("weight").join(settled, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = label.groupBy("value").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("held")).filter("low <> high AND held > 2").select("value")
    label = label.join(hubs.select("value", F.col("id").alias("hub")).join(mixed, "value", "left_semi"), "value")
    compared = seen.select(F.col("a").alias("id"), F.col("b").alias("hub"), F.lit(True).alias("compared"))
    label = label.join(compared, ["id", "hub"], "left").withColumn("compared", F.coalesce("compared", F.col("id") == F.col("hub")))
    label = stored(label, "open")
    pair = (F.col("component_a") != F.col("component_b")) & (F.col("compared_b") | (F.col("id_a") < F.col("id_b")))
    rest = side(label.filter("NOT compared"), "_a", "component").join(side(label, "_b", "component", "compared"), "value").filter(pair & fits & collide)
    rest = rest.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"))
    pairs = stored(rest.distinct(), "rest")
    more = _confirm(pairs, sets_of(pairs, "more-sets")).filter(linked).select("a", "b")
    joined = components(stored(found.unionByName(family).unionByName(more), "links"))

    # Classes take their representative's component; an id that stands for several classes joins them.
    classes = marks.select("id", "n", "digest").join(first, "digest", "left").select("id", "n", F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("rep")).otherwise(F.col("id")).alias("rep"))
    told = classes.join(joined.select(F.col("id").alias("rep"), "component"), "rep", "left").select("id", "n", F.coalesce("component", "rep").alias("component"))
    rows = told.select("id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))
    return rows


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that stay: one id of each group, and one row of those that are equal in every column.

    Rows without an id are near-duplicates of nothing; of equal ones of them one stays too. Rows that share an id and differ all stay.
    """
    gone = near_duplicates(docs, key, text, size, similarity).filter("NOT kept").select(F.col("id").alias(free_name(docs, "_gone"))).distinct()
    left = docs.join(gone, docs[key] == gone[gone.columns[0]], "left_anti")
    # Ids that come more than once are few: only their rows, and those without an id, are compared as wholes.
    often = free_name(docs, "_often")
    repeated = stored(docs.groupBy(F.col(key).alias(often)).agg(F.count("*").alias("held")).filter("held > 1").select(often), "repeated-ids")
    if repeated.isEmpty():
        return left
    same = left[key].eqNullSafe(F.col(often))
    return left.join(repeated, same, "left_anti").unionByName(left.join(repeated, same, "left_semi").dropDuplicates())


@query(
    "op5_minhash_inverted",
    r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
            ELSE list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM w),
    c AS (SELECT list_sort(s) AS s, min(doc_id) AS rep FROM s WHERE len(s) > 0 GROUP BY 1),
    e AS (SELECT rep, len(s) AS n, unnest(s) AS x FROM c),
    f AS (SELECT x, count(*) AS held FROM e GROUP BY 1),
    p AS (SELECT e.rep, e.n, e.x, row_number() OVER (PARTITION BY e.rep ORDER BY f.held, e.x) AS place FROM e JOIN f USING (x)),
    q AS (SELECT * FROM p WHERE place <= n - ceil(0.8 * n) + 1),
    m AS (SELECT DISTINCT a.rep AS a, b.rep AS b FROM q a JOIN q b ON a.x = b.x AND a.rep < b.rep AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n),
    i AS (SELECT m.a, m.b, len(list_intersect(ca.s, cb.s)) AS common, len(ca.s) + len(cb.s) AS total FROM m JOIN c ca ON ca.rep = m.a JOIN c cb ON cb.rep = m.b),
    l AS (SELECT a, b FROM i WHERE 100 * common >= 80 * (total - common)),
    g AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
    r AS (SELECT rep AS id, rep AS component FROM c UNION SELECT g.b, r.component FROM r JOIN g ON g.a = r.id),
    k AS (SELECT id, min(component) AS component FROM r GROUP BY 1)
    SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(k.component, s.doc_id) AS component_id, coalesce(k.component, s.doc_id) = s.doc_id AS kept
    FROM s LEFT JOIN c ON c.s = list_sort(s.s) LEFT JOIN k ON k.id = c.rep
    """,
)
def op5_minhash_inverted(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), size=2)
    return found.withColumnRenamed("id", "doc_id")
