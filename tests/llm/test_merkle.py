"""The Merkle manifest against plain Python and its SQL."""

import hashlib
import zlib

import duckdb
import pytest
from compare import oracle, rows_of
from pyspark.sql import functions as F

from attesta.llm import merkle
from attesta.llm.common import ORACLES, QUERIES, ready

DOCS = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.fixture(scope="module")
def session(spark):
    return ready(spark)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes, arity):
    """The root of a list of digests and the path of each: (before, after) by level."""
    paths = [[] for _ in nodes]
    owner = [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        ups, owners = [], []
        for first in range(0, len(nodes), arity):
            run = nodes[first : first + arity]
            for k in range(len(run)):
                for doc in owner[first + k]:
                    paths[doc].append(("".join(run[:k]), "".join(run[k + 1 :])))
            ups.append(h(*run))
            owners.append([d for o in owner[first : first + arity] for d in o])
        nodes, owner = ups, owners
    return nodes[0], paths


def plain(rows, arity=3):
    """Result rows of the query's columns from (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, h(*map(field, r)), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subroots, inner = [], []
    for s in order:
        groups[s].sort(key=lambda x: x[:3])
        root, paths = climb([x[2] for x in groups[s]], arity)
        subroots.append(root)
        inner.append(paths)
    root, outer = climb(subroots, arity)
    out = []
    for s, sub, paths, above in zip(order, subroots, inner, outer, strict=True):
        for (_, _, leaf, r), path in zip(groups[s], paths, strict=True):
            now = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                now = h(*map(field, (*r[:4], r[4].replace("\n", ""))))
            for before, after in path + above:
                now = h(before, now, after)
            out.append((r[0], leaf, sub, root, h(*[b + a for b, a in path + above]), now, now == root))
    return sorted(out, key=str)


NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def odd_rows():
    rows = [(k, "hot", "en", 3 * k, f"line {k}\nmore\n" if k % 3 else "no line") for k in range(1, 95)]
    rows += [(k, "s" + str(k % 5), None, None, None if k % 2 else "") for k in range(200, 221)]
    rows += [(300, None, "de", 1, "a"), (None, None, "de", 1, "a\nb"), (None, None, None, None, None), (301, "ä", "x", -5, "é\n漢"), (302, "", "x", 1, "5:x"), (301, "ä", "x", -5, "é\n漢"), (301, "ä", "x", 2, "é"), (400, "~", "en", 0, "x" * 100_000 + "\n")]
    return rows


def run(session, tmp_path, rows):
    folder = str(tmp_path / "tables")
    session.createDataFrame(rows, DOCS).withColumn("tree", F.lit(1)).withColumn("digest", F.lit("clash")).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return QUERIES["op12_merkle_manifest"](session, folder), folder


def test_query_against_plain_python_and_sql(session, tmp_path):
    rows = odd_rows()
    got, folder = run(session, tmp_path, rows)
    assert got.columns == NAMES
    found = sorted((tuple(r) for r in got.collect()), key=str)
    assert found == plain(rows)
    assert {r[-1] for r in found} == {True, False}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    assert sorted(con.execute(ORACLES["op12_merkle_manifest"]).fetchall(), key=str) == found


@pytest.mark.parametrize("rows", [[], [(5, "a", "b", 1, "x\ny")], [(5, None, "b", 1, "x\ny"), (6, "a", "b", 1, "x")]])
def test_few_rows(session, tmp_path, rows):
    got, _ = run(session, tmp_path, rows)
    assert sorted((tuple(r) for r in got.collect()), key=str) == (plain(rows) if rows else [])


@pytest.mark.parametrize("arity", [2, 4])
def test_other_arities(session, arity):
    rows = odd_rows()
    df = session.createDataFrame(rows, DOCS)
    leaves = df.select(F.col("doc_id").alias("id"), F.col("source").alias("group"), merkle.leaf(*[F.col(c) for c in merkle.FIELDS]).alias("leaf"), F.lit(None).cast("string").alias("facts"))
    found = merkle.manifest(leaves, arity).select("id", "leaf", "subroot", "root", F.sha2(merkle.proof(F.col("path")).cast("binary"), 256).alias("p"), merkle.fold(F.col("leaf"), F.col("path")).alias("f"))
    want = [(*r[:5], r[3]) for r in plain(rows, arity)]
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(want, key=str)


def test_query_over_whole_documents(session):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op12_merkle_manifest"](session, folder)
    cursor = oracle(folder).execute(ORACLES["op12_merkle_manifest"])
    want = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == want
