"""Run bound queries next to their SQL and compare the rows. Also a command line tool."""

from __future__ import annotations

import logging
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle(sf_dir: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def plain(value):
    if value is None:
        return "∅"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        if isinstance(value, float) and math.isnan(value):
            return "nan"
        return repr(round(float(value), 9) + 0.0)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows), sorted(columns)


def compare(spark, connection, bound, sf_dir: str) -> dict:
    started = time.time()
    frame = bound.run(spark, sf_dir)
    got, got_columns = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    report = {"name": bound.name, "seconds": round(time.time() - started, 2), "rows": len(got), "status": "rows-only"}
    if bound.oracle is None:
        return report
    started = time.time()
    cursor = connection.execute(bound.oracle)
    want_columns = [c[0] for c in cursor.description]
    odd = [f"{c[0]}:{c[1]}" for c in cursor.description if any(t in str(c[1]) for t in ("DECIMAL", "HUGEINT"))]
    if odd:
        report["types"] = odd
    want, want_columns = rows_of(want_columns, cursor.fetchall())
    report["oracle_seconds"] = round(time.time() - started, 2)
    report["status"] = "match" if got == want and got_columns == want_columns else "MISMATCH"
    if report["status"] != "match":
        report["columns"] = (got_columns, want_columns) if got_columns != want_columns else "same"
        mine, theirs = set(got), set(want)
        report["want_rows"] = len(want)
        report["only_spark"] = sorted(mine - theirs)[:4]
        report["only_oracle"] = sorted(theirs - mine)[:4]
    return report


def main(arguments: list[str]) -> int:
    sys.path.insert(0, str(__import__("pathlib").Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from attesta.plans.catalog import CATALOG
    from attesta.session import build_session

    sf_dir = arguments[0]
    entry.queries()
    wanted = [b for b in CATALOG.values() if not arguments[1:] or any(a in b.name or a in b.covers.split() for a in arguments[1:])]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    logging.disable(logging.CRITICAL)
    connection = oracle(sf_dir)
    bad = 0
    for bound in wanted:
        try:
            report = compare(spark, connection, bound, sf_dir)
        except Exception as error:  # noqa: BLE001 - the tool reports every failure and goes on
            report = {"name": bound.name, "status": "ERROR", "error": str(error)[:900]}
        if report["status"] in ("match", "rows-only"):
            flag = "  (EMPTY)" if not report["rows"] else ""
            print(f"{report['status']:10} {report['name']:32} rows={report['rows']:<7} {report['seconds']}s oracle={report.get('oracle_seconds', '-')}{flag} {report.get('types', '')}")
        else:
            bad += 1
            print("!!", report)
    print("bad:", bad, "of", len(wanted))
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
