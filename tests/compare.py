"""Run registered queries next to their DuckDB statements and compare the rows.

    python tests/compare.py [--sf sf0.001|/path/to/tables] [names...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

KINDS = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in NAMES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(df, con, sql) -> str | None:
    """None when equal, otherwise what differs."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want_cols, want = rows_of(names, rel.fetchall())
    kinds = {d[0]: str(d[1]) for d in rel.description}
    for field in df.schema:
        want_kind = KINDS[field.dataType.simpleString()]
        if kinds.get(field.name, want_kind) != want_kind:
            return f"column {field.name}: {field.dataType.simpleString()} here, {kinds[field.name]} there"
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return f"first difference:\n   got  {g}\n   want {w}"
    return None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="sf0.001", help="scale folder, or a path to other tables")
    args = parser.parse_args()

    import __spark_entry__ as entry
    from pitchgrain.session import build_session

    spark = build_session(
        "compare", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = args.sf if "/" in args.sf else f"/root/testdata/{args.sf}"
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args.names or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                note = "ok" if problem is None else f"MISMATCH {problem}"
            else:
                problem, note = None, f"rows only: {len(df.collect())}"
        except Exception as exc:  # noqa: BLE001 - report and go on
            problem, note = exc, f"ERROR {str(exc)[:1500]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s  {note}", flush=True)
    extra = set(oracles) - set(queries)
    if extra:
        print("oracle without query:", extra)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
