"""Compare registered queries with their SQL twins on one scale factor.

    python tests/oracle_check.py [sf_dir] [name prefix ...]
"""

from __future__ import annotations

import datetime
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_cell(x) for x in v) + "]"
    return str(v)


def _lines(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted("|".join(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences in schema, row count and values; an empty list means equal."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    kinds = {d[0]: str(d[1]) for d in rel.description}
    expected = rel.fetchall()
    rows = [tuple(r) for r in df.collect()]
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for c, t in df.dtypes:
        want = KINDS.get(t, t.upper())
        have = {"NUMBER": "BIGINT"}.get(kinds[c].upper(), kinds[c].upper())
        if want != have and not t.startswith("array"):
            problems.append(f"type of {c}: {t} vs {kinds[c]}")
    if len(rows) != len(expected):
        problems.append(f"rows {len(rows)} != {len(expected)}")
    a, b = _lines(df.columns, rows), _lines(names, expected)
    if hashlib.md5("\n".join(a).encode()).digest() != hashlib.md5("\n".join(b).encode()).digest():
        only_a, only_b = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
        problems.append(f"values differ: spark {only_a} sql {only_b}")
    return problems


def main() -> int:
    import __spark_entry__ as entry
    from ratewell.session import local_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    prefixes = tuple(args[1:])
    spark = local_session("oracle-check", "8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in sql:
                problems, note = compare(df, con, sql[name]), ""
            else:
                problems, note = [], f" rows={df.count()} (no SQL)"
        except Exception as e:  # report and go on
            problems, note = [f"{type(e).__name__}: {str(e)[:700]}"], ""
        print(f"{'ok  ' if not problems else 'BAD '} {name} {time.time() - start:.1f}s{note}", flush=True)
        for p in problems:
            print("      ", p)
        bad += bool(problems)
    print("bad:", bad, "of", len(queries), "with SQL:", len(sql), "missing queries for SQL:", set(sql) - set(queries))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
