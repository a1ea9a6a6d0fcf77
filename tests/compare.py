"""Run registered queries beside their SQL twins: `python tests/compare.py [sf] [name ...]`."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from cuelake.session import get_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def engine(folder: str):
    db = duckdb.connect()
    for name in TABLES:
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def plain(value):
    if value is None or isinstance(value, str | bool):
        return value
    if isinstance(value, list | tuple):
        return tuple(plain(item) for item in value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    data = [tuple(plain(row[at]) for at in order) for row in rows]
    return [columns[at] for at in order], sorted(data, key=repr)


def compare(spark, db, folder, name, build, sql):
    """Return (message, spark seconds, rows); an empty message means equal."""
    begun = time.time()
    frame = build(spark, folder)
    rows = frame.collect()
    spent = time.time() - begun
    if sql is None:
        return "", spent, len(rows)
    answer = db.sql(sql)
    ours = canonical(frame.columns, [tuple(row) for row in rows])
    types = dict(zip(frame.columns, [kind for _, kind in frame.dtypes]))
    theirs = canonical(answer.columns, answer.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}", spent, len(rows)
    wide = {c: str(k) for c, k in zip(answer.columns, answer.types)}
    odd = [f"{c}:{types[c]}/{wide[c]}" for c in ours[0]
           if (wide[c] == "HUGEINT") or (types[c] == "bigint") != (wide[c] == "BIGINT")
           or (types[c] == "double") != (wide[c] == "DOUBLE")]
    if ours[1] != theirs[1]:
        left, right = set(map(repr, ours[1])), set(map(repr, theirs[1]))
        return (f"rows {len(ours[1])} vs {len(theirs[1])}; columns {ours[0]}; only spark "
                f"{sorted(left - right)[:3]}; only sql {sorted(right - left)[:3]}"), spent, len(rows)
    return ("types " + ", ".join(odd)) if odd else "", spent, len(rows)


def main():
    from cuelake.plans import all_checks, all_plans

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].replace(".", "").isdigit() else "0.01"
    folder = f"/root/testdata/sf{sf}"
    spark = get_session("local[8]", 8, "8g")
    spark.sparkContext.setLogLevel("ERROR")
    db = engine(folder)
    plans, checks = all_plans(), all_checks()
    failed = 0
    for name, build in plans.items():
        if args and not any(name.startswith(prefix) for prefix in args):
            continue
        try:
            message, spent, rows = compare(spark, db, folder, name, build, checks.get(name))
        except Exception as error:  # report and go on to the next query
            message, spent, rows = f"{type(error).__name__}: {str(error)[:700]}", 0.0, -1
        failed += bool(message)
        mark = "FAIL" if message else ("ok" if name in checks else "rows")
        print(f"{mark:5}{name:32}{rows:8} rows {spent:6.2f}s {message}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
