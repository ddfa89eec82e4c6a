"""Run registered queries against their checking SQL and report differences."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations").split()


def duck(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return ("dec", str(v.normalize()))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def differences(spark_df, con, sql) -> str | None:
    """None when both sides hold the same rows under the same columns and type families."""
    cols = sorted(spark_df.columns)
    got = [tuple(plain(r[c]) for c in cols) for r in spark_df.collect()]
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    if sorted(names) != cols:
        return f"columns {cols} vs {sorted(names)}"
    order = [names.index(c) for c in cols]
    types = {d[0]: str(d[1]) for d in rel.description}
    want = [tuple(plain(r[i]) for i in order) for r in rel.fetchall()]
    family = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
              "date": "DATE", "boolean": "BOOLEAN"}
    for name, kind in spark_df.dtypes:
        if kind in family and types[name].upper() != family[kind] \
                and types[name].upper() not in ("STRING", "NUMBER", "BOOL"):
            return f"type of {name}: {kind} vs {types[name]}"
    a, b = Counter(got), Counter(want)
    if a != b:
        only_a, only_b = list((a - b).items())[:2], list((b - a).items())[:2]
        return f"{len(got)} vs {len(want)} rows; spark only {only_a}; sql only {only_b}"
    return None


def main(root: str, names: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as entry

    from claimrisk.session import local_session
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(root), 0
    queries, oracle = entry.queries(), entry.oracle_sql()
    for name in names or queries:
        t = time.time()
        try:
            df = queries[name](spark, root)
            if name in oracle:
                why = differences(df, con, oracle[name])
                status = "ok" if why is None else f"DIFF {why}"
            else:
                status = f"rows-only {df.count()}"
        except Exception as e:  # report and go on with the next query
            status = f"ERROR {type(e).__name__}: {str(e)[:1500]}"
        bad += status.startswith(("DIFF", "ERROR"))
        print(f"{name}: {time.time() - t:.2f}s {status}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
