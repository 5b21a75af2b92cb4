"""Run registered queries against their SQL twins on one data folder.

    python -m tests.oracle /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal

import duckdb

from opsight.plans.views import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def canon(value, digits: int | None = None):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (float, Decimal)):
        value = float(value)
        if math.isnan(value):
            return "nan"
        if digits is not None:
            return f"{value:.{digits}g}"
        return repr(int(value)) if value.is_integer() and abs(value) < 1e15 else repr(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(canon(v, digits) for v in value) + "]"
    if isinstance(value, dict):
        return "{" + ",".join(f"{k}:{canon(v, digits)}" for k, v in sorted(value.items())) + "}"
    return str(value)


def rows_of(columns, rows, digits=None):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canon(r[i], digits) for i in order) for r in rows)


def compare(df, con, sql: str):
    """(verdict, detail): 'exact', 'close' (equal to 9 digits) or 'differs'."""
    cur = con.execute(sql)
    oracle_cols = [d[0] for d in cur.description]
    oracle = cur.fetchall()
    cols = df.columns
    mine = [tuple(r) for r in df.collect()]
    if sorted(cols) != sorted(oracle_cols):
        return "differs", f"columns {sorted(cols)} vs {sorted(oracle_cols)}"
    if len(mine) != len(oracle):
        return "differs", f"rows {len(mine)} vs {len(oracle)}"
    if rows_of(cols, mine) == rows_of(oracle_cols, oracle):
        return "exact", f"{len(mine)} rows"
    a, b = rows_of(cols, mine, 9), rows_of(oracle_cols, oracle, 9)
    if a == b:
        return "close", f"{len(mine)} rows"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return "differs", f"{len(bad)} of {len(a)}; {sorted(cols)}\n   mine   {bad[0][0]}\n   oracle {bad[0][1]}"


def main() -> None:
    import __spark_entry__ as entry
    from opsight.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session()
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    tally: dict[str, list[str]] = {}
    for name, run in queries.items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracle:
                verdict, detail = compare(df, con, oracle[name])
            else:
                verdict, detail = "rows", f"{len(df.collect())} rows"
        except Exception as error:  # noqa: BLE001 - report and go on
            verdict, detail = "error", str(error)[:700]
        tally.setdefault(verdict, []).append(name)
        print(f"{verdict:8}{time.time() - start:7.1f}s {name}: {detail}", flush=True)
    print({k: len(v) for k, v in tally.items()})


if __name__ == "__main__":
    main()
