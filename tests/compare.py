"""Run registered queries against their oracle on one folder of tables.

    python tests/compare.py [folder] [query ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KINDS = {"bigint": "int64", "int": "int32", "double": "float64", "boolean": "bool", "string": "str"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def ordered(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf[sorted(pdf.columns)]
    return pdf.sort_values(list(pdf.columns), kind="mergesort", na_position="last").reset_index(drop=True)


def differences(spark, con, folder: str, name: str) -> list[str]:
    """What differs between a query and its oracle; empty if nothing does."""
    df = entry.queries()[name](spark, folder)
    mine = df.toPandas()
    sql = con.execute(entry.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in sql.description}
    theirs = sql.df()
    if sorted(mine.columns) != sorted(theirs.columns):
        return [f"columns {sorted(mine.columns)} against {sorted(theirs.columns)}"]
    out = []
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN", "string": "VARCHAR"}
    names2 = {"BIGINT": "NUMBER", "INTEGER": "NUMBER"}
    for f in df.schema.fields:
        kind = names.get(f.dataType.simpleString(), f.dataType.simpleString())
        if types[f.name] not in (kind, names2.get(kind, kind)):
            out.append(f"{f.name}: {kind} against {types[f.name]}")
    if len(mine) != len(theirs):
        return out + [f"{len(mine)} rows against {len(theirs)}"]
    if not len(mine):
        return out + ["no rows"]
    a, b = ordered(mine), ordered(theirs)
    for c in a.columns:
        x, y = a[c], b[c]
        same = (x == y) | (x.isna() & y.isna())
        if not np.all(same):
            at = int(np.argmin(np.asarray(same)))
            out.append(f"{c}: {int((~same).sum())} values, first {a.loc[at].to_dict()} against {b.loc[at].to_dict()}")
    return out


def main() -> None:
    from varigrove import session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(entry.queries())
    spark = session.build(
        "local[" + os.environ.get("COMPARE_CPUS", "8") + "]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="12g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            found = differences(spark, con, folder, name)
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(found)
        print(f"{'ok  ' if not found else 'DIFF'} {name} {time.time() - start:.1f}s", *found, sep="\n     " if found else " ", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} match")


if __name__ == "__main__":
    main()
