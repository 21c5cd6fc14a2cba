"""Run queries and their SQL side by side: python -m tests.compare [sf_dir] [name ..]"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None if the rows, column names and types agree, else what does not."""
    df = contract.queries()[name](spark, sf_dir)
    cursor = con.execute(contract.oracle_sql()[name])
    theirs = {c[0]: str(c[1]) for c in cursor.description}
    ours = {f.name: SAME.get(f.dataType.simpleString(), "?") for f in df.schema.fields}
    if ours != theirs:
        return f"columns {ours} and {theirs}"
    names = sorted(ours)
    order = [list(theirs).index(n) for n in names]
    want = Counter(tuple(r[i] for i in order) for r in cursor.fetchall())
    got = Counter(map(tuple, df.select(*names).toArrow().to_pandas().astype(object)
                      .where(lambda x: x.notna(), None).itertuples(index=False, name=None)))
    if got != want:
        return (f"{got.total()} rows and {want.total()}; only ours {list((got - want).items())[:2]},"
                f" only theirs {list((want - got).items())[:2]}")
    return None


if __name__ == "__main__":
    from tests.conftest import session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = session(), oracle(sf_dir)
    print("without SQL:", sorted(set(contract.queries()) - set(contract.oracle_sql())) or "none")
    for name in sys.argv[2:] or contract.oracle_sql():
        start = time.time()
        try:
            wrong = difference(spark, con, name, sf_dir)
        except Exception as e:  # noqa: BLE001
            wrong = f"{type(e).__name__}: {str(e)[:600]}"
        print(f"{'OK ' if wrong is None else 'BAD'} {name} {time.time() - start:.1f}s {wrong or ''}",
              flush=True)
