"""Every registered query outside the optional subpackage runs on the smallest tables, and gives what its SQL gives."""

import math
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from gridloom.plans import catalog, finders, small, tables

DATA = Path("/root/testdata/sf0.001")
assert tables and finders and small


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    return f"{float(v):.6g}" if isinstance(v, (int, float, Decimal)) and not isinstance(v, bool) else str(v)


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in found)


def check(spark, name):
    df = catalog.QUERIES[name](spark, str(DATA))
    got = rows(df.columns, [tuple(r) for r in df.toPandas().astype(object).itertuples(index=False)]) if name not in catalog.SQL else rows(df.columns, df.collect())
    if name in catalog.SQL:
        with duckdb.connect() as db:
            for f in DATA.glob("*.parquet"):
                db.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
            want = db.execute(catalog.SQL[name])
            names = [d[0] for d in want.description]
            if sorted(names) != sorted(df.columns):
                return f"{name}: columns {df.columns} and {names}"
            other = rows(names, want.fetchall())
            if got != other:
                return f"{name}: rows differ, {[x for x in zip(got, other, strict=False) if x[0] != x[1]][:1]} {len(got)} {len(other)}"
    return None


@pytest.mark.skipif(not DATA.exists(), reason="no tables here")
def test_all_queries(spark):
    def run(name):
        try:
            return check(spark, name)
        except Exception as e:  # every failing query is to be named
            return f"{name}: {type(e).__name__} {str(e)[:300]}"

    with ThreadPoolExecutor(6) as pool:
        wrong = [x for x in pool.map(run, sorted(catalog.QUERIES)) if x]
    assert not wrong, "\n".join(wrong)
