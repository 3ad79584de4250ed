"""Source conflicts over all lines beside a brute force over all pairs of rows."""

from collections import defaultdict

import duckdb

from matchloom.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_all_lines(spark):
    rows = set(duckdb.sql(f"select l_partkey, l_suppkey, l_linestatus || l_returnflag from '{SF}/lineitem.parquet'").fetchall())
    items, codes = defaultdict(list), defaultdict(list)
    for r in rows:
        items[r[0]].append(r)
        codes[r[1]].append(r)
    want = set()
    for i, c, s in rows:
        code = any(x[1] != c and x[2] != s for x in items[i])
        item = any(x[0] != i and x[2] != s for x in codes[c])
        if code or item:
            want.add((i, c, s, code, item))
    got = [tuple(r) for r in QUERIES["source_conflict_lines"](spark, SF).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(got) > QUERIES["source_conflict"](spark, SF).count()
