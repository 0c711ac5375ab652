"""Every query with an oracle, on the smallest tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, normal

SF = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql(spark, duck, key):
    out = entry.queries()[key](spark, SF)
    cols = sorted(out.columns)
    got = Counter(tuple(normal(v) for v in r) for r in out.select(*[f"`{c}`" for c in cols]).collect())
    cur = duck.execute(ORACLES[key])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    assert got == Counter(tuple(normal(r[i]) for i in order) for r in cur.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry_point_survives_a_missing_package(monkeypatch):
    import importlib
    import sys
    import warnings

    import __spark_entry__ as entry

    part = "tallyweave.llm.queries"
    if importlib.util.find_spec("tallyweave.llm") is None:
        return
    for name in [m for m in sys.modules if m.startswith("tallyweave.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "xxhash", None)
    with warnings.catch_warnings(record=True) as told:
        warnings.simplefilter("always")
        assert entry._part(part) is None
    assert any("xxhash" in str(w.message) for w in told)
    assert "rfm_table" in entry.queries()
