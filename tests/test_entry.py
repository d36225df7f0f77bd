"""Driver contract and the DuckDB oracle on the smallest test data."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
HAVE_DATA = os.path.exists(f"{SF}/events.parquet")


def test_contract_keys():
    q, s = E.queries(), E.oracle_sql()
    assert q and set(s) <= set(q)


@pytest.mark.skipif(not HAVE_DATA, reason="test data not present")
def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["phone"]
    assert df.count() >= 1


@pytest.mark.skipif(not HAVE_DATA, reason="test data not present")
@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_oracle_sf0001(spark, key):
    con = duck(SF)
    r = compare(spark, con, key, E.queries()[key], E.oracle_sql()[key], SF)
    assert r["ok"], r


@pytest.mark.skipif(not HAVE_DATA, reason="test data not present")
def test_same_answer_for_1_and_64_partitions(spark):
    from towertrace.operators import intervals
    from towertrace.plans import trace
    from towertrace.sources import cdr_from_events, load, subjects_from_events
    ev = load(spark, SF, "events")
    cdr, subj = cdr_from_events(ev), subjects_from_events(ev)
    res = []
    for parts in ("1", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        stays = sorted(tuple(r) for r in intervals(cdr, "robust").collect())
        contacts = sorted(r.phone for r in trace(cdr, subj, include=True).collect())
        res.append((stays, contacts))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert res[0] == res[1] and res[0][0]
