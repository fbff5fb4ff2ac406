"""Every query that has SQL equals it on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from check_oracle import compare  # noqa: E402
from quotegrid.plans import all_oracles, all_queries  # noqa: E402

SF = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query_equals_sql(spark, duck, name):
    got = all_queries()[name](spark, str(SF)).toPandas()
    assert compare(got, duck.execute(all_oracles()[name]).df()) == "ok"


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
