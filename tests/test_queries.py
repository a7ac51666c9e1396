"""Every registered query against its SQL twin."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest
from conftest import TABLES

import __spark_entry__ as entry_points
from trackmill.operators import trajectory as tr
from trackmill.plans.queries import QUERIES, SQL
from trackmill.plans.queries.tracks import points_of


@pytest.fixture(scope="module")
def database():
    if not Path(TABLES).exists():
        pytest.skip(f"no tables at {TABLES}")
    connection = duckdb.connect()
    for path in Path(TABLES).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def as_text(frame):
    frame = frame[sorted(frame.columns)]

    def one(value):
        if pd.isna(value):
            return ""
        return repr(float(value)) if isinstance(value, (int, float)) else str(value)

    return list(frame.columns), sorted(tuple(one(v) for v in row) for row in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    found = QUERIES[name](spark, TABLES).toPandas()
    if name in SQL:
        assert as_text(found) == as_text(database.execute(SQL[name]).df())
    else:
        assert len(found) > 0


def test_points_of_events_in_pieces(spark, database):
    points = points_of(spark.read.parquet(f"{TABLES}/events.parquet"))
    names = ["traj_id", "seq", "run_value", "run_no", "run_len", "member_no", "speed"]
    plain_runs, cut_runs = (tr.runs(tr.analyse(points, digits=6, max_rows=n)).select(names) for n in (None, 5))
    assert as_text(plain_runs.toPandas()) == as_text(cut_runs.toPandas())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
    assert set(SQL) <= set(QUERIES)
