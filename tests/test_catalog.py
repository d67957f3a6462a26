"""Every registered query against its SQL twin on the small tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidegate.plans.catalog import CATALOG

SF = "/root/testdata/sf0.001"


def norm(value):
    return repr(round(value, 9)) if isinstance(value, float) else repr(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for f in os.listdir(SF):
        connection.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return connection


def test_every_query_has_a_twin():
    assert set(CATALOG) <= set(queries())
    assert set(CATALOG) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_matches_its_twin(spark, duck, name):
    df = queries()[name](spark, SF)
    expected = duck.execute(oracle_sql()[name])
    columns = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(columns)
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table(columns, expected.fetchall())


def test_key_lookup_finds_the_most_redelivered_event_of_the_whole_inbox(spark, duck, tmp_path):
    # Events 50, 100 and 200 are sent three times; 200 has the earliest window of them.
    ids = [(i, 60 * i) for i in range(1, 51)] + [(100, 5_000), (200, 600)]
    values = ", ".join(f"({i}, TIMESTAMP '2024-01-16 10:00:00' + INTERVAL {s} SECOND)" for i, s in ids)
    duck.execute(f"""COPY (SELECT CAST(id AS BIGINT) AS event_id, ts, CAST(id % 7 AS BIGINT) AS user_id, 'view' AS event_type,
        CAST(1 AS DOUBLE) AS value, '{{}}' AS props FROM (VALUES {values}) v(id, ts)) TO '{tmp_path}/events.parquet'""")
    (row,) = queries()["key_lookup"](spark, str(tmp_path)).collect()
    own = duckdb.connect()
    own.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    expected = own.execute(oracle_sql()["key_lookup"])
    names = [c[0] for c in expected.description]
    assert tuple(row[n] for n in names) == expected.fetchone()
    assert (row.event_id, row.copies) == ("200", 3)


def test_entry(spark):
    assert entry(spark).count() > 0
