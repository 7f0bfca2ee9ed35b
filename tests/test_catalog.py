"""Every registered query against its SQL."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from tidemark.plans import catalog

DATA = "/root/testdata/sf0.01"


def text(value):
    if pd.isna(value):
        return ""
    if isinstance(value, int | np.integer) and not isinstance(value, bool):
        return str(int(value))
    if isinstance(value, float | np.floating):
        return f"{float(value):.9g}"
    return str(value)[:26]


def rows(frame):
    frame = frame[sorted(frame.columns)].apply(lambda column: column.map(text))
    return sorted(map(tuple, frame.values))


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("events", "conversations"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_matches_sql(spark, duck, name):
    result = catalog.QUERIES[name](spark, DATA)
    made = duck.sql(catalog.ORACLE_SQL[name])
    # whole numbers of a column with nulls would turn to floats in a frame, and lose digits
    got, want = (pd.DataFrame(rows, columns=names, dtype=object) for rows, names in (([tuple(r) for r in result.collect()], result.columns), (made.fetchall(), made.columns)))
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_anchors(spark):
    assert catalog.QUERIES["hash_sample"](spark, DATA).count() == 1013
    assert catalog.QUERIES["subscription_state"](spark, DATA).count() == 278
    assert catalog.QUERIES["moderation_burst"](spark, DATA).count() == 171
