"""Every registered query against its SQL on a second engine."""

import pytest

from marginalia.catalog.oracle import SQL
from marginalia.catalog.queries import QUERIES


def normal(frame):
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), ignore_index=True)


def test_each_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, db, folder):
    ours = normal(QUERIES[name](spark, folder).toPandas())
    theirs = normal(db.execute(SQL[name]).df())
    assert list(ours.columns) == list(theirs.columns)
    assert len(ours) == len(theirs)
    for column in ours.columns:
        assert (ours[column].fillna(-1).astype(str) == theirs[column].fillna(-1).astype(str)).all(), column
