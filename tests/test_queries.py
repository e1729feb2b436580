"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from tidemark.session import new_path, shared_dir, staging

FOLDER = entry_module.SMOKE_FOLDER
LARGER = FOLDER.replace("0.001", "0.01")  # more batches, windows and partitions
QUERIES = entry_module.queries()
SQL = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def oracles():
    found = {}
    for folder in (FOLDER, LARGER):
        found[folder] = duckdb.connect()
        for path in Path(folder).glob("*.parquet"):
            found[folder].execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return found


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if value is None or (isinstance(value, float) and math.isnan(value)):
            return "NULL"
        return round(value, 6) if isinstance(value, float) else str(value)

    return sorted(([cell(row[i]) for i in order] for row in rows), key=repr)


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


CASES = [(name, FOLDER) for name in sorted(QUERIES)] + [(name, LARGER) for name in sorted(SQL)]


@pytest.mark.parametrize("name, folder", CASES)
def test_query(spark, oracles, name, folder):
    before = set(Path(shared_dir(spark)).iterdir())
    with staging(spark):
        df = QUERIES[name](spark, folder)
        rows = df.collect()
    assert rows
    assert set(Path(shared_dir(spark)).iterdir()) == before, "staged tables are left behind"
    if name not in SQL:
        return
    result = oracles[folder].execute(SQL[name])
    columns = [column[0] for column in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert comparable(df.columns, rows) == comparable(columns, result.fetchall())


def test_staging_ends_with_its_block(spark):
    with staging(spark) as outer:
        with staging(spark) as inner:
            assert inner.startswith(outer)
            spark.range(3).write.parquet(new_path(spark, "kept"))
            assert Path(inner).exists()
        assert Path(outer).exists() and not Path(inner).exists()
    assert not Path(outer).exists()
    assert Path(new_path(spark, "later")).parent == Path(shared_dir(spark))


def test_entry(spark):
    assert entry_module.entry(spark).count() == 4
