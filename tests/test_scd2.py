from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import tuples
from tidemark.operators import scd2
from tidemark.sinks import dimensions
from tidemark.sinks.files import write_csv
from tidemark.sources.files import csv_with_header, dimension_file, feed_file

OPEN = date(9999, 12, 31)
DAY = date(2024, 1, 15)
GOLDEN = [
    (1, 1001, date(2023, 1, 1), OPEN, True),
    (2, 1002, date(2023, 1, 1), DAY, False),
    (3, 1003, date(2023, 1, 1), date(2023, 6, 15), False),
    (4, 1003, date(2023, 6, 16), DAY, False),
    (5, 1004, date(2023, 1, 1), OPEN, True),
    (6, 1005, date(2023, 1, 1), date(2023, 8, 20), False),
    (7, 1005, date(2023, 8, 21), OPEN, True),
    (8, 1006, date(2023, 1, 1), OPEN, True),
    (9, 1002, DAY, OPEN, True),
    (10, 1003, DAY, OPEN, True),
    (11, 1007, DAY, OPEN, True),
    (12, 1008, DAY, OPEN, True),
]
SHOWN = (
    "customer_key",
    "customer_id",
    "effective_start_date",
    "effective_end_date",
    "is_current",
)
DIM = scd2.Dimension(attributes=("a", "b"))
DIM_SCHEMA = (
    "customer_key int, customer_id int, a string, b string,"
    "effective_start_date date, effective_end_date date, is_current boolean"
)
FEED_SCHEMA = "customer_id int, a string, b string, source_date date"


@pytest.fixture()
def existing(spark, fixtures):
    rows = dimension_file(spark, str(fixtures / "dimension.csv"))
    assert rows.filter("rejected").count() == 0
    return rows.drop("rejected")


@pytest.fixture()
def feed(spark, fixtures):
    return feed_file(spark, str(fixtures / "feed.csv"))


def test_trailing_blank_in_the_flag_is_read_as_true(existing):
    assert existing.filter("customer_id = 1006").first()["is_current"] is True


def test_unreadable_flag_is_rejected(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(
        "customer_key,customer_id,customer_name,address,phone,email,"
        "effective_start_date,effective_end_date,is_current\n"
        "1,1,n,a,p,e,2023-01-01,9999-12-31,maybe\n"
        "2,2,n,a,p,e,01/02/2023,9999-12-31,true\n"
        "3,3,n,a,p,e,2023-01-01,9999-12-31, true \n"
    )
    assert tuples(dimension_file(spark, str(path)), "customer_key", "rejected") == [
        (1, True),
        (2, True),
        (3, False),
    ]


def test_golden_classes(existing, feed):
    counts = scd2.class_counts(scd2.classify_changes(existing, feed))
    assert tuples(counts) == [("CHANGED", 2), ("NEW", 2), ("UNCHANGED", 4)]


@pytest.mark.parametrize("merge", [scd2.scd2_merge, scd2.scd2_merge_sql])
def test_golden_merge(existing, feed, merge):
    merged = merge(existing, feed)
    assert sorted(tuples(merged, *SHOWN)) == GOLDEN
    assert merged.schema.names == existing.schema.names
    assert [f.dataType for f in merged.schema] == [f.dataType for f in existing.schema]
    assert tuples(scd2.scd2_summary(merged)) == [(12, 8, 4, 8)]
    row = merged.filter("customer_key = 9").first()
    assert (row["address"], row["phone"]) == ("789 Sunset Blvd", "555-5678")


@pytest.mark.parametrize("merge", [scd2.scd2_merge, scd2.scd2_merge_sql])
def test_merging_again_changes_nothing(existing, feed, merge):
    once = merge(existing, feed)
    assert tuples(merge(once, feed)) == tuples(once)


def test_history_is_kept(existing, feed):
    merged = scd2.scd2_merge(existing, feed)
    assert scd2.scd2_history_kept(existing, merged).count() == existing.count()


def test_saved_dimension_loads_again(spark, existing, feed, tmp_path):
    merged = scd2.scd2_merge(existing, feed)
    write_csv(merged, str(tmp_path / "out"))
    loaded = dimension_file(spark, str(tmp_path / "out")).drop("rejected")
    assert tuples(loaded) == tuples(merged)
    assert csv_with_header(spark, str(tmp_path / "out")).count() == 12


def frames(spark, dim_rows, feed_rows):
    return (
        spark.createDataFrame(dim_rows, DIM_SCHEMA),
        spark.createDataFrame(feed_rows, FEED_SCHEMA),
    )


def test_nulls_compare_as_values(spark):
    start = date(2020, 1, 1)
    existing, feed = frames(
        spark,
        [(i, i, a, "x", start, OPEN, True) for i, a in ((1, None), (2, None), (3, "v"))],
        [(1, None, "x", DAY), (2, "v", "x", DAY), (3, None, "x", DAY)],
    )
    got = tuples(scd2.classify_changes(existing, feed, DIM), "customer_id", "record_type")
    assert got == [(1, "UNCHANGED"), (2, "CHANGED"), (3, "CHANGED")]
    assert scd2.scd2_merge(existing, feed, DIM).count() == 5


def test_missing_and_unidentified_rows(spark):
    start = date(2020, 1, 1)
    existing, feed = frames(
        spark,
        [
            (1, 1, "v", "x", start, OPEN, True),
            (2, None, "v", "x", start, OPEN, True),
            (3, 3, "v", "x", start, OPEN, None),
        ],
        [(None, "w", "x", DAY), (None, "w", "x", DAY)],
    )
    classes = scd2.classify_changes(existing, feed, DIM)
    assert tuples(scd2.class_counts(classes)) == [("MISSING", 1), ("UNKNOWN", 3)]
    assert tuples(scd2.scd2_merge(existing, feed, DIM)) == tuples(existing)


def test_duplicate_ids_fail_or_take_the_latest(spark):
    existing, feed = frames(
        spark, [], [(1, "old", "x", date(2024, 1, 1)), (1, "new", "x", date(2024, 1, 2))]
    )
    with pytest.raises(Exception, match="duplicate id in feed: 1"):
        scd2.scd2_merge(existing, feed, DIM).collect()
    with pytest.raises(Exception, match="duplicate id in feed: 1"):
        scd2.class_counts(scd2.classify_changes(existing, feed, DIM)).collect()
    merged = scd2.scd2_merge(existing, feed, DIM, duplicates="latest")
    assert tuples(merged) == [(1, 1, "new", "x", date(2024, 1, 2), OPEN, True)]
    with pytest.raises(ValueError):
        scd2.scd2_merge(existing, feed, DIM, duplicates="any")


def test_empty_feed_and_empty_dimension(spark):
    start = date(2020, 1, 1)
    existing, feed = frames(spark, [(4, 1, "v", "x", start, OPEN, True)], [])
    assert tuples(scd2.scd2_merge(existing, feed, DIM)) == tuples(existing)
    existing, feed = frames(spark, [], [(7, "v", "x", DAY), (3, "v", "x", DAY)])
    got = tuples(scd2.scd2_merge(existing, feed, DIM), "customer_key", "customer_id")
    assert got == [(1, 3), (2, 7)]


def test_each_row_closes_on_its_own_date(spark):
    start = date(2020, 1, 1)
    days = {1: date(2024, 3, 1), 2: date(2024, 4, 1)}
    existing, feed = frames(
        spark,
        [(i, i, "v", "x", start, OPEN, True) for i in days],
        [(i, "w", "x", day) for i, day in days.items()],
    )
    for offset in (0, 1):
        merged = scd2.scd2_merge(existing, feed, DIM, close_offset_days=offset)
        closed = tuples(merged.filter("NOT is_current"), "customer_id", "effective_end_date")
        assert closed == [(i, day - timedelta(days=offset)) for i, day in days.items()]


def merge_in_python(dimension, feed):
    """Brute force: what the merge has to give, row by row."""
    current = {r[1]: r for r in dimension if r[6] and r[1] is not None}
    key = max([r[0] for r in dimension], default=0)
    changed = sorted(f for f in feed if f[0] in current and current[f[0]][2:4] != f[1:3])
    new = sorted(f for f in feed if f[0] not in current)
    closing = {f[0]: f[3] for f in changed}
    out = [
        (*r[:5], closing[r[1]], False) if r[6] and r[1] in closing else r for r in dimension
    ]
    for number, f in enumerate(changed + new, key + 1):
        out.append((number, f[0], f[1], f[2], f[3], OPEN, True))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_random_feeds_against_brute_force(spark, seed):
    rng = random.Random(seed)
    dimension, day = [], date(2024, 1, 1)
    for step in range(3):
        day += timedelta(days=10)
        ids = rng.sample(range(40), rng.randint(0, 30))
        feed = [(i, rng.choice("pqr"), rng.choice("uv"), day + timedelta(days=i % 3)) for i in ids]
        existing_df, feed_df = frames(spark, dimension, feed)
        for merge in (scd2.scd2_merge, scd2.scd2_merge_sql):
            got = sorted(tuple(r) for r in merge(existing_df, feed_df, DIM).collect())
            assert got == sorted(merge_in_python(dimension, feed)), (seed, step)
        dimension = got
        keys = [r[0] for r in got]
        assert len(set(keys)) == len(keys)
        open_ids = [r[1] for r in got if r[6]]
        assert len(set(open_ids)) == len(open_ids)
        by_id = {}
        for row in sorted(got, key=lambda r: (r[1], r[4], r[5])):
            by_id.setdefault(row[1], []).append(row)
        for versions in by_id.values():
            assert versions[-1][6]
            assert all(a[5] <= b[4] for a, b in zip(versions, versions[1:]))


@pytest.mark.parametrize("closed_end", [False, True])
def test_as_of_against_brute_force(spark, closed_end):
    """One id owns most versions and most facts; slices spread both."""
    rng = random.Random(7)
    versions, key = [], 0
    for cid, count in ((1, 60), (2, 3), (3, 1)):
        starts = sorted(date(2020, 1, 1) + timedelta(days=d) for d in rng.sample(range(1500), count))
        for place, start in enumerate(starts):
            key += 1
            last = place == count - 1
            gap = 1 if closed_end else 0
            end = OPEN if last else starts[place + 1] - timedelta(days=gap)
            versions.append((key, cid, "v", "x", start, end, last))
    facts = [
        (n, 1 if n % 3 else rng.randint(2, 4), date(2019, 6, 1) + timedelta(days=rng.randint(0, 2500)))
        for n in range(600)
    ]

    def valid(fact):
        for k, cid, _, _, start, end, _ in versions:
            before_end = fact[2] <= end if closed_end else (fact[2] < end or end == OPEN)
            if cid == fact[1] and start <= fact[2] and before_end:
                return k
        return None

    dim_df, _ = frames(spark, versions, [])
    facts_df = spark.createDataFrame(facts, "n int, cid int, d date")
    for slice_days in (30, 366):
        got = scd2.scd2_as_of(
            facts_df, dim_df, "cid", "d", DIM, closed_end=closed_end, slice_days=slice_days
        )
        assert tuples(got, "n", "customer_key") == sorted(
            [(f[0], valid(f)) for f in facts], key=repr
        )


def test_without_ids_ignores_null_ids(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,)], "customer_id int")
    ids = spark.createDataFrame([(1,), (None,)], "customer_id int")
    left = scd2.without_ids(rows, ids, "customer_id")
    assert sorted((r[0] is None, r[0]) for r in left.collect()) == [(False, 2), (True, None)]
    assert rows.filter(F.col("customer_id") == 1).count() == 1


def test_duplicates_fail_whatever_is_read(spark):
    existing = versions(spark, [(1, 1, "a", date(2020, 1, 1), OPEN, True)])
    feed = small_feed(spark, [(1, "b", date(2021, 1, 1)), (1, "c", date(2021, 1, 1))])
    classified = scd2.classify_changes(existing, feed, SMALL)
    for job in (lambda: classified.count(), lambda: classified.select("customer_id").collect()):
        with pytest.raises(Exception, match="duplicate id"):
            job()


def test_rejected_feed_rows(spark):
    existing = versions(spark, [
        (1, 1, "a", date(2020, 1, 1), OPEN, True), (2, 2, "b", date(2020, 1, 1), OPEN, True),
        (3, None, "n", date(2020, 1, 1), OPEN, True),
    ])
    feed = small_feed(spark, [
        (1, "x", date(2019, 1, 1)), (2, "y", None), (None, "z", date(2021, 1, 1)), (4, "w", None),
    ])
    rejects = scd2.scd2_rejects(existing, feed, SMALL)
    assert tuples(rejects, "customer_id", "reason") == sorted(
        [(1, "out_of_date"), (2, "no_date"), (None, "no_id"), (4, "no_date")], key=repr)
    for merge in (scd2.scd2_merge, scd2.scd2_merge_sql):
        assert tuples(merge(existing, feed, SMALL)) == tuples(existing.select(*SMALL.columns))


def largest_share(df):
    """Share of all rows that the fullest partition holds."""
    sizes = [row["n"] for row in
             df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    return max(sizes) / sum(sizes)


def test_heavy_and_missing_ids_are_dealt_out(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        dimension = versions(
            spark, [(k, k, "a", date(2020, 1, 1), OPEN, True) for k in range(100)])
        facts = spark.range(20_000).select(
            "id",
            F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 3 == 1, F.col("id") % 100)
            .cast("int").alias("who"),
            F.lit(date(2020, 5, 1)).alias("day"),
        ).repartition(16)
        got = scd2.scd2_as_of(facts, dimension, "who", "day", SMALL)
        assert got.count() == 20_000
        assert got.filter("customer_key is null").count() == facts.filter("who is null").count()
        assert largest_share(got) < 0.2
        many = spark.range(20_000).select(
            F.col("id").cast("int").alias("customer_key"),
            F.when(F.col("id") < 500, F.col("id")).cast("int").alias("customer_id"),
            F.lit("a").alias("name"),
            F.lit(date(2020, 1, 1)).alias("effective_start_date"),
            F.lit(OPEN).alias("effective_end_date"),
            F.lit(True).alias("is_current"),
        ).repartition(16)
        feed = small_feed(spark, [(k, "b", date(2021, 1, 1)) for k in range(0, 600, 2)])
        for merge in (scd2.scd2_merge, scd2.scd2_merge_sql):
            assert largest_share(merge(many, feed, SMALL)) < 0.2
        assert largest_share(scd2.without_ids(many, feed, "customer_id")) < 0.2
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


OPEN = date(9999, 12, 31)
SMALL = scd2.Dimension(attributes=("name",))


def versions(spark, rows):
    return spark.createDataFrame(
        rows, "customer_key int, customer_id int, name string, effective_start_date date,"
        " effective_end_date date, is_current boolean")


def small_feed(spark, rows):
    return spark.createDataFrame(rows, "customer_id int, name string, source_date date")


def two_attributes(spark, rows):
    return spark.createDataFrame(rows, FEED_SCHEMA)


def files_of(path, run, part):
    folder = path / "versions" / f"merge_run={run}" / f"open_part={part}"
    return sorted(f.name for f in folder.glob("*.parquet"))


@pytest.fixture()
def stored(spark, tmp_path):
    """Two closed versions, three open ones, one of them without an id."""
    rows = [
        (1, 1, "a", "x", date(2023, 1, 1), DAY, False),
        (2, 1, "b", "x", DAY, OPEN, True),
        (3, 2, "c", "x", DAY, OPEN, True),
        (4, None, "d", "x", DAY, OPEN, True),
        (5, 3, "e", "x", date(2023, 1, 1), DAY, None),
    ]
    df = spark.createDataFrame(rows, DIM_SCHEMA)
    dimensions.create_dimension(df, str(tmp_path), DIM)
    return df


def test_merge_in_place_equals_the_merge_and_keeps_closed_files(spark, tmp_path, stored):
    path = str(tmp_path)
    read = lambda: tuples(dimensions.read_dimension(spark, path, stored.schema, DIM))
    assert read() == tuples(stored)
    closed = files_of(tmp_path, 0, "false")
    feeds = [
        [(1, "B", "x", date(2024, 2, 1)), (7, "n", "x", date(2024, 2, 1))],
        [(1, "B", "y", date(2024, 3, 1)), (2, "c", "x", date(2024, 3, 1)), (None, "z", "z", DAY)],
    ]
    expected = stored
    for run, rows in enumerate(feeds, 1):
        feed = two_attributes(spark, rows)
        expected = spark.createDataFrame(
            scd2.scd2_merge(expected, feed, DIM).collect(), stored.schema
        )
        assert dimensions.merge_dimension(spark, path, stored.schema, feed, DIM) == run
        assert read() == tuples(expected)
        before = {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")}
        assert dimensions.merge_dimension(spark, path, stored.schema, feed, DIM) == run
        assert {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*.parquet")} == before
    assert files_of(tmp_path, 0, "false") == closed
    dimensions.drop_old_runs(spark, path, keep=1)
    assert files_of(tmp_path, 1, "true") == [] and read() == tuples(expected)
    runs = tuples(dimensions.dimension_runs(spark, path))
    assert runs == [(0, 0, 3, 2, 0), (1, 0, 4, 1, 2), (1, 1, 4, 1, 1)]


def test_a_run_without_commit_is_not_seen_and_is_written_over(spark, tmp_path, stored, monkeypatch):
    path, feed = str(tmp_path), two_attributes(spark, [(2, "C", "x", date(2024, 2, 1))])

    def stop(*_):
        raise RuntimeError("stopped before the commit")

    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr(dimensions, "_commit", stop)
        dimensions.merge_dimension(spark, path, stored.schema, feed, DIM)
    read = lambda: tuples(dimensions.read_dimension(spark, path, stored.schema, DIM))
    assert files_of(tmp_path, 1, "true") and read() == tuples(stored)
    other = two_attributes(spark, [(1, "Z", "x", date(2024, 2, 1))])
    assert dimensions.merge_dimension(spark, path, stored.schema, other, DIM) == 1
    assert read() == tuples(scd2.scd2_merge(stored, other, DIM))


def test_only_the_parts_in_use_are_read(spark, tmp_path, stored):
    path = str(tmp_path)
    for k in (2, 3):
        feed = two_attributes(spark, [(2, "C", str(k), date(2024, k, 1))])
        dimensions.merge_dimension(spark, path, stored.schema, feed, DIM)
    scanned = dimensions.read_dimension(spark, path, stored.schema, DIM)
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "merge_run" in plan.split("PartitionFilters: [")[1].split("]")[0]
