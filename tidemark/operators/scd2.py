"""Type 2 slowly changing dimension: classify, merge, summarise, look up."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dense_ids import dense_ids
from tidemark.session import stage

OPEN_END = "9999-12-31"
MOST_HOT_KEYS = 1000
_SINCE = "_open_since"
UNCHANGED, CHANGED, NEW, MISSING, UNKNOWN = "UNCHANGED", "CHANGED", "NEW", "MISSING", "UNKNOWN"


@dataclass(frozen=True)
class Dimension:
    """Column names of a versioned table and of the feed that updates it."""

    attributes: tuple[str, ...] = ("customer_name", "address", "phone", "email")
    business_id: str = "customer_id"
    key: str = "customer_key"
    start: str = "effective_start_date"
    end: str = "effective_end_date"
    current: str = "is_current"
    source_date: str = "source_date"

    @property
    def columns(self) -> list[str]:
        return [self.key, self.business_id, *self.attributes, self.start, self.end, self.current]


CUSTOMER = Dimension()


def is_current(dim: Dimension) -> Column:
    return F.col(dim.current).eqNullSafe(True)


def one_row_per_id(feed: DataFrame, dim: Dimension, duplicates: str) -> DataFrame:
    """The feed with unique, known ids.

    ``duplicates="error"`` fails the job on a repeated id, ``"latest"`` keeps its
    newest row. Either way it is one aggregation with a map-side part, so a
    heavily repeated id does not gather its rows anywhere, and the join on the
    id that follows reuses its partitioning.
    """
    row = F.struct(dim.source_date, *dim.attributes)
    grouped = (
        feed.filter(F.col(dim.business_id).isNotNull())
        .groupBy(dim.business_id)
        .agg(F.max(row).alias("row"), F.count("*").alias("copies"))
    )
    if duplicates == "error":
        message = F.concat(F.lit("duplicate id in feed: "), F.col(dim.business_id).cast("string"))
        # A filter is kept whatever columns are read later, and the id stays a
        # plain grouping column, so its partitioning carries over.
        alone = F.when(F.col("copies") == 1, True).otherwise(
            F.raise_error(message).cast("boolean")
        )
        grouped = grouped.filter(alone)
    elif duplicates != "latest":
        raise ValueError(f"unknown policy for duplicate ids: {duplicates}")
    return grouped.select(dim.business_id, "row.*")


def _same_attributes(dim: Dimension) -> Column:
    same = F.lit(True)
    for name in dim.attributes:
        same = same & F.col(f"cur.{name}").eqNullSafe(F.col(f"new.{name}"))
    return same


def classify_changes(
    existing: DataFrame, feed: DataFrame, dim: Dimension = CUSTOMER, duplicates: str = "error"
) -> DataFrame:
    """One row per id of the open versions and the feed, with its ``record_type``.

    Two NULLs are equal, a NULL and a value are not. Ids only in the dimension
    are MISSING. Rows without an id cannot be matched: they are UNKNOWN and stay
    out of the join, where they would all land in one partition.
    """
    identified = F.col(dim.business_id).isNotNull()
    current = existing.filter(is_current(dim))
    cur_id, new_id = F.col(f"cur.{dim.business_id}"), F.col(f"new.{dim.business_id}")
    record_type = (
        F.when(cur_id.isNull(), NEW)
        .when(new_id.isNull(), MISSING)
        .when(_same_attributes(dim), UNCHANGED)
        .otherwise(CHANGED)
    )
    matched = (
        current.filter(identified)
        .alias("cur")
        .join(one_row_per_id(feed, dim, duplicates).alias("new"), cur_id == new_id, "full_outer")
        .select(
            F.coalesce(cur_id, new_id).alias(dim.business_id),
            F.col(f"cur.{dim.key}").alias(dim.key),
            F.col(f"new.{dim.source_date}").alias(dim.source_date),
            record_type.alias("record_type"),
        )
    )
    without_id = [
        rows.filter(~identified).select(
            dim.business_id, key.alias(dim.key), date.alias(dim.source_date)
        )
        for rows, key, date in (
            (current, F.col(dim.key), F.lit(None).cast(feed.schema[dim.source_date].dataType)),
            (feed, F.lit(None).cast(existing.schema[dim.key].dataType), F.col(dim.source_date)),
        )
    ]
    unknown = without_id[0].unionByName(without_id[1]).withColumn("record_type", F.lit(UNKNOWN))
    return matched.unionByName(unknown)


def class_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("record_type").agg(F.count("*").alias("records"))


def _changes(
    existing: DataFrame, feed: DataFrame, dim: Dimension, duplicates: str
) -> DataFrame:
    """Feed rows that open a version; ``is_new`` orders new ids after changed ones.

    The open versions are first cut down to the ids of the feed. A small feed is
    broadcast for that, and the dimension is not shuffled; a large one shares
    its shuffle with the join below.
    """
    cur_id, new_id = F.col(f"cur.{dim.business_id}"), F.col(f"new.{dim.business_id}")
    rows = one_row_per_id(feed, dim, duplicates)
    fed_ids = rows.select(dim.business_id)
    with_id = existing.filter(is_current(dim) & F.col(dim.business_id).isNotNull())
    touched = with_id.join(fed_ids, dim.business_id, "left_semi")
    return (
        rows.alias("new")
        .join(touched.alias("cur"), cur_id == new_id, "left")
        .filter(cur_id.isNull() | ~_same_attributes(dim))
        .select(
            "new.*", cur_id.isNull().alias("is_new"), F.col(f"cur.{dim.start}").alias(_SINCE)
        )
    )


def _applicable(dim: Dimension) -> Column:
    """Whether a change has a date that does not lie before the version it would close."""
    dated = F.col(dim.source_date).isNotNull()
    return dated & F.coalesce(F.col(dim.source_date) >= F.col(_SINCE), F.lit(True))


def scd2_rejects(
    existing: DataFrame, feed: DataFrame, dim: Dimension = CUSTOMER, duplicates: str = "error"
) -> DataFrame:
    """Feed rows that the merge sets aside, with the ``reason``.

    ``no_id``; ``no_date``; ``out_of_date``: the row would close a version before
    that version starts. Rows that change nothing are no rejects.
    """
    columns = [dim.business_id, dim.source_date, *dim.attributes]
    nameless = feed.filter(F.col(dim.business_id).isNull())
    reason = F.when(F.col(dim.source_date).isNull(), "no_date").otherwise("out_of_date")
    late = _changes(existing, feed, dim, duplicates).filter(~_applicable(dim))
    return nameless.select(*columns, F.lit("no_id").alias("reason")).unionByName(
        late.select(*columns, reason.alias("reason"))
    )


def scd2_merge(
    existing: DataFrame,
    feed: DataFrame,
    dim: Dimension = CUSTOMER,
    duplicates: str = "error",
    close_offset_days: int = 0,
) -> DataFrame:
    """The dimension after applying the feed; every old version is kept.

    A changed id gets its open version closed at the feed row's date (or
    ``close_offset_days`` before it) and a new open version. Ids missing from
    the feed stay as they are. Feed rows without an id or date, and those dated
    before the version they would close, are set aside; ``scd2_rejects`` lists
    them. Versions without an id stay as they are. New versions get consecutive keys above the
    highest old one: changed ids first, then new ids, each by id.

    Only open versions with an id take part in the two joins on it; all others
    pass through, so neither an id with a long history nor rows without an id
    weigh on one task. What is stored in between is the changes alone, by a job
    that runs while the result is being built.
    """
    changes = numbered_changes(existing, feed, dim, duplicates)
    joins = is_current(dim) & F.col(dim.business_id).isNotNull()
    history = existing.filter(~joins).select(*dim.columns)
    return history.unionByName(touched_versions(existing, changes, dim, close_offset_days))


def numbered_changes(
    existing: DataFrame, feed: DataFrame, dim: Dimension = CUSTOMER, duplicates: str = "error"
) -> DataFrame:
    """The feed rows that a merge applies, stored, with the ``rank`` that their keys follow."""
    changes = _changes(existing, feed, dim, duplicates).filter(_applicable(dim)).drop(_SINCE)
    return dense_ids(changes, ["is_new", dim.business_id], name="rank")


def touched_versions(
    existing: DataFrame, changes: DataFrame, dim: Dimension = CUSTOMER, close_offset_days: int = 0
) -> DataFrame:
    """Open versions with an id after the merge, closed where changed, and the new versions."""
    highest_key = existing.agg(F.coalesce(F.max(dim.key), F.lit(0)).alias("k")).scalar()
    types = {field.name: field.dataType for field in existing.schema}
    opened = changes.select(
        (highest_key + F.col("rank")).cast(types[dim.key]).alias(dim.key),
        F.col(dim.business_id).cast(types[dim.business_id]).alias(dim.business_id),
        *[F.col(name).cast(types[name]).alias(name) for name in dim.attributes],
        F.col(dim.source_date).cast(types[dim.start]).alias(dim.start),
        F.lit(OPEN_END).cast(types[dim.end]).alias(dim.end),
        F.lit(True).alias(dim.current),
    )
    closing = changes.filter(~F.col("is_new")).select(
        F.col(dim.business_id).alias("closing_id"),
        F.date_sub(dim.source_date, close_offset_days).alias("closing_date"),
    )
    closed = F.col("closing_id").isNotNull()
    joins = is_current(dim) & F.col(dim.business_id).isNotNull()
    after_close = (
        existing.filter(joins)
        .join(closing, F.col(dim.business_id) == F.col("closing_id"), "left")
        .withColumn(
            dim.end,
            F.when(closed, F.col("closing_date")).otherwise(F.col(dim.end)).cast(types[dim.end]),
        )
        .withColumn(dim.current, F.col(dim.current) & ~closed)
        .select(*dim.columns)
    )
    return after_close.unionByName(opened)


def scd2_merge_sql(
    existing: DataFrame, feed: DataFrame, dim: Dimension = CUSTOMER, duplicates: str = "error"
) -> DataFrame:
    """The same merge as SQL text over the frames; no views are registered."""
    spark = existing.sparkSession
    key, bid, start, end, current = dim.key, dim.business_id, dim.start, dim.end, dim.current
    same = " AND ".join(f"cur.{a} <=> new.{a}" for a in dim.attributes)
    changes = spark.sql(
        f"""
        SELECT new.*, cur.{bid} IS NULL AS is_new
        FROM {{new}} AS new
        LEFT JOIN (
          SELECT e.* FROM {{existing}} AS e LEFT SEMI JOIN {{new}} AS f ON e.{bid} = f.{bid}
          WHERE e.{current} <=> true AND e.{bid} IS NOT NULL
        ) AS cur ON cur.{bid} = new.{bid}
        WHERE (cur.{bid} IS NULL OR NOT ({same}))
          AND new.{dim.source_date} IS NOT NULL
          AND COALESCE(new.{dim.source_date} >= cur.{start}, true)
        """,
        new=one_row_per_id(feed, dim, duplicates),
        existing=existing,
    )
    ranked = dense_ids(changes, ["is_new", bid], name="rank")
    columns = ", ".join(dim.columns)
    attributes = ", ".join(dim.attributes)
    key_type = existing.schema[key].dataType.simpleString()
    return spark.sql(
        f"""
        SELECT {columns} FROM {{existing}} WHERE NOT ({current} <=> true) OR {bid} IS NULL
        UNION ALL
        SELECT e.{key}, e.{bid}, {", ".join(f"e.{a}" for a in dim.attributes)}, e.{start},
               CASE WHEN c.{bid} IS NULL THEN e.{end} ELSE c.{dim.source_date} END AS {end},
               c.{bid} IS NULL AS {current}
        FROM (SELECT * FROM {{existing}} WHERE {current} <=> true AND {bid} IS NOT NULL) AS e
        LEFT JOIN (SELECT {bid}, {dim.source_date} FROM {{ranked}} WHERE NOT is_new) AS c
          ON e.{bid} = c.{bid}
        UNION ALL
        SELECT CAST((SELECT COALESCE(MAX({key}), 0) FROM {{existing}}) + rank AS {key_type}),
               {bid}, {attributes}, {dim.source_date}, DATE'{OPEN_END}', true
        FROM {{ranked}}
        """,
        existing=existing,
        ranked=ranked,
    )


def scd2_history_kept(before: DataFrame, after: DataFrame, dim: Dimension = CUSTOMER) -> DataFrame:
    """Old versions whose key is still there after a merge; should be all of them."""
    return before.join(after.select(dim.key), dim.key, "left_semi")


def scd2_summary(dimension: DataFrame, dim: Dimension = CUSTOMER) -> DataFrame:
    """Version counts in one pass; ids are first reduced to one row each."""
    per_id = dimension.groupBy(dim.business_id).agg(
        F.count("*").alias("n"), F.count_if(is_current(dim)).alias("open")
    )
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("open"), F.lit(0)).alias("current_records"),
        F.coalesce(F.sum(F.col("n") - F.col("open")), F.lit(0)).alias("historical_records"),
        F.count(dim.business_id).alias("unique_customers"),
    )


def without_ids(rows: DataFrame, ids: DataFrame, business_id: str) -> DataFrame:
    """Rows whose id is not in ``ids``; NULL ids there exclude nothing.

    Rows without an id stay, and stay out of the join.
    """
    listed = ids.select(business_id).filter(F.col(business_id).isNotNull())
    known = F.col(business_id).isNotNull()
    kept = rows.filter(known).join(listed, business_id, "left_anti").select(*rows.columns)
    return kept.unionByName(rows.filter(~known))


def scd2_as_of(
    facts: DataFrame,
    dimension: DataFrame,
    fact_id: str,
    fact_date: str,
    dim: Dimension = CUSTOMER,
    closed_end: bool = False,
    slice_days: int = 366,
) -> DataFrame:
    """Facts with the version valid on their date; facts without one keep NULLs.

    A version holds from its start up to, not including, its end; use
    ``closed_end`` for dimensions closed the day before the next start. Both
    sides also carry the time slice a date falls in, so the join key is (id,
    slice): an id with many versions or many facts is spread over its slices,
    and a fact meets only versions of its own slice. Versions repeat once per
    slice they touch, never beyond the slices the facts have.

    A count finds the keys that hold more than a share of ``1 / MOST_HOT_KEYS`` of
    the facts, of which there are fewer than ``MOST_HOT_KEYS``; only those are
    broadcast. Their facts are dealt out further by a hash of the whole row, and
    their versions repeat for each part. Facts without an id or date pass by.
    """
    days = F.unix_date(F.to_date(fact_date))
    span = facts.agg(F.min(days).alias("low"), F.max(days).alias("high"))
    low, high = span.select("low").scalar(), span.select("high").scalar()
    last_day = F.unix_date(dim.end) - (0 if closed_end else 1)
    is_open = F.col(dim.end) == F.lit(OPEN_END).cast("date")

    def slice_of(day: str) -> Column:
        return F.floor(F.col(day) / slice_days).cast("int")

    versions = (
        dimension.select(
            *dim.columns,
            F.unix_date(dim.start).alias("from_day"),
            F.when(is_open, F.lit(2**31 - 1)).otherwise(last_day).alias("to_day"),
        )
        .withColumn("first_day", F.greatest("from_day", low))
        .withColumn("final_day", F.least("to_day", high))
        .filter("first_day <= final_day")
        .withColumn(
            "time_slice", F.explode(F.sequence(slice_of("first_day"), slice_of("final_day")))
        )
        .drop("first_day", "final_day")
    )
    able = F.col(fact_id).isNotNull() & days.isNotNull()
    dated = (
        facts.filter(able)
        .withColumn("fact_day", days)
        .withColumn("fact_slice", slice_of("fact_day"))
    )
    counts = dated.groupBy(F.col(fact_id).alias("hot_id"), F.col("fact_slice").alias("hot_slice"))
    counts = stage(counts.agg(F.count("*").alias("n")), "fact-keys")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(
        counts.filter(F.col("n") * MOST_HOT_KEYS > total).select(
            "hot_id",
            "hot_slice",
            F.ceil(F.col("n") * MOST_HOT_KEYS / F.lit(max(1, total))).cast("int").alias("parts"),
        )
    )
    parts = F.coalesce("parts", F.lit(1))
    in_slice = F.col("hot_slice")
    fact_key = (F.col(fact_id) == F.col("hot_id")) & (F.col("fact_slice") == in_slice)
    version_key = (F.col(dim.business_id) == F.col("hot_id")) & (F.col("time_slice") == in_slice)
    dated = (
        dated.join(hot, fact_key, "left")
        .withColumn("fact_part", F.pmod(F.xxhash64(*facts.columns), parts))
        .drop("hot_id", "hot_slice", "parts")
    )
    versions = (
        versions.join(hot, version_key, "left")
        .withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop("hot_id", "hot_slice", "parts")
    )
    matches = (
        (F.col(fact_id) == F.col(dim.business_id))
        & (F.col("fact_slice") == F.col("time_slice"))
        & (F.col("fact_part") == F.col("part"))
        & F.col("fact_day").between(F.col("from_day"), F.col("to_day"))
    )
    matched = dated.join(versions, matches, "left").drop(
        "fact_day", "fact_slice", "fact_part", "from_day", "to_day", "time_slice", "part"
    )
    return matched.unionByName(facts.filter(~able), allowMissingColumns=True)
