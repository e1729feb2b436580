"""Type 2 dimension jobs on ``customer`` and ``orders``.

The dimension and its feed are both read from ``customer``. New in the feed are
the customers of nations 20 and up, missing from it those of nations 0 to 3.
Machinery customers already have a closed version. A low balance moves a
customer to another segment, a high one hides the name in the feed, a very high
one in the dimension as well. The date of a feed row follows from its nation.
Every fifth customer of the nations that only one side has comes without an id.
A third of the orders belong to one customer, and some to none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import scd2
from tidemark.operators.dense_ids import dense_ids as number_rows
from tidemark.session import new_path, stage
from tidemark.sinks.dimensions import (
    create_dimension,
    dimension_runs,
    drop_old_runs,
    merge_dimension,
    read_dimension,
)
from tidemark.sinks.files import read_with_places, write_sorted
from tidemark.sources.files import dimension_file
from tidemark.sources.tables import table

HEAVY_CUSTOMER = 7
DIM = scd2.Dimension(attributes=("customer_name", "nation_key", "segment"))


def _customer_id(only_here: Column) -> Column:
    nameless = only_here & (F.col("c_custkey") % 5 == 0)
    return F.when(~nameless, F.col("c_custkey")).alias("customer_id")


def existing(spark: SparkSession, folder: str) -> DataFrame:
    has_older = F.col("c_mktsegment") == "MACHINERY"
    customers = table(spark, folder, "customer").filter(F.col("c_nationkey") < 20)
    change, begin, open_end = (
        F.lit(day).cast("date") for day in ("1997-07-01", "1995-01-01", scd2.OPEN_END)
    )
    shared = [
        F.when(F.col("c_acctbal") <= 9500, F.col("c_name")).alias("customer_name"),
        F.col("c_nationkey").alias("nation_key"),
    ]
    current = customers.select(
        (F.col("c_custkey") * 2 + 2).alias("customer_key"),
        _customer_id(F.col("c_nationkey") < 4),
        *shared,
        F.col("c_mktsegment").alias("segment"),
        F.when(has_older, change).otherwise(begin).alias("effective_start_date"),
        open_end.alias("effective_end_date"),
        F.lit(True).alias("is_current"),
    )
    older = customers.filter(has_older).select(
        (F.col("c_custkey") * 2 + 1).alias("customer_key"),
        _customer_id(F.col("c_nationkey") < 4),
        *shared,
        F.lit("PROSPECT").alias("segment"),
        begin.alias("effective_start_date"),
        change.alias("effective_end_date"),
        F.lit(False).alias("is_current"),
    )
    return current.unionByName(older)


def feed(spark: SparkSession, folder: str) -> DataFrame:
    segment = F.when(F.col("c_acctbal") < 1000, F.concat("c_mktsegment", F.lit(" LOW")))
    customers = table(spark, folder, "customer").filter(F.col("c_nationkey") >= 4)
    return customers.select(
        _customer_id(F.col("c_nationkey") >= 20),
        F.when(F.col("c_acctbal") <= 9000, F.col("c_name")).alias("customer_name"),
        F.col("c_nationkey").alias("nation_key"),
        segment.otherwise(F.col("c_mktsegment")).alias("segment"),
        F.date_add(F.lit("1999-01-01").cast("date"), F.col("c_nationkey")).alias("source_date"),
    )


def scd2_classify(spark: SparkSession, folder: str) -> DataFrame:
    return scd2.classify_changes(existing(spark, folder), feed(spark, folder), DIM)


def scd2_class_counts(spark: SparkSession, folder: str) -> DataFrame:
    return scd2.class_counts(scd2_classify(spark, folder))


def scd2_merge(spark: SparkSession, folder: str) -> DataFrame:
    return scd2.scd2_merge(existing(spark, folder), feed(spark, folder), DIM)


def scd2_merge_sql(spark: SparkSession, folder: str) -> DataFrame:
    return scd2.scd2_merge_sql(existing(spark, folder), feed(spark, folder), DIM)


def _odd_feed(spark: SparkSession, folder: str) -> DataFrame:
    """The feed with dates that are missing in nation 5 and too early in nation 6."""
    early, none = F.lit("1990-01-01").cast("date"), F.lit(None).cast("date")
    date = F.when(F.col("nation_key") == 5, none).when(F.col("nation_key") == 6, early)
    rows = feed(spark, folder)
    return rows.withColumn("source_date", date.otherwise(F.col("source_date")))


def scd2_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Feed rows without an id or a date, or dated before the open version."""
    return scd2.scd2_rejects(existing(spark, folder), _odd_feed(spark, folder), DIM)


def scd2_merge_odd_feed(spark: SparkSession, folder: str) -> DataFrame:
    """The merge without those rows."""
    return scd2.scd2_merge(existing(spark, folder), _odd_feed(spark, folder), DIM)


def scd2_merge_twice(spark: SparkSession, folder: str) -> DataFrame:
    """The second merge of the same feed changes nothing."""
    merged = stage(scd2_merge(spark, folder), "dimension")
    return scd2.scd2_merge(merged, feed(spark, folder), DIM)


def _stored(spark: SparkSession, folder: str) -> tuple[str, StructType]:
    path, rows = new_path(spark, "stored-dimension"), existing(spark, folder)
    create_dimension(rows, path, DIM)
    return path, rows.schema


def scd2_merge_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The merge in place, of a dimension in files; a second run of the feed writes nothing."""
    path, schema = _stored(spark, folder)
    for _ in range(2):
        merge_dimension(spark, path, schema, feed(spark, folder), DIM)
    return read_dimension(spark, path, schema, DIM)


def scd2_merge_runs(spark: SparkSession, folder: str) -> DataFrame:
    """What each of two merges of half the feed changed, with the first half applied twice."""
    path, schema = _stored(spark, folder)
    low = F.col("nation_key") < 12
    for half in (low, low, ~low):
        merge_dimension(spark, path, schema, feed(spark, folder).where(half), DIM)
    drop_old_runs(spark, path, keep=1)
    return dimension_runs(spark, path)


def scd2_merge_latest(spark: SparkSession, folder: str) -> DataFrame:
    """A feed with many rows per customer: every order, of which the last one counts.

    The feed sets the segment only; its dates lie ten years after the orders.
    """
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("segment"),
        F.add_months(F.col("o_orderdate").cast("date"), 120).alias("source_date"),
    )
    dim = scd2.Dimension(attributes=("segment",))
    before = existing(spark, folder).select(*dim.columns)
    return scd2.scd2_merge(before, orders, dim, duplicates="latest")


def scd2_summary(spark: SparkSession, folder: str) -> DataFrame:
    return scd2.scd2_summary(scd2_merge(spark, folder), DIM)


def scd2_history_kept(spark: SparkSession, folder: str) -> DataFrame:
    return scd2.scd2_history_kept(existing(spark, folder), scd2_merge(spark, folder), DIM)


def anti_by_subquery(spark: SparkSession, folder: str) -> DataFrame:
    """Dimension rows of customers that the feed does not change."""
    changed = scd2_classify(spark, folder).filter(F.col("record_type") == scd2.CHANGED)
    return scd2.without_ids(existing(spark, folder), changed, "customer_id")


def scd2_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the customer version that held on their date."""
    place = F.col("o_orderkey")
    customer = F.when(place % 3 == 0, F.lit(HEAVY_CUSTOMER).cast("bigint")).when(
        place % 7 != 0, F.col("o_custkey")
    )
    orders = table(spark, folder, "orders").select(
        "o_orderkey", customer.alias("o_custkey"), "o_orderdate"
    )
    matched = scd2.scd2_as_of(orders, scd2_merge(spark, folder), "o_custkey", "o_orderdate", DIM)
    return matched.select("o_orderkey", "customer_key", "segment", "effective_start_date")


def scd2_load(spark: SparkSession, folder: str) -> DataFrame:
    """The dimension written as CSV with blanks around the flag, and loaded again."""
    path = new_path(spark, "dimension-csv")
    rows = existing(spark, folder).select(
        "customer_key",
        "customer_id",
        "customer_name",
        F.col("segment").alias("address"),
        F.col("nation_key").cast("string").alias("phone"),
        F.concat(F.col("customer_id"), F.lit("@email.com")).alias("email"),
        "effective_start_date",
        "effective_end_date",
        F.concat(F.col("is_current").cast("string"), F.lit(" ")).alias("is_current"),
    )
    rows.write.option("header", True).option("ignoreTrailingWhiteSpace", False).csv(path)
    return dimension_file(spark, path)


def scd2_sorted(spark: SparkSession, folder: str) -> DataFrame:
    """The merged dimension in files sorted by id and start, numbered by file and place."""
    path = new_path(spark, "sorted-dimension")
    write_sorted(scd2_merge(spark, folder), path, "customer_id", "effective_start_date", "customer_key")
    places = read_with_places(spark, path).select("customer_key", "file_name", "row_index")
    return number_rows(places, ["file_name", "row_index"]).select("customer_key", "row_id")


def dense_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Orders numbered by date, then key."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    numbered = number_rows(orders, ["o_orderdate", "o_orderkey"], unique=True)
    return numbered.select("o_orderkey", "row_id")


QUERIES = {
    function.__name__: function
    for function in (
        scd2_classify,
        scd2_class_counts,
        scd2_merge,
        scd2_merge_sql,
        scd2_rejects,
        scd2_merge_odd_feed,
        scd2_merge_twice,
        scd2_merge_stored,
        scd2_merge_runs,
        scd2_merge_latest,
        scd2_summary,
        scd2_history_kept,
        anti_by_subquery,
        scd2_as_of,
        scd2_load,
        scd2_sorted,
        dense_ids,
    )
}

_INPUTS = """
existing AS (
  SELECT c_custkey * 2 + 2 AS customer_key,
    CASE WHEN NOT (c_nationkey < 4 AND c_custkey % 5 = 0) THEN c_custkey END AS customer_id,
    CASE WHEN c_acctbal <= 9500 THEN c_name END AS customer_name, c_nationkey AS nation_key,
    c_mktsegment AS segment,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN DATE '1997-07-01' ELSE DATE '1995-01-01' END
      AS effective_start_date,
    DATE '9999-12-31' AS effective_end_date, true AS is_current
  FROM customer WHERE c_nationkey < 20
  UNION ALL
  SELECT c_custkey * 2 + 1,
    CASE WHEN NOT (c_nationkey < 4 AND c_custkey % 5 = 0) THEN c_custkey END,
    CASE WHEN c_acctbal <= 9500 THEN c_name END, c_nationkey,
    'PROSPECT', DATE '1995-01-01', DATE '1997-07-01', false
  FROM customer WHERE c_nationkey < 20 AND c_mktsegment = 'MACHINERY'),
feed AS (
  SELECT CASE WHEN NOT (c_nationkey >= 20 AND c_custkey % 5 = 0) THEN c_custkey END AS customer_id,
    CASE WHEN c_acctbal <= 9000 THEN c_name END AS customer_name,
    c_nationkey AS nation_key,
    CASE WHEN c_acctbal < 1000 THEN c_mktsegment || ' LOW' ELSE c_mktsegment END AS segment,
    DATE '1999-01-01' + c_nationkey AS source_date
  FROM customer WHERE c_nationkey >= 4),
classified AS (
  SELECT coalesce(c.customer_id, f.customer_id) AS customer_id, c.customer_key, f.source_date,
    f.customer_name, f.nation_key, f.segment,
    CASE WHEN coalesce(c.customer_id, f.customer_id) IS NULL THEN 'UNKNOWN'
         WHEN c.customer_id IS NULL THEN 'NEW' WHEN f.customer_id IS NULL THEN 'MISSING'
         WHEN c.customer_name IS NOT DISTINCT FROM f.customer_name
          AND c.nation_key IS NOT DISTINCT FROM f.nation_key
          AND c.segment IS NOT DISTINCT FROM f.segment THEN 'UNCHANGED'
         ELSE 'CHANGED' END AS record_type
  FROM (SELECT * FROM existing WHERE is_current) c
  FULL OUTER JOIN feed f ON c.customer_id = f.customer_id)"""

_MERGED = f"""{_INPUTS},
merged AS (
  SELECT e.customer_key, e.customer_id, e.customer_name, e.nation_key, e.segment,
    e.effective_start_date,
    CASE WHEN e.is_current AND c.customer_id IS NOT NULL THEN c.source_date
         ELSE e.effective_end_date END AS effective_end_date,
    e.is_current AND c.customer_id IS NULL AS is_current
  FROM existing e
  LEFT JOIN (SELECT * FROM classified WHERE record_type = 'CHANGED') c USING (customer_id)
  UNION ALL
  SELECT (SELECT max(customer_key) FROM existing)
      + row_number() OVER (ORDER BY record_type = 'NEW', customer_id),
    customer_id, customer_name, nation_key, segment, source_date, DATE '9999-12-31', true
  FROM classified WHERE record_type IN ('NEW', 'CHANGED'))"""

_ODD = f"""{_INPUTS},
odd AS (
  SELECT * REPLACE (CASE nation_key WHEN 5 THEN NULL WHEN 6 THEN DATE '1990-01-01'
                                    ELSE source_date END AS source_date) FROM feed),
judged AS (
  SELECT f.*, c.customer_id IS NULL AS is_new,
    CASE WHEN f.customer_id IS NULL THEN 'no_id' WHEN f.source_date IS NULL THEN 'no_date'
         WHEN f.source_date < c.effective_start_date THEN 'out_of_date' END AS reason
  FROM odd f LEFT JOIN (SELECT * FROM existing WHERE is_current) c USING (customer_id)
  WHERE f.customer_id IS NULL OR c.customer_id IS NULL
     OR NOT (c.customer_name IS NOT DISTINCT FROM f.customer_name
         AND c.nation_key IS NOT DISTINCT FROM f.nation_key
         AND c.segment IS NOT DISTINCT FROM f.segment))"""

SQL = {
    "scd2_rejects": f"""WITH {_ODD}
SELECT customer_id, source_date, customer_name, nation_key, segment, reason
FROM judged WHERE reason IS NOT NULL""",
    "scd2_merge_odd_feed": f"""WITH {_ODD}
SELECT e.customer_key, e.customer_id, e.customer_name, e.nation_key, e.segment,
  e.effective_start_date,
  CASE WHEN e.is_current AND j.customer_id IS NOT NULL THEN j.source_date
       ELSE e.effective_end_date END AS effective_end_date,
  e.is_current AND j.customer_id IS NULL AS is_current
FROM existing e
LEFT JOIN (SELECT * FROM judged WHERE reason IS NULL AND NOT is_new) j USING (customer_id)
UNION ALL
SELECT (SELECT max(customer_key) FROM existing) + row_number() OVER (ORDER BY is_new, customer_id),
  customer_id, customer_name, nation_key, segment, source_date, DATE '9999-12-31', true
FROM judged WHERE reason IS NULL""",
    "scd2_classify": f"""WITH {_INPUTS}
SELECT customer_id, customer_key, source_date, record_type FROM classified""",
    "scd2_class_counts": f"""WITH {_INPUTS}
SELECT record_type, count(*) AS records FROM classified GROUP BY 1""",
    "scd2_merge": f"WITH {_MERGED} SELECT * FROM merged",
    "scd2_merge_sql": f"WITH {_MERGED} SELECT * FROM merged",
    "scd2_merge_twice": f"WITH {_MERGED} SELECT * FROM merged",
    "scd2_merge_stored": f"WITH {_MERGED} SELECT * FROM merged",
    "scd2_merge_runs": f"""WITH {_INPUTS},
counted AS (
  SELECT nation_key >= 12 AS later, count(*) FILTER (record_type = 'CHANGED') AS changed,
    count(*) FILTER (record_type = 'NEW') AS new
  FROM classified WHERE record_type IN ('CHANGED', 'NEW') GROUP BY 1),
versions AS (SELECT count(*) FILTER (is_current) AS open, count(*) AS n FROM existing)
SELECT CAST(0 AS BIGINT) AS changed, CAST(0 AS BIGINT) AS new, open AS open_versions,
  n - open AS closed_versions, CAST(0 AS INTEGER) AS merge_run
FROM versions
UNION ALL
SELECT changed, new, CAST(open + sum(new) OVER (ORDER BY later) AS BIGINT), changed,
  CAST(1 + later::INT AS INTEGER)
FROM counted, versions""",
    "scd2_merge_latest": f"""WITH {_INPUTS},
ranked AS (
  SELECT o_custkey AS customer_id, o_orderpriority AS segment,
    CAST(CAST(o_orderdate AS DATE) + INTERVAL 10 YEAR AS DATE) AS source_date,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderpriority DESC) AS r
  FROM orders),
latest AS (
  SELECT f.*, c.customer_id IS NULL AS is_new
  FROM ranked f LEFT JOIN (SELECT * FROM existing WHERE is_current) c USING (customer_id)
  WHERE r = 1 AND f.segment IS DISTINCT FROM c.segment)
SELECT e.customer_key, e.customer_id, e.segment, e.effective_start_date,
  CASE WHEN e.is_current AND l.customer_id IS NOT NULL THEN l.source_date
       ELSE e.effective_end_date END AS effective_end_date,
  e.is_current AND l.customer_id IS NULL AS is_current
FROM existing e LEFT JOIN (SELECT * FROM latest WHERE NOT is_new) l USING (customer_id)
UNION ALL
SELECT (SELECT max(customer_key) FROM existing) + row_number() OVER (ORDER BY is_new, customer_id),
  customer_id, segment, source_date, DATE '9999-12-31', true
FROM latest""",
    "scd2_summary": f"""WITH {_MERGED}
SELECT count(*) AS total_records, count(*) FILTER (is_current) AS current_records,
  count(*) FILTER (NOT is_current) AS historical_records,
  count(DISTINCT customer_id) AS unique_customers
FROM merged""",
    "scd2_history_kept": f"""WITH {_MERGED}
SELECT * FROM existing WHERE customer_key IN (SELECT customer_key FROM merged)""",
    "anti_by_subquery": f"""WITH {_INPUTS}
SELECT * FROM existing WHERE customer_id IS NULL OR customer_id NOT IN (
  SELECT customer_id FROM classified WHERE record_type = 'CHANGED' AND customer_id IS NOT NULL)""",
    "scd2_as_of": f"""WITH {_MERGED}
SELECT o_orderkey, customer_key, segment, effective_start_date
FROM (SELECT o_orderkey, o_orderdate, CASE WHEN o_orderkey % 3 = 0 THEN {HEAVY_CUSTOMER}
        WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS o_custkey FROM orders)
LEFT JOIN merged ON o_custkey = customer_id
 AND CAST(o_orderdate AS DATE) >= effective_start_date
 AND (CAST(o_orderdate AS DATE) < effective_end_date OR effective_end_date = DATE '9999-12-31')""",
    "scd2_load": f"""WITH {_INPUTS}
SELECT CAST(customer_key AS INTEGER) AS customer_key, CAST(customer_id AS INTEGER) AS customer_id,
  customer_name, segment AS address, CAST(nation_key AS VARCHAR) AS phone,
  customer_id || '@email.com' AS email, effective_start_date, effective_end_date, is_current,
  customer_id IS NULL AS rejected
FROM existing""",
    "scd2_sorted": f"""WITH {_MERGED}
SELECT customer_key, row_number() OVER (
  ORDER BY customer_id NULLS FIRST, effective_start_date, customer_key) AS row_id FROM merged""",
    "dense_ids": """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_id FROM orders""",
}
