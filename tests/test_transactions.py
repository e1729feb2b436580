from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from conftest import tuples
from tidemark import schemas
from tidemark.operators import transactions as op
from tidemark.sources.files import csv_with_header, transactions, transactions_with_rejects
from tidemark.streaming.messages import parse_messages


def mini_batches(spark):
    rows = [
        (b, (b - 1) * 10 + i + 1, f"CUST_{b}_{i:03d}", 50 + 10.5 * i)
        for b in range(1, 6)
        for i in range(10)
    ]
    return spark.createDataFrame(
        rows, "batch_number int, record_id int, customer_id string, final_amount double"
    )


def test_golden_batches(spark):
    for distinct in (op.EXACT, op.APPROX):
        assert tuples(op.batch_metrics(mini_batches(spark), distinct=distinct)) == [
            (b, 10, 972.5, 97.25, 10, b * 10 - 9, b * 10) for b in range(1, 6)
        ]


def test_grand_total_merges_states(spark):
    total = op.grand_total(op.batch_states(mini_batches(spark)))
    assert tuples(total) == [(50, 4862.5, 97.25, 50)]


def test_grand_total_counts_a_returning_customer_once(spark):
    """No sum of distinct counts, no mean of means."""
    rows = [(1, "a", 10.0), (2, "a", 20.0), (2, "a", 30.0), (2, "b", 40.0)]
    df = spark.createDataFrame(rows, "batch_number int, customer_id string, final_amount double")
    assert tuples(op.grand_total(op.batch_states(df))) == [(4, 100.0, 25.0, 2)]


def windows_in_python(rows, width, slide):
    out = {}
    for time, user, amount, batch in rows:
        start = datetime(1970, 1, 1) + ((time - datetime(1970, 1, 1)) // slide) * slide
        while start + width > time:
            out.setdefault(start, []).append((user, amount, batch))
            start -= slide
    return sorted(
        (
            start,
            start + width,
            len(items),
            round(sum(i[1] for i in items), 2),
            round(sum(i[1] for i in items) / len(items), 4),
            len({i[0] for i in items}),
            min(i[2] for i in items),
            max(i[2] for i in items),
        )
        for start, items in out.items()
    )


def test_sliding_and_tumbling_windows_against_brute_force(spark):
    begin = datetime(2024, 1, 1)
    rows = [(begin + timedelta(seconds=i * 37 % 600), i % 7, (i % 100) / 4, i // 50) for i in range(400)]
    df = spark.createDataFrame(
        rows, "t timestamp_ntz, customer_id int, final_amount double, batch_number int"
    )
    for width, slide in ((10, 5), (30, 10), (20, 20)):
        slide_text = None if width == slide else f"{slide} seconds"
        got = op.window_metrics(df, "t", f"{width} seconds", slide_text)
        got = got.withColumn("avg_transaction_value", F.round("avg_transaction_value", 4))
        want = windows_in_python(rows, timedelta(seconds=width), timedelta(seconds=slide))
        assert sorted(tuple(r) for r in got.collect()) == want


def test_missing_amounts_do_not_count_in_the_mean(spark):
    df = spark.createDataFrame(
        [("x", "a", 10.0), ("x", "a", None), ("x", None, 20.0)],
        "category string, customer_id string, final_amount double",
    )
    assert tuples(op.category_stats(df, "category")) == [("x", 3, 30.0, 15.0, 1)]


def test_numbering_cuts_batches_and_caps_on_request(spark):
    df = spark.range(25).select(F.col("id").cast("string").alias("customer_id"), "id")
    got = tuples(op.numbered_batches(df, ["id"], 10), "id", "batch_number", "batch_position")
    assert sorted(got) == [(i, i // 10 + 1, i % 10 + 1) for i in range(25)]
    capped = op.numbered_batches(df, ["id"], 10, max_records=12)
    assert sorted(r["id"] for r in capped.collect()) == list(range(12))


def test_messages_can_be_read_back(spark):
    df = spark.createDataFrame([("C1", 9.5), ("C2", 1.25)], "customer_id string, final_amount double")
    batches = op.numbered_batches(df, ["customer_id"], 1)
    produced_at = F.lit("2024-01-15 10:00:00.5").cast("timestamp")
    messages = op.published_messages(batches, "customer_id", produced_at)
    assert sorted(r["key"] for r in messages.collect()) == ["C1", "C2"]
    parsed = parse_messages(messages, schemas.TRANSACTION_MESSAGE, "key")
    got = tuples(
        parsed,
        "customer_id",
        "final_amount",
        "batch_number",
        "batch_position",
        "producer_timestamp",
        "producer_timestamp_str",
    )
    assert got == [
        ("C1", 9.5, 1, 1, 1705312800.5, "2024-01-15 10:00:00"),
        ("C2", 1.25, 2, 1, 1705312800.5, "2024-01-15 10:00:00"),
    ]


def test_order_amounts_round_to_cents(spark):
    df = spark.createDataFrame([(3, "19.99", "0.15"), (1, "0.10", "0.05")], "q int, p string, d string")
    got = op.order_amounts(df, "q", F.col("p").cast("decimal(10,2)"), F.col("d").cast("decimal(4,2)"))
    assert tuples(got, "total_amount", "discount_amount", "final_amount") == [
        (0.1, 0.01, 0.09),
        (59.97, 9.0, 50.97),
    ]


def transaction_line(**changes):
    row = {
        "customer_id": "CUST_10001",
        "transaction_id": "TXN_1",
        "transaction_date": "2024-01-15 10:00:00",
        "first_name": "A",
        "last_name": "B",
        "email": "a@b.c",
        "phone": "1",
        "age": "30",
        "gender": "F",
        "city": "X",
        "state": "Y",
        "zip_code": "01234",
        "product_category": "Books",
        "quantity": "2",
        "unit_price": "10.5",
        "total_amount": "21.0",
        "discount": "1.0",
        "final_amount": "20.0",
        "payment_method": "Cash",
        "is_premium_customer": "True",
        "customer_since": "2020-01-01",
        "loyalty_points": "5",
        "record_id": "1",
    }
    row.update(changes)
    return ",".join(row[name] for name in schemas.TRANSACTION_FILE.names)


def test_transaction_file_sets_ill_typed_rows_aside(spark, tmp_path):
    lines = [
        ",".join(schemas.TRANSACTION_FILE.names),
        transaction_line(),
        transaction_line(record_id="2", age="old"),
        transaction_line(record_id="3", is_premium_customer="no"),
        transaction_line(record_id="4", final_amount=""),
    ]
    path = tmp_path / "t.csv"
    path.write_text("\n".join(lines))
    rows = transactions(spark, str(path))
    assert rows.schema.names == schemas.TRANSACTION_FILE.names
    assert [f.dataType for f in rows.schema] == [f.dataType for f in schemas.TRANSACTION_FILE]
    assert tuples(rows, "record_id", "zip_code", "is_premium_customer") == [
        (1, "01234", True),
        (3, "01234", False),
    ]
    # The verdict does not depend on the columns a query uses.
    assert rows.count() == 2
    assert rows.select("email").count() == 2
    rejected = transactions_with_rejects(spark, str(path)).filter("rejected")
    raw = sorted(r["raw_record"] for r in rejected.select("raw_record").collect())
    assert len(raw) == 2 and any(",old," in text for text in raw)
    inferred = csv_with_header(spark, str(path))
    assert dict(inferred.dtypes)["quantity"] == "int"


def test_profile_of_no_rows(spark):
    df = spark.createDataFrame([], "d date, final_amount double, p boolean")
    row = op.transaction_profile(df, "d", F.col("p")).first()
    assert (row["record_count"], row["total_value"], row["premium_percentage"]) == (0, None, None)


def test_small_amounts_are_not_lost(spark):
    rows = spark.range(1000).selectExpr(
        "0.004D AS final_amount", "id AS customer_id", "1 AS batch_number", "id AS record_id")
    assert op.batch_metrics(rows).first()["total_transaction_value"] == 4.0
    assert op.grand_total(op.batch_states(rows)).first()["grand_total_value"] == 4.0


def test_no_records_are_no_records(spark):
    rows = spark.range(30).select(F.col("id").alias("key"))
    assert op.numbered_batches(rows, ["key"], 10, max_records=0).count() == 0
    assert op.numbered_batches(rows, ["key"], 10).count() == 30
