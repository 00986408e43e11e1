import pytest
from pyspark.sql import functions as F

from tidemark.operators import models as m
from tidemark.operators import subscription as sub

COLUMNS = "msno string, transaction_date date, payment_method_id int, payment_plan_days double, plan_list_price double, actual_amount_paid double, is_auto_renew int, is_cancel int, membership_expire_date date"


def _rows(spark, changes):
    base = {"msno": "u", "transaction_date": "2001-05-01", "payment_method_id": 3, "payment_plan_days": 30.0, "plan_list_price": 99.0, "actual_amount_paid": 99.0,
            "is_auto_renew": 0, "is_cancel": 0, "membership_expire_date": "2001-06-01"}
    frame = spark.createDataFrame([{**base, **c} for c in changes], COLUMNS.replace(" date", " string"))
    return frame.withColumns({c: F.col(c).cast("date") for c in ("transaction_date", "membership_expire_date")})


def test_rows_that_thirty_bits_of_a_hash_confuse(spark):
    """Two methods whose row hashes agree in 30 bits: the greater is the last one, however the rows are dealt."""
    values = [F.lit(30.0), F.lit(99.0), F.lit(99.0), F.lit(0), F.lit(0)]
    hashed = spark.range(400_000).select(F.col("id").cast("int").alias("method")).withColumn("h", F.shiftrightunsigned(F.xxhash64("method", *values), 34))
    low, high = hashed.groupBy("h").agg(F.min("method"), F.max("method"), F.count("*").alias("n")).filter("n > 1").orderBy("h").first()[1:3]
    for order in ([low, high], [high, low]):
        frame = _rows(spark, [{"payment_method_id": x} for x in order])
        for dealt in (frame.coalesce(1), frame.repartition(2, "payment_method_id"), frame.repartition(7)):
            assert sub.latest_transactions(dealt).first().latest_payment_method_id == high
            assert sub.transaction_features(dealt).first().latest_payment_method_id == high


@pytest.mark.parametrize("column,low,high", [
    ("membership_expire_date", None, "0001-01-01"), ("membership_expire_date", "2001-06-01", "9999-12-31"), ("plan_list_price", None, 0.0), ("plan_list_price", 99.9999, 100_000.0),
    ("actual_amount_paid", None, 0.0), ("actual_amount_paid", 12.3456, 12.3457), ("payment_method_id", None, 0), ("payment_method_id", 41, 2_000_000_000),
    ("payment_plan_days", None, 0.0), ("payment_plan_days", 3649.0, 3650.0), ("is_auto_renew", 0, 1), ("is_cancel", 0, 1)])
def test_each_field_orders_rows_alike_before_it(spark, column, low, high):
    later = ["membership_expire_date", "plan_list_price", "actual_amount_paid", "payment_method_id", "payment_plan_days", "is_auto_renew", "is_cancel"]
    top = {"membership_expire_date": "9999-12-31", "plan_list_price": 100_000.0, "actual_amount_paid": 100_000.0, "payment_method_id": 2_000_000_000, "payment_plan_days": 3650.0, "is_auto_renew": 1, "is_cancel": 1}
    rest = {c: top[c] for c in later[later.index(column) + 1:]}
    rows = _rows(spark, [{column: low, **rest}, {column: high}]).withColumn("o", sub._transaction_order()).collect()
    assert rows[0].o is not None and rows[1].o is not None and rows[0].o < rows[1].o


def test_categories_are_counted_before_they_come(spark):
    frame = spark.range(1_000_001).select(F.concat(F.lit("v"), "id").alias("c"), (F.col("id") % 3).cast("string").alias("d"))
    with pytest.raises(ValueError, match="1000004 distinct categories.*c alone has 1000001"):
        m.category_labels(frame, ["c", "d"])
    small = spark.createDataFrame([("b", None), ("a", "x"), ("B", "x"), ("é", None)], "c string, d string")
    assert m.category_labels(small, ["c", "d"]) == {"c": ["B", "a", "b", "é"], "d": ["x"]}
