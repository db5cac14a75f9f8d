"""Discount and category rules: built-in expressions and pandas UDFs agree."""

from pyspark.sql import functions as F

from tablecraft.functions import udfs
from tablecraft.functions.columns import discount, order_category, round2

ROWS = [
    # order_id, order_value, promo_code, status
    (1, 75000.0, "SAVE10", "COMPLETED"),
    (2, 20000.0, None, "COMPLETED"),
    (3, 35000.0, "FLAT500", "PENDING"),
    (4, 300.0, "flat500", "COMPLETED"),
    (5, 150.0, "welcome200", "COMPLETED"),
    (6, 1000.0, "OTHER", "COMPLETED"),
    (7, None, "SAVE10", "COMPLETED"),
    (8, 120000.0, None, None),
    (9, 5000.0, None, "COMPLETED"),
]


def frame(spark):
    return spark.createDataFrame(ROWS, "order_id int, order_value double, promo_code string, status string")


def test_discount_rules(spark):
    out = dict(frame(spark).select("order_id", discount("order_value", "promo_code").alias("d")).collect())
    assert out[1] == 67500.0  # SAVE10
    assert out[2] == 20000.0  # null code: unchanged
    assert out[3] == 34500.0  # FLAT500
    assert out[4] == 0.0  # case-insensitive, floored at 0
    assert out[5] == 0.0  # WELCOME200 floored
    assert out[6] == 1000.0  # unknown code
    assert out[7] == 0.0  # null value


def test_category_rules(spark):
    df = frame(spark).select("order_id", order_category("order_value", "status").alias("c"))
    out = dict(df.collect())
    assert out[1] == "HIGH" and out[3] == "NON_COMPLETED" and out[9] == "LOW"
    assert out[7] == "UNKNOWN" and out[8] == "UNKNOWN"  # nulls first, not banded
    assert out[2] == "MEDIUM"


def test_udf_equals_builtin(spark):
    udfs.register(spark)
    df = frame(spark).select(
        discount("order_value", "promo_code").alias("b"),
        F.call_udf("apply_discount", F.col("order_value"), F.col("promo_code")).alias("u"),
        order_category("order_value", "status").alias("cb"),
        F.call_udf("order_category", F.col("order_value"), F.col("status")).alias("cu"),
    )
    for r in df.collect():
        assert r.b == r.u and r.cb == r.cu


def test_udf_in_sql(spark):
    udfs.register(spark)
    frame(spark).createOrReplaceTempView("udf_orders")
    r = spark.sql("SELECT apply_discount(order_value, promo_code) AS d FROM udf_orders WHERE order_id = 1").first()
    assert r.d == 67500.0


def test_round2_half_up(spark):
    r = spark.range(1).select(round2(F.lit(1.005)).alias("a"), round2(F.lit(2.675)).alias("b")).first()
    assert r.a == 1.01 and r.b == 2.68


def test_udf_and_built_in_rules_agree_on_odd_values(spark):
    from tablecraft.functions import udfs
    from tablecraft.functions.columns import discount, order_category

    values = [None, float("nan"), float("inf"), float("-inf"), 0.0, -1.0, 499.0, 60000.0, 100000.0]
    rows = [(v, c, s) for v in values for c in (None, "save10", "FLAT500", "WELCOME200", "x") for s in (None, "COMPLETED", "PENDING")]
    df = spark.createDataFrame(rows, "v double, c string, s string")
    out = df.select("v", udfs.apply_discount("v", "c").alias("a"), discount("v", "c").alias("b"),
                    udfs.order_category_udf("v", "s").alias("x"), order_category("v", "s").alias("y")).collect()
    for r in out:
        assert (r.a == r.b) and (r.x == r.y), r
        if r.v is None or r.v != r.v:
            assert r.a == 0.0 and r.x == "UNKNOWN"
