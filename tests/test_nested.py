"""Nested documents: explode drops empty arrays, explode_outer keeps them."""

from pyspark.sql import functions as F

from tablecraft.operators.nested import flatten_items, nest_items

DOCS = [
    (1, ("C1", "Ravi Kumar"), [(75000.0, "Laptop", 1), (1500.0, "Mouse", 2)]),
    (2, ("C2", "Asha"), []),
    (3, ("C3", "Mei"), [(30000.0, "Phone", 1), (2500.0, "Case", 2), (1200.0, "Cable", 1)]),
    (4, ("C1", "Ravi Kumar"), None),
]
SCHEMA = ("txn_id int, customer struct<id:string,name:string>, "
          "items array<struct<price:double,product:string,quantity:int>>")
FIELDS = {"txn_id": "txn_id", "name": "customer.name", "product": "item.product",
          "price": "item.price", "quantity": "item.quantity"}


def test_explode_vs_outer(spark):
    df = spark.createDataFrame(DOCS, SCHEMA)
    inner = flatten_items(df, "items", FIELDS)
    outer = flatten_items(df, "items", FIELDS, outer=True)
    assert inner.count() == 5 and outer.count() == 7
    per = {r.txn_id: r["count"] for r in inner.groupBy("txn_id").count().collect()}
    assert per == {1: 2, 3: 3}
    total = inner.filter("txn_id = 1").agg(F.sum(F.col("price") * F.col("quantity"))).first()[0]
    assert total == 78000.0


def test_nest_then_flatten_round_trip(spark):
    lines = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "c", 3.0)], "k int, product string, price double")
    nested = nest_items(lines, ["k"], ["product", "price"])
    flat = flatten_items(nested, "items", {"k": "k", "product": "item.product", "price": "item.price"})
    assert sorted(map(tuple, flat.collect())) == sorted(map(tuple, lines.collect()))


def test_nested_queries_at_sf(spark, sf):
    from tablecraft.plans import nested as N

    ex, exo = N.q_nested_explode(spark, sf).count(), N.q_nested_explode_outer(spark, sf).count()
    assert exo >= ex
    dim = N.q_nested_dim_customers(spark, sf)
    assert dim.count() == dim.select("customer_id").distinct().count()
