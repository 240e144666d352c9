"""Fan-out queries against the joins that define them, on data with a hot product."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from quaymark.plans import gold


@pytest.fixture(scope="module")
def tables(spark):
    items = [(i // 3, i % 3 + 1, 1 if i % 3 else i % 11, i % 4, 1 + i % 7, 100 + i % 13) for i in range(300)]
    frames = {
        "order_items": spark.createDataFrame(items, "order_id long, order_item_id long, product_id long, subsidiary_id long, quantity int, p long")
        .withColumn("sale_price", F.col("p").cast("decimal(18,2)"))
        .withColumn("total_price", (F.col("p") * F.col("quantity")).cast("decimal(18,2)")),
        "reviews": spark.createDataFrame([(i, 1 if i % 2 else i % 9, 1.0 + i % 9 / 2) for i in range(80)], "review_id long, product_id long, s double")
        .withColumn("review_score", F.col("s").cast("decimal(2,1)")),
        "products": spark.createDataFrame([(i, f"p{i}", i % 3, i % 2) for i in range(11)], "product_id long, product_name string, brand_id long, category_id long"),
        "categories": spark.createDataFrame([(0, "zero"), (1, "one")], "cate_id long, cate_name string"),
    }
    for name, frame in frames.items():
        frame.createOrReplaceTempView(f"g_{name}")
    return frames


def test_category_fan_out(spark, tables):
    have = gold.category_performance(tables["products"], tables["categories"], tables["reviews"], tables["order_items"])
    want = spark.sql("""
        SELECT cate_id, count(DISTINCT p.product_id) AS total_products, sum(quantity) AS total_sold,
               count(DISTINCT order_id) AS total_orders, sum(total_price) AS total_revenue,
               round(avg(review_score), 2) AS score, round(avg(total_price / quantity), 2) AS price
        FROM g_products p JOIN g_categories c ON p.category_id = c.cate_id
        JOIN g_reviews r ON p.product_id = r.product_id JOIN g_order_items o ON p.product_id = o.product_id GROUP BY cate_id""")
    want = {r.cate_id: (r.total_products, r.total_sold, r.total_orders, float(r.total_revenue), float(r.score), float(r.price)) for r in want.collect()}
    found = {r.cate_id: (r.total_products, r.total_sold, r.total_orders, float(r.total_revenue), float(r.avg_review_score), float(r.avg_price)) for r in have.collect()}
    assert found == want
    assert float(sum(r.revenue_share for r in have.collect())) == pytest.approx(100, abs=0.05)


def test_product_fan_out_and_exact(spark, tables):
    scores = tables["reviews"].groupBy("product_id").agg(F.count("*").alias("review_count"), F.avg("review_score").cast("float").alias("avg_rating"))
    args = (tables["products"], tables["categories"], scores, tables["reviews"], tables["order_items"])
    have = {r.product_id: (r.total_sold, r.total_orders, float(r.total_revenue)) for r in gold.product_performance(*args).collect()}
    want = spark.sql("""
        SELECT o.product_id, sum(quantity) AS q, count(*) AS n, sum(total_price) AS v
        FROM g_reviews r JOIN g_order_items o ON r.product_id = o.product_id GROUP BY 1""")
    assert have == {r.product_id: (r.q, r.n, float(r.v)) for r in want.collect()}
    exact = gold.product_performance(*args, exact=True).agg(F.sum("total_orders")).first()[0]
    assert exact == tables["order_items"].join(tables["reviews"], "product_id", "left_semi").count()


def test_the_pairs_are_never_built(spark, tables):
    """No join has items on one side and reviews on the other before they are aggregated."""
    frame = gold.category_performance(tables["products"], tables["categories"], tables["reviews"], tables["order_items"])
    text = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in text and "Cross" not in text
    for line_no, line in enumerate(lines := text.splitlines()):
        if "Join Inner" in line and "_items" in line and "_reviews" in line:
            assert "Aggregate" in "\n".join(lines[line_no : line_no + 6])


def test_branch_items_move_once_before_customers(spark):
    """Items are joined with their orders as they are; sums per branch and order would be moved as a step more."""
    items = spark.createDataFrame(
        [("B1", "O1", 1.5, 3.0), ("B1", "O1", 2.5, 4.0), ("B1", "O2", 1.0, 1.0), ("B2", "O3", 9.0, 9.0), (None, "O3", 1.0, 1.0), ("B2", "O9", 7.0, 7.0)],
        "subsidiary_id string, order_id string, sale_price double, total_price double",
    ).withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("sale_price", "total_price")})
    orders = spark.createDataFrame([("O1", "A"), ("O2", "A"), ("O3", None)], "order_id string, acc_id string")
    branches = spark.createDataFrame([("B1", "one", "D", "x"), ("B2", "two", "D", "x")], "sub_id string, sub_name string, sub_district string, sub_city string")
    found = gold.subsidiary_performance(branches, items, orders)
    assert sorted((r.sub_id, r.total_orders, r.total_customers) for r in found.collect()) == [("B1", 3, 1), ("B2", 1, 0)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(subsidiary_id#\d+, order_id", plan)
