"""Compare the scalable forms with the literal ones: python tools/measure.py <folder> [copies].

The event table is copied to get enough rows; a third of the copies is given to one user.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from quaymark.operators import behaviour, keys, quality  # noqa: E402
from quaymark.plans import gold  # noqa: E402
from quaymark.session import build_session, stage  # noqa: E402
from workload.bindings import Tables  # noqa: E402


def timed(label: str, build) -> None:
    began = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    print(f"{label}: {time.perf_counter() - began:.1f} s", flush=True)


def main() -> None:
    folder, copies = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 100
    spark = build_session(
        "measure",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": 32,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": False,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    t = Tables(spark, folder)
    times = spark.range(copies).select(F.col("id").alias("copy"))
    many = t["b_behaviors"].select("event_id", "acc_id", "event_time").join(times.hint("shuffle_replicate_nl"))
    many = many.select(
        (F.col("event_id") * copies + F.col("copy")).alias("event_id"),
        F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("acc_id") * copies + F.col("copy")).alias("acc_id"),
        F.col("event_time") + F.make_interval(secs=F.col("copy") * 7),
    ).toDF("event_id", "acc_id", "event_time")
    events = stage(many, "many")
    print(f"{events.count()} events, {events.filter('acc_id = 0').count()} of one user")

    timed("warm-up", lambda: events)
    timed("row number, slices", lambda: keys.number_rows(events, ["acc_id", "event_time", "event_id"], "n"))
    plain = Window.orderBy("acc_id", "event_time", "event_id")
    timed("row number, one window", lambda: events.withColumn("n", F.row_number().over(plain)))
    timed("sessions, large user split", lambda: behaviour.sessionize(events))
    timed("sessions, plain window", lambda: behaviour.sessionize(events, split=False))

    items = stage(t["b_items"].drop("order_item_id"), "items")
    timed("profile, one job", lambda: quality.profile(items))

    def three_jobs() -> DataFrame:
        rows, distinct = items.count(), items.distinct().count()
        return quality.null_profile(items).withColumn("rows", F.lit(rows - distinct))

    timed("profile, three jobs", three_jobs)

    reviews, products = stage(t["b_reviews"], "reviews"), t["b_products"]

    def pairs() -> DataFrame:
        joined = products.join(reviews.select("product_id", "review_score"), "product_id").join(items, "product_id")
        return joined.groupBy("category_id").agg(
            F.count_distinct("product_id"), F.sum("quantity"), F.count_distinct("order_id"), F.sum("total_price"),
            F.avg("review_score"),
        )

    timed("category performance, totals", lambda: gold.category_performance(products, t["b_categories"], reviews, items))
    timed("category performance, pairs", pairs)
    spark.stop()


if __name__ == "__main__":
    main()
