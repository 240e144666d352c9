from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from quaymark.functions import hashing, money, rules, text, times


def one(spark, column, **values):
    names = list(values)
    types = {str: "string", int: "long", float: "double", type(None): "string", datetime: "timestamp", date: "date"}
    schema = ", ".join(f"{n} {types[type(v)]}" for n, v in values.items())
    return spark.createDataFrame([tuple(values[n] for n in names)], schema).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "raw,name", [("product7", "Product 07"), ("product15", "Product 15"), ("product123", "Product 123"), ("product", None), (None, None)]
)
def test_product_names_are_padded_and_never_cut(spark, raw, name):
    assert one(spark, text.numbered_name(F.col("c"), "Product", "product", 2), c=raw) == name


@pytest.mark.parametrize(
    "raw,account", [("KH001", "ACC00000001"), ("KH123456789", "ACC123456789"), ("guest", None), (None, None)]
)
def test_account_ids(spark, raw, account):
    assert one(spark, text.account_id(F.col("c")), c=raw) == account


@pytest.mark.parametrize("raw,name", [("salename1", "Program Sale 01"), ("salename123", "Program Sale 123"), ("x", None)])
def test_campaign_names(spark, raw, name):
    assert one(spark, text.campaign_name(F.col("c")), c=raw) == name


@pytest.mark.parametrize(
    "raw,plain", [("Đức", "duc"), ("Nguyễn Thị Minh", "nguyen thi minh"), ("", ""), (None, None), ("ế", "e"), ("ÜÑ", "un")]
)
def test_accents(spark, raw, plain):
    assert one(spark, text.strip_diacritics(F.col("c")), c=raw) == plain


def test_phone(spark):
    assert one(spark, text.phone(F.col("c"), width=9), c=1234) == "0000001234"
    assert one(spark, text.phone(F.col("c"), missing="UNKNOWN"), c=None) == "UNKNOWN"


@pytest.mark.parametrize(
    "raw,parsed",
    [("1/2/2023 3:04", datetime(2023, 1, 2, 3, 4)), ("13/45/2023 1:00", None), ("", None), (None, None)],
)
def test_times_that_do_not_parse_are_null(spark, raw, parsed):
    assert one(spark, times.parse_time(F.col("c")), c=raw) == parsed


def test_days_late(spark):
    late = times.days_late(F.col("a"), F.col("b"))
    assert one(spark, late, a=date(2024, 1, 5), b=date(2024, 1, 2)) == 3
    assert one(spark, late, a=date(2024, 1, 1), b=date(2024, 1, 2)) == 0
    assert one(spark, times.days_late(F.lit(None).cast("date"), F.col("b")), b=date(2024, 1, 2)) == 0


def test_money(spark):
    price = F.lit("100.05").cast(money.MONEY)
    for rate, sale in (("0.00", "100.05"), ("1.00", "0.00"), ("0.15", "85.04")):
        assert str(one(spark, money.sale_price(price, F.lit(rate).cast("decimal(4,2)")), c=1)) == sale
    assert one(spark, money.half_up(F.lit(2.345), 2), c=1) == 2.35
    assert one(spark, money.guarded_ratio(F.lit(3), F.lit(0)), c=1) == 0.0
    assert one(spark, money.ratio(F.lit(3), F.lit(0)), c=1) is None
    assert one(spark, money.density(F.lit(5), F.lit(0)), c=1) == 0


def test_shipping_fee(spark):
    fee = money.shipping_fee(F.lit(1000), F.lit(10000), F.lit(10))
    assert float(one(spark, fee, c=1)) == 15000 + 4000 + 2500 + 3000
    assert float(one(spark, money.shipping_fee(F.lit(None), F.lit(None), F.lit(0)), c=1)) == 15000


def test_spend_rank_limits(spark):
    for spent, rank in ((0, "COPPER"), (49_999_999, "COPPER"), (50_000_000, "SILVER"), (120_000_000, "GOLD"),
                        (250_000_000, "PLATINUM"), (450_000_000, "DIAMOND"), (780_000_000, "VIP")):
        assert one(spark, rules.spend_rank(F.col("c")), c=spent) == rank
    assert one(spark, rules.spend_rank(F.lit(None).cast("long")), c=1) == "COPPER"


def test_payment_matrix(spark):
    def status(method, order):
        return one(spark, rules.payment_status(F.lit(method), F.lit(order), F.lit("k")), c=1)

    assert [status("COD", s) for s in ("DELIVERED", "CANCELLED", "SHIPPED")] == ["SUCCESS", "FAILED", "PENDING"]
    assert [status("MOMO", s) for s in ("PENDING", "CONFIRMED", "SHIPPED", "DELIVERED", "RETURNED")] == [
        "PENDING", "SUCCESS", "SUCCESS", "SUCCESS", "PENDING"]
    assert status("MOMO", "CANCELLED") in ("REFUNDED", "FAILED")


def test_weighted_choice_follows_its_weights(spark):
    picked = spark.range(20000).select(hashing.weighted_choice(rules.EVENT_WEIGHTS, F.col("id")).alias("e"))
    share = {r.e: r["count"] / 200 for r in picked.groupBy("e").count().collect()}
    assert set(share) == {e for e, _ in rules.EVENT_WEIGHTS}
    assert all(abs(share[e] - w) < 1.5 for e, w in rules.EVENT_WEIGHTS)


def test_rfm_segments_first_match(spark):
    def seg(r, f, m):
        return one(spark, rules.rfm_segment(F.lit(r), F.lit(f), F.lit(m)), c=1)

    cases = {(5, 5, 5): "Champions", (2, 4, 4): "Loyal Customers", (4, 3, 1): "Potential Loyalists", (1, 3, 4): "Big Spenders",
             (4, 2, 2): "New Customers", (3, 2, 2): "Promising", (3, 3, 1): "Need Attention", (2, 3, 1): "At Risk",
             (1, 2, 2): "Hibernating", (1, 1, 2): "Lost", (3, 1, 1): "Others"}
    assert {k: seg(*k) for k in cases} == cases


def test_offset_stays_in_range(spark):
    span = spark.range(5000).select(hashing.offset(7, 90, F.col("id")).alias("d")).agg(F.min("d"), F.max("d")).first()
    assert tuple(span) == (7, 90)


@pytest.mark.parametrize(
    "top,bottom,places,want",
    [
        ("201", "200", 2, "1.01"), ("-201", "200", 2, "-1.01"), ("201", "-200", 2, "-1.01"), ("1", "3", 2, "0.33"), ("-2", "3", 2, "-0.67"),
        ("0.005", "1", 2, "0.01"), ("1.0049", "1", 2, "1.00"), ("90071992547409930.05", "1", 2, "90071992547409930.05"),
        ("90071992547409930.05", "10", 2, "9007199254740993.01"), ("1", "0", 2, None), (None, "1", 2, None), ("0", "5", 5, "0.00000"),
    ],
)
def test_rounding_is_exact(spark, top, bottom, places, want):
    row = spark.range(1).select(
        money.rounded_ratio(F.lit(top).cast("decimal(28,6)"), F.lit(bottom).cast("decimal(18,2)"), places).alias("x")
    ).first()
    assert (None if row.x is None else str(row.x)) == want
