"""Gold tables. Facts are aggregated to the join key before each join, so joins see unique keys.

The two queries whose definition joins reviews with order items per product (every review meets every
item) are computed from per-product totals: a sum over all pairs is the product of the sums of the
sides. The pairs themselves are never built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import money, rules, times
from ..functions.money import half_up, percent, ratio, rounded_ratio
from ..operators import relations
from ..operators.tiles import with_tiles
from ..session import stage

HUNDRED_THOUSAND = 100000
BIG = "decimal(38,2)"


def _rows() -> Column:
    return F.count(F.lit(1))


def _sum(name: str) -> Column:
    return F.sum(name).cast(BIG)


def brand_performance(
    order_items: DataFrame, products: DataFrame, brands: DataFrame, orders: DataFrame
) -> DataFrame:
    per_product = order_items.groupBy("product_id").agg(
        _rows().alias("_n"), F.sum("quantity").alias("_q"), _sum("total_price").alias("_v")
    )
    per_brand = (
        per_product.join(products.select("product_id", "brand_id"), "product_id")
        .groupBy("brand_id")
        .agg(F.sum("_n").alias("total_orders"), F.sum("_q").alias("total_products_sold"), _sum("_v").alias("_v"))
    )
    all_orders = orders.agg(_sum("total_amount")).scalar()
    revenue = rounded_ratio(F.col("_v"), F.lit(HUNDRED_THOUSAND), 5)
    mean = rounded_ratio(F.col("_v"), F.col("total_orders") * HUNDRED_THOUSAND, 5)
    return (
        per_brand.join(brands.select("brand_id", "brand_name"), "brand_id")
        .select(
            "brand_id",
            "brand_name",
            "total_orders",
            "total_products_sold",
            revenue.alias("total_revenue_oht"),
            mean.alias("avg_order_value_oht"),
        )
        .withColumn(
            "revenue_share_pct", rounded_ratio(F.col("total_revenue_oht") * 10000000, all_orders, 2)
        )
        .orderBy(F.desc("revenue_share_pct"), "brand_id")
    )


def brand_reviewed(products: DataFrame, reviews: DataFrame, brands: DataFrame) -> DataFrame:
    score = F.col("review_score")
    per_product = reviews.groupBy("product_id").agg(
        F.sum("review_score").alias("_s"),
        F.count("review_score").alias("_n"),
        F.count_if(score >= 4.0).alias("_pos"),
        F.count_if((score < 4.0) & (score > 2.5)).alias("_neu"),
        F.count_if(score <= 2.5).alias("_neg"),
    )
    names = {"_s": "_s", "_n": "_n", "_pos": "total_positive_reviews", "_neu": "total_neutral_reviews",
             "_neg": "total_negative_reviews"}
    per_brand = (
        per_product.join(products.select("product_id", "brand_id"), "product_id")
        .groupBy("brand_id")
        .agg(*[F.sum(c).alias(n) for c, n in names.items()])
    )
    rated = F.col("total_positive_reviews") + F.col("total_neutral_reviews") + F.col("total_negative_reviews")
    return (
        per_brand.join(brands.select("brand_id", "brand_name"), "brand_id")
        .select(
            "brand_id",
            "brand_name",
            ratio(F.col("_s"), F.col("_n")).alias("avg_review_score"),
            "total_positive_reviews",
            "total_neutral_reviews",
            "total_negative_reviews",
            percent(F.col("total_positive_reviews"), rated).alias("positive_review_rate"),
            percent(F.col("total_negative_reviews"), rated).alias("negative_review_rate"),
            percent(F.col("total_neutral_reviews"), rated).alias("neutral_review_rate"),
        )
        .orderBy(F.desc("avg_review_score"), "brand_id")
    )


def campaign_performance(
    program_sales: DataFrame, product_sales: DataFrame, order_items: DataFrame, orders: DataFrame
) -> DataFrame:
    sold = order_items.filter(F.col("sale_id").isNotNull())
    offered = product_sales.groupBy("sale_id").agg(_rows().alias("total_products"))
    revenue = sold.groupBy("sale_id").agg(
        _rows().alias("total_orders"),
        F.sum("quantity").alias("total_quantity_sold"),
        _sum("total_price").alias("total_revenue"),
        F.sum((F.col("list_price") * F.col("quantity")).cast(money.MONEY)).cast(BIG).alias("total_org_price"),
        F.sum((F.col("sale_price") * F.col("quantity")).cast(money.MONEY)).cast(BIG).alias("total_sale_price"),
    )
    first_ever = orders.groupBy("acc_id").agg(F.min("created_at").alias("_first"))
    # one row per campaign and order first, so the join to orders does not carry every item
    taken = sold.select("sale_id", "order_id").distinct()
    first_here = (
        taken.join(orders.select("order_id", "acc_id", "created_at"), "order_id")
        .groupBy("sale_id", "acc_id")
        .agg(F.min("created_at").alias("_here"))
    )
    people = (
        first_here.join(first_ever, "acc_id")
        .groupBy("sale_id")
        .agg(
            F.count("acc_id").alias("total_customers"),
            F.count_if(F.col("_first") == F.col("_here")).alias("new_customers"),
            F.count_if(F.col("_first") < F.col("_here")).alias("returning_customers"),
        )
    )
    campaigns = program_sales.select("sale_id", "sale_name", "start_date", "end_date")
    return (
        campaigns.join(offered, "sale_id")
        .join(revenue, "sale_id")
        .join(people, "sale_id")
        .select(
            "sale_id",
            "sale_name",
            "start_date",
            "end_date",
            "total_products",
            F.datediff("end_date", "start_date").alias("duration_days"),
            "total_orders",
            "total_quantity_sold",
            "total_revenue",
            rounded_ratio(F.col("total_revenue"), F.col("total_orders")).alias("avg_revenue"),
            "total_org_price",
            "total_sale_price",
            "total_customers",
            "new_customers",
            "returning_customers",
            (F.col("total_org_price") - F.col("total_sale_price")).cast(BIG).alias("total_discount_amount"),
        )
    )


def category_metrix(products: DataFrame, categories: DataFrame) -> DataFrame:
    measures = {
        "avg_weight_g": "product_weight_g",
        "avg_length_cm": "product_length_cm",
        "avg_height_cm": "product_height_cm",
        "avg_width_cm": "product_width_cm",
        "avg_volume_cm3": "product_volume_cm3",
        "avg_density_g_cm3": "product_density_g_cm3",
    }
    means = [
        rounded_ratio(F.sum(F.col(c).cast("decimal(18,4)")), F.count(c)).alias(n) for n, c in measures.items()
    ]
    per_category = products.groupBy("category_id").agg(
        _rows().alias("total_products"),
        *means,
        F.max("product_weight_g").alias("max_weight"),
        F.min("product_weight_g").alias("min_weight"),
    )
    return _with_category(per_category, categories).orderBy(F.desc("total_products"), "category_id")


def _with_category(per_category: DataFrame, categories: DataFrame) -> DataFrame:
    names = categories.select(F.col("cate_id").alias("category_id"), "cate_name")
    rest = [c for c in per_category.columns if c != "category_id"]
    return per_category.join(names, "category_id").select("category_id", "cate_name", *rest)


def category_status(products: DataFrame, categories: DataFrame) -> DataFrame:
    states = ("active", "inactive", "discontinued", "out_of_stock")
    per_category = products.groupBy("category_id").agg(
        _rows().alias("total_products"),
        *[F.count_if(F.col("product_status") == s.upper()).alias(f"{s}_products") for s in states],
    )
    rates = {f"{s}_rate": percent(F.col(f"{s}_products"), F.col("total_products")) for s in states}
    return _with_category(per_category, categories).withColumns(rates)


def _item_totals(order_items: DataFrame) -> DataFrame:
    unit = money.unit_price(F.col("total_price"), F.col("quantity"))
    return order_items.groupBy("product_id").agg(
        _rows().alias("_items"),
        F.sum("quantity").alias("_quantity"),
        _sum("total_price").alias("_revenue"),
        F.sum(unit).alias("_unit"),
    )


def _review_totals(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("product_id").agg(_rows().alias("_reviews"), F.sum("review_score").alias("_score"))


def _times(a: str, b: str, kind: str = BIG) -> Column:
    return F.sum((F.col(a) * F.col(b)).cast(kind))


SHARES = {"total_revenue": "revenue_share", "total_sold": "sold_share", "total_orders": "orders_share"}


def category_performance(
    products: DataFrame, categories: DataFrame, reviews: DataFrame, order_items: DataFrame, exact: bool = False
) -> DataFrame:
    """Category sales over products that have both reviews and items.

    As defined, each item counts once per review of its product. `exact` counts each item and each
    review once.
    """
    located = products.select("product_id", "category_id")
    both = _item_totals(order_items).join(_review_totals(reviews), "product_id").join(located, "product_id")
    # one row per product, read twice below; written so that reviews are read once
    both = stage(both, "product-totals")
    if exact:
        sold, revenue = F.sum("_quantity"), F.sum("_revenue")
        score = rounded_ratio(F.sum("_score"), F.sum("_reviews"))
        price = rounded_ratio(F.sum("_unit"), F.sum("_items"))
    else:
        pairs = _times("_items", "_reviews", "decimal(38,0)")
        sold, revenue = _times("_quantity", "_reviews", "bigint"), _times("_revenue", "_reviews")
        score = rounded_ratio(_times("_score", "_items"), pairs)
        price = rounded_ratio(_times("_unit", "_reviews", "decimal(38,6)"), pairs)
    totals = both.groupBy("category_id").agg(
        _rows().alias("total_products"),
        sold.alias("total_sold"),
        revenue.cast(BIG).alias("total_revenue"),
        score.alias("avg_review_score"),
        price.alias("avg_price"),
    )
    # distinct orders need the rows: one per order and category, over reviewed products only
    orders = (
        order_items.select("product_id", "order_id")
        .join(both.select("product_id", "category_id"), "product_id")
        .groupBy("category_id", "order_id")
        .agg(_rows().alias("_n"))
        .groupBy("category_id")
        .agg(_rows().alias("total_orders"))
    )
    named = _with_category(totals.join(orders, "category_id"), categories)
    ordered = named.select(
        F.col("category_id").alias("cate_id"), "cate_name", "total_products", "total_sold", "total_orders",
        "total_revenue", "avg_review_score", "avg_price",
    )
    return relations.with_shares(ordered, SHARES)


def product_performance(
    products: DataFrame,
    categories: DataFrame,
    product_scores: DataFrame,
    reviews: DataFrame,
    order_items: DataFrame,
    exact: bool = False,
) -> DataFrame:
    """Product sales over products with reviews; see category_performance for `exact`."""
    items = _item_totals(order_items)
    counts = reviews.groupBy("product_id").agg(_rows().alias("_reviews"))
    factor = F.lit(1) if exact else F.col("_reviews")
    named = products.select("product_id", "product_name", "brand_id", "category_id").join(
        categories.select(F.col("cate_id").alias("category_id"), "cate_name"), "category_id"
    )
    return (
        named.join(product_scores, "product_id", "left")
        .join(counts, "product_id")
        .join(items, "product_id")
        .select(
            "product_id",
            "product_name",
            "brand_id",
            "cate_name",
            F.col("avg_rating").alias("product_rating"),
            "review_count",
            (F.col("_quantity") * factor).cast("bigint").alias("total_sold"),
            (F.col("_items") * factor).cast("bigint").alias("total_orders"),
            (F.col("_revenue") * factor).cast(BIG).alias("total_revenue"),
            rounded_ratio((F.col("_unit") * factor).cast("decimal(38,6)"), F.col("_items") * factor).alias("avg_price"),
        )
        .orderBy(F.desc("total_sold"), "product_id")
    )


def customer_360(customers: DataFrame, orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Customers that have orders with items. avg_order_value is the mean item total, as defined."""
    placed = orders.groupBy("acc_id").agg(
        _rows().alias("total_orders"),
        _sum("total_amount").alias("total_spent"),
        F.min("created_at").alias("firsr_order"),
        F.max("created_at").alias("last_order"),
    )
    per_order = order_items.groupBy("order_id").agg(_rows().alias("_n"), _sum("total_price").alias("_v"))
    bought = (
        per_order.join(orders.select("order_id", "acc_id"), "order_id")
        .groupBy("acc_id")
        .agg(F.sum("_n").alias("total_products_purchased"), _sum("_v").alias("_v"))
    )
    return (
        customers.join(placed, "acc_id")
        .join(bought, "acc_id")
        .select(
            "acc_id",
            "last_name",
            "first_name",
            "gender",
            "district",
            "city",
            "customer_rank",
            "account_age_days",
            "total_orders",
            "total_products_purchased",
            "total_spent",
            ratio(F.col("_v"), F.col("total_products_purchased")).alias("avg_order_value"),
            "firsr_order",
            "last_order",
            "is_active",
        )
    )


def customer_reviews(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    score = F.col("review_score")
    per_order = reviews.groupBy("order_id").agg(
        _rows().alias("_n"),
        F.sum("review_score").alias("_s"),
        F.count_if(score >= 4.0).alias("_pos"),
        F.count_if(score <= 2.5).alias("_neg"),
        F.count_if((score > 2.5) & (score < 4.0)).alias("_neu"),
        F.count_if(F.col("has_reply")).alias("_replies"),
    )
    summed = (
        per_order.join(orders.select("order_id", "acc_id"), "order_id")
        .groupBy("acc_id")
        .agg(*[F.sum(c).alias(c) for c in ("_n", "_s", "_pos", "_neg", "_neu", "_replies")])
    )
    return summed.select(
        "acc_id",
        F.col("_n").alias("total_reviews"),
        rounded_ratio(F.col("_s"), F.col("_n")).alias("avg_review_score"),
        F.col("_pos").alias("total_positive_reviews"),
        F.col("_neg").alias("total_negative_reviews"),
        F.col("_neu").alias("total_neutral_reviews"),
        money.guarded_ratio(F.col("_pos"), F.col("_pos") + F.col("_neg")).alias("positive_review_rate"),
        money.guarded_ratio(F.col("_replies"), F.col("_n")).alias("has_reply_rate"),
    )


ANALYSIS_DATE = "2023-12-29"


def customer_rfm(
    customer_360: DataFrame, customer_reviews: DataFrame, as_of: str = ANALYSIS_DATE, recency_desc: bool = False
) -> DataFrame:
    """Recency, frequency and money in quintiles over all customers.

    Recency is ranked ascending as defined (the most recent customers get 1); `recency_desc` turns it
    round. Ties are broken by the account id. The edges of all quintiles are searched together; no customer is sorted.
    """
    day = F.lit(as_of).cast("date")
    base = (
        customer_360.filter(F.col("total_orders") > 0)
        .join(customer_reviews.select("acc_id", "avg_review_score"), "acc_id", "left")
        .select(
            "acc_id",
            F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"),
            F.datediff(day, F.to_date("last_order")).alias("recency_days"),
            F.col("total_orders").alias("frequency_orders"),
            F.col("total_spent").alias("monetary_value"),
            half_up(F.col("avg_order_value"), 2).alias("avg_order_value"),
            F.coalesce(F.col("avg_review_score"), F.lit(0)).alias("avg_review_score"),
            "customer_rank",
            F.to_date("last_order").alias("last_order_date"),
        )
    )
    recency = -F.col("recency_days") if recency_desc else F.col("recency_days")
    measures = {"r_score": "_recency", "f_score": "frequency_orders", "m_score": "monetary_value"}
    scored = with_tiles(base.withColumn("_recency", recency), "acc_id", {n: (m, 5) for n, m in measures.items()})
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return scored.select(
        "acc_id",
        "customer_name",
        "recency_days",
        "frequency_orders",
        "monetary_value",
        "r_score",
        "f_score",
        "m_score",
        F.concat(*[c.cast("string") for c in (r, f, m)]).alias("rfm_score"),
        rules.rfm_segment(r, f, m).alias("customer_segment"),
        "avg_order_value",
        "avg_review_score",
        "customer_rank",
        "last_order_date",
        day.alias("analysis_date"),
    ).orderBy(F.desc("r_score"), F.desc("f_score"), F.desc("m_score"), "acc_id")


def customer_top_city(customers: DataFrame, n: int | None = None) -> DataFrame:
    return relations.top_groups(customers, ["city"], "total_customer", n)


def customer_top_district(customers: DataFrame, city: str, n: int | None = None) -> DataFrame:
    return relations.top_groups(customers.filter(F.col("city") == city), ["district"], "total_customer", n)


def order_360(orders: DataFrame, order_items: DataFrame, products: DataFrame, reviews: DataFrame) -> DataFrame:
    sizes = products.select("product_id", "product_weight_g", "product_volume_cm3")
    amount = {
        "_weight": F.col("quantity") * F.col("product_weight_g"),
        "_volume": F.col("quantity") * F.col("product_volume_cm3"),
    }
    per_order = (
        order_items.join(sizes, "product_id")
        .groupBy("order_id")
        .agg(
            F.sum("quantity").alias("total_sold"),
            _rows().alias("total_items"),
            *[F.sum(c.cast(money.MONEY)).cast(BIG).alias(n) for n, c in amount.items()],
            rounded_ratio(F.sum("total_price"), F.count("total_price")).alias("avg_price_per_item"),
            rounded_ratio(F.sum("shipping_distance_km"), F.count("shipping_distance_km")).alias("avg_distance_km"),
            F.max("shipping_distance_km").alias("max_distance_km"),
            F.min("shipping_distance_km").alias("min_distance_km"),
            rounded_ratio(F.sum("shipping_fee"), F.count("shipping_fee")).alias("avg_fee"),
        )
        .withColumnsRenamed({"_weight": "total_weight_sold", "_volume": "total_volume_sold"})
    )
    wait = F.datediff("replied_at", "created_at")
    feelings = ("positive", "negative", "neutral")
    per_review = reviews.groupBy("order_id").agg(
        rounded_ratio(F.sum("review_score"), F.count("review_score")).alias("avg_review"),
        _rows().alias("total_reviews"),
        F.bool_or("has_reply").alias("has_reply"),
        ratio(F.sum(wait), F.count(wait)).alias("reply_in"),
        *[F.count_if(F.col("review_sentiment") == s.title()).alias(f"{s}_reviews") for s in feelings],
    )
    heads = orders.select(
        "order_id",
        "acc_id",
        "created_at",
        times.is_weekend(F.col("created_at")).alias("is_weekend_purchase"),
        "order_status",
        "total_amount",
        "total_shipfee",
        (F.col("total_amount") + F.col("total_shipfee")).alias("grand_total"),
        rounded_ratio(F.col("total_shipfee"), F.col("total_amount"), 5).alias("shipping_fee_ratio"),
        F.datediff("delivered_at", "created_at").alias("delivery_day"),
        times.days_late(F.col("delivered_at"), F.col("estimated_delivery_date")).alias("delay_day"),
    )
    return (
        heads.join(per_order, "order_id", "left")
        .join(per_review, "order_id", "left")
        .withColumns(
            {
                "order_value_segment": rules.level(F.col("total_amount"), 100000000, 50000000),
                "product_volume_segment": rules.level(F.col("total_volume_sold"), 300000, 200000),
                "product_weight_segment": rules.level(F.col("total_weight_sold"), 100000, 60000),
            }
        )
    )


def order_performance(orders: DataFrame) -> DataFrame:
    amount, status = F.col("total_amount"), F.col("order_status")

    def value(state: str) -> Column:
        return F.coalesce(F.sum(F.when(status == state, amount)), F.lit(0)).cast(BIG)

    return (
        orders.groupBy(F.year("created_at").alias("year"), F.month("created_at").alias("month"))
        .agg(
            _rows().alias("total_orders"),
            _sum("total_amount").alias("hope_total_revenue"),
            ratio(F.sum(amount), F.count(amount)).alias("avg_order_value"),
            F.count_if(status == "DELIVERED").alias("delivered_orders"),
            value("DELIVERED").alias("real_total_revenue"),
            F.count_if(status == "CANCELLED").alias("cancelled_orders"),
            value("CANCELLED").alias("cancelled_hopeful_revenue"),
        )
        .orderBy("year", "month")
    )


def payments_analysis(payments: DataFrame, orders: DataFrame, order_items: DataFrame) -> DataFrame:
    sizes = order_items.groupBy("order_id").agg(_rows().alias("_items"))
    states = {"paid": "SUCCESS", "pending": "PENDING", "failed": "FAILED", "refunded": "REFUNDED"}
    joined = (
        payments.join(orders.select("order_id", "acc_id"), "order_id")
        .join(sizes, "order_id")
        .select("payment_method", "acc_id", "payment_status", "payment_amount", "_items")
    )
    # first per method and customer, so that customers are counted without an expand
    per_customer = joined.groupBy("payment_method", "acc_id").agg(
        _rows().alias("_n"),
        *[F.count_if(F.col("payment_status") == s).alias(f"_{n}") for n, s in states.items()],
        _sum("payment_amount").alias("_v"),
        F.max("_items").alias("_max"),
        F.min("_items").alias("_min"),
    )
    per_method = per_customer.groupBy("payment_method").agg(
        F.sum("_n").alias("total_orders"),
        *[F.sum(f"_{n}").alias(f"total_{n}") for n in states],
        F.count("acc_id").alias("total_customers"),
        _sum("_v").alias("total_revenue"),
        F.max("_max").alias("max_items"),
        F.min("_min").alias("min_items"),
    )
    everyone = orders.groupBy("acc_id").agg(_sum("total_amount").alias("_v"))
    totals = everyone.agg(F.struct(_sum("_v").alias("revenue"), F.count("acc_id").alias("customers"))).scalar()
    count = F.col("total_orders")
    names = {"paid": "success", "pending": "pending", "failed": "failed", "refunded": "refunded"}
    return per_method.select(
        "payment_method",
        "total_orders",
        *[f"total_{n}" for n in states],
        "total_customers",
        "total_revenue",
        rounded_ratio(F.col("total_revenue"), count).alias("avg_order_value"),
        "max_items",
        "min_items",
        rules.payment_channel(F.col("payment_method")).alias("payment_channel"),
        rounded_ratio(F.col("total_revenue"), totals["revenue"]).alias("payment_share_pct"),
        rounded_ratio(F.col("total_customers"), totals["customers"]).alias("payment_customers_pct"),
        *[rounded_ratio(F.col(f"total_{n}"), count).alias(f"payment_{o}_rate") for n, o in names.items()],
    ).orderBy(F.desc("total_orders"), "payment_method")


def shipping_city_district_performance(orders: DataFrame) -> DataFrame:
    """The on-time rate counts orders not delivered yet as not on time, as defined."""
    way = F.datediff("delivered_at", "shipped_at")
    return (
        orders.groupBy("target_city", "target_district")
        .agg(
            _rows().alias("total_orders"),
            rounded_ratio(F.sum("total_shipfee"), F.count("total_shipfee")).alias("avg_fee"),
            rounded_ratio(F.sum("total_amount"), F.count("total_amount")).alias("avg_revenue"),
            rounded_ratio(F.sum(way), F.count(way)).alias("avg_days"),
            F.max(way).alias("max_days"),
            F.min(way).alias("min_days"),
            percent(F.count_if(F.col("delivered_at") < F.col("estimated_delivery_date")), _rows()).alias("ontime_rate"),
        )
        .orderBy("target_city", "target_district")
    )


def subsidiary_performance(subsidiaries: DataFrame, order_items: DataFrame, orders: DataFrame) -> DataFrame:
    # a branch seldom has two items of an order, so sums per branch and order would move as many rows once more
    per_customer = (
        order_items.select("subsidiary_id", "order_id", "sale_price", "total_price")
        .join(orders.select("order_id", "acc_id"), "order_id")
        .groupBy("subsidiary_id", "acc_id")
        .agg(_rows().alias("_n"), _sum("sale_price").alias("_sale"), _sum("total_price").alias("_v"))
    )
    per_branch = per_customer.groupBy("subsidiary_id").agg(
        F.sum("_n").alias("total_orders"),
        F.count("acc_id").alias("total_customers"),
        _sum("_sale").alias("_sale"),
        _sum("_v").alias("_v"),
    )
    mean = rounded_ratio(F.col("_v"), F.col("total_orders") * HUNDRED_THOUSAND, 3)
    return per_branch.join(subsidiaries, F.col("subsidiary_id") == F.col("sub_id")).select(
        "sub_id",
        "sub_name",
        "sub_district",
        F.initcap("sub_city").alias("sub_city"),
        "total_orders",
        "total_customers",
        rounded_ratio(F.col("_sale"), F.lit(HUNDRED_THOUSAND), 3).alias("total_revenue"),
        mean.alias("avg_order_value"),
    )


def subsidiary_shipping_performance(order_items: DataFrame, exact: bool = False) -> DataFrame:
    """total_items adds up item numbers, as defined; `exact` counts items."""
    items = _rows() if exact else F.sum("order_item_id")
    # per branch and order first: distinct orders become a plain count
    per_order = order_items.groupBy("subsidiary_id", "order_id").agg(
        items.alias("_items"),
        F.sum("quantity").alias("_quantity"),
        _rows().alias("_n"),
        *[_sum(c).alias(f"_{c}") for c in ("shipping_fee", "total_price", "shipping_distance_km", "item_total_weight_g")],
        F.max("shipping_distance_km").alias("_max"),
        F.min("shipping_distance_km").alias("_min"),
    )
    n = F.sum("_n")
    return (
        per_order.groupBy("subsidiary_id")
        .agg(
            _rows().alias("total_order"),
            F.sum("_items").alias("total_items"),
            F.sum("_quantity").alias("total_quantity"),
            _sum("_shipping_fee").alias("total_fee"),
            rounded_ratio(_sum("_shipping_fee"), n).alias("avg_fee"),
            _sum("_total_price").alias("total_revenue"),
            rounded_ratio(_sum("_total_price"), n).alias("avg_revenue"),
            rounded_ratio(_sum("_shipping_distance_km"), n).alias("avg_distance"),
            F.max("_max").alias("max_distance"),
            F.min("_min").alias("min_distance"),
            _sum("_item_total_weight_g").alias("total_weight"),
        )
        .withColumn("avg_items_per_order", rounded_ratio(F.col("total_items"), F.col("total_order")))
        .orderBy("subsidiary_id")
    )
