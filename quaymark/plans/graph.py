"""The tables of the three layers and what each is built from.

Bronze exports and publishes the raw frames, silver reads what bronze published, gold reads what silver committed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..sources import writers
from . import gold, layers, silver
from .warehouse import Commit, Run, Table


def _bronze(name: str, source: DataFrame) -> Table:
    def build(run: Run) -> Commit:
        done = layers.run_bronze(source, f"{run.base}/bronze", "bronze", name)
        return Commit(done.path or done.staged, source.schema.json(), done.row_count, "csv", writers.CSV_OPTIONS)

    return Table("bronze", name, build)


def _table(layer: str, name: str, build: Callable[..., DataFrame | tuple[DataFrame, DataFrame]], *needs: str, after: tuple[str, ...] = ()) -> Table:
    """A table built from the committed tables it needs, passed in order; `after` only has to be there before."""
    return Table(layer, name, lambda run: build(*(run.read(n) for n in needs)), (*needs, *after))


def _customers(as_of: Column) -> Table:
    """Ranks come from the orders of the run before; the first run has none, then everybody has the lowest rank."""

    def build(run: Run) -> DataFrame:
        return silver.customers(run.read("bronze.users"), as_of, run.existing("silver.orders"))

    return Table("silver", "customers", build, ("bronze.users",))


def silver_tables(as_of: Column, cart_day: Column, domain: str, photos: str) -> list[Table]:
    def of(name: str, build: Callable[..., DataFrame | tuple[DataFrame, DataFrame]], *needs: str, after: tuple[str, ...] = ()) -> Table:
        return _table("silver", name, build, *needs, after=after)

    return [
        of("brands", silver.brands, "bronze.brands"),
        of("categories", silver.categories, "bronze.categories"),
        _customers(as_of),
        of("employees", lambda raw: silver.employees(raw, domain), "bronze.employees"),
        of("sub_products", silver.sub_products, "bronze.sub_products"),
        of("products", lambda raw, stock: silver.products(raw, stock, photos), "bronze.products", "silver.sub_products"),
        of("subsidiaries", silver.subsidiaries, "bronze.subsidiaries"),
        of("program_sales", silver.program_sales, "bronze.program_sales"),
        of("carts_base", silver.carts_base, "bronze.carts"),
        of("cart_items", silver.cart_items, "bronze.cart_items", "bronze.products", "silver.carts_base"),
        of("carts", lambda base, items: silver.carts(base, items, cart_day), "silver.carts_base", "silver.cart_items"),
        of("orders_base", silver.orders_base, "bronze.orders", "bronze.addresses"),
        of(
            "order_items", silver.order_items, "bronze.order_items", "silver.products", "silver.subsidiaries",
            "silver.orders_base", "silver.program_sales",
        ),
        # replaces the orders of the run before, which customers read
        of("orders", silver.orders, "silver.orders_base", "silver.order_items", after=("silver.customers",)),
        of("payments", lambda o, raw: silver.payments(o, raw, as_of), "silver.orders", "bronze.payments"),
        of("reviews", lambda i, o: silver.reviews(i, o, as_of), "silver.order_items", "silver.orders"),
        of("product_sales", silver.product_sales, "silver.order_items"),
        of("product_scores", silver.product_scores, "silver.reviews"),
        of(
            "behaviors", lambda raw, products: silver.behaviors_and_rejects(raw, products, as_of), "bronze.user_behaviors",
            "bronze.products",
        ),
    ]


def gold_tables(cities: Mapping[str, str]) -> list[Table]:
    """`cities`: the last part of a district table's name, and its city."""

    def of(name: str, build: Callable[..., DataFrame], *needs: str) -> Table:
        return _table("gold", name, build, *(n if "." in n else f"silver.{n}" for n in needs))

    def reviewed(reviews: DataFrame) -> DataFrame:
        return reviews.withColumn("review_sentiment", rules.sentiment(F.col("review_score")))

    return [
        of("brand_performance", gold.brand_performance, "order_items", "products", "brands", "orders"),
        of("brand_reviewed", gold.brand_reviewed, "products", "reviews", "brands"),
        of("campaign_performance", gold.campaign_performance, "program_sales", "product_sales", "order_items", "orders"),
        of("category_metrix", gold.category_metrix, "products", "categories"),
        of("category_performance", gold.category_performance, "products", "categories", "reviews", "order_items"),
        of("category_status", gold.category_status, "products", "categories"),
        of("customer_360", gold.customer_360, "customers", "orders", "order_items"),
        of("customer_reviews", gold.customer_reviews, "orders", "reviews"),
        of("customer_rfm", gold.customer_rfm, "gold.customer_360", "gold.customer_reviews"),
        of("customer_top_city", gold.customer_top_city, "customers"),
        *[of(f"customer_top_district_{part}", lambda c, city=city: gold.customer_top_district(c, city), "customers") for part, city in cities.items()],
        of("order_360", lambda o, i, p, r: gold.order_360(o, i, p, reviewed(r)), "orders", "order_items", "products", "reviews"),
        of("order_performance", gold.order_performance, "orders"),
        of("payments_analysis", gold.payments_analysis, "payments", "orders", "order_items"),
        of(
            "product_performance", lambda p, c, s, r, i: gold.product_performance(p, c, s, reviewed(r), i), "products", "categories",
            "product_scores", "reviews", "order_items",
        ),
        of("shipping_city_district_performance", gold.shipping_city_district_performance, "orders"),
        of("subsidiary_performance", gold.subsidiary_performance, "subsidiaries", "order_items", "orders"),
        of("subsidiary_shipping_performance", gold.subsidiary_shipping_performance, "order_items"),
    ]


def warehouse(
    raw: Mapping[str, DataFrame], as_of: Column, cart_day: Column, domain: str, photos: str, cities: Mapping[str, str]
) -> list[Table]:
    """All tables, from raw frames by name."""
    return [
        *[_bronze(name, frame) for name, frame in raw.items()],
        *silver_tables(as_of, cart_day, domain, photos),
        *gold_tables(cities),
    ]
