"""Every registered query: a name and a function from the tables of a data folder to a frame."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaymark.functions import hashing, money, rules, text, times
from quaymark.operators import behaviour, cleaning, keys, logs, metrics, ordered, quality, relations, sketches, tiles
from quaymark.plans import gold, graph, layers, records, silver, warehouse
from quaymark.session import new_folder, stage
from quaymark.sources import clustered, files, readers, versions, writers
from quaymark.streaming import flows, log_records

from .bindings import LINE_ORDER, Tables

Query = Callable[[Tables], DataFrame]
QUERIES: dict[str, Query] = {}

CATALOG, SCHEMA = "spark_catalog", "default"
PHOTOS = "https://cdn.shop.example/products"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def as_of():
    return F.lit("2024-06-30").cast("date")


def _table(name: str) -> str:
    """A table name no other run uses."""
    return f"{name}_{new_folder(SparkSession.active(), 't').rsplit('-', 1)[-1]}"


# ---------------------------------------------------------------- sources and sinks


@query
def src_read_table(t: Tables) -> DataFrame:
    name = _table("customers")
    path = new_folder(t.spark, "table")
    writers.write_table(t["b_customers"], CATALOG, SCHEMA, name, path=path)
    return readers.read_table(t.spark, CATALOG, SCHEMA, name)


@query
def src_named_sql(t: Tables) -> DataFrame:
    return readers.run_named(t.spark, "order_performance", {"orders": t["b_orders"]})


@query
def sink_csv_roundtrip(t: Tables) -> DataFrame:
    sent = t["b_products"]
    path = writers.write_csv(sent, new_folder(t.spark, "csv"), "bronze", "products")
    return readers.read_path(t.spark, path, "csv", sent.schema, **writers.CSV_OPTIONS)


@query
def sink_csv_texts(t: Tables) -> DataFrame:
    """Whole texts with line breaks and quotes, an empty one and a null one, published as CSV and read back."""
    first = t["documents"].agg(F.min("doc_id")).scalar()
    text = F.when(F.col("doc_id") == first, F.lit("")).when(F.col("doc_id") == first + 1, F.lit(None)).otherwise(F.col("text"))
    sent = t["documents"].withColumn("text", text)
    staged, target = writers.write_csv(sent, new_folder(t.spark, "csv"), "bronze", "documents"), new_folder(t.spark, "published")
    plain = writers.as_text(sent)
    writers.publish(t.spark, plain, staged, target, "csv", plain.schema, **writers.CSV_OPTIONS)
    return versions.read_current(t.spark, target, "csv", sent.schema, **writers.CSV_OPTIONS).withColumn("text_md5", F.md5("text")).drop("text")


@query
def sink_parquet_roundtrip(t: Tables) -> DataFrame:
    sent = t["b_orders"]
    path = writers.write_path(sent, new_folder(t.spark, "orders"))
    return readers.read_path(t.spark, path, schema=sent.schema)


@query
def sink_table_roundtrip(t: Tables) -> DataFrame:
    name, path = _table("order_performance"), new_folder(t.spark, "gold")
    writers.write_table(gold.order_performance(t["b_orders"]), CATALOG, SCHEMA, name, path=path)
    return readers.read_table(t.spark, CATALOG, SCHEMA, name)


@query
def sink_verified_publish(t: Tables) -> DataFrame:
    sent = t["b_payments"]
    staged = writers.write_path(sent, new_folder(t.spark, "staged"))
    target = new_folder(t.spark, "published")
    writers.publish(t.spark, sent, staged, target, "parquet", sent.schema)
    return versions.read_current(t.spark, target, "parquet", sent.schema)


@query
def sink_rolled_back(t: Tables) -> DataFrame:
    """A first version, a second one that is taken back, and a damaged third one that never becomes current."""
    target, first = new_folder(t.spark, "published"), t["b_payments"]
    versions.publish(t.spark, first, first, target, "parquet", first.schema)
    second = first.withColumn("payment_status", F.lit("CHANGED"))
    versions.publish(t.spark, second, second, target, "parquet", first.schema)
    versions.rollback(t.spark, target)
    try:
        versions.publish(t.spark, first, second, target, "parquet", first.schema)
    except versions.PublishError:
        return versions.read_current(t.spark, target, "parquet", first.schema)
    raise AssertionError("a copy that differs was published")


@query
def sink_clustered(t: Tables) -> DataFrame:
    """All lines written by ship date; the lines of a quarter, read from the files that may hold them."""
    lines, path = t["lineitem"].withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp")), new_folder(t.spark, "clustered")
    clustered.write_clustered(lines, path, "l_shipdate", ["l_orderkey", "l_linenumber"])
    first, last = (F.lit(day).cast("timestamp") for day in ("1995-01-01", "1995-04-01"))
    quarter = clustered.read_between(t.spark, path, "l_shipdate", lines.schema, first, last)
    return quarter.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice")


def _gold_jobs(t: Tables) -> dict[str, Callable[[], layers.Outcome]]:
    queries = {
        "category_status": lambda: gold.category_status(t["b_products"], t["b_categories"]),
        "customer_top_city": lambda: gold.customer_top_city(t["b_customers"]),
        "order_performance": lambda: gold.order_performance(t["b_orders"]),
        "not_there": lambda: readers.run_named(t.spark, "not_there"),
    }
    return {
        name: lambda name=name, build=build: layers.run_gold(
            t.spark, build, name, CATALOG, SCHEMA, new_folder(t.spark, name), _table(name)
        )
        for name, build in queries.items()
    }


@query
def run_layer_summary(t: Tables) -> DataFrame:
    summary = layers.run_layer(t.spark, _gold_jobs(t), stop_on_error=False, raise_at_end=False)
    return summary.select("table_name", "status", "row_count")


RAW = (
    "users", "brands", "categories", "employees", "products", "subsidiaries", "sub_products", "program_sales", "orders",
    "order_items", "payments", "carts", "cart_items", "user_behaviors",
)
CITIES = {"danang": "NATION_1", "hanoi": "NATION_2", "hcm": "NATION_3"}


def warehouse_tables(t: Tables) -> list[warehouse.Table]:
    raw = {name: t[f"r_{name}"] for name in RAW} | {"addresses": t["addresses"]}
    # a handful of campaigns, found among all lines, is not looked for each time it is read
    raw["program_sales"] = t.stored("r_program_sales")
    return graph.warehouse(raw, as_of(), F.lit("2023-12-31").cast("date"), "shop.example", PHOTOS, CITIES)


@contextmanager
def _database(t: Tables) -> Iterator[str]:
    name = _table("shop")
    t.spark.sql(f"CREATE DATABASE {name} LOCATION '{new_folder(t.spark, 'database')}'")
    try:
        yield name
    finally:
        t.spark.sql(f"DROP DATABASE {name} CASCADE")


@query
def run_warehouse(t: Tables) -> DataFrame:
    """All tables of the three layers, each built once from the ones before it, and whether the catalog lists them."""
    with _database(t) as database:
        run = warehouse.Run(t.spark, new_folder(t.spark, "warehouse"), "first", CATALOG, database)
        summary = warehouse.run_layers(run, warehouse_tables(t))
        listed = F.concat_ws("_", "layer", "table_name").isin(run.listed())
        return summary.select("layer", "table_name", "status", "row_count", "quarantined", listed.alias("listed"))


@query
def run_stopped_and_resumed(t: Tables) -> DataFrame:
    """A silver table fails, so nothing after it runs; started again, the run keeps what is committed."""
    names = ("brands", "categories", "sub_products", "products", "subsidiaries", "program_sales")
    tables = [x for x in warehouse_tables(t) if x.layer in ("bronze", "silver") and x.name in names]
    tables += [x for x in warehouse_tables(t) if x.full_name in ("gold.category_metrix", "gold.category_status")]

    def refuse(run: warehouse.Run) -> DataFrame:
        raise ValueError("no products today")

    broken = [replace(x, build=refuse) if x.full_name == "silver.products" else x for x in tables]
    run = warehouse.Run(t.spark, new_folder(t.spark, "warehouse"), "again")
    attempts = [warehouse.run_layers(run, chosen, workers=1, raise_at_end=False) for chosen in (broken, tables)]
    first, second = (a.select(F.lit(i).alias("attempt"), "layer", "table_name", "status", "row_count", "resumed", "error") for i, a in enumerate(attempts, 1))
    return first.unionByName(second)


# ---------------------------------------------------------------- projections, filters, cleaning


@query
def proj_rename_select(t: Tables) -> DataFrame:
    return cleaning.reshape(
        t["r_employees"],
        rename={"emp_id": "employee_id", "emp_role": "role", "sub_id": "subsidiary_id", "emp_born": "born"},
        drop=["emp_password"],
        keep=["employee_id", "role", "born", "subsidiary_id", "source_file"],
    )


@query
def filter_required_columns(t: Tables) -> DataFrame:
    return cleaning.require(t["r_employees"], ["emp_id", "emp_gender", "emp_phone", "emp_role"]).select(
        "emp_id", "emp_gender", "emp_phone", "emp_role"
    )


@query
def filter_campaign_rules(t: Tables) -> DataFrame:
    renamed = t["r_program_sales"].select(
        "sale_id",
        F.to_date("sale_startdate").alias("start_date"),
        F.to_date("sale_enddate").alias("end_date"),
        F.col("sale_createdat").alias("created_at"),
        F.col("sale_updateat").alias("updated_at"),
    )
    return cleaning.unbroken(renamed, cleaning.campaign_rules())


@query
def filter_inventory_rules(t: Tables) -> DataFrame:
    renamed = t["r_sub_products"].withColumnsRenamed({"QUANTITY": "quantity", "PRODUCT_ID": "product_id", "SUB_ID": "sub_id"})
    return cleaning.unbroken(renamed.select("sub_id", "product_id", "quantity", "created_at", "updated_at"), cleaning.inventory_rules())


@query
def dq_valid_rows(t: Tables) -> DataFrame:
    valid, _ = cleaning.split_valid(silver.judged_behaviors(t["r_user_behaviors"], t["r_products"]))
    return valid


@query
def dq_quarantine_rows(t: Tables) -> DataFrame:
    _, bad = cleaning.split_valid(silver.judged_behaviors(t["r_user_behaviors"], t["r_products"]))
    return bad.withColumn("reasons", F.array_join("reasons", "; "))


@query
def clean_fill_nulls(t: Tables) -> DataFrame:
    return t["r_users"].na.fill({"user_email": "UNKNOWN", "user_phone": 0}).select("user_id", "user_email", "user_phone")


@query
def clean_coalesce_timestamps(t: Tables) -> DataFrame:
    moved = t["r_orders"].select(
        "order_id",
        times.parse_time(F.col("created_at")).alias("created_at"),
        times.parse_time(F.col("delivered_at")).alias("delivered_at"),
    )
    return cleaning.fill_from(moved, "delivered_at", F.col("created_at"))


@query
def clean_recode_synonyms(t: Tables) -> DataFrame:
    return t["r_user_behaviors"].select(
        "event_id",
        rules.recode(F.col("device_type"), rules.DEVICES, "Desktop").alias("device_type"),
        rules.recode(F.col("event_type"), rules.EVENT_TYPES, "view").alias("event_type"),
    )


@query
def derive_order_status(t: Tables) -> DataFrame:
    return t["r_orders"].select(
        "order_id",
        rules.order_status(
            times.parse_time(F.col("confirmed_at")), times.parse_time(F.col("delivered_at"))
        ).alias("order_status"),
    )


@query
def derive_spend_rank(t: Tables) -> DataFrame:
    spent = t["b_orders"].groupBy("acc_id").agg((F.sum("total_amount") * 100).alias("spent"))
    return spent.select("acc_id", "spent", rules.spend_rank(F.col("spent")).alias("customer_rank"))


@query
def dedup_by_key(t: Tables) -> DataFrame:
    timed = t["r_brands"].withColumn("created_at", times.parse_time(F.col("created_at")))
    kept = ordered.latest_per_key(timed, ["brand_id"], [F.desc("created_at"), F.asc("brand_name")])
    return kept.select("brand_id", "brand_name", "brand_country", "created_at")


@query
def derive_stock_status(t: Tables) -> DataFrame:
    stock = t["r_sub_products"].groupBy(F.col("PRODUCT_ID").alias("product_id")).agg(F.sum("QUANTITY").alias("stock"))
    joined = t["r_products"].select("product_id").join(stock, "product_id", "left")
    return joined.select("product_id", "stock", rules.stock_status(F.col("stock")).alias("product_status"))


@query
def derive_presence_flags(t: Tables) -> DataFrame:
    id_ = F.col("review_id")
    texts = t["b_reviews"].select(
        "review_id",
        F.when(id_ % 5 != 0, "title").alias("title"),
        F.when(id_ % 3 != 0, "message").alias("message"),
    )
    return texts.withColumns(rules.presence_flags(F.col("title"), F.col("message"))).drop("title", "message")


@query
def derive_sentiment(t: Tables) -> DataFrame:
    rated = t["b_reviews"].select("review_id", "review_score")
    return rated.withColumns(rules.sentiment_flags(F.col("review_score")))


@query
def derive_payment_status(t: Tables) -> DataFrame:
    joined = t["b_payments"].select("order_id", "payment_method").join(
        t["b_orders"].select("order_id", "order_status"), "order_id"
    )
    status = rules.payment_status(F.col("payment_method"), F.col("order_status"), F.col("order_id"))
    return joined.withColumn("payment_status", status)


@query
def derive_cart_status(t: Tables) -> DataFrame:
    moved = t["r_cart_events"].groupBy("cart_id").agg(F.max("event_time").alias("updated_at"))
    day = F.lit("2024-05-20").cast("date")
    return moved.withColumn("cart_status", rules.cart_status(F.col("updated_at"), day, F.col("cart_id")))


@query
def derive_density(t: Tables) -> DataFrame:
    sides = [F.col(f"product_{s}_cm") for s in ("length", "height", "width")]
    sized = t["r_products"].withColumn("volume", money.volume(*sides))
    return sized.select(
        "product_id", "volume", money.density(F.col("product_weight_g"), F.col("volume")).alias("density")
    )


@query
def derive_lookup_gender(t: Tables) -> DataFrame:
    first = text.last_word(F.col("user_name"))
    gender = rules.lookup_gender(first, silver.FEMALE_NAMES, silver.MALE_NAMES)
    return t["r_users"].select("user_id", first.alias("first_name"), gender.alias("gender"))


@query
def derive_seeded_offset(t: Tables) -> DataFrame:
    key = F.col("order_id")
    days = hashing.offset(7, 90, F.lit("days"), key)
    start = times.shift(F.col("created_at"), days=-days)
    return t["b_orders"].select(
        "order_id",
        days.alias("days"),
        start.alias("moved_at"),
        times.shift(start, seconds=hashing.offset(0, days * 86400, F.lit("seconds"), key)).alias("changed_at"),
    )


# ---------------------------------------------------------------- joins


@query
def join_inner(t: Tables) -> DataFrame:
    carts = t["b_behaviors"].select("event_id", "product_id")
    return carts.join(t["b_products"].select("product_id", "product_name", "product_listprice"), "product_id", "inner")


@query
def join_left(t: Tables) -> DataFrame:
    items = t["b_items"].groupBy("order_id").agg(F.sum("total_price").alias("item_total"))
    return t["b_orders"].select("order_id", "total_amount").join(items, "order_id", "left")


def _active(t: Tables) -> DataFrame:
    return t["b_products"].filter(F.col("product_status") == "ACTIVE").select("product_id")


@query
def join_semi_reference(t: Tables) -> DataFrame:
    return relations.known_rows(t["b_behaviors"].select("event_id", "acc_id", "product_id"), _active(t), "product_id")


@query
def join_anti_reference(t: Tables) -> DataFrame:
    return relations.unknown_rows(t["b_behaviors"].select("event_id", "acc_id", "product_id"), _active(t), "product_id")


@query
def join_zip_rank(t: Tables) -> DataFrame:
    users = t["r_users"].select(F.trim("user_id").alias("user_id"))
    return keys.zip_join(users, t["b_customers"].select("acc_id"), ["user_id"], ["acc_id"])


@query
def join_round_robin(t: Tables) -> DataFrame:
    orders = t["b_orders"].select("order_id", "acc_id")
    return keys.round_robin(orders, ["order_id"], t["addresses"], "slot")


@query
def join_scalar_subquery(t: Tables) -> DataFrame:
    total = t["b_orders"].agg(F.sum("total_amount")).scalar()
    by_method = t["b_payments"].groupBy("payment_method").agg(F.sum("payment_amount").alias("amount"))
    return by_method.withColumn("share", money.rounded_ratio(F.col("amount"), total, 4))


@query
def join_bucket_lookup(t: Tables) -> DataFrame:
    branches = t["b_subsidiaries"].select("sub_id", "sub_city")
    return keys.bucket_lookup(t["b_orders"].select("order_id"), ["order_id"], branches, ["sub_id"], salt="branch")


# ---------------------------------------------------------------- aggregates


@query
def agg_group_count(t: Tables) -> DataFrame:
    return t["b_orders"].groupBy("order_status").agg(
        F.count(F.lit(1)).alias("orders"), F.count("delivered_at").alias("delivered")
    )


@query
def agg_basic(t: Tables) -> DataFrame:
    price = F.col("total_price")
    return t["b_items"].groupBy("subsidiary_id").agg(
        F.sum(price).alias("total"),
        money.ratio(F.sum(price), F.count(price)).alias("mean"),
        F.min(price).alias("lowest"),
        F.max(price).alias("highest"),
    )


@query
def agg_count_distinct(t: Tables) -> DataFrame:
    return relations.distinct_counts(t["b_items"], "subsidiary_id", {"products": "product_id", "orders": "order_id"})


@query
def agg_approx_distinct(t: Tables) -> DataFrame:
    """The exact count, and whether the sketch is within four of its standard errors."""
    error = 0.02
    # a repeated value changes neither; with the rows themselves, each pair of values would carry a sketch of its own
    pairs = t["b_items"].select("subsidiary_id", "product_id").distinct().repartition("subsidiary_id")
    found = pairs.groupBy("subsidiary_id").agg(
        F.approx_count_distinct("product_id", error).alias("_near"), F.count("product_id").alias("products")
    )
    within = F.abs(F.col("_near") - F.col("products")) <= 4 * error * F.col("products") + 1
    return found.withColumn("within", within).drop("_near")


@query
def agg_conditional(t: Tables) -> DataFrame:
    status = F.col("order_status")
    return t["b_orders"].groupBy("target_city").agg(
        F.count_if(status == "DELIVERED").alias("delivered"),
        F.sum(F.when(status == "CANCELLED", F.col("total_amount")).otherwise(0)).alias("cancelled_amount"),
    )


@query
def agg_rollup_to_parent(t: Tables) -> DataFrame:
    totals = {"items": F.count(F.lit(1)), "amount": F.sum("total_price"), "fee": F.sum("shipping_fee")}
    return relations.roll_up(
        t["b_orders"].select("order_id"), t["b_items"], "order_id", totals, {"items": 0, "amount": 0, "fee": 0}
    )


@query
def dq_null_profile(t: Tables) -> DataFrame:
    return quality.null_profile(t["r_users"])


@query
def dq_duplicate_count(t: Tables) -> DataFrame:
    return quality.profile(t["b_items"].drop("order_item_id")).select(
        "row_count", "duplicate_count", F.col("null_details")["sale_id"].alias("null_sale_ids")
    )


# ---------------------------------------------------------------- windows and numbering


@query
def win_item_sequence(t: Tables) -> DataFrame:
    items = t["lineitem"].withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))
    return ordered.item_sequence(items, "l_orderkey", LINE_ORDER, "item_sequence").select(
        "l_orderkey", "item_sequence", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"
    )


@query
def win_keep_latest(t: Tables) -> DataFrame:
    newest = [F.desc("created_at"), F.desc("order_id")]
    return ordered.latest_per_key(t["b_orders"].select("acc_id", "order_id", "created_at"), ["acc_id"], newest)


@query
def sessionize_events(t: Tables) -> DataFrame:
    return behaviour.sessionize(t["b_behaviors"].select("event_id", "acc_id", "event_time"))


@query
def funnel_repair(t: Tables) -> DataFrame:
    # one funnel per user and day, so that chains of several steps occur
    daily = t["b_behaviors"].select(
        "event_id", "acc_id", "event_time", "event_type", F.to_date("event_time").alias("day")
    )
    return behaviour.repair_funnel(daily, ("acc_id", "day"))


@query
def key_dense_surrogate(t: Tables) -> DataFrame:
    users = t["r_users"].withColumn("identity", text.identity(F.col("user_email"), F.col("user_phone")))
    return keys.dense_keys(users.select("user_id", "identity"), ["identity"], "cus_seq")


@query
def key_stable_surrogate(t: Tables) -> DataFrame:
    """Keys given to the users who have ordered, then to all: the first keys stay, and a third run adds none."""
    users = t["r_users"].withColumn("identity", text.identity(F.col("user_email"), F.col("user_phone"))).select("user_id", "identity")
    buyers = t["r_orders"].select(F.trim("user_id").alias("user_id"))
    base = new_folder(t.spark, "keys")
    keys.stable_keys(relations.known_rows(users, buyers, "user_id"), ["identity"], "cus_seq", base)
    keys.stable_keys(users, ["identity"], "cus_seq", base)
    return keys.stable_keys(users, ["identity"], "cus_seq", base)


@query
def key_global_row_number(t: Tables) -> DataFrame:
    reviews = t["b_reviews"].select("review_id", "order_id")
    return keys.number_rows(reviews, ["order_id", "review_id"], "row_no", "row_total")


@query
def win_ntile_scores(t: Tables) -> DataFrame:
    spent = t["b_orders"].groupBy("acc_id").agg(F.sum("total_amount").alias("spent"))
    return tiles.with_tiles(spent, "acc_id", {"quintile": ("spent", 5), "septile": ("spent", 7)})


@query
def win_share_of_total(t: Tables) -> DataFrame:
    return relations.with_shares(relations.group_count(t["b_products"], ["category_id"], "products"), {"products": "share"})


@query
def sort_multi_key(t: Tables) -> DataFrame:
    return t["b_customers"].select("acc_id", "city", "district").orderBy("city", F.desc("district"), "acc_id")


@query
def topk_groups(t: Tables) -> DataFrame:
    return relations.top_groups(t["b_customers"], ["city", "district"], "total_customer", 10)


@query
def set_distinct(t: Tables) -> DataFrame:
    return t["b_items"].select("product_id", "subsidiary_id").distinct()


# ---------------------------------------------------------------- functions


@query
def fn_text_clean(t: Tables) -> DataFrame:
    c = F.col("text")
    return t["documents"].select(
        "doc_id",
        F.length(text.squeeze(c)).alias("squeezed_length"),
        F.md5(text.squeeze(c)).alias("squeezed_md5"),
        text.capitals(F.col("lang")).alias("lang_upper"),
        text.title(F.col("lang")).alias("lang_title"),
        text.canonical(F.col("source")).alias("source_lower"),
    )


@query
def fn_id_format(t: Tables) -> DataFrame:
    return t["r_products"].select(
        "product_id",
        text.padded_id(F.col("product_id"), "P", 6, "PR").alias("padded"),
        text.numbered_name(F.col("product_name"), "Product", "product", 2).alias("name"),
        text.padded_id(F.col("brand_id"), "B", 1).alias("short"),
        text.campaign_name(F.concat(F.lit("salename"), text.digits(F.col("product_id")))).alias("campaign"),
        text.account_id(F.col("product_id")).alias("no_account"),
    )


@query
def fn_phone(t: Tables) -> DataFrame:
    number = F.col("user_phone")
    return t["r_users"].select(
        "user_id",
        text.phone(number, missing="UNKNOWN").alias("with_default"),
        text.phone(number).alias("plain"),
        text.phone(number % 1000, width=9).alias("padded"),
    )


@query
def fn_strip_diacritics(t: Tables) -> DataFrame:
    return t["documents"].select(
        "doc_id",
        F.md5(text.strip_diacritics(F.col("text"))).alias("plain_md5"),
        text.strip_diacritics(text.first_word(F.col("text"))).alias("first_word"),
    )


@query
def fn_name_parts(t: Tables) -> DataFrame:
    first, last = text.last_word(F.col("user_name")), text.without_last_word(F.col("user_name"))
    return t["r_users"].select(
        "user_id",
        text.customer_email(first, last, F.lit(7)).alias("email"),
        text.company_email(first, last, F.lit("EP0042"), "shop.example").alias("company_email"),
        text.account_name(first, text.account_id(F.col("user_id"))).alias("account_name"),
        text.photo_link(PHOTOS, F.col("user_id"), F.lit("v1")).alias("photo"),
    )


@query
def fn_parse_dates(t: Tables) -> DataFrame:
    return t["r_users"].select(
        "user_id",
        times.parse_time(F.col("user_createdat")).alias("created_at"),
        F.to_date(times.parse_time(F.col("user_createdat"))).alias("created_on"),
        times.parse_day(F.col("user_born")).alias("born"),
    )


@query
def fn_date_parts(t: Tables) -> DataFrame:
    created, delivered = F.col("created_at"), F.col("delivered_at")
    return t["b_orders"].select(
        "order_id",
        F.year(created).alias("year"),
        F.month(created).alias("month"),
        times.is_weekend(created).alias("is_weekend"),
        F.datediff(delivered, created).alias("delivery_days"),
        times.days_late(delivered, F.col("estimated_delivery_date")).alias("delay_days"),
        times.age_years(F.to_date(created), as_of()).cast("int").alias("age"),
        times.days_since(created, as_of()).alias("account_age"),
        times.shift(created, days=2, seconds=90).alias("shifted"),
    )


@query
def fn_pricing(t: Tables) -> DataFrame:
    return t["lineitem"].select(
        "l_orderkey", "l_partkey", "l_quantity", F.col("l_discount").cast("decimal(4,2)").alias("rate")
    ).join(t["b_products"], F.col("l_partkey") == F.col("product_id")).select(
        "l_orderkey",
        "product_id",
        "rate",
        money.sale_price(F.col("product_listprice"), F.col("rate")).alias("sale_price"),
        money.line_total(
            F.col("l_quantity").cast("int"), money.sale_price(F.col("product_listprice"), F.col("rate"))
        ).alias("total_price"),
        money.volume(*[F.col(f"product_{s}_cm") for s in ("length", "height", "width")]).alias("volume"),
    )


@query
def fn_shipping_fee(t: Tables) -> DataFrame:
    km = F.pmod(F.col("product_id"), F.lit(1200)).cast("decimal(18,2)")
    city = F.when(F.col("product_id") % 3 == 0, "A").otherwise("B")
    district = F.when(F.col("product_id") % 2 == 0, "X").otherwise("Y")
    return t["b_products"].select(
        "product_id",
        money.shipping_fee(F.col("product_weight_g"), F.col("product_volume_cm3"), km).alias("fee"),
        rules.shipping_zone(F.lit("A"), F.lit("X"), city, district).alias("zone"),
    )


@query
def fn_rates(t: Tables) -> DataFrame:
    return t["b_orders"].groupBy("acc_id").agg(
        F.count_if(F.col("order_status") == "CANCELLED").alias("cancelled"),
        F.count_if(F.col("order_status") == "DELIVERED").alias("delivered"),
    ).select(
        "acc_id",
        money.percent(F.col("delivered"), F.col("delivered") + F.col("cancelled")).alias("delivered_pct"),
        money.guarded_ratio(F.col("cancelled"), F.col("delivered")).alias("cancelled_per_delivered"),
    )


@query
def fn_weighted_bucket(t: Tables) -> DataFrame:
    key = F.col("event_id")
    return t["b_behaviors"].select(
        "event_id",
        hashing.bucket(10000, key).alias("slot"),
        hashing.weighted_choice(rules.EVENT_WEIGHTS, key).alias("event_type"),
        hashing.weighted_choice(rules.SCORE_WEIGHTS, F.lit("score"), key).alias("score"),
        hashing.pick(rules.PAYMENT_METHODS, key).alias("method"),
    )


# ---------------------------------------------------------------- logs


@query
def log_assemble_records(t: Tables) -> DataFrame:
    return logs.assemble_records(t["log_lines"])


@query
def log_record_texts(t: Tables) -> DataFrame:
    return logs.record_texts(logs.assemble_records(t["log_lines"]))


@query
def log_structure_lines(t: Tables) -> DataFrame:
    found = logs.structure(t["log_lines"], message="line")
    return found.withColumn("tags", F.array_join("tags", ","))


@query
def log_classify(t: Tables) -> DataFrame:
    lines = t["log_lines"].withColumn("line", F.regexp_replace("line", r"^\[DBG\]", "DBG"))
    found = logs.classify(logs.structure(lines, message="line"), message="line")
    return found.select("path", "line_no", "line", "log_level", "layer", "severity")


# ---------------------------------------------------------------- metrics


@query
def ts_tumbling_agg(t: Tables) -> DataFrame:
    millis = t["b_metrics"].withColumn("value", metrics.nanos_to_millis(F.col("value") * 1000000.0))
    aggs = [metrics.exact_mean("value").alias("mean_value"), F.count("value").alias("samples")]
    return metrics.tumbling(millis, "1 minute", ["measurement", "field"], aggs)


@query
def ts_pivot_slowest(t: Tables) -> DataFrame:
    return metrics.slowest(t["b_metrics"], ["p50", "p95"], "p95", "1 hour")


@query
def ts_last_value(t: Tables) -> DataFrame:
    return metrics.last_values(t["b_metrics"], ["measurement", "field"])


def _six_places(df: DataFrame) -> DataFrame:
    """Doubles to six places: interpolation may differ in the last bit between engines."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({n: money.half_up(F.col(n), 6) for n in names})


@query
def ts_percentiles(t: Tables) -> DataFrame:
    return _six_places(metrics.percentiles(t["b_metrics"], ["measurement"]))


@query
def ts_percentiles_approx(t: Tables) -> DataFrame:
    """The number of samples, and whether each sketched value stands within the stated error of its rank."""
    near = metrics.approximate_percentiles(t["b_metrics"], ["measurement"])
    names = [c for c in near.columns if c != "measurement"]
    value = F.col("value")
    counts = [F.count("value").alias("samples")]
    for name in names:
        counts += [F.count_if(value < F.col(name)).alias(f"_below_{name}"), F.count_if(value <= F.col(name)).alias(f"_upto_{name}")]
    ranked = t["b_metrics"].where(value.isNotNull()).join(near, "measurement").groupBy("measurement").agg(*counts)
    slack = F.col("samples") / 10000 + 1
    within = F.lit(True)
    for name, share in zip(names, metrics.PERCENTILES):
        rank = F.col("samples") * share
        within = within & (F.col(f"_below_{name}") <= rank + slack) & (F.col(f"_upto_{name}") >= rank - slack)
    return ranked.select("measurement", "samples", within.alias("within"))


@query
def ts_rate_non_negative(t: Tables) -> DataFrame:
    total = F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("value")
    points = metrics.tumbling(t["b_metrics"], "1 hour", ["measurement"], [total]).drop("window_end")
    return metrics.rate(points, ["measurement"])


@query
def ts_downsample_hourly(t: Tables) -> DataFrame:
    return metrics.downsample(t["b_metrics"])


@query
def ts_failure_alerts(t: Tables) -> DataFrame:
    return metrics.failure_alerts(t["b_metrics"], F.col("measurement") == "app.error")


@query
def ts_latency_alerts(t: Tables) -> DataFrame:
    return _six_places(metrics.latency_alerts(t["b_metrics"]))


@query
def ts_moving_alerts(t: Tables) -> DataFrame:
    """Days whose latency is far over the mean of the seven days before, from exact percentiles per day."""
    daily = t["b_metrics"].withColumn("window_start", F.window("ts", "1 day")["start"])
    levels = metrics.percentiles(daily, ["measurement", "window_start"], at=(0.95, 0.99))
    return _six_places(metrics.moving_alerts(levels, ["measurement"]))


def _within_bounds(t: Tables, stored: DataFrame, every: str) -> DataFrame:
    """Each merged window with its exact sample count, and whether its quantiles and distinct count keep their bounds."""
    names = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    read = sketches.read_sketches(stored, names)
    raw = t["b_metrics"].withColumn("window_start", F.window("ts", every)["start"])
    joined = raw.join(read.select("window_start", "measurement", *names, "distinct_keys", "samples"), ["window_start", "measurement"])
    value, share = F.col("value"), sketches.RANK_ERROR
    counts = [F.first("samples").alias("samples"), F.first("distinct_keys").alias("_distinct"), F.count("value").alias("_n"), F.count_distinct("event_id").alias("_events")]
    for name in names:
        counts += [F.count_if(value < F.col(name)).alias(f"_below_{name}"), F.count_if(value <= F.col(name)).alias(f"_upto_{name}")]
    found = joined.groupBy("window_start", "measurement").agg(*counts)
    within = F.lit(True)
    for name, at in names.items():
        within = within & (F.col(f"_below_{name}") <= (at + share) * F.col("_n") + 1) & (F.col(f"_upto_{name}") >= (at - share) * F.col("_n") - 1)
    near = F.abs(F.col("_distinct") - F.col("_events")) <= 4 * sketches.DISTINCT_ERROR * F.col("_events") + 1
    return found.select(F.lit(every).alias("every"), "window_start", "measurement", "samples", within.alias("within"), near.alias("distinct_within"))


@query
def ts_sketch_rollup(t: Tables) -> DataFrame:
    """Sketches of five minutes, stored; hours merged from them and days from the hours, against exact ranks."""
    stored = stage(sketches.window_sketches(t["b_metrics"], "5 minutes", ["measurement"], "event_id"), "sketches")
    hours = stage(sketches.merged(stored, "1 hour", ["measurement"]), "sketches")
    days = sketches.merged(hours, "1 day", ["measurement"])
    return _within_bounds(t, hours, "1 hour").unionByName(_within_bounds(t, days, "1 day"))


@query
def ts_heartbeat_gaps(t: Tables) -> DataFrame:
    return metrics.heartbeat_gaps(t["b_metrics"], ["measurement"])


# ---------------------------------------------------------------- streams


EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def _run_stream(t: Tables, build: Callable[[DataFrame], DataFrame], whole: bool = False) -> DataFrame:
    """The rows a stream over the events appends; `whole` also closes what is open when all events are read."""
    # a pattern, because the table may be one file, and a stream's plain path must be a folder
    source = flows.file_stream(t.spark, f"{t.folder}/events.parque[t]", EVENT_SCHEMA)
    out, offsets, end = (new_folder(t.spark, n) for n in ("stream", "offsets", "closing"))
    if whole:
        source = source.unionByName(flows.closing_stream(t.spark, end, EVENT_SCHEMA))
    stream = build(source)
    flows.run_available(stream, out, offsets)
    if whole:
        last = t["events"].agg(F.max("ts").cast("timestamp")).first()[0]
        flows.close(t.spark, end, EVENT_SCHEMA, "ts", F.lit(last))
        flows.run_available(stream, out, offsets)
    return readers.read_path(t.spark, out, schema=stream.schema)


@query
def stream_sessions(t: Tables) -> DataFrame:
    return _run_stream(t, lambda s: flows.session_totals(s, "user_id", "ts"), whole=True)


@query
def stream_tumbling_agg(t: Tables) -> DataFrame:
    return _run_stream(t, lambda s: flows.window_totals(s, "5 minutes", ["event_type"]), whole=True)


@query
def stream_sketch_rollup(t: Tables) -> DataFrame:
    """Sketches of five minutes that a stream appends, merged into days by batch."""
    def build(events: DataFrame) -> DataFrame:
        samples = events.withColumn("measurement", F.concat(F.lit("app."), "event_type")).withWatermark("ts", flows.LATENESS)
        return sketches.window_sketches(samples, "5 minutes", ["measurement"], "event_id")

    stored = _run_stream(t, build, whole=True)
    return _within_bounds(t, sketches.merged(stored, "1 day", ["measurement"]), "1 day")


@query
def stream_dedup(t: Tables) -> DataFrame:
    keep = ["event_id", "ts", "user_id"]
    return _run_stream(t, lambda s: flows.drop_repeats(s.select(*keep).unionAll(s.select(*keep)), ["event_id"]))


#: Files the log lines are cut into for a stream; a record may be cut anywhere.
CUTS = 4


def _read_lines(t: Tables) -> DataFrame:
    """Log lines with the time they were read, which a line takes from the event it comes from."""
    times_read = t["events"].select((F.col("event_id") * 4).alias("_first"), F.col("ts").cast("timestamp").alias("read_at"))
    lines = t["log_lines"].withColumn("_first", F.col("line_no") - F.col("line_no") % 4)
    return lines.join(times_read, "_first").select("path", "line_no", "line", "read_at")


def _line_streams(t: Tables) -> Iterator[tuple[DataFrame, T.StructType]]:
    """The stream of the lines' folder, each time one more part of the lines is there."""
    lines = _read_lines(t)
    for folder in log_records.cut(lines, F.col("line_no"), CUTS):
        yield flows.file_stream(t.spark, folder, lines.schema), lines.schema


@query
def stream_log_lines(t: Tables) -> DataFrame:
    out, offsets = new_folder(t.spark, "stream"), new_folder(t.spark, "offsets")
    for source, _ in _line_streams(t):
        stream = log_records.number_lines(source)
        flows.run_available(stream, out, offsets)
    return readers.read_path(t.spark, out, schema=stream.schema)


@query
def stream_log_records(t: Tables) -> DataFrame:
    out, offsets, end = (new_folder(t.spark, n) for n in ("stream", "offsets", "closing"))
    for source, schema in _line_streams(t):
        if not files.exists(t.spark, end):
            closing = flows.closing_stream(t.spark, end, schema)
        stream = log_records.gather_records(source.unionByName(closing), flows.LATENESS)
        flows.run_available(stream, out, offsets)
    last = t["events"].agg(F.max("ts").cast("timestamp")).first()[0]
    flows.close(t.spark, end, schema, "read_at", F.lit(last))
    flows.run_available(stream, out, offsets)
    return readers.read_path(t.spark, out, schema=stream.schema)


@query
def stream_log_routes(t: Tables) -> DataFrame:
    """Fields and classes of the lines of a stream; lines that no pattern matches have a sink of their own."""
    out, offsets = new_folder(t.spark, "routes"), new_folder(t.spark, "offsets")
    for source, _ in _line_streams(t):
        stream = log_records.routed(source.drop("read_at"))
        log_records.run_routed(stream, out, offsets)
    parts = [log_records.read_route(t.spark, out, r, stream.schema).withColumn("route", F.lit(r)) for r in (log_records.PARSED, log_records.FAILED)]
    return parts[0].unionByName(parts[1]).withColumn("tags", F.array_join("tags", ","))


# ---------------------------------------------------------------- silver


def _silver(t: Tables, name: str) -> DataFrame:
    """A silver table as later tables read it: written once, then read from its path."""
    key = f"silver_{name}"
    if key not in t.made:
        t.made[key] = stage(SILVER[name](t), key)
    return t.made[key]


SILVER: dict[str, Query] = {
    "brands": lambda t: silver.brands(t["r_brands"]),
    "categories": lambda t: silver.categories(t["r_categories"]),
    "customers": lambda t: silver.customers(t["r_users"], as_of(), _raw_spend(t)),
    "employees": lambda t: silver.employees(t["r_employees"], "shop.example"),
    "sub_products": lambda t: silver.sub_products(t["r_sub_products"]),
    "products": lambda t: silver.products(t["r_products"], _silver(t, "sub_products"), PHOTOS),
    "subsidiaries": lambda t: silver.subsidiaries(t["r_subsidiaries"]),
    "program_sales": lambda t: silver.program_sales(t["r_program_sales"]),
    "carts_base": lambda t: silver.carts_base(t["r_carts"]),
    "cart_items": lambda t: silver.cart_items(t["r_cart_items"], t["r_products"], _silver(t, "carts_base")),
    "carts": lambda t: silver.carts(_silver(t, "carts_base"), _silver(t, "cart_items"), F.lit("2023-12-31").cast("date")),
    "orders_base": lambda t: silver.orders_base(t["r_orders"], t["addresses"]),
    "order_items": lambda t: silver.order_items(
        t["r_order_items"], _silver(t, "products"), _silver(t, "subsidiaries"), _silver(t, "orders_base"),
        _silver(t, "program_sales"),
    ),
    # order items for orders, and orders for payments, are read once and not written first
    "orders": lambda t: silver.orders(_silver(t, "orders_base"), SILVER["order_items"](t)),
    "payments": lambda t: silver.payments(SILVER["orders"](t), t["r_payments"], as_of()),
    "reviews": lambda t: silver.reviews(_silver(t, "order_items"), _silver(t, "orders"), as_of()),
    "product_sales": lambda t: silver.product_sales(_silver(t, "order_items")),
    "product_scores": lambda t: silver.product_scores(_silver(t, "reviews")),
    "behaviors": lambda t: silver.behaviors(t["r_user_behaviors"], t["r_products"], as_of()),
}


def _raw_spend(t: Tables) -> DataFrame:
    """Spending per account in the scale of the rank limits."""
    return t["b_orders"].select(
        text.account_id(F.concat(F.lit("KH"), F.col("acc_id"))).alias("acc_id"), (F.col("total_amount") * 100).alias("total_amount")
    )


def _register_silver(name: str) -> None:
    QUERIES[f"silver_{name}"] = SILVER[name]


for _name in SILVER:
    if not _name.endswith("_base"):
        _register_silver(_name)


# ---------------------------------------------------------------- gold


@query
def gold_brand_performance(t: Tables) -> DataFrame:
    return gold.brand_performance(t["b_items"], t["b_products"], t["b_brands"], t["b_orders"])


@query
def gold_brand_reviewed(t: Tables) -> DataFrame:
    return gold.brand_reviewed(t["b_products"], t["b_reviews"], t["b_brands"])


@query
def gold_campaign_performance(t: Tables) -> DataFrame:
    sold = t["b_items"].select("product_id", "sale_id").filter(F.col("sale_id").isNotNull()).distinct()
    return gold.campaign_performance(t["b_program_sales"], sold, t["b_items"], t["b_orders"])


@query
def gold_category_metrix(t: Tables) -> DataFrame:
    dense = money.density(F.col("product_weight_g"), F.col("product_volume_cm3"))
    return gold.category_metrix(t["b_products"].withColumn("product_density_g_cm3", dense), t["b_categories"])


@query
def gold_category_performance(t: Tables) -> DataFrame:
    return gold.category_performance(t["b_products"], t["b_categories"], t["b_reviews"], t["b_items"])


@query
def gold_category_performance_exact(t: Tables) -> DataFrame:
    return gold.category_performance(t["b_products"], t["b_categories"], t["b_reviews"], t["b_items"], exact=True)


@query
def gold_category_status(t: Tables) -> DataFrame:
    return gold.category_status(t["b_products"], t["b_categories"])


@query
def gold_customer_360(t: Tables) -> DataFrame:
    return gold.customer_360(t["b_customers"], t["b_orders"], t["b_items"])


@query
def gold_customer_reviews(t: Tables) -> DataFrame:
    return gold.customer_reviews(t["b_orders"], t["b_reviews"])


@query
def gold_customer_rfm(t: Tables) -> DataFrame:
    return gold.customer_rfm(gold_customer_360(t), gold_customer_reviews(t))


@query
def gold_customer_top_city(t: Tables) -> DataFrame:
    return gold.customer_top_city(t["b_customers"])


@query
def gold_customer_top_district_danang(t: Tables) -> DataFrame:
    return gold.customer_top_district(t["b_customers"], "NATION_1")


@query
def gold_customer_top_district_hanoi(t: Tables) -> DataFrame:
    return gold.customer_top_district(t["b_customers"], "NATION_2")


@query
def gold_customer_top_district_hcm(t: Tables) -> DataFrame:
    return gold.customer_top_district(t["b_customers"], "NATION_3")


@query
def gold_order_360(t: Tables) -> DataFrame:
    return gold.order_360(t["b_orders"], t["b_items"], t["b_products"], t["b_reviews"])


@query
def gold_order_performance(t: Tables) -> DataFrame:
    return gold.order_performance(t["b_orders"])


@query
def gold_payments_analysis(t: Tables) -> DataFrame:
    return gold.payments_analysis(t["b_payments"], t["b_orders"], t["b_items"])


@query
def gold_product_performance(t: Tables) -> DataFrame:
    reviews = t.stored("b_reviews")
    scores = silver.product_scores(reviews)
    return gold.product_performance(t["b_products"], t["b_categories"], scores, reviews, t["b_items"])


@query
def gold_product_performance_exact(t: Tables) -> DataFrame:
    reviews = t.stored("b_reviews")
    scores = silver.product_scores(reviews)
    return gold.product_performance(t["b_products"], t["b_categories"], scores, reviews, t["b_items"], exact=True)


@query
def gold_shipping_city_district_performance(t: Tables) -> DataFrame:
    return gold.shipping_city_district_performance(t["b_orders"])


@query
def gold_subsidiary_performance(t: Tables) -> DataFrame:
    return gold.subsidiary_performance(t["b_subsidiaries"], t["b_items"], t["b_orders"])


@query
def gold_subsidiary_shipping_performance(t: Tables) -> DataFrame:
    return gold.subsidiary_shipping_performance(t["b_numbered_items"])


@query
def gold_subsidiary_shipping_performance_exact(t: Tables) -> DataFrame:
    return gold.subsidiary_shipping_performance(t["b_items"], exact=True)


# ---------------------------------------------------------------- quality, metadata, layers


def _flat(report: DataFrame) -> DataFrame:
    """Maps and arrays as text, so that every engine can compare them."""
    details = F.array_sort(F.transform(F.map_entries("null_details"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return report.withColumns(
        {
            "null_details": F.array_join(details, ","),
            "error_messages": F.array_join("error_messages", ","),
            "warning_messages": F.array_join("warning_messages", ","),
        }
    )


@query
def dq_bronze_report(t: Tables) -> DataFrame:
    return _flat(quality.bronze_report(t["r_users"]))


@query
def dq_incremental_profile(t: Tables) -> DataFrame:
    """A profile that is extended by the lines of one return flag after the other, and by the first ones a second time."""
    rows = t["lineitem"].drop("l_orderkey", "l_extendedprice", "l_partkey", "l_suppkey", "l_shipdate")
    rows = rows.withColumn("l_tax", F.when(F.col("l_tax") != 0.03, F.col("l_tax")))
    base = new_folder(t.spark, "profile")
    flags = [r[0] for r in rows.select("l_returnflag").distinct().orderBy("l_returnflag").collect()]
    for flag in [*flags, flags[0]]:
        # the flag itself is left out, so that rows occur again in several parts
        found = quality.extended_profile(rows.where(F.col("l_returnflag") == flag).drop("l_returnflag"), base, flag)
    return found.select("row_count", "duplicate_count", F.col("null_details")["l_tax"].alias("null_tax"), F.col("null_details")["l_discount"].alias("null_discount"))


@query
def dq_silver_report(t: Tables) -> DataFrame:
    return _flat(quality.silver_report(t["documents"], wide=True))


def _steady(record: DataFrame) -> DataFrame:
    """A metadata record without what differs between runs: times, durations and paths."""
    columns = F.array_join("columns", ",")
    moving = ("generated_at", "processing_duration", "object_path", "target_table")
    return record.withColumn("columns", columns).drop(*moving)


@query
def meta_bronze(t: Tables) -> DataFrame:
    employees = t["r_employees"]
    report = quality.bronze_report(employees)
    return _steady(_flat(records.bronze_record(report, employees.columns, "employees", "bronze", "/staging/employees")))


@query
def meta_silver(t: Tables) -> DataFrame:
    orders = t["b_orders"]
    report = quality.silver_report(orders)
    record = records.silver_record(report, orders.columns, "orders", "silver", "/silver/orders", duration=1.5)
    return _steady(_flat(record))


@query
def meta_gold(t: Tables) -> DataFrame:
    written = gold_order_performance(t)
    return _steady(records.gold_record(written, "order_performance", "gold.order_performance", "/gold/order_performance"))


@query
def meta_as_json(t: Tables) -> DataFrame:
    written = gold_order_performance(t)
    record = records.gold_record(written, "order_performance", "gold.order_performance", "/gold/order_performance")
    return records.as_json(record.drop("generated_at"))


@query
def layer_bronze(t: Tables) -> DataFrame:
    done = layers.run_bronze(t["r_employees"], new_folder(t.spark, "bronze"), "bronze", "employees")
    return _steady(_flat(done.record))


@query
def layer_silver(t: Tables) -> DataFrame:
    done = layers.run_silver(
        t["r_brands"], silver.brands, new_folder(t.spark, "brands"), CATALOG, SCHEMA, _table("brands"),
        table_path=new_folder(t.spark, "brands-table"),
    )
    return _steady(_flat(done.record)).drop("dataset")


@query
def layer_gold(t: Tables) -> DataFrame:
    done = layers.run_gold(
        t.spark, lambda: gold_order_performance(t), "order_performance", CATALOG, SCHEMA,
        new_folder(t.spark, "order_performance"), _table("order_performance"),
    )
    return _steady(done.record)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that engines with other decimal widths print the same values."""
    casts = {f.name: F.col(f.name).cast("double") for f in df.schema if isinstance(f.dataType, T.DecimalType)}
    return df.withColumns(casts) if casts else df


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return plain(QUERIES[name](Tables(spark, folder)))
