"""Silver tables: one function per table, raw frames in, typed frame with a fixed column order out.

Nothing is random. A value that has no source column is derived from a hash of the row's key, so a
rerun, a retried task or a second action gives the same rows. Tables that depend on each other are
built in two steps (`*_base` first), which makes the order of the tables acyclic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import hashing, money, rules, text, times
from ..operators import cleaning, relations
from ..operators.behaviour import rebuild_sessions
from ..operators.keys import bucket_lookup, dense_keys, number_rows, round_robin
from ..operators.ordered import item_sequence, latest_per_key
from ..session import stage

LINEAGE = ("ingestion_time", "source_file")
DAY = 86400

# First names with a known gender.
MALE_NAMES = ("An", "Bảo", "Đức", "Huy", "Khang", "Long", "Tú", "Quân", "Tuấn", "Hải", "Hùng", "Hoàng")
FEMALE_NAMES = (
    "Anh", "Chi", "Linh", "Trang", "Hương", "Ngân", "Vy", "Thảo", "Nhi", "Hường", "Ly", "Như", "Nhã",
    "Ngọc", "Thy", "My",
)

# Distance in hundredths of a kilometre per shipping zone, lowest and highest.
ZONE_RANGES = {1: (300, 2000), 2: (1000, 3500), 3: (5000, 120000)}
SALE_SHARE = 70


def _parsed(*names: str) -> dict[str, Column]:
    return {n: times.parse_time(F.col(n)) for n in names}


def _later(start: Column, low: int, high: int, *key: Column) -> Column:
    """A time that follows another by a hashed number of seconds."""
    return times.shift(start, seconds=hashing.offset(low, high, *key))


def _days_later(start: Column, days: int, *key: Column) -> Column:
    return times.shift(start, days=hashing.bucket(days, *key))


def brands(raw: DataFrame) -> DataFrame:
    cleaned = raw.select(
        "brand_id",
        text.title(F.col("brand_name")).alias("brand_name"),
        text.capitals(F.col("brand_country")).alias("brand_country"),
        times.parse_time(F.col("created_at")).alias("created_at"),
        *LINEAGE,
    ).na.fill("UNKNOWN", ["brand_name", "brand_country"])
    newest = [F.desc("created_at"), F.asc("brand_name"), F.asc("brand_country"), *map(F.asc, LINEAGE)]
    kept = latest_per_key(cleaned, ["brand_id"], newest)
    dated = kept.withColumn("updated_at", _days_later(F.col("created_at"), 180, F.col("brand_id")))
    return dated.select("brand_id", "brand_name", "brand_country", "created_at", "updated_at", *LINEAGE)


def categories(raw: DataFrame) -> DataFrame:
    cleaned = raw.select(
        F.trim("prcs_id").alias("cate_id"),
        text.squeeze(F.col("prcs_name")).alias("cate_name"),
        times.parse_time(F.col("created_at")).alias("created_at"),
        times.parse_time(F.col("updated_at")).alias("updated_at"),
        *LINEAGE,
    )
    newest = [F.desc("updated_at"), F.desc("created_at"), F.asc("cate_name"), *map(F.asc, LINEAGE)]
    return latest_per_key(cleaning.require(cleaned, ["cate_id", "cate_name"]), ["cate_id"], newest)


def customers(users: DataFrame, as_of: Column, orders: DataFrame | None = None) -> DataFrame:
    """`orders` may be missing on a first run; then everybody has the lowest rank."""
    first, last = text.last_word(F.col("user_name")), text.without_last_word(F.col("user_name"))
    place = F.split("user_address", ", ")
    known = users.withColumns(
        {
            "acc_id": text.account_id(F.col("user_id")),
            "_identity": text.identity(F.col("user_email"), F.col("user_phone")),
            "created_at": times.parse_time(F.col("user_createdat")),
            "birth_date": times.parse_day(F.col("user_born")),
            "first_name": first,
            "last_name": last,
            "district": F.get(place, F.lit(0)),
            "city": F.get(place, F.lit(1)),
        }
    )
    numbered = dense_keys(known, ["_identity"], "_cus_seq")
    if orders is None:
        spent = numbered.withColumn("_spent", F.lit(0))
    else:
        totals = orders.groupBy("acc_id").agg(F.sum("total_amount").alias("_spent"))
        spent = numbered.join(totals, "acc_id", "left")
    key = F.col("user_id")
    return spent.select(
        "acc_id",
        text.sequence_id(F.col("_cus_seq"), "CUS", 6).alias("cus_id"),
        "last_name",
        "first_name",
        text.customer_email(F.col("first_name"), F.col("last_name"), hashing.bucket(999, key)).alias("email"),
        text.phone(F.col("user_phone"), missing="UNKNOWN").alias("phone_number"),
        rules.lookup_gender(F.col("first_name"), FEMALE_NAMES, MALE_NAMES).alias("gender"),
        "birth_date",
        times.age_years(F.col("birth_date"), as_of).alias("age"),
        "district",
        "city",
        text.account_name(F.col("first_name"), F.col("acc_id")).alias("account_name"),
        rules.spend_rank(F.col("_spent")).alias("customer_rank"),
        F.lit(True).alias("is_active"),
        times.days_since(F.col("created_at"), as_of).alias("account_age_days"),
        "created_at",
        _days_later(F.col("created_at"), 365, key).alias("updated_at"),
        *LINEAGE,
    )


def employees(raw: DataFrame, domain: str) -> DataFrame:
    first, last = text.last_word(F.col("emp_name")), text.without_last_word(F.col("emp_name"))
    shaped = raw.withColumns({"first_name": first, "last_name": last})
    typed = shaped.select(
        F.col("emp_id").alias("employee_id"),
        "last_name",
        "first_name",
        rules.recode(F.col("emp_gender"), rules.GENDERS, "Male").alias("gender"),
        text.phone(F.col("emp_phone"), width=9).alias("phone"),
        text.company_email(F.col("first_name"), F.col("last_name"), F.col("emp_id"), domain).alias("email"),
        F.col("emp_born").alias("born"),
        F.col("emp_address").alias("address"),
        _days_later(F.col("ingestion_time"), 365, F.col("emp_id")).cast("date").alias("recruited_at"),
        F.col("emp_account").alias("username"),
        F.col("emp_password").alias("password"),
        F.col("emp_role").alias("role"),
        F.col("sub_id").alias("subsidiary_id"),
        *LINEAGE,
    )
    return cleaning.require(typed, ["employee_id", "first_name", "gender", "phone", "role", "subsidiary_id"])


def products(raw: DataFrame, stock: DataFrame, photo_base: str) -> DataFrame:
    """`stock` is the silver sub_products table; photos are linked below `photo_base`."""
    quantity = stock.groupBy("product_id").agg(F.sum("quantity").alias("_stock"))
    weight = F.col("product_weight_g")
    sides = [F.col(f"product_{s}_cm") for s in ("length", "height", "width")]
    key = F.col("product_id")
    shaped = raw.join(quantity, "product_id", "left").withColumns(
        {
            "product_name": text.numbered_name(F.col("product_name"), "Product", "product", 2),
            "product_version": text.numbered_name(F.col("product_specs"), "Version", "vs"),
            "product_volume_cm3": money.volume(*sides),
            **_parsed("created_at", "updated_at"),
        }
    )
    return shaped.select(
        "product_id",
        "product_version",
        "brand_id",
        F.col("prcs_id").alias("category_id"),
        "product_name",
        text.squeeze(F.col("product_description")).alias("product_description"),
        rules.stock_status(F.col("_stock")).alias("product_status"),
        F.col("product_listprice").cast(money.MONEY).alias("product_listprice"),
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        "product_volume_cm3",
        money.density(weight, F.col("product_volume_cm3")).alias("product_density_g_cm3"),
        text.photo_link(photo_base, key, F.col("product_version")).alias("product_photos_link"),
        F.col("product_photos_qty").cast("int").alias("product_photos_qty"),
        "created_at",
        "updated_at",
        *LINEAGE,
    )


def subsidiaries(raw: DataFrame) -> DataFrame:
    return raw.select(
        "sub_id",
        text.numbered_name(F.col("sub_name"), "Subsidiary", "subsi").alias("sub_name"),
        text.phone(F.col("sub_phone")).alias("phone_number"),
        "establishment_date",
        "sub_street",
        "sub_district",
        "sub_city",
        F.to_date("created_at").alias("created_at"),
        F.to_date("updated_at").alias("updated_at"),
        *LINEAGE,
    )


def sub_products(raw: DataFrame) -> DataFrame:
    renamed = cleaning.reshape(
        raw,
        rename={"SUB_ID": "subsidiary_id", "PRODUCT_ID": "product_id", "QUANTITY": "quantity"},
        keep=["subsidiary_id", "product_id", "quantity", *LINEAGE, "created_at", "updated_at"],
    )
    return cleaning.unbroken(renamed, cleaning.inventory_rules())


def program_sales(raw: DataFrame) -> DataFrame:
    typed = raw.select(
        "sale_id",
        text.campaign_name(F.col("sale_name")).alias("sale_name"),
        F.col("discount_value").cast("decimal(18,2)").alias("discount_value"),
        "min_ordervalue",
        F.to_date("sale_startdate").alias("start_date"),
        F.to_date("sale_enddate").alias("end_date"),
        F.col("sale_createdat").alias("created_at"),
        F.col("sale_updateat").alias("updated_at"),
        *LINEAGE,
    )
    return cleaning.unbroken(typed, cleaning.campaign_rules())


def product_sales(order_items: DataFrame) -> DataFrame:
    """Which product was sold in which campaign, dated before the first such order."""
    first = (
        order_items.filter(F.col("sale_id").isNotNull())
        .groupBy("product_id", "sale_id")
        .agg(F.min("created_at").alias("_first"))
    )
    key = (F.col("product_id"), F.col("sale_id"))
    days = hashing.offset(7, 90, F.lit("created"), *key)
    start = times.shift(F.col("_first"), days=-days)
    dated = first.withColumn("created_at", start).withColumn(
        "updated_at",
        times.shift(F.col("created_at"), seconds=hashing.offset(0, days * DAY, F.lit("updated"), *key)),
    )
    return dated.select("product_id", "sale_id", "created_at", "updated_at")


def carts_base(raw: DataFrame) -> DataFrame:
    """Carts with their ids and dates, before totals. A cart starts somewhere in 2023."""
    typed = raw.withColumns(
        {
            "acc_id": text.account_id(F.col("user_id")),
            "cart_id": text.padded_id(F.col("cart_id"), "CA", 6),
        }
    )
    new_year = F.lit("2023-01-01 00:00:00").cast("timestamp")
    started = typed.withColumn("created_at", _later(new_year, 0, 365 * DAY - 1, F.col("cart_id")))
    moved = _later(F.col("created_at"), 0, 30 * DAY - 1, F.lit("updated"), F.col("cart_id"))
    return started.select("cart_id", "acc_id", "created_at", moved.alias("updated_at"), *LINEAGE)


def cart_items(raw: DataFrame, products: DataFrame, carts: DataFrame) -> DataFrame:
    """`carts` is carts_base; items of unknown products or carts are left out."""
    named = raw.withColumn("cart_id", text.padded_id(F.col("cart_id"), "CA", 6))
    order = ["product_id", "created_at", "updated_at", *LINEAGE]
    numbered = item_sequence(named, "cart_id", order, "item_sequence")
    prices = products.select("product_id", F.col("product_listprice").cast(money.MONEY).alias("list_price"))
    starts = carts.select(F.col("cart_id").alias("_cart"), F.col("created_at").alias("_start"))
    priced = numbered.drop("created_at", "updated_at").join(prices, "product_id")
    dated = priced.join(starts, F.col("cart_id") == F.col("_cart"))
    key = (F.col("cart_id"), F.col("item_sequence"))
    enriched = dated.withColumns(
        {
            "quantity": hashing.offset(1, 19, F.lit("quantity"), *key).cast("int"),
            "added_at": _later(F.col("_start"), 0, DAY - 1, F.lit("added"), *key),
        }
    )
    return enriched.select(
        "cart_id",
        "item_sequence",
        "product_id",
        "quantity",
        "list_price",
        money.line_total(F.col("quantity"), F.col("list_price")).alias("item_total_amount"),
        "added_at",
        _later(F.col("added_at"), 0, 7 * DAY - 1, F.lit("updated"), *key).alias("updated_at"),
        *LINEAGE,
    )


def carts(base: DataFrame, items: DataFrame, as_of: Column) -> DataFrame:
    # distinct products per cart in two plain aggregates: no expand, and partial results both times
    per_product = items.groupBy("cart_id", "product_id").agg(F.sum("item_total_amount").alias("_amount"))
    totalled = relations.roll_up(
        base,
        per_product,
        "cart_id",
        {"total_items": F.count("product_id"), "total_amount": F.sum("_amount").cast(money.MONEY)},
        {"total_items": 0, "total_amount": 0},
    )
    status = rules.cart_status(F.col("updated_at"), as_of, F.lit("status"), F.col("cart_id"))
    return totalled.select(
        "cart_id", "acc_id", status.alias("cart_status"), "total_items", "total_amount", "created_at",
        "updated_at", *LINEAGE,
    )


def orders_base(raw: DataFrame, addresses: DataFrame) -> DataFrame:
    """Orders with status, account and address, before totals.

    `addresses` has slot, target_street, target_district, target_city and is dealt out in turn.
    """
    known = cleaning.require(raw.withColumn("acc_id", text.account_id(F.trim("user_id"))), ["acc_id"])
    # what the table doesn't keep isn't dealt out either
    kept = known.drop("total_order", "payment_id", "shipping_address", "user_id")
    # dealing out reads its input twice, so texts are read and checked once before, and times are parsed afterwards
    held = stage(kept, "kept")
    dealt = round_robin(held, ["order_id"], addresses, "slot")
    typed = dealt.withColumns(
        {
            "estimated_delivery_date": times.parse_time(F.col("estimated_delivery_at")),
            **_parsed("created_at", "confirmed_at", "delivered_at", "updated_at"),
        }
    )
    status = rules.order_status(F.col("confirmed_at"), F.col("delivered_at"))
    return typed.withColumn("order_status", status).drop("estimated_delivery_at", "slot")


def order_items(
    raw: DataFrame,
    products: DataFrame,
    subsidiaries: DataFrame,
    orders: DataFrame,
    campaigns: DataFrame,
) -> DataFrame:
    """`orders` is orders_base, `campaigns` the silver program_sales table."""
    lines = raw.select("order_id", "product_id", F.col("product_quantity").alias("quantity"), *LINEAGE)
    # products are joined before the rows are numbered and heads right after, so lines move twice: by product, by order
    newest = [F.desc("product_version"), F.desc("updated_at"), F.asc("product_listprice")]
    current = latest_per_key(products, ["product_id"], newest).select(
        "product_id",
        F.col("product_listprice").cast(money.MONEY).alias("list_price"),
        F.col("product_weight_g").alias("_weight"),
        F.col("product_volume_cm3").alias("_volume"),
    )
    heads = orders.select(
        "order_id",
        "created_at",
        F.col("target_city").alias("_city"),
        F.col("target_district").alias("_district"),
    )
    known = lines.join(current, "product_id", "left")
    order = ["product_id", "quantity", *LINEAGE]
    numbered = item_sequence(known, "order_id", order, "order_item_id", counted=lines).join(heads, "order_id", "left")

    branches = subsidiaries.select(
        F.col("sub_id").alias("subsidiary_id"),
        F.col("sub_city").alias("_branch_city"),
        F.col("sub_district").alias("_branch_district"),
    )
    offers = campaigns.select("sale_id", F.col("discount_value").alias("_discount"))
    key = ["order_id", "order_item_id"]
    placed = bucket_lookup(numbered, key, branches, ["subsidiary_id"], salt="branch")
    joined = bucket_lookup(placed, key, offers, ["sale_id"], salt="campaign")

    ids = [F.col(k) for k in key]
    on_sale = hashing.bucket(100, F.lit("sale"), *ids) < SALE_SHARE
    zone = rules.shipping_zone(F.col("_branch_city"), F.col("_branch_district"), F.col("_city"), F.col("_district"))
    reach = {
        z: (hashing.offset(low, high, F.lit("km"), *ids) / 100).cast(money.MONEY)
        for z, (low, high) in ZONE_RANGES.items()
    }
    facts = joined.withColumns(
        {
            "discount_rate": F.when(on_sale, F.coalesce("_discount", F.lit(0))).otherwise(0).cast("decimal(18,2)"),
            "sale_id": F.when(on_sale, F.col("sale_id")),
            "shipping_distance_km": F.when(zone == 1, reach[1]).when(zone == 2, reach[2]).otherwise(reach[3]),
        }
    ).withColumn("sale_price", money.sale_price(F.col("list_price"), F.col("discount_rate")))
    return facts.select(
        "order_id",
        "order_item_id",
        "product_id",
        "subsidiary_id",
        "sale_id",
        "quantity",
        "list_price",
        "discount_rate",
        "sale_price",
        money.line_total(F.col("quantity"), F.col("sale_price")).alias("total_price"),
        money.line_total(F.col("quantity"), F.col("_weight")).alias("item_total_weight_g"),
        "shipping_distance_km",
        money.shipping_fee(F.col("_weight"), F.col("_volume"), F.col("shipping_distance_km")).alias("shipping_fee"),
        "created_at",
        _days_later(F.col("created_at"), 180, *ids).alias("updated_at"),
        *LINEAGE,
    )


def orders(base: DataFrame, items: DataFrame) -> DataFrame:
    totalled = relations.roll_up(
        base,
        items,
        "order_id",
        {
            "total_amount": F.sum("total_price").cast(money.MONEY),
            "total_shipfee": F.sum("shipping_fee").cast(money.MONEY),
        },
        {"total_amount": 0, "total_shipfee": 0},
    )
    key, sent = F.col("order_id"), F.col("order_status").isin("SHIPPED", "DELIVERED")
    # up to 30 % of the way from confirmation to the promised date, in whole seconds
    promised, confirmed = F.unix_timestamp("estimated_delivery_date"), F.unix_timestamp("confirmed_at")
    way = F.floor((promised - confirmed) * hashing.bucket(10000, key) * 3 / 100000)
    return cleaning.paid_orders(totalled).select(
        "order_id",
        "acc_id",
        "employee_id",
        "order_status",
        "total_amount",
        "total_shipfee",
        "target_street",
        "target_district",
        "target_city",
        "created_at",
        "confirmed_at",
        F.when(sent, times.shift(F.col("confirmed_at"), seconds=way)).alias("shipped_at"),
        "estimated_delivery_date",
        "delivered_at",
        F.when(
            F.col("order_status") == "CANCELLED", _later(F.col("created_at"), 0, 3 * DAY - 1, key)
        ).alias("cancel_date"),
        "updated_at",
        *LINEAGE,
    )


def payments(orders: DataFrame, raw: DataFrame, as_of: Column) -> DataFrame:
    """One payment per order; what the raw payment table knows is kept, the rest is filled."""
    known = raw.select(
        F.trim("payment_id").alias("payment_id"),
        times.parse_time(F.col("updated_at")).alias("_updated"),
        F.col("ingestion_time").alias("_ingested"),
        F.col("source_file").alias("_file"),
    )
    key, method, status = F.col("order_id"), F.col("payment_method"), F.col("payment_status")
    due = orders.select(
        F.concat(F.lit("PA"), text.digits(key, "OD")).alias("payment_id"),
        "order_id",
        "order_status",
        hashing.pick(rules.PAYMENT_METHODS, F.lit("method"), key).alias("payment_method"),
        (F.col("total_amount") + F.col("total_shipfee")).cast(money.MONEY).alias("payment_amount"),
        "delivered_at",
        "created_at",
    )
    joined = due.join(known, "payment_id", "left").withColumn(
        "payment_status", rules.payment_status(method, F.col("order_status"), F.lit("refund"), key)
    )
    online = (method != "COD") & status.isin("SUCCESS", "REFUNDED")
    paid = F.when(online, _later(F.col("created_at"), 60, 1799, F.lit("paid"), key)).when(
        (method == "COD") & (status == "SUCCESS"), F.col("delivered_at")
    )
    back = _later(F.col("paid_at"), 3600, 72 * 3600 - 1, F.lit("refunded"), key)
    return joined.withColumn("paid_at", paid).select(
        "payment_id",
        "order_id",
        "payment_method",
        "payment_status",
        "payment_amount",
        "paid_at",
        F.when(status == "REFUNDED", back).alias("refund_at"),
        "created_at",
        F.coalesce("_updated", "created_at").alias("updated_at"),
        F.coalesce("_ingested", as_of.cast("timestamp")).alias("ingestion_time"),
        F.coalesce("_file", F.lit("GENERATED_FROM_ORDERS")).alias("source_file"),
    )


def reviews(order_items: DataFrame, orders: DataFrame, as_of: Column) -> DataFrame:
    """One review per delivered item, numbered over the whole table."""
    delivered = orders.filter(F.col("delivered_at").isNotNull()).select("order_id", "delivered_at")
    items = order_items.select("order_id", "order_item_id", "product_id").join(delivered, "order_id")
    numbered = number_rows(items, ["order_id", "order_item_id"], "_review_no")
    key = (F.col("order_id"), F.col("order_item_id"))
    kind = hashing.weighted_choice(rules.COMMENT_WEIGHTS, F.lit("comment"), *key)
    score = hashing.weighted_choice(rules.SCORE_WEIGHTS, F.lit("score"), *key).cast("decimal(2,1)")
    rated = numbered.withColumns({"_kind": kind, "review_score": score})
    written = rated.withColumns(
        {
            "review_title": F.when(
                F.col("_kind").isin("NORMAL", "TITLE_ONLY"),
                F.concat(rules.sentiment(F.col("review_score")), F.lit(" experience")),
            ),
            "review_message": F.when(
                F.col("_kind").isin("NORMAL", "MESSAGE_ONLY"),
                F.concat(F.lit("Rated "), F.col("review_score").cast("string"), F.lit(" for "), F.col("product_id")),
            ),
            "created_at": _later(F.col("delivered_at"), DAY, 15 * DAY - 1, F.lit("created"), *key),
        }
    )
    answer = _later(F.col("created_at"), DAY, 5 * DAY - 1, F.lit("replied"), *key)
    replied = F.when(hashing.bucket(2, F.lit("reply"), *key) == 0, answer)
    flags = rules.presence_flags(F.col("review_title"), F.col("review_message"))
    feeling = rules.sentiment_flags(F.col("review_score"))
    return written.select(
        text.sequence_id(F.col("_review_no"), "RV", 6).alias("review_id"),
        "order_id",
        "product_id",
        hashing.weighted_choice(rules.REVIEW_STATUS_WEIGHTS, F.lit("status"), *key).alias("review_status"),
        "review_score",
        "review_title",
        "review_message",
        "created_at",
        replied.alias("replied_at"),
        replied.isNotNull().alias("has_reply"),
        *[c.alias(n) for n, c in {**flags, **feeling}.items()],
        as_of.cast("timestamp").alias("ingestion_time"),
        F.lit("generated_reviews").alias("source_file"),
    )


def product_scores(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("product_id").agg(
        F.count("review_id").alias("review_count"),
        money.ratio(F.sum("review_score"), F.count("review_score")).cast("float").alias("avg_rating"),
    )


def judged_behaviors(raw: DataFrame, products: DataFrame) -> DataFrame:
    """Typed and recoded events with the reasons why a row is not usable."""
    typed = raw.select(
        "event_id",
        text.account_id(F.col("user_id")).alias("acc_id"),
        times.parse_time(F.col("event_time")).alias("event_time"),
        rules.recode(F.col("event_type"), rules.EVENT_TYPES, "view").alias("event_type"),
        "product_id",
        rules.recode(F.col("device_type"), rules.DEVICES, "Desktop").alias("device_type"),
        F.col("timeon_page").alias("time_on_page_minutes"),
        *LINEAGE,
    )
    required = ["acc_id", "event_time", "event_type", "product_id"]
    return cleaning.with_reasons(typed, required, "product_id", products, "product_id", "product is unknown")


def _repaired_behaviors(valid: DataFrame, as_of: Column) -> DataFrame:
    return rebuild_sessions(valid).select(
        "acc_id",
        "session_id",
        "event_time",
        "event_type",
        "product_id",
        "device_type",
        "time_on_page_minutes",
        F.col("event_time").alias("created_at"),
        as_of.cast("timestamp").alias("updated_at"),
        *LINEAGE,
    )


def behaviors(raw: DataFrame, products: DataFrame, as_of: Column) -> DataFrame:
    return _repaired_behaviors(cleaning.valid_rows(judged_behaviors(raw, products)), as_of)


def behaviors_and_rejects(raw: DataFrame, products: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """The table, and the rows that didn't get into it with their reasons."""
    valid, bad = cleaning.split_valid(judged_behaviors(raw, products))
    return _repaired_behaviors(valid, as_of), bad
