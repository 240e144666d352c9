"""For each query, independent SQL that DuckDB runs on the given tables."""

from __future__ import annotations

from . import bindings
from .bindings import LINE_ORDER, TEXTS, names_in

# ---------------------------------------------------------------- SQL pieces


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


class Ratio(str):
    """A quotient as doubles that still knows its two sides."""

    top: str
    bottom: str


def _millionths(x: str) -> str:
    return f"CAST(replace(CAST(CAST({x} AS DECIMAL(38,6)) AS VARCHAR), '.', '') AS HUGEINT)"


def half_up(x: str, places: int = 2) -> str:
    """Round half away from zero: exactly, in whole numbers, where the two sides of a quotient are known."""
    scale = f"1{'0' * places}"
    if isinstance(x, Ratio):
        a, b = _millionths(x.top), _millionths(x.bottom)
        return (f"(CASE WHEN {b} <> 0 THEN sign({a}) * sign({b}) * ((abs({a}) * {scale} * 2 + abs({b})) // (abs({b}) * 2)) END"
                f" / {scale}.0::DOUBLE)")
    return f"floor(CAST({x} AS DOUBLE) * {scale}.0 + 0.5) / {scale}.0"


def ratio(a: str, b: str) -> Ratio:
    made = Ratio(f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))")
    made.top, made.bottom = a, b
    return made


def pct(a: str, b: str, places: int = 2) -> str:
    return half_up(ratio(f"({a}) * 100", b), places)


def h(*parts: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 15) AS BIGINT)"


def off(low: int, high: int | str, *parts: str) -> str:
    width = f"({high} - {low} + 1)" if isinstance(high, str) else str(high - low + 1)
    return f"({low} + {h(*parts)} % {width})"


def parse(x: str) -> str:
    return f"try_strptime({x}, '%m/%d/%Y %H:%M')"


def later(start: str, seconds: str) -> str:
    return f"({start} + to_seconds({seconds}))"


def days_on(start: str, days: str) -> str:
    return f"({start} + to_days(CAST({days} AS INTEGER)))"


def pad(x: str, width: int) -> str:
    return f"CASE WHEN length({x}) < {width} THEN lpad({x}, {width}, '0') ELSE {x} END"


def digits(x: str, after: str = "") -> str:
    return f"NULLIF(regexp_extract({x}, '{after}([0-9]+)', 1), '')"


def joined_id(prefix: str, x: str, width: int) -> str:
    """Text concatenation that is null when a part is null."""
    return f"('{prefix}' || ({pad(x, width)}))"


def weighted(options: list[tuple[str, int]], *parts: str) -> str:
    slot, edge, cases = f"{h(*parts)} % 10000", 0, ""
    for value, weight in options[:-1]:
        edge += weight * 100
        cases += f" WHEN {slot} < {edge} THEN {value}"
    return f"(CASE{cases} ELSE {options[-1][0]} END)"


def quoted(options: list[tuple[str, int]]) -> list[tuple[str, int]]:
    return [(f"'{v}'", w) for v, w in options]


def rank_of(spent: str) -> str:
    return (
        f"CASE WHEN {spent} >= 780000000 THEN 'VIP' WHEN {spent} >= 450000000 THEN 'DIAMOND' "
        f"WHEN {spent} >= 250000000 THEN 'PLATINUM' WHEN {spent} >= 120000000 THEN 'GOLD' "
        f"WHEN {spent} >= 50000000 THEN 'SILVER' ELSE 'COPPER' END"
    )


def plain_letters(x: str) -> str:
    return f"replace(strip_accents(lower({x})), 'đ', 'd')"


LINEAGE = "ingestion_time, source_file"
SENTIMENT = "CASE WHEN review_score >= 4.0 THEN 'Positive' WHEN review_score < 3.0 THEN 'Negative' ELSE 'Neutral' END"
DEVICE = """CASE WHEN lower(trim(device_type)) IN ('desktop', 'pc', 'computer') THEN 'Desktop'
    WHEN lower(trim(device_type)) IN ('mobile', 'phone', 'smartphone') THEN 'Mobile'
    WHEN lower(trim(device_type)) IN ('tablet', 'ipad') THEN 'Tablet' ELSE 'Desktop' END"""
EVENT = """CASE WHEN lower(trim(event_type)) IN ('view', 'page_view', 'product_view') THEN 'view'
    WHEN lower(trim(event_type)) IN ('click', 'button_click', 'link_click') THEN 'click'
    WHEN lower(trim(event_type)) IN ('search', 'query', 'search_query') THEN 'search'
    WHEN lower(trim(event_type)) IN ('add_to_cart', 'cart_add', 'add_cart') THEN 'add_to_cart'
    WHEN lower(trim(event_type)) IN ('remove_from_cart', 'cart_remove', 'remove_cart') THEN 'remove_from_cart'
    WHEN lower(trim(event_type)) IN ('checkout', 'begin_checkout') THEN 'checkout'
    WHEN lower(trim(event_type)) IN ('purchase', 'order', 'buy') THEN 'purchase'
    WHEN lower(trim(event_type)) IN ('wishlist', 'add_to_wishlist', 'save') THEN 'wishlist' ELSE 'view' END"""
ORDER_STATUS = (
    f"CASE WHEN {parse('delivered_at')} IS NOT NULL THEN 'DELIVERED' "
    f"WHEN {parse('confirmed_at')} IS NOT NULL THEN 'SHIPPED' ELSE 'PENDING' END"
)
METHODS = ["COD", "BANKING", "MOMO", "ZALOPAY", "VNPAY", "CREDIT_CARD"]
METHOD_LIST = "[" + ", ".join(f"'{m}'" for m in METHODS) + "]"
EVENT_WEIGHTS = [("view", 35), ("search", 20), ("click", 15), ("add_to_cart", 12), ("wishlist", 7), ("checkout", 5),
                 ("remove_from_cart", 3), ("purchase", 3)]
SCORES = [("5.0", 30), ("4.5", 20), ("4.0", 15), ("3.5", 10), ("3.0", 10), ("2.5", 5), ("2.0", 4), ("1.5", 3),
          ("1.0", 3)]
MALE = "'An', 'Bảo', 'Đức', 'Huy', 'Khang', 'Long', 'Tú', 'Quân', 'Tuấn', 'Hải', 'Hùng', 'Hoàng'"
FEMALE = ("'Anh', 'Chi', 'Linh', 'Trang', 'Hương', 'Ngân', 'Vy', 'Thảo', 'Nhi', 'Hường', 'Ly', 'Như', 'Nhã', "
          "'Ngọc', 'Thy', 'My'")
FIRST = "regexp_extract(user_name, '(\\S+)$', 1)"
LAST = "regexp_replace(user_name, '\\s*\\S+$', '')"
GENDER = f"CASE WHEN {FIRST} IN ({FEMALE}) THEN 'Female' WHEN {FIRST} IN ({MALE}) THEN 'Male' ELSE 'Unknown' END"


def payment_state(*key: str) -> str:
    half = weighted(quoted([("REFUNDED", 50), ("FAILED", 50)]), *key)
    return f"""CASE WHEN payment_method = 'COD' THEN CASE order_status WHEN 'DELIVERED' THEN 'SUCCESS'
            WHEN 'CANCELLED' THEN 'FAILED' ELSE 'PENDING' END
        WHEN order_status IN ('CONFIRMED', 'SHIPPED', 'DELIVERED') THEN 'SUCCESS'
        WHEN order_status = 'CANCELLED' THEN {half} ELSE 'PENDING' END"""


def cart_state(updated: str, day: str, *key: str) -> str:
    mix = weighted(quoted([("ACTIVE", 85), ("ABANDONED", 10), ("EXPIRED", 5)]), *key)
    return f"CASE WHEN datediff('day', CAST({updated} AS DATE), DATE '{day}') > 120 THEN 'EXPIRED' ELSE {mix} END"


# ---------------------------------------------------------------- intermediate tables

O: dict[str, str] = {
    "o_customers": f"""
        SELECT c.*, {rank_of('COALESCE(spent, 0)')} AS customer_rank
        FROM {{b_customers}} c LEFT JOIN (SELECT acc_id, sum(total_amount) * 100 AS spent FROM {{b_orders}} GROUP BY 1) s
        USING (acc_id)""",
    "o_reviews_b": f"SELECT *, {SENTIMENT} AS review_sentiment FROM {{b_reviews}}",
    "o_judged": f"""
        SELECT event_id, 'ACC' || ({pad(digits('user_id', 'KH'), 8)}) AS acc_id, {parse('event_time')} AS event_time,
               {EVENT} AS event_type, product_id, {DEVICE} AS device_type, timeon_page AS time_on_page_minutes,
               {LINEAGE},
               concat_ws('; ', CASE WHEN {digits('user_id', 'KH')} IS NULL THEN 'acc_id is null' END,
                   CASE WHEN {parse('event_time')} IS NULL THEN 'event_time is null' END,
                   CASE WHEN product_id IS NULL THEN 'product_id is null' END,
                   CASE WHEN product_id IS NOT NULL AND product_id NOT IN (SELECT product_id FROM {{r_products}})
                        THEN 'product is unknown' END) AS reasons
        FROM {{r_user_behaviors}}""",
    "o_sub_products": f"""
        SELECT SUB_ID AS subsidiary_id, PRODUCT_ID AS product_id, QUANTITY AS quantity, {LINEAGE}, created_at, updated_at
        FROM {{r_sub_products}} WHERE created_at IS NOT NULL AND updated_at IS NOT NULL AND created_at <= updated_at
             AND QUANTITY IS NOT NULL AND QUANTITY >= 0""",
    "o_products": f"""
        SELECT p.product_id, 'Version ' || {digits('product_specs', 'vs')} AS product_version, brand_id,
               prcs_id AS category_id, 'Product ' || ({pad(digits('product_name', 'product'), 2)}) AS product_name,
               CASE WHEN stock > 0 THEN 'ACTIVE' ELSE 'INACTIVE' END AS product_status,
               CAST(product_listprice AS DECIMAL(18,2)) AS product_listprice, product_weight_g, product_length_cm,
               product_height_cm, product_width_cm, regexp_replace(trim(product_description), '\\s+', ' ', 'g') AS product_description,
               CAST(product_photos_qty AS INT) AS product_photos_qty, CAST(product_length_cm * product_height_cm * product_width_cm AS DECIMAL(18,2)) AS product_volume_cm3,
               {parse('created_at')} AS created_at, {parse('updated_at')} AS updated_at, {LINEAGE}
        FROM {{r_products}} p LEFT JOIN (SELECT product_id, sum(quantity) AS stock FROM {{o_sub_products}} GROUP BY 1) s
        USING (product_id)""",
    "o_program_sales": f"""
        SELECT sale_id, 'Program Sale ' || lpad({digits('sale_name', 'salename')}, 2, '0') AS sale_name,
               CAST(discount_value AS DECIMAL(18,2)) AS discount_value, min_ordervalue,
               CAST(sale_startdate AS DATE) AS start_date, CAST(sale_enddate AS DATE) AS end_date,
               sale_createdat AS created_at, sale_updateat AS updated_at, {LINEAGE}
        FROM {{r_program_sales}}
        WHERE CAST(sale_startdate AS DATE) < CAST(sale_enddate AS DATE)
          AND CAST(sale_createdat AS DATE) <= CAST(sale_startdate AS DATE) AND sale_updateat >= sale_createdat""",
    "o_carts_base": f"""
        SELECT cart_id, acc_id, created_at, {later('created_at', off(0, 30 * 86400 - 1, "'updated'", 'cart_id'))}
               AS updated_at, {LINEAGE}
        FROM (SELECT *, {later("TIMESTAMP '2023-01-01 00:00:00'", off(0, 365 * 86400 - 1, 'cart_id'))} AS created_at
              FROM (SELECT 'CA' || ({pad(digits('cart_id'), 6)}) AS cart_id,
                           'ACC' || ({pad(digits('user_id', 'KH'), 8)}) AS acc_id, {LINEAGE} FROM {{r_carts}}) a) b""",
    "o_cart_items": f"""
        SELECT *, {later('added_at', off(0, 7 * 86400 - 1, "'updated'", 'cart_id', 'item_sequence'))} AS updated_at,
               CAST(quantity * list_price AS DECIMAL(18,2)) AS item_total_amount
        FROM (SELECT n.cart_id, item_sequence, n.product_id,
                     {off(1, 19, "'quantity'", 'n.cart_id', 'item_sequence')} AS quantity,
                     CAST(p.product_listprice AS DECIMAL(18,2)) AS list_price,
                     {later('b.created_at', off(0, 86399, "'added'", 'n.cart_id', 'item_sequence'))} AS added_at,
                     n.ingestion_time, n.source_file
              FROM (SELECT 'CA' || ({pad(digits('cart_id'), 6)}) AS cart_id, product_id, {LINEAGE},
                           row_number() OVER (PARTITION BY cart_id ORDER BY product_id NULLS FIRST, created_at,
                                              updated_at) AS item_sequence
                    FROM {{r_cart_items}}) n
              JOIN {{r_products}} p ON n.product_id = p.product_id
              JOIN {{o_carts_base}} b ON n.cart_id = b.cart_id) x""",
    "o_orders_base": f"""
        SELECT o.*, target_street, target_district, target_city
        FROM (SELECT order_id, 'ACC' || ({pad(digits('user_id', 'KH'), 8)}) AS acc_id, employee_id,
                     {ORDER_STATUS} AS order_status, {parse('created_at')} AS created_at,
                     {parse('confirmed_at')} AS confirmed_at,
                     {parse('estimated_delivery_at')} AS estimated_delivery_date,
                     {parse('delivered_at')} AS delivered_at, {parse('updated_at')} AS updated_at, {LINEAGE},
                     row_number() OVER (ORDER BY order_id) - 1 AS turn
              FROM {{r_orders}}) o
        JOIN {{addresses}} ON slot = turn % (SELECT count(*) FROM {{addresses}})""",
    "o_branches": """
        SELECT sub_id, sub_city, sub_district, row_number() OVER (ORDER BY sub_id) - 1 AS place,
               count(*) OVER () AS places FROM {r_subsidiaries}""",
    "o_offers": """
        SELECT sale_id, discount_value, row_number() OVER (ORDER BY sale_id) - 1 AS place,
               count(*) OVER () AS places FROM {o_program_sales}""",
    "o_numbered": f"""
        SELECT order_id, product_id, product_quantity AS quantity, {LINEAGE},
               row_number() OVER (PARTITION BY order_id ORDER BY product_id, product_quantity) AS order_item_id
        FROM {{r_order_items}}""",
    "o_placed": f"""
        SELECT n.*, b.sub_id AS subsidiary_id,
               CASE WHEN {h("'sale'", 'order_id', 'order_item_id')} % 100 < 70 THEN f.sale_id END AS sale_id,
               CASE WHEN {h("'sale'", 'order_id', 'order_item_id')} % 100 < 70 THEN f.discount_value
                    ELSE CAST(0 AS DECIMAL(18,2)) END AS discount_rate,
               b.sub_city, b.sub_district
        FROM {{o_numbered}} n
        JOIN {{o_branches}} b ON b.place = {h("'branch'", 'order_id', 'order_item_id')} % (SELECT max(places) FROM {{o_branches}})
        JOIN {{o_offers}} f ON f.place = {h("'campaign'", 'order_id', 'order_item_id')} % (SELECT max(places) FROM {{o_offers}})""",
    "o_order_items": f"""
        SELECT order_id, order_item_id, product_id, subsidiary_id, sale_id, quantity, list_price, discount_rate, sale_price,
               CAST(quantity * sale_price AS DECIMAL(18,2)) AS total_price,
               CAST(quantity * product_weight_g AS DECIMAL(18,2)) AS item_total_weight_g, km AS shipping_distance_km,
               CAST(15000 + product_weight_g * 4 + product_volume_cm3 / 4 + km * 300 AS DECIMAL(18,2)) AS shipping_fee,
               created_at, {days_on('created_at', h('order_id', 'order_item_id') + ' % 180')} AS updated_at, {LINEAGE}
        FROM (SELECT l.*, p.product_listprice AS list_price, p.product_weight_g, p.product_volume_cm3, o.created_at,
                     CAST(p.product_listprice * (1 - l.discount_rate) AS DECIMAL(18,2)) AS sale_price,
                     CAST(CASE WHEN l.sub_city = o.target_city AND l.sub_district = o.target_district
                               THEN {off(300, 2000, "'km'", 'l.order_id', 'l.order_item_id')}
                               WHEN l.sub_city = o.target_city
                               THEN {off(1000, 3500, "'km'", 'l.order_id', 'l.order_item_id')}
                               ELSE {off(5000, 120000, "'km'", 'l.order_id', 'l.order_item_id')} END / 100.0
                          AS DECIMAL(18,2)) AS km
              FROM {{o_placed}} l LEFT JOIN {{o_products}} p ON l.product_id = p.product_id
              LEFT JOIN {{o_orders_base}} o ON l.order_id = o.order_id) x""",
    "o_orders": f"""
        SELECT b.order_id, acc_id, employee_id, order_status, amount AS total_amount, fee AS total_shipfee, target_street,
               target_district, target_city, created_at, confirmed_at,
               CASE WHEN order_status IN ('SHIPPED', 'DELIVERED') THEN
                    {later('confirmed_at', "datediff('second', confirmed_at, estimated_delivery_date) * (" + h('b.order_id')
                           + " % 10000) * 3 // 100000")} END AS shipped_at,
               estimated_delivery_date, delivered_at, CAST(NULL AS TIMESTAMP) AS cancel_date, updated_at, {LINEAGE}
        FROM {{o_orders_base}} b JOIN (SELECT order_id, CAST(sum(total_price) AS DECIMAL(18,2)) AS amount,
            CAST(sum(shipping_fee) AS DECIMAL(18,2)) AS fee FROM {{o_order_items}} GROUP BY 1) i ON b.order_id = i.order_id
        WHERE amount > 0 OR fee > 0""",
    "o_payments": f"""
        SELECT *, CASE WHEN payment_method <> 'COD' AND payment_status IN ('SUCCESS', 'REFUNDED')
                       THEN {later('created_at', off(60, 1799, "'paid'", 'order_id'))}
                       WHEN payment_method = 'COD' AND payment_status = 'SUCCESS' THEN delivered_at END AS paid_at
        FROM (SELECT *, {payment_state("'refund'", 'order_id')} AS payment_status
              FROM (SELECT 'PA' || {digits('order_id', 'OD')} AS payment_id, order_id, order_status, delivered_at,
                           created_at, CAST(total_amount + total_shipfee AS DECIMAL(18,2)) AS payment_amount,
                           {METHOD_LIST}[{h("'method'", 'order_id')} % 6 + 1] AS payment_method
                    FROM {{o_orders}}) a) b""",
    "o_reviews": f"""
        SELECT *, CASE WHEN kind IN ('NORMAL', 'TITLE_ONLY') THEN {SENTIMENT} || ' experience' END AS review_title,
               CASE WHEN kind IN ('NORMAL', 'MESSAGE_ONLY')
                    THEN 'Rated ' || CAST(review_score AS STRING) || ' for ' || product_id END AS review_message,
               {later('delivered_at', off(86400, 15 * 86400 - 1, "'created'", 'order_id', 'order_item_id'))} AS created_at
        FROM (SELECT i.order_id, i.order_item_id, i.product_id, o.delivered_at,
                     row_number() OVER (ORDER BY i.order_id, i.order_item_id) AS review_no,
                     CAST({weighted(SCORES, "'score'", 'i.order_id', 'i.order_item_id')} AS DECIMAL(2,1)) AS review_score,
                     {weighted(quoted([("NORMAL", 85), ("TITLE_ONLY", 5), ("MESSAGE_ONLY", 8), ("MISSING_BOTH", 2)]),
                               "'comment'", 'i.order_id', 'i.order_item_id')} AS kind
              FROM {{o_order_items}} i JOIN {{o_orders}} o ON i.order_id = o.order_id WHERE o.delivered_at IS NOT NULL) x""",
    "o_sessions": """
        SELECT *, sum(opens) OVER (PARTITION BY acc_id ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) AS session_no
        FROM (SELECT *, CASE WHEN prev IS NULL OR epoch_us(event_time) // 1000000 - epoch_us(prev) // 1000000 > 1800
                             THEN 1 ELSE 0 END AS opens
              FROM (SELECT *, lag(event_time) OVER (PARTITION BY acc_id ORDER BY event_time, event_id) AS prev
                    FROM {o_judged} WHERE reasons = '') a) b""",
    "o_360": f"""
        SELECT c.acc_id, last_name, first_name, gender, district, city, customer_rank, account_age_days, total_orders,
               total_products_purchased, total_spent, avg_order_value, firsr_order, last_order, is_active
        FROM {{o_customers}} c
        JOIN (SELECT acc_id, count(*) AS total_orders, sum(total_amount) AS total_spent, min(created_at) AS firsr_order,
                     max(created_at) AS last_order FROM {{b_orders}} GROUP BY 1) p ON c.acc_id = p.acc_id
        JOIN (SELECT acc_id, count(*) AS total_products_purchased, {ratio('sum(total_price)', 'count(*)')} AS avg_order_value
              FROM {{b_order_items}} i JOIN {{b_orders}} o ON i.order_id = o.order_id GROUP BY 1) b ON c.acc_id = b.acc_id""",
    "o_creviews": f"""
        SELECT acc_id, count(*) AS total_reviews, {half_up(ratio('sum(review_score)', 'count(*)'))} AS avg_review_score,
               count(*) FILTER (review_score >= 4.0) AS total_positive_reviews,
               count(*) FILTER (review_score <= 2.5) AS total_negative_reviews,
               count(*) FILTER (review_score > 2.5 AND review_score < 4.0) AS total_neutral_reviews,
               CASE WHEN count(*) FILTER (review_score >= 4.0 OR review_score <= 2.5) > 0
                    THEN {half_up(ratio('count(*) FILTER (review_score >= 4.0)',
                                        'count(*) FILTER (review_score >= 4.0 OR review_score <= 2.5)'))}
                    ELSE 0.0 END AS positive_review_rate,
               {half_up(ratio('count(*) FILTER (has_reply)', 'count(*)'))} AS has_reply_rate
        FROM {{b_orders}} o JOIN {{b_reviews}} r ON o.order_id = r.order_id GROUP BY 1""",
    "o_scores": f"""
        SELECT product_id, count(*) AS review_count, CAST({ratio('sum(review_score)', 'count(*)')} AS FLOAT) AS avg_rating
        FROM {{b_reviews}} GROUP BY 1""",
    "o_identities": """
        SELECT user_id, concat_ws('_', coalesce(user_email, 'unknown'), coalesce(CAST(user_phone AS STRING), 'unknown'))
               AS identity FROM {r_users}""",
    "o_lines": """
        SELECT * EXCLUDE (l_orderkey, l_extendedprice, l_partkey, l_suppkey, l_shipdate, l_returnflag)
               REPLACE (CASE WHEN l_tax <> 0.03 THEN l_tax END AS l_tax) FROM {lineitem}""",
    "o_records": """
        SELECT *, sum(CASE WHEN line LIKE '[%' THEN 1 ELSE 0 END) OVER (PARTITION BY path ORDER BY line_no
               ROWS UNBOUNDED PRECEDING) AS record_no FROM {log_lines}""",
    # log fields
    "o_log": r"""
        SELECT path, line_no, line,
               regexp_extract(line, '\[(\d{{4}}-\d{{2}}-\d{{2}}[ T]\d{{2}}:\d{{2}}:\d{{2}}[.,]\d{{3}})\] \{{([^}}]*)\}} ([A-Za-z]+) - (.*)',
                   ['stamp', 'source_file', 'log_level', 'log_message']) AS f,
               regexp_matches(line, '\[\d{{4}}-\d{{2}}-\d{{2}}[ T]\d{{2}}:\d{{2}}:\d{{2}}[.,]\d{{3}}\] \{{[^}}]*\}} [A-Za-z]+ - .*') AS ok,
               regexp_extract(path, '.*/([^/]+)/([^/]+)/([^/]+)/(\d+)\.log$',
                   ['dag_id', 'task_id', 'execution_date', 'try_number']) AS p,
               regexp_matches(path, '.*/[^/]+/[^/]+/[^/]+/\d+\.log$') AS placed
        FROM {log_lines}""",
}

ALL = {**TEXTS, **bindings.ORACLE_TEXTS, **O}


def _needed(text: str, seen: list[str]) -> None:
    for name in names_in(text):
        if name in ALL and name not in seen:
            _needed(ALL[name], seen)
            seen.append(name)


def _fill(text: str) -> str:
    return text.format(**{n: n for n in names_in(text)})


def complete(text: str) -> str:
    """The query with every binding it needs in front."""
    seen: list[str] = []
    _needed(text, seen)
    parts = ",\n".join(f"{n} AS MATERIALIZED ({_fill(ALL[n])})" for n in seen)
    return f"WITH {parts}\n{_fill(text)}" if parts else _fill(text)


# ---------------------------------------------------------------- the queries

ORDER_PERFORMANCE = f"""
    SELECT CAST(year(created_at) AS INT) AS year, CAST(month(created_at) AS INT) AS month, count(*) AS total_orders,
           {dbl('sum(total_amount)')} AS hope_total_revenue, {ratio('sum(total_amount)', 'count(*)')} AS avg_order_value,
           count(*) FILTER (order_status = 'DELIVERED') AS delivered_orders,
           {dbl("sum(CASE WHEN order_status = 'DELIVERED' THEN total_amount ELSE 0 END)")} AS real_total_revenue,
           count(*) FILTER (order_status = 'CANCELLED') AS cancelled_orders,
           {dbl("sum(CASE WHEN order_status = 'CANCELLED' THEN total_amount ELSE 0 END)")} AS cancelled_hopeful_revenue
    FROM {{b_orders}} GROUP BY 1, 2"""


def _district(city: str) -> str:
    return f"SELECT district, count(*) AS total_customer FROM {{b_customers}} WHERE city = '{city}' GROUP BY 1"


def _category_performance(exact: bool) -> str:
    if exact:
        totals = f"""
        SELECT category_id, count(*) AS total_products, CAST(sum(q) AS BIGINT) AS total_sold, sum(v) AS revenue,
               {half_up(ratio('sum(s)', 'sum(r)'))} AS avg_review_score, {half_up(ratio('sum(u)', 'sum(n)'))} AS avg_price
        FROM (SELECT product_id, count(*) AS n, sum(quantity) AS q, sum(total_price) AS v,
                     sum(CAST(total_price / quantity AS DECIMAL(18,6))) AS u FROM {{b_order_items}} GROUP BY 1) i
        JOIN (SELECT product_id, count(*) AS r, sum(review_score) AS s FROM {{b_reviews}} GROUP BY 1) w USING (product_id)
        JOIN {{b_products}} USING (product_id) GROUP BY 1"""
    else:
        totals = f"""
        SELECT category_id, count(DISTINCT i.product_id) AS total_products, CAST(sum(quantity) AS BIGINT) AS total_sold,
               sum(total_price) AS revenue, {half_up(ratio('sum(review_score)', 'count(*)'))} AS avg_review_score,
               {half_up(ratio('sum(CAST(total_price / quantity AS DECIMAL(18,6)))', 'count(*)'))} AS avg_price
        FROM {{b_products}} p JOIN {{b_reviews}} r ON p.product_id = r.product_id
        JOIN {{b_order_items}} i ON p.product_id = i.product_id GROUP BY 1"""
    return f"""
        SELECT category_id AS cate_id, cate_name, total_products, total_sold, total_orders,
               {dbl('revenue')} AS total_revenue, avg_review_score, avg_price,
               {pct('revenue', 'sum(revenue) OVER ()')} AS revenue_share,
               {pct('total_sold', 'sum(total_sold) OVER ()')} AS sold_share,
               {pct('total_orders', 'sum(total_orders) OVER ()')} AS orders_share
        FROM ({totals}) t JOIN {{b_categories}} ON category_id = cate_id
        JOIN (SELECT category_id AS c, count(DISTINCT order_id) AS total_orders
              FROM {{b_order_items}} i JOIN {{b_products}} p ON i.product_id = p.product_id
              WHERE i.product_id IN (SELECT product_id FROM {{b_reviews}}) GROUP BY 1) o ON o.c = category_id"""


def _product_performance(exact: bool) -> str:
    source = "{b_order_items} i" if exact else "{b_reviews} r JOIN {b_order_items} i ON i.product_id = r.product_id"
    return f"""
        SELECT p.product_id, product_name, brand_id, cate_name, avg_rating AS product_rating, review_count, total_sold,
               total_orders, total_revenue, avg_price
        FROM {{b_products}} p JOIN {{b_categories}} ON category_id = cate_id
        JOIN {{o_scores}} s ON p.product_id = s.product_id
        JOIN (SELECT i.product_id, CAST(sum(quantity) AS BIGINT) AS total_sold, count(*) AS total_orders,
                     {dbl('sum(total_price)')} AS total_revenue,
                     {half_up(ratio('sum(CAST(total_price / quantity AS DECIMAL(18,6)))', 'count(*)'))} AS avg_price
              FROM {source} GROUP BY 1) f ON p.product_id = f.product_id"""


def _subsidiary_shipping(exact: bool) -> str:
    items = "count(*)" if exact else "CAST(sum(order_item_id) AS BIGINT)"
    sums = {"fee": "shipping_fee", "revenue": "total_price", "distance": "shipping_distance_km"}
    return f"""
        SELECT subsidiary_id, count(DISTINCT order_id) AS total_order, {items} AS total_items,
               CAST(sum(quantity) AS BIGINT) AS total_quantity, {dbl('sum(shipping_fee)')} AS total_fee,
               {', '.join(f"{half_up(ratio(f'sum({c})', 'count(*)'))} AS avg_{n}" for n, c in sums.items())},
               {dbl('sum(total_price)')} AS total_revenue, {dbl('max(shipping_distance_km)')} AS max_distance,
               {dbl('min(shipping_distance_km)')} AS min_distance, {dbl('sum(item_total_weight_g)')} AS total_weight,
               {half_up(ratio(items, 'count(DISTINCT order_id)'))} AS avg_items_per_order
        FROM {{b_order_items}} GROUP BY 1"""


def _rate(a: str, b: str) -> str:
    return half_up(ratio(a, b))


def _mean(column: str) -> str:
    return ratio(f"sum(CAST({column} AS DECIMAL(28,6)))", f"count({column})")


def _bucketed(interval: str, ts: str = "ts") -> str:
    return f"time_bucket(INTERVAL '{interval}', {ts})"


def _profile_text(columns: list[str], table: str, all_columns: bool) -> str:
    parts = []
    for c in sorted(columns):
        count = f"count(*) FILTER ({c} IS NULL)"
        text = f"'{c}=' || {count}"
        parts.append(text if all_columns else f"CASE WHEN {count} > 0 THEN {text} END")
    return f"concat_ws(',', {', '.join(parts)})"


USER_COLUMNS = ["user_id", "user_name", "user_email", "user_phone", "user_gender", "user_born", "user_address",
                "user_account", "user_password", "user_ranked", "user_createdat", "ingestion_time", "source_file"]
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

RAW_SENTIMENT = f"{SENTIMENT} AS review_sentiment"
_PLAIN_EVENTS = "SELECT event_id, acc_id, event_time, event_type, CAST(event_time AS DATE) AS day FROM {b_behaviors}"
_FIELDS = ["source_file", "log_level", "log_message"]
_PLACES = ["dag_id", "task_id", "execution_date"]

ORACLES: dict[str, str] = {
    # sources and sinks
    "src_read_table": "SELECT * FROM {o_customers}",
    "src_named_sql": f"""SELECT year, month, total_orders, hope_total_revenue, delivered_orders, cancelled_orders
        FROM ({ORDER_PERFORMANCE}) t""",
    "sink_csv_roundtrip": f"""SELECT * REPLACE ({dbl('product_listprice')} AS product_listprice,
        {dbl('product_volume_cm3')} AS product_volume_cm3) FROM {{b_products}}""",
    "sink_csv_texts": """SELECT * EXCLUDE (text), CASE doc_id - (SELECT min(doc_id) FROM {documents}) WHEN 0 THEN md5('') WHEN 1 THEN NULL
        ELSE md5(text) END AS text_md5 FROM {documents}""",
    "sink_parquet_roundtrip": f"""SELECT * REPLACE ({dbl('total_amount')} AS total_amount,
        {dbl('total_shipfee')} AS total_shipfee) FROM {{b_orders}}""",
    "sink_table_roundtrip": ORDER_PERFORMANCE,
    "sink_verified_publish": f"SELECT * REPLACE ({dbl('payment_amount')} AS payment_amount) FROM {{b_payments}}",
    "sink_clustered": """SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS TIMESTAMP) AS l_shipdate, l_extendedprice FROM {lineitem}
        WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_shipdate < TIMESTAMP '1995-04-01'""",
    "sink_rolled_back": f"SELECT * REPLACE ({dbl('payment_amount')} AS payment_amount) FROM {{b_payments}}",
    "run_layer_summary": """
        SELECT 'category_status' AS table_name, 'SUCCESS' AS status, count(DISTINCT category_id) AS row_count FROM {b_products}
        UNION ALL SELECT 'customer_top_city', 'SUCCESS', count(DISTINCT city) FROM {b_customers}
        UNION ALL SELECT 'order_performance', 'SUCCESS', count(DISTINCT date_trunc('month', created_at)) FROM {b_orders}
        UNION ALL SELECT 'not_there', 'FAILED', NULL""",
    # projections, filters, cleaning
    "proj_rename_select": """SELECT emp_id AS employee_id, emp_role AS role, emp_born AS born, sub_id AS subsidiary_id,
        source_file FROM {r_employees}""",
    "filter_required_columns": """SELECT emp_id, emp_gender, emp_phone, emp_role FROM {r_employees}
        WHERE emp_id IS NOT NULL AND emp_gender IS NOT NULL AND emp_phone IS NOT NULL AND emp_role IS NOT NULL""",
    "filter_campaign_rules": "SELECT sale_id, start_date, end_date, created_at, updated_at FROM {o_program_sales}",
    "filter_inventory_rules": """SELECT subsidiary_id AS sub_id, product_id, quantity, created_at, updated_at
        FROM {o_sub_products}""",
    "dq_valid_rows": "SELECT * EXCLUDE (reasons) FROM {o_judged} WHERE reasons = ''",
    "dq_quarantine_rows": "SELECT * FROM {o_judged} WHERE reasons <> ''",
    "clean_fill_nulls": """SELECT user_id, coalesce(user_email, 'UNKNOWN') AS user_email,
        coalesce(user_phone, 0) AS user_phone FROM {r_users}""",
    "clean_coalesce_timestamps": f"""SELECT order_id, {parse('created_at')} AS created_at,
        coalesce({parse('delivered_at')}, {parse('created_at')}) AS delivered_at FROM {{r_orders}}""",
    "clean_recode_synonyms": f"SELECT event_id, {DEVICE} AS device_type, {EVENT} AS event_type FROM {{r_user_behaviors}}",
    "derive_order_status": f"SELECT order_id, {ORDER_STATUS} AS order_status FROM {{r_orders}}",
    "derive_spend_rank": f"""SELECT acc_id, {dbl('spent')} AS spent, {rank_of('spent')} AS customer_rank
        FROM (SELECT acc_id, sum(total_amount) * 100 AS spent FROM {{b_orders}} GROUP BY 1) t""",
    "dedup_by_key": f"""SELECT brand_id, brand_name, brand_country, {parse('created_at')} AS created_at FROM {{r_brands}}
        QUALIFY row_number() OVER (PARTITION BY brand_id ORDER BY {parse('created_at')} DESC, brand_name) = 1""",
    "derive_stock_status": """SELECT product_id, stock, CASE WHEN stock > 0 THEN 'ACTIVE' ELSE 'INACTIVE' END AS product_status
        FROM {r_products} LEFT JOIN (SELECT PRODUCT_ID AS product_id, CAST(sum(QUANTITY) AS BIGINT) AS stock
                                     FROM {r_sub_products} GROUP BY 1) s USING (product_id)""",
    "derive_presence_flags": """SELECT review_id, review_id % 5 = 0 AND review_id % 3 = 0 AS is_missing_comment,
        review_id % 5 <> 0 AND review_id % 3 = 0 AS has_title_only, review_id % 5 = 0 AND review_id % 3 <> 0 AS has_message_only,
        review_id % 5 <> 0 AND review_id % 3 <> 0 AS is_complete_review FROM {b_reviews}""",
    "derive_sentiment": f"""SELECT review_id, {dbl('review_score')} AS review_score, review_score >= 4 AS is_positive_review,
        review_score >= 3 AND review_score < 4 AS is_neutral_review, review_score < 3 AS is_negative_review, {RAW_SENTIMENT}
        FROM {{b_reviews}}""",
    "derive_payment_status": f"""SELECT order_id, payment_method, order_status, {payment_state('order_id')} AS payment_status
        FROM (SELECT order_id, payment_method FROM {{b_payments}}) p
        JOIN (SELECT order_id, order_status FROM {{b_orders}}) o USING (order_id)""",
    "derive_cart_status": f"""SELECT cart_id, updated_at, {cart_state('updated_at', '2024-05-20', 'cart_id')} AS cart_status
        FROM (SELECT cart_id, max(event_time) AS updated_at FROM {{r_cart_events}} GROUP BY 1) t""",
    "derive_density": f"""SELECT product_id, {dbl('volume')} AS volume,
        CASE WHEN volume > 0 THEN {dbl('CAST(product_weight_g / volume AS DECIMAL(18,4))')} ELSE 0.0 END AS density
        FROM (SELECT product_id, product_weight_g, CAST(product_length_cm * product_height_cm * product_width_cm
              AS DECIMAL(18,2)) AS volume FROM {{r_products}}) t""",
    "derive_lookup_gender": f"SELECT user_id, {FIRST} AS first_name, {GENDER} AS gender FROM {{r_users}}",
    "derive_seeded_offset": f"""SELECT order_id, days, {days_on('created_at', '-days')} AS moved_at,
        {later(days_on('created_at', '-days'), off(0, 'days * 86400', "'seconds'", 'order_id'))} AS changed_at
        FROM (SELECT order_id, created_at, {off(7, 90, "'days'", 'order_id')} AS days FROM {{b_orders}}) t""",
    # joins
    "join_inner": f"""SELECT event_id, b.product_id, product_name, {dbl('product_listprice')} AS product_listprice
        FROM {{b_behaviors}} b JOIN {{b_products}} p ON b.product_id = p.product_id""",
    "join_left": f"""SELECT o.order_id, {dbl('total_amount')} AS total_amount, {dbl('item_total')} AS item_total FROM {{b_orders}} o
        LEFT JOIN (SELECT order_id, sum(total_price) AS item_total FROM {{b_order_items}} GROUP BY 1) i
        ON o.order_id = i.order_id""",
    "join_semi_reference": """SELECT event_id, acc_id, product_id FROM {b_behaviors} WHERE product_id IN
        (SELECT product_id FROM {b_products} WHERE product_status = 'ACTIVE')""",
    "join_anti_reference": """SELECT event_id, acc_id, product_id FROM {b_behaviors} b WHERE NOT EXISTS
        (SELECT 1 FROM {b_products} p WHERE product_status = 'ACTIVE' AND p.product_id = b.product_id)""",
    "join_zip_rank": """SELECT row_no, user_id, acc_id
        FROM (SELECT trim(user_id) AS user_id, row_number() OVER (ORDER BY trim(user_id)) AS row_no FROM {r_users}) u
        JOIN (SELECT acc_id, row_number() OVER (ORDER BY acc_id) AS row_no FROM {b_customers}) c USING (row_no)""",
    "join_round_robin": """SELECT order_id, acc_id, slot, target_street, target_district, target_city
        FROM (SELECT order_id, acc_id, row_number() OVER (ORDER BY order_id) - 1 AS turn FROM {b_orders}) o
        JOIN {addresses} ON slot = turn % (SELECT count(*) FROM {addresses})""",
    "join_scalar_subquery": f"""SELECT payment_method, {dbl('sum(payment_amount)')} AS amount,
        {half_up(ratio('sum(payment_amount)', '(SELECT sum(total_amount) FROM {b_orders})'), 4)} AS share
        FROM {{b_payments}} GROUP BY 1""",
    "join_bucket_lookup": f"""SELECT order_id, sub_id, sub_city FROM {{b_orders}} JOIN
        (SELECT sub_id, sub_city, row_number() OVER (ORDER BY sub_id) - 1 AS place FROM {{b_subsidiaries}}) b
        ON place = {h("'branch'", 'order_id')} % (SELECT count(*) FROM {{b_subsidiaries}})""",
    # aggregates
    "agg_group_count": "SELECT order_status, count(*) AS orders, count(delivered_at) AS delivered FROM {b_orders} GROUP BY 1",
    "agg_basic": f"""SELECT subsidiary_id, {dbl('sum(total_price)')} AS total, {ratio('sum(total_price)', 'count(*)')} AS mean,
        {dbl('min(total_price)')} AS lowest, {dbl('max(total_price)')} AS highest FROM {{b_order_items}} GROUP BY 1""",
    "agg_count_distinct": """SELECT subsidiary_id, count(DISTINCT product_id) AS products, count(DISTINCT order_id) AS orders
        FROM {b_order_items} GROUP BY 1""",
    "agg_conditional": f"""SELECT target_city, count(*) FILTER (order_status = 'DELIVERED') AS delivered,
        {dbl("sum(CASE WHEN order_status = 'CANCELLED' THEN total_amount ELSE 0 END)")} AS cancelled_amount
        FROM {{b_orders}} GROUP BY 1""",
    "agg_rollup_to_parent": f"""SELECT o.order_id, coalesce(items, 0) AS items, {dbl('coalesce(amount, 0)')} AS amount,
        {dbl('coalesce(fee, 0)')} AS fee FROM {{b_orders}} o LEFT JOIN (SELECT order_id, count(*) AS items,
        sum(total_price) AS amount, sum(shipping_fee) AS fee FROM {{b_order_items}} GROUP BY 1) i ON o.order_id = i.order_id""",
    "dq_null_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count FROM {{r_users}}" for c in USER_COLUMNS
    ),
    "dq_duplicate_count": """SELECT CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(n - 1) AS BIGINT) AS duplicate_count,
        CAST(sum(CASE WHEN sale_id IS NULL THEN n ELSE 0 END) AS BIGINT) AS null_sale_ids
        FROM (SELECT * EXCLUDE (order_item_id), count(*) AS n FROM {b_order_items} GROUP BY ALL) t""",
    # windows and numbering
    "win_item_sequence": f"""SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)})
        AS item_sequence, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate FROM {{lineitem}}""",
    "win_keep_latest": """SELECT acc_id, order_id, created_at FROM {b_orders}
        QUALIFY row_number() OVER (PARTITION BY acc_id ORDER BY created_at DESC, order_id DESC) = 1""",
    "sessionize_events": """SELECT event_id, acc_id, event_time, CAST(sum(opens) OVER (PARTITION BY acc_id
            ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_no
        FROM (SELECT *, CASE WHEN prev IS NULL OR epoch_us(event_time) // 1000000 - epoch_us(prev) // 1000000 > 1800
                             THEN 1 ELSE 0 END AS opens
              FROM (SELECT event_id, acc_id, event_time, lag(event_time) OVER (PARTITION BY acc_id
                    ORDER BY event_time, event_id) AS prev FROM {b_behaviors}) a) b""",
    "funnel_repair": f"""SELECT event_id, acc_id, event_time, day,
               CASE WHEN event_type = 'purchase' AND coalesce(checkouts, 0) = 0 THEN 'view'
                    WHEN event_type = 'checkout' AND coalesce(carts, 0) = 0 THEN 'add_to_cart'
                    WHEN event_type = 'remove_from_cart' AND coalesce(carts, 0) = 0 THEN 'view'
                    ELSE event_type END AS event_type
        FROM (SELECT *, count(*) FILTER (event_type = 'add_to_cart') OVER w AS carts,
                     count(*) FILTER (event_type = 'checkout') OVER w AS checkouts
              FROM ({_PLAIN_EVENTS}) e WINDOW w AS (PARTITION BY acc_id, day ORDER BY event_time, event_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) x""",
    "key_dense_surrogate": """SELECT user_id, identity, dense_rank() OVER (ORDER BY identity) AS cus_seq FROM {o_identities}""",
    "key_stable_surrogate": """SELECT user_id, identity, CAST(cus_seq AS BIGINT) AS cus_seq FROM (
        SELECT identity, row_number() OVER (ORDER BY NOT early, identity) AS cus_seq
        FROM (SELECT identity, bool_or(user_id IN (SELECT trim(user_id) FROM {r_orders})) AS early FROM {o_identities} GROUP BY 1) a) b
        JOIN {o_identities} USING (identity)""",
    "key_global_row_number": """SELECT review_id, order_id, row_number() OVER (ORDER BY order_id, review_id) AS row_no,
        count(*) OVER () AS row_total FROM {b_reviews}""",
    "win_ntile_scores": f"""SELECT acc_id, {dbl('spent')} AS spent, CAST(ntile(5) OVER (ORDER BY spent, acc_id) AS INT) AS quintile,
        CAST(ntile(7) OVER (ORDER BY spent, acc_id) AS INT) AS septile
        FROM (SELECT acc_id, sum(total_amount) AS spent FROM {{b_orders}} GROUP BY 1) t""",
    "win_share_of_total": f"""SELECT category_id, products, {pct('products', 'sum(products) OVER ()')} AS share
        FROM (SELECT category_id, count(*) AS products FROM {{b_products}} GROUP BY 1) t""",
    "sort_multi_key": "SELECT acc_id, city, district FROM {b_customers} ORDER BY city, district DESC, acc_id",
    "topk_groups": """SELECT city, district, count(*) AS total_customer FROM {b_customers} GROUP BY 1, 2
        ORDER BY total_customer DESC, city, district LIMIT 10""",
    "set_distinct": "SELECT DISTINCT product_id, subsidiary_id FROM {b_order_items}",
    # functions
    "fn_text_clean": r"""SELECT doc_id, CAST(length(s) AS INT) AS squeezed_length, md5(s) AS squeezed_md5,
        upper(trim(lang)) AS lang_upper, upper(left(trim(lang), 1)) || lower(substr(trim(lang), 2)) AS lang_title,
        lower(trim(source)) AS source_lower
        FROM (SELECT *, regexp_replace(trim(text), '\s+', ' ', 'g') AS s FROM {documents}) t""",
    "fn_id_format": f"""SELECT product_id, {joined_id('P', digits('product_id', 'PR'), 6)} AS padded,
        {joined_id('Product ', digits('product_name', 'product'), 2)} AS name, {joined_id('B', digits('brand_id'), 1)} AS short,
        {joined_id('Program Sale ', digits('product_id'), 2)} AS campaign, CAST(NULL AS STRING) AS no_account
        FROM {{r_products}}""",
    "fn_phone": f"""SELECT user_id, coalesce('0' || CAST(user_phone AS STRING), 'UNKNOWN') AS with_default,
        '0' || CAST(user_phone AS STRING) AS plain, '0' || lpad(CAST(user_phone % 1000 AS STRING), 9, '0') AS padded
        FROM {{r_users}}""",
    "fn_strip_diacritics": f"""SELECT doc_id, md5({plain_letters('text')}) AS plain_md5,
        {plain_letters("string_split(text, ' ')[1]")} AS first_word FROM {{documents}}""",
    "fn_name_parts": f"""SELECT user_id,
        {plain_letters(FIRST)} || '.' || {plain_letters(f"replace({LAST}, ' ', '')")} || '007@gmail.com' AS email,
        {plain_letters(FIRST)} || {plain_letters(f"string_split({LAST}, ' ')[1]")} || '0042@shop.example' AS company_email,
        {plain_letters(FIRST)} || '_' || ({pad(digits('user_id', 'KH'), 8)}) AS account_name,
        'https://cdn.shop.example/products/' || user_id || '/v1.jpg' AS photo FROM {{r_users}}""",
    "fn_parse_dates": f"""SELECT user_id, {parse('user_createdat')} AS created_at,
        CAST({parse('user_createdat')} AS DATE) AS created_on, try_cast(user_born AS DATE) AS born FROM {{r_users}}""",
    "fn_date_parts": """SELECT order_id, CAST(year(created_at) AS INT) AS year, CAST(month(created_at) AS INT) AS month,
        dayofweek(created_at) IN (0, 6) AS is_weekend,
        CAST(datediff('day', CAST(created_at AS DATE), delivered_at) AS INT) AS delivery_days,
        CAST(greatest(coalesce(datediff('day', estimated_delivery_date, delivered_at), 0), 0) AS INT) AS delay_days,
        CAST(datediff('day', CAST(created_at AS DATE), DATE '2024-06-30') // 365 AS INT) AS age,
        CAST(datediff('day', CAST(created_at AS DATE), DATE '2024-06-30') AS INT) AS account_age,
        created_at + INTERVAL 2 DAY + INTERVAL 90 SECOND AS shifted FROM {b_orders}""",
    "fn_pricing": f"""SELECT order_id AS l_orderkey, i.product_id, {dbl('discount_rate')} AS rate, {dbl('sale_price')} AS sale_price,
        {dbl('total_price')} AS total_price, {dbl('product_volume_cm3')} AS volume
        FROM {{b_order_items}} i JOIN {{b_products}} p ON i.product_id = p.product_id""",
    "fn_shipping_fee": f"""SELECT product_id, {dbl('CAST(15000 + product_weight_g * 4 + product_volume_cm3 / 4 + (product_id % 1200) * 300 AS DECIMAL(18,2))')} AS fee,
        CASE WHEN product_id % 3 <> 0 THEN 3 WHEN product_id % 2 = 0 THEN 1 ELSE 2 END AS zone FROM {{b_products}}""",
    "fn_rates": f"""SELECT acc_id, {pct('d', 'd + c')} AS delivered_pct,
        CASE WHEN d > 0 THEN {half_up(ratio('c', 'd'))} ELSE 0.0 END AS cancelled_per_delivered
        FROM (SELECT acc_id, count(*) FILTER (order_status = 'CANCELLED') AS c, count(*) FILTER (order_status = 'DELIVERED') AS d
              FROM {{b_orders}} GROUP BY 1) t""",
    "fn_weighted_bucket": f"""SELECT event_id, {h('event_id')} % 10000 AS slot, {weighted(quoted(EVENT_WEIGHTS), 'event_id')} AS event_type,
        {dbl(weighted(SCORES, "'score'", 'event_id'))} AS score, {METHOD_LIST}[{h('event_id')} % 6 + 1] AS method FROM {{b_behaviors}}""",
    # logs
    "log_assemble_records": r"""SELECT path, line_no, line, CAST(record_no AS BIGINT) AS record_no,
        row_number() OVER (PARTITION BY path, record_no ORDER BY line_no) AS line_in_record FROM {o_records}""",
    "log_record_texts": r"""SELECT path, CAST(record_no AS BIGINT) AS record_no, min(line_no) AS first_line, count(*) AS lines,
        string_agg(line, chr(10) ORDER BY line_no) AS message FROM {o_records} GROUP BY 1, 2""",
    "stream_log_lines": r"""SELECT path, line_no, line, CAST(record_no AS BIGINT) AS record_no,
        row_number() OVER (PARTITION BY path, record_no ORDER BY line_no) AS line_in_record FROM {o_records}""",
    "stream_log_records": r"""SELECT path, CAST(record_no AS BIGINT) AS record_no, min(line_no) AS first_line, count(*) AS lines,
        string_agg(line, chr(10) ORDER BY line_no) AS message FROM {o_records} GROUP BY 1, 2""",
    "log_structure_lines": f"""SELECT path, line_no, line,
        try_strptime(CASE WHEN ok THEN replace(replace(f['stamp'], 'T', ' '), ',', '.') END, '%Y-%m-%d %H:%M:%S.%g') AS logged_at,
        CASE WHEN ok THEN f['source_file'] END AS source_file, CASE WHEN ok THEN lower(f['log_level']) END AS log_level,
        CASE WHEN ok THEN f['log_message'] END AS log_message,
        {', '.join(f"CASE WHEN placed THEN p['{c}'] END AS {c}" for c in _PLACES)},
        CASE WHEN placed THEN TRY_CAST(p['try_number'] AS INT) END AS try_number,
        concat_ws(',', CASE WHEN NOT ok THEN 'record_parse_failure' END, CASE WHEN NOT placed THEN 'path_parse_failure' END) AS tags
        FROM {{o_log}}""",
    "log_classify": f"""SELECT path, line_no, regexp_replace(line, '^\\[DBG\\]', 'DBG') AS line, level AS log_level,
        CASE WHEN dag LIKE '%bronze%' THEN 'bronze' WHEN dag LIKE '%silver%' THEN 'silver' WHEN dag LIKE '%gold%' THEN 'gold'
             WHEN dag LIKE '%master%' THEN 'orchestration' END AS layer,
        CASE WHEN regexp_matches(msg, '(?i)(error|exception|failed|traceback|fatal)') THEN 'high' WHEN level = 'warning' THEN 'medium'
             ELSE 'low' END AS severity
        FROM (SELECT path, line_no, line, CASE WHEN placed THEN p['dag_id'] END AS dag, CASE WHEN ok THEN lower(f['log_level']) END AS level,
                     CASE WHEN ok THEN f['log_message'] END AS msg FROM {{o_log}}) t
        WHERE NOT coalesce(msg LIKE '%Heartbeat%' AND level = 'debug', false) AND line NOT LIKE '[DBG]%'""",
    # metrics
    "ts_tumbling_agg": f"""SELECT {_bucketed('1 minute')} AS window_start, {_bucketed('1 minute')} + INTERVAL 1 MINUTE AS window_end,
        measurement, field, {_mean('value')} AS mean_value, count(value) AS samples FROM {{b_metrics}} GROUP BY ALL""",
    "ts_pivot_slowest": f"""SELECT measurement, {_mean('p50')} AS p50, {_mean('p95')} AS p95 FROM (
        SELECT measurement, {_bucketed('1 hour')} AS w, {ratio("sum(CAST(value AS DECIMAL(28,6))) FILTER (field = 'p50')", "count(*) FILTER (field = 'p50')")} AS p50,
               {ratio("sum(CAST(value AS DECIMAL(28,6))) FILTER (field = 'p95')", "count(*) FILTER (field = 'p95')")} AS p95
        FROM {{b_metrics}} GROUP BY 1, 2) t GROUP BY 1""",
    "ts_last_value": """SELECT measurement, field, ts AS last_ts, value AS last_value FROM {b_metrics}
        QUALIFY row_number() OVER (PARTITION BY measurement, field ORDER BY ts DESC, event_id DESC) = 1""",
    "ts_percentiles": f"""SELECT measurement, count(*) AS samples, {', '.join(
        f"{half_up(f'quantile_cont(value, {q})', 6)} AS p{n}"
        for q, n in ((0.5, '50'), (0.9, '90'), (0.95, '95'), (0.99, '99'), (0.999, '99_9')))} FROM {{b_metrics}} GROUP BY 1""",
    "ts_rate_non_negative": f"""SELECT window_start, measurement, value, CASE WHEN value - before >= 0 THEN
            (value - before) * 1000000.0 / CAST(epoch_us(window_start) - epoch_us(since) AS DOUBLE) END AS per_second
        FROM (SELECT *, lag(value) OVER w AS before, lag(window_start) OVER w AS since FROM (
              SELECT {_bucketed('1 hour')} AS window_start, measurement, {dbl('sum(CAST(value AS DECIMAL(18,2)))')} AS value
              FROM {{b_metrics}} GROUP BY 1, 2) s WINDOW w AS (PARTITION BY measurement ORDER BY window_start)) t WHERE since IS NOT NULL""",
    "ts_downsample_hourly": f"""SELECT {_bucketed('1 hour')} AS window_start, {_bucketed('1 hour')} + INTERVAL 1 HOUR AS window_end,
        measurement, field, {_mean('value')} AS mean_value FROM {{b_metrics}} GROUP BY ALL""",
    "ts_failure_alerts": f"""SELECT *, CASE WHEN failure_rate > 0.25 THEN 'CRITICAL' ELSE 'WARNING' END AS alert FROM (
        SELECT {_bucketed('5 minutes')} AS window_start, {_bucketed('5 minutes')} + INTERVAL 5 MINUTE AS window_end,
               count(*) AS events, count(*) FILTER (measurement = 'app.error') AS failures,
               {ratio("count(*) FILTER (measurement = 'app.error')", 'count(*)')} AS failure_rate
        FROM {{b_metrics}} GROUP BY ALL) t WHERE failure_rate > 0.10""",
    "ts_latency_alerts": f"""SELECT measurement, window_start, samples, {', '.join(f"{half_up(c, 6)} AS {c}" for c in ('p95', 'p99', 'base_p95', 'base_p99'))}
        FROM (SELECT *, lag(p95) OVER w AS base_p95, lag(p99) OVER w AS base_p99 FROM (
        SELECT measurement, {_bucketed('1 day')} AS window_start, count(*) AS samples, quantile_cont(value, 0.95) AS p95,
               quantile_cont(value, 0.99) AS p99 FROM {{b_metrics}} GROUP BY 1, 2) t
        WINDOW w AS (PARTITION BY measurement ORDER BY window_start)) x WHERE p95 > base_p95 * 2 OR p99 > base_p99 * 5""",
    "ts_moving_alerts": f"""SELECT measurement, window_start, samples, {', '.join(f"{half_up(c, 6)} AS {c}" for c in ('p95', 'p99', 'base_p95', 'base_p99'))}, base_windows
        FROM (SELECT *, avg(p95) OVER w AS base_p95, avg(p99) OVER w AS base_p99, count(p95) OVER w AS base_windows FROM (
        SELECT measurement, {_bucketed('1 day')} AS window_start, count(*) AS samples, quantile_cont(value, 0.95) AS p95,
               quantile_cont(value, 0.99) AS p99 FROM {{b_metrics}} GROUP BY 1, 2) t
        WINDOW w AS (PARTITION BY measurement ORDER BY window_start RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 SECOND PRECEDING)) x
        WHERE p95 > base_p95 * 2 OR p99 > base_p99 * 5""",
    "ts_sketch_rollup": " UNION ALL ".join(f"""SELECT '{every}' AS every, {_bucketed(every)} AS window_start, measurement, count(value) AS samples,
        true AS within, true AS distinct_within FROM {{b_metrics}} WHERE value IS NOT NULL GROUP BY ALL""" for every in ("1 hour", "1 day")),
    "stream_sketch_rollup": f"""SELECT '1 day' AS every, {_bucketed('1 day')} AS window_start, measurement, count(value) AS samples,
        true AS within, true AS distinct_within FROM {{b_metrics}} WHERE value IS NOT NULL GROUP BY ALL""",
    "ts_heartbeat_gaps": """SELECT measurement, prev AS gap_start, ts AS gap_end,
        CAST(epoch_us(ts) - epoch_us(prev) AS DOUBLE) / 1000000.0 AS gap_seconds
        FROM (SELECT *, lag(ts) OVER (PARTITION BY measurement ORDER BY ts, event_id) AS prev FROM {b_metrics}) t
        WHERE epoch_us(ts) - epoch_us(prev) > 60000000""",
    # streams: every event is in a window or session
    "stream_tumbling_agg": f"""SELECT {_bucketed('5 minutes')} AS window_start, {_bucketed('5 minutes')} + INTERVAL 5 MINUTE AS window_end,
        event_type, count(*) AS events, {dbl('sum(CAST(value AS DECIMAL(18,2)))')} AS total FROM {{events}} GROUP BY 1, 2, 3""",
    "stream_sessions": """SELECT user_id, count(*) AS events, min(ts) AS first_event, max(ts) AS last_event
        FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s
              FROM (SELECT *, CASE WHEN prev IS NULL OR epoch_us(ts) // 1000000 - epoch_us(prev) // 1000000 > 1800
                                   THEN 1 ELSE 0 END AS opens
                    FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM {events}) a) b) c
        GROUP BY user_id, s""",
    "stream_dedup": "SELECT event_id, ts, user_id FROM {events}",
    # silver
    "silver_brands": f"""SELECT brand_id, brand_name, brand_country, created_at, {days_on('created_at', h('brand_id') + ' % 180')} AS updated_at,
        {LINEAGE} FROM (SELECT brand_id, upper(left(trim(brand_name), 1)) || lower(substr(trim(brand_name), 2)) AS brand_name,
            coalesce(upper(trim(brand_country)), 'UNKNOWN') AS brand_country, {parse('created_at')} AS created_at, {LINEAGE} FROM {{r_brands}}) t
        QUALIFY row_number() OVER (PARTITION BY brand_id ORDER BY created_at DESC, brand_name, brand_country) = 1""",
    "silver_categories": f"""SELECT trim(prcs_id) AS cate_id, regexp_replace(trim(prcs_name), '\\s+', ' ', 'g') AS cate_name,
        {parse('created_at')} AS created_at, {parse('updated_at')} AS updated_at, {LINEAGE} FROM {{r_categories}}
        WHERE prcs_id IS NOT NULL AND prcs_name IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY prcs_id ORDER BY {parse('updated_at')} DESC, {parse('created_at')} DESC) = 1""",
    "silver_customers": f"""SELECT acc_id, 'CUS' || ({pad('CAST(seq AS STRING)', 6)}) AS cus_id, last_name, first_name,
        {plain_letters('first_name')} || '.' || {plain_letters("replace(last_name, ' ', '')")} || lpad(CAST({h('user_id')} % 999 AS STRING), 3, '0')
            || '@gmail.com' AS email, coalesce('0' || CAST(user_phone AS STRING), 'UNKNOWN') AS phone_number, gender, birth_date,
        datediff('day', birth_date, DATE '2024-06-30') // 365 AS age, district, city,
        {plain_letters('first_name')} || '_' || substr(acc_id, 4, 8) AS account_name, {rank_of('coalesce(spent, 0)')} AS customer_rank,
        true AS is_active, CAST(datediff('day', CAST(created_at AS DATE), DATE '2024-06-30') AS INT) AS account_age_days, created_at,
        {days_on('created_at', h('user_id') + ' % 365')} AS updated_at, {LINEAGE}
        FROM (SELECT *, 'ACC' || ({pad(digits('user_id', 'KH'), 8)}) AS acc_id, {FIRST} AS first_name, {LAST} AS last_name, {GENDER} AS gender,
                     try_cast(user_born AS DATE) AS birth_date, string_split(user_address, ', ')[1] AS district,
                     string_split(user_address, ', ')[2] AS city, {parse('user_createdat')} AS created_at,
                     dense_rank() OVER (ORDER BY coalesce(user_email, 'unknown') || '_' || coalesce(CAST(user_phone AS STRING), 'unknown')) AS seq,
                     CAST(substr(user_id, 3) AS BIGINT) AS number FROM {{r_users}}) u
        LEFT JOIN (SELECT acc_id AS number, sum(total_amount) * 100 AS spent FROM {{b_orders}} GROUP BY 1) s USING (number)""",
    "silver_employees": f"""SELECT emp_id AS employee_id, {LAST.replace('user_name', 'emp_name')} AS last_name,
        {FIRST.replace('user_name', 'emp_name')} AS first_name,
        CASE WHEN lower(trim(emp_gender)) IN ('female', 'f') THEN 'Female' ELSE 'Male' END AS gender,
        '0' || lpad(CAST(emp_phone AS STRING), 9, '0') AS phone,
        {plain_letters(FIRST.replace('user_name', 'emp_name'))} || {plain_letters("string_split(emp_name, ' ')[1]")} || replace(emp_id, 'EP', '')
            || '@shop.example' AS email, emp_born AS born, emp_address AS address,
        CAST({days_on('ingestion_time', h('emp_id') + ' % 365')} AS DATE) AS recruited_at, emp_account AS username, emp_password AS password,
        emp_role AS role, sub_id AS subsidiary_id, {LINEAGE} FROM {{r_employees}} WHERE emp_phone IS NOT NULL AND emp_role IS NOT NULL""",
    "silver_sub_products": "SELECT * FROM {o_sub_products}",
    "silver_products": f"""SELECT * REPLACE ({dbl('product_listprice')} AS product_listprice, {dbl('product_volume_cm3')} AS product_volume_cm3),
        CASE WHEN product_volume_cm3 > 0 THEN {dbl('CAST(product_weight_g / product_volume_cm3 AS DECIMAL(18,4))')} ELSE 0.0 END AS product_density_g_cm3,
        'https://cdn.shop.example/products/' || product_id || '/' || product_version || '.jpg' AS product_photos_link
        FROM {{o_products}}""",
    "silver_subsidiaries": f"""SELECT sub_id, 'Subsidiary ' || substr(sub_name, 6) AS sub_name, '0' || CAST(sub_phone AS STRING) AS phone_number,
        establishment_date, sub_street, sub_district, sub_city, CAST(created_at AS DATE) AS created_at, CAST(updated_at AS DATE) AS updated_at,
        {LINEAGE} FROM {{r_subsidiaries}}""",
    "silver_program_sales": f"SELECT * REPLACE ({dbl('discount_value')} AS discount_value) FROM {{o_program_sales}}",
    "silver_cart_items": f"""SELECT * REPLACE ({dbl('list_price')} AS list_price, {dbl('item_total_amount')} AS item_total_amount,
        CAST(quantity AS INT) AS quantity) FROM {{o_cart_items}}""",
    "silver_carts": f"""SELECT b.cart_id, acc_id, {cart_state('updated_at', '2023-12-31', "'status'", 'b.cart_id')} AS cart_status,
        coalesce(n, 0) AS total_items, {dbl('coalesce(v, 0)')} AS total_amount, created_at, updated_at, {LINEAGE}
        FROM {{o_carts_base}} b LEFT JOIN (SELECT cart_id, count(DISTINCT product_id) AS n, sum(item_total_amount) AS v
            FROM {{o_cart_items}} GROUP BY 1) i ON b.cart_id = i.cart_id""",
    "silver_order_items": f"""SELECT * REPLACE ({', '.join(f"{dbl(c)} AS {c}" for c in ('list_price', 'discount_rate', 'sale_price',
        'total_price', 'item_total_weight_g', 'shipping_distance_km', 'shipping_fee'))}) FROM {{o_order_items}}""",
    "silver_orders": f"""SELECT * REPLACE ({dbl('total_amount')} AS total_amount, {dbl('total_shipfee')} AS total_shipfee) FROM {{o_orders}}""",
    "silver_payments": f"""SELECT p.payment_id, order_id, payment_method, payment_status, {dbl('payment_amount')} AS payment_amount, paid_at,
        CASE WHEN payment_status = 'REFUNDED' THEN {later('paid_at', off(3600, 72 * 3600 - 1, "'refunded'", 'order_id'))} END AS refund_at,
        created_at, coalesce(u, created_at) AS updated_at, coalesce(ingestion_time, TIMESTAMP '2024-06-30 00:00:00') AS ingestion_time,
        coalesce(source_file, 'GENERATED_FROM_ORDERS') AS source_file
        FROM {{o_payments}} p LEFT JOIN (SELECT trim(payment_id) AS payment_id, {parse('updated_at')} AS u, {LINEAGE} FROM {{r_payments}}) r
        ON p.payment_id = r.payment_id""",
    "silver_reviews": f"""SELECT 'RV' || ({pad('CAST(review_no AS STRING)', 6)}) AS review_id, order_id, product_id,
        {weighted(quoted([("PUBLISHED", 95), ("HIDDEN", 3), ("REPORTED", 2)]), "'status'", 'order_id', 'order_item_id')} AS review_status,
        {dbl('review_score')} AS review_score, review_title, review_message, created_at,
        CASE WHEN {h("'reply'", 'order_id', 'order_item_id')} % 2 = 0
             THEN {later('created_at', off(86400, 5 * 86400 - 1, "'replied'", 'order_id', 'order_item_id'))} END AS replied_at,
        {h("'reply'", 'order_id', 'order_item_id')} % 2 = 0 AS has_reply,
        review_title IS NULL AND review_message IS NULL AS is_missing_comment, review_title IS NOT NULL AND review_message IS NULL AS has_title_only,
        review_title IS NULL AND review_message IS NOT NULL AS has_message_only,
        review_title IS NOT NULL AND review_message IS NOT NULL AS is_complete_review, review_score >= 4 AS is_positive_review,
        review_score >= 3 AND review_score < 4 AS is_neutral_review, review_score < 3 AS is_negative_review, {RAW_SENTIMENT},
        TIMESTAMP '2024-06-30 00:00:00' AS ingestion_time, 'generated_reviews' AS source_file FROM {{o_reviews}}""",
    "silver_product_sales": f"""SELECT product_id, sale_id, created_at,
        {later('created_at', off(0, 'days * 86400', "'updated'", 'product_id', 'sale_id'))} AS updated_at
        FROM (SELECT product_id, sale_id, days, {days_on('first', '-days')} AS created_at
              FROM (SELECT *, {off(7, 90, "'created'", 'product_id', 'sale_id')} AS days
                    FROM (SELECT product_id, sale_id, min(created_at) AS first FROM {{o_order_items}} WHERE sale_id IS NOT NULL GROUP BY 1, 2) a) b) c""",
    "silver_product_scores": f"""SELECT product_id, count(*) AS review_count, CAST({ratio('sum(review_score)', 'count(*)')} AS FLOAT) AS avg_rating
        FROM {{o_reviews}} GROUP BY 1""",
    "silver_behaviors": f"""SELECT acc_id, 'SS' || ({pad('CAST(dense_rank() OVER (ORDER BY acc_id, session_no) AS STRING)', 8)}) AS session_id, event_time,
        CASE WHEN event_type = 'purchase' AND checkouts = 0 THEN 'view' WHEN event_type = 'checkout' AND carts = 0 THEN 'add_to_cart'
             WHEN event_type = 'remove_from_cart' AND carts = 0 THEN 'view' ELSE event_type END AS event_type,
        product_id, device_type, time_on_page_minutes, event_time AS created_at, TIMESTAMP '2024-06-30 00:00:00' AS updated_at, {LINEAGE}
        FROM (SELECT *,
                     count(*) FILTER (event_type = 'add_to_cart') OVER w AS carts, count(*) FILTER (event_type = 'checkout') OVER w AS checkouts
              FROM {{o_sessions}} WINDOW w AS (PARTITION BY acc_id, session_no ORDER BY event_time, event_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) t""",
    # gold
    "gold_brand_performance": f"""SELECT *, {half_up(ratio('total_revenue_oht * 10000000', '(SELECT sum(total_amount) FROM {b_orders})'))} AS revenue_share_pct
        FROM (SELECT p.brand_id, brand_name, count(*) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_products_sold,
                     {half_up(ratio('sum(total_price)', '100000'), 5)} AS total_revenue_oht,
                     {half_up(ratio('sum(total_price)', 'count(*) * 100000'), 5)} AS avg_order_value_oht
              FROM {{b_order_items}} i JOIN {{b_products}} p ON i.product_id = p.product_id JOIN {{b_brands}} b ON b.brand_id = p.brand_id GROUP BY 1, 2) t""",
    "gold_brand_reviewed": f"""SELECT brand_id, brand_name, score AS avg_review_score, pos AS total_positive_reviews, neu AS total_neutral_reviews,
        neg AS total_negative_reviews, {pct('pos', 'pos + neu + neg')} AS positive_review_rate, {pct('neg', 'pos + neu + neg')} AS negative_review_rate,
        {pct('neu', 'pos + neu + neg')} AS neutral_review_rate
        FROM (SELECT p.brand_id, brand_name, {ratio('sum(review_score)', 'count(*)')} AS score, count(*) FILTER (review_score >= 4) AS pos,
                     count(*) FILTER (review_score < 4 AND review_score > 2.5) AS neu, count(*) FILTER (review_score <= 2.5) AS neg
              FROM {{b_products}} p JOIN {{b_reviews}} r ON p.product_id = r.product_id JOIN {{b_brands}} b ON p.brand_id = b.brand_id GROUP BY 1, 2) t""",
    "gold_campaign_performance": f"""SELECT p.sale_id, sale_name, start_date, end_date, total_products,
        CAST(datediff('day', start_date, end_date) AS INT) AS duration_days, total_orders, total_quantity_sold, {dbl('v')} AS total_revenue,
        {half_up(ratio('v', 'total_orders'))} AS avg_revenue, {dbl('org')} AS total_org_price, {dbl('sale')} AS total_sale_price, total_customers,
        new_customers, returning_customers, {dbl('org - sale')} AS total_discount_amount
        FROM {{b_program_sales}} p
        JOIN (SELECT sale_id, count(*) AS total_products FROM {{b_product_sales}} GROUP BY 1) a ON p.sale_id = a.sale_id
        JOIN (SELECT sale_id, count(*) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold, sum(total_price) AS v,
                     sum(list_price * quantity) AS org, sum(sale_price * quantity) AS sale FROM {{b_order_items}} GROUP BY 1) b ON p.sale_id = b.sale_id
        JOIN (SELECT sale_id, count(DISTINCT acc_id) AS total_customers, count(DISTINCT CASE WHEN ever = here THEN acc_id END) AS new_customers,
                     count(DISTINCT CASE WHEN ever < here THEN acc_id END) AS returning_customers
              FROM (SELECT sale_id, o.acc_id, ever, min(o.created_at) AS here FROM {{b_order_items}} i JOIN {{b_orders}} o ON i.order_id = o.order_id
                    JOIN (SELECT acc_id, min(created_at) AS ever FROM {{b_orders}} GROUP BY 1) f ON o.acc_id = f.acc_id
                    GROUP BY 1, 2, 3) x GROUP BY 1) c ON p.sale_id = c.sale_id""",
    "gold_category_metrix": f"""SELECT category_id, cate_name, count(*) AS total_products,
        {', '.join(f"{half_up(ratio(f'sum({c})', 'count(*)'))} AS {n}" for n, c in {
            'avg_weight_g': 'product_weight_g', 'avg_length_cm': 'product_length_cm', 'avg_height_cm': 'product_height_cm',
            'avg_width_cm': 'product_width_cm', 'avg_volume_cm3': 'product_volume_cm3',
            'avg_density_g_cm3': 'CAST(product_weight_g / product_volume_cm3 AS DECIMAL(18,4))'}.items())},
        max(product_weight_g) AS max_weight, min(product_weight_g) AS min_weight
        FROM {{b_products}} JOIN {{b_categories}} ON category_id = cate_id GROUP BY 1, 2""",
    "gold_category_performance": _category_performance(False),
    "gold_category_performance_exact": _category_performance(True),
    "gold_category_status": f"""SELECT *, {', '.join(f"{pct(f'{s}_products', 'total_products')} AS {s}_rate" for s in ('active', 'inactive', 'discontinued', 'out_of_stock'))}
        FROM (SELECT category_id, cate_name, count(*) AS total_products,
              {', '.join(f"count(*) FILTER (product_status = '{s.upper()}') AS {s}_products" for s in ('active', 'inactive', 'discontinued', 'out_of_stock'))}
              FROM {{b_products}} JOIN {{b_categories}} ON category_id = cate_id GROUP BY 1, 2) t""",
    "gold_customer_360": f"SELECT * REPLACE ({dbl('total_spent')} AS total_spent) FROM {{o_360}}",
    "gold_customer_reviews": "SELECT * FROM {o_creviews}",
    "gold_customer_rfm": f"""SELECT acc_id, customer_name, recency_days, frequency_orders, {dbl('monetary_value')} AS monetary_value, r_score, f_score, m_score,
        concat(r_score, f_score, m_score) AS rfm_score,
        CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions' WHEN f_score >= 4 AND m_score >= 4 THEN 'Loyal Customers'
             WHEN r_score >= 4 AND f_score >= 3 THEN 'Potential Loyalists' WHEN m_score >= 4 AND f_score <= 3 THEN 'Big Spenders'
             WHEN r_score >= 4 AND f_score <= 2 THEN 'New Customers' WHEN r_score >= 3 AND f_score >= 2 AND m_score >= 2 THEN 'Promising'
             WHEN r_score >= 3 AND f_score >= 3 THEN 'Need Attention' WHEN r_score <= 2 AND (f_score >= 3 OR m_score >= 3) THEN 'At Risk'
             WHEN r_score <= 2 AND f_score >= 2 AND m_score >= 2 THEN 'Hibernating'
             WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN 'Lost' ELSE 'Others' END AS customer_segment,
        avg_order_value, avg_review_score, customer_rank, last_order_date, DATE '2023-12-29' AS analysis_date
        FROM (SELECT *, CAST(ntile(5) OVER (ORDER BY recency_days, acc_id) AS INT) AS r_score,
                     CAST(ntile(5) OVER (ORDER BY frequency_orders, acc_id) AS INT) AS f_score,
                     CAST(ntile(5) OVER (ORDER BY monetary_value, acc_id) AS INT) AS m_score
              FROM (SELECT c.acc_id, concat(first_name, ' ', last_name) AS customer_name,
                           CAST(datediff('day', CAST(last_order AS DATE), DATE '2023-12-29') AS INT) AS recency_days, total_orders AS frequency_orders,
                           total_spent AS monetary_value, {half_up('avg_order_value')} AS avg_order_value,
                           {half_up('coalesce(avg_review_score, 0)')} AS avg_review_score, customer_rank, CAST(last_order AS DATE) AS last_order_date
                    FROM {{o_360}} c LEFT JOIN {{o_creviews}} r ON c.acc_id = r.acc_id) a) b""",
    "gold_customer_top_city": "SELECT city, count(*) AS total_customer FROM {b_customers} GROUP BY 1",
    "gold_customer_top_district_danang": _district("NATION_1"),
    "gold_customer_top_district_hanoi": _district("NATION_2"),
    "gold_customer_top_district_hcm": _district("NATION_3"),
    "gold_order_360": f"""SELECT o.order_id, acc_id, created_at, dayofweek(created_at) IN (0, 6) AS is_weekend_purchase, order_status,
        {dbl('total_amount')} AS total_amount, {dbl('total_shipfee')} AS total_shipfee, {dbl('total_amount + total_shipfee')} AS grand_total,
        {half_up(ratio('total_shipfee', 'total_amount'), 5)} AS shipping_fee_ratio,
        CAST(datediff('day', CAST(created_at AS DATE), delivered_at) AS INT) AS delivery_day,
        CAST(CASE WHEN datediff('day', estimated_delivery_date, delivered_at) > 0 THEN datediff('day', estimated_delivery_date, delivered_at)
                  ELSE 0 END AS INT) AS delay_day,
        total_sold, total_items, {dbl('weight')} AS total_weight_sold, {dbl('volume')} AS total_volume_sold, avg_price_per_item, avg_distance_km,
        max_distance_km, min_distance_km, avg_fee, avg_review, total_reviews, has_reply, reply_in, positive_reviews, negative_reviews, neutral_reviews,
        CASE WHEN total_amount > 100000000 THEN 'HIGH' WHEN total_amount > 50000000 THEN 'MEDIUM' ELSE 'LOW' END AS order_value_segment,
        CASE WHEN volume > 300000 THEN 'HIGH' WHEN volume > 200000 THEN 'MEDIUM' ELSE 'LOW' END AS product_volume_segment,
        CASE WHEN weight > 100000 THEN 'HIGH' WHEN weight > 60000 THEN 'MEDIUM' ELSE 'LOW' END AS product_weight_segment
        FROM {{b_orders}} o LEFT JOIN (
            SELECT order_id, CAST(sum(quantity) AS BIGINT) AS total_sold, count(*) AS total_items, sum(quantity * product_weight_g) AS weight,
                   sum(quantity * product_volume_cm3) AS volume, {half_up(ratio('sum(total_price)', 'count(*)'))} AS avg_price_per_item,
                   {half_up(ratio('sum(shipping_distance_km)', 'count(*)'))} AS avg_distance_km, {dbl('max(shipping_distance_km)')} AS max_distance_km,
                   {dbl('min(shipping_distance_km)')} AS min_distance_km, {half_up(ratio('sum(shipping_fee)', 'count(*)'))} AS avg_fee
            FROM {{b_order_items}} i JOIN {{b_products}} p ON i.product_id = p.product_id GROUP BY 1) p ON o.order_id = p.order_id
        LEFT JOIN (
            SELECT order_id, {half_up(ratio('sum(review_score)', 'count(*)'))} AS avg_review, count(*) AS total_reviews, bool_or(has_reply) AS has_reply,
                   {ratio("sum(datediff('day', created_at, replied_at))", "count(replied_at)")} AS reply_in,
                   {', '.join(f"count(*) FILTER (review_sentiment = '{s.title()}') AS {s}_reviews" for s in ('positive', 'negative', 'neutral'))}
            FROM {{o_reviews_b}} GROUP BY 1) r ON o.order_id = r.order_id""",
    "gold_order_performance": ORDER_PERFORMANCE,
    "gold_payments_analysis": f"""SELECT payment_method, total_orders, total_paid, total_pending, total_failed, total_refunded, total_customers,
        {dbl('v')} AS total_revenue, {_rate('v', 'total_orders')} AS avg_order_value, max_items, min_items,
        CASE WHEN payment_method IN ('BANKING', 'MOMO', 'ZALOPAY', 'VNPAY', 'CREDIT_CARD') THEN 'ONLINE' ELSE 'OFFLINE' END AS payment_channel,
        {_rate('v', '(SELECT sum(total_amount) FROM {b_orders})')} AS payment_share_pct,
        {_rate('total_customers', '(SELECT count(DISTINCT acc_id) FROM {b_orders})')} AS payment_customers_pct,
        {_rate('total_paid', 'total_orders')} AS payment_success_rate, {_rate('total_pending', 'total_orders')} AS payment_pending_rate,
        {_rate('total_failed', 'total_orders')} AS payment_failed_rate, {_rate('total_refunded', 'total_orders')} AS payment_refunded_rate
        FROM (SELECT payment_method, count(*) AS total_orders, count(*) FILTER (payment_status = 'SUCCESS') AS total_paid,
                     count(*) FILTER (payment_status = 'PENDING') AS total_pending, count(*) FILTER (payment_status = 'FAILED') AS total_failed,
                     count(*) FILTER (payment_status = 'REFUNDED') AS total_refunded, count(DISTINCT acc_id) AS total_customers,
                     sum(payment_amount) AS v, max(n) AS max_items, min(n) AS min_items
              FROM {{b_payments}} p JOIN {{b_orders}} o ON p.order_id = o.order_id
              JOIN (SELECT order_id, count(*) AS n FROM {{b_order_items}} GROUP BY 1) s ON p.order_id = s.order_id GROUP BY 1) t""",
    "gold_product_performance": _product_performance(False),
    "gold_product_performance_exact": _product_performance(True) + " WHERE p.product_id IN (SELECT product_id FROM {b_reviews})",
    "gold_shipping_city_district_performance": f"""SELECT target_city, target_district, count(*) AS total_orders,
        {_rate('sum(total_shipfee)', 'count(*)')} AS avg_fee, {_rate('sum(total_amount)', 'count(*)')} AS avg_revenue,
        {_rate("sum(datediff('day', shipped_at, delivered_at))", "count(datediff('day', shipped_at, delivered_at))")} AS avg_days,
        CAST(max(datediff('day', shipped_at, delivered_at)) AS INT) AS max_days, CAST(min(datediff('day', shipped_at, delivered_at)) AS INT) AS min_days,
        {pct('count(*) FILTER (delivered_at < estimated_delivery_date)', 'count(*)')} AS ontime_rate FROM {{b_orders}} GROUP BY 1, 2""",
    "gold_subsidiary_performance": f"""SELECT sub_id, sub_name, sub_district, upper(left(sub_city, 1)) || lower(substr(sub_city, 2)) AS sub_city,
        count(*) AS total_orders, count(DISTINCT acc_id) AS total_customers, {half_up(ratio('sum(sale_price)', '100000'), 3)} AS total_revenue,
        {half_up(ratio('sum(total_price)', 'count(*) * 100000'), 3)} AS avg_order_value
        FROM {{b_subsidiaries}} s JOIN {{b_order_items}} i ON s.sub_id = i.subsidiary_id JOIN {{b_orders}} o ON i.order_id = o.order_id GROUP BY 1, 2, 3, 4""",
    "gold_subsidiary_shipping_performance": _subsidiary_shipping(False),
    "gold_subsidiary_shipping_performance_exact": _subsidiary_shipping(True),
    # quality
    "dq_bronze_report": f"""SELECT true AS is_valid, count(*) AS row_count, 13 AS column_count, count(*) - count(DISTINCT user_id) AS duplicate_count,
        (count(*) - count(user_email)) + (count(*) - count(user_phone)) AS null_count,
        {_profile_text(USER_COLUMNS, 'r_users', False)} AS null_details, true AS schema_valid, '' AS error_messages,
        concat_ws(',', 'nulls in ' || concat_ws(', ', CASE WHEN count(*) > count(user_email) THEN 'user_email' END,
            CASE WHEN count(*) > count(user_phone) THEN 'user_phone' END)) AS warning_messages FROM {{r_users}}""",
    "dq_incremental_profile": """SELECT count(*) AS row_count, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {o_lines}) d) AS duplicate_count,
        count(*) - count(l_tax) AS null_tax, count(*) - count(l_discount) AS null_discount FROM {o_lines}""",
    "dq_silver_report": f"""SELECT true AS is_valid, count(*) AS row_count, 5 AS column_count,
        count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {{documents}}) d) AS duplicate_count, CAST(0 AS BIGINT) AS null_count,
        {_profile_text(DOCUMENT_COLUMNS, 'documents', True)} AS null_details, true AS schema_valid, '' AS error_messages, '' AS warning_messages
        FROM {{documents}}""",
}

EMPLOYEE_COLUMNS = ["emp_id", "emp_name", "emp_gender", "emp_phone", "emp_email", "emp_born", "emp_address", "emp_account",
                    "emp_password", "emp_role", "sub_id", "ingestion_time", "source_file"]
ORDER_COLUMNS = ["order_id", "acc_id", "order_status", "total_amount", "total_shipfee", "target_city", "target_district",
                 "created_at", "confirmed_at", "shipped_at", "estimated_delivery_date", "delivered_at"]
BRAND_COLUMNS = ["brand_id", "brand_name", "brand_country", "created_at", "updated_at", "ingestion_time", "source_file"]
MONTH_COLUMNS = ["year", "month", "total_orders", "hope_total_revenue", "avg_order_value", "delivered_orders",
                 "real_total_revenue", "cancelled_orders", "cancelled_hopeful_revenue"]


def _record(table: str, key: str, columns: list[str], layer: str, fmt: str, all_columns: bool, dataset: str = "") -> str:
    nulls = [f"CASE WHEN count(*) > count({c}) THEN '{c}' END" for c in sorted(columns)]
    found = f"concat_ws(', ', {', '.join(nulls)})"
    name = f"'{dataset}' AS dataset, " if dataset else ""
    return f"""SELECT true AS is_valid, count(*) AS row_count, {len(columns)} AS column_count,
        count(*) - count(DISTINCT {key}) AS duplicate_count, {' + '.join(f'(count(*) - count({c}))' for c in columns)} AS null_count,
        {_profile_text(columns, table, all_columns)} AS null_details, true AS schema_valid, '' AS error_messages,
        CASE WHEN {found} <> '' THEN 'nulls in ' || {found} ELSE '' END AS warning_messages, {name}'{layer}' AS layer,
        '{fmt}' AS format, '{','.join(columns)}' AS columns, 'quaymark' AS framework, '1.0.0' AS framework_version
        FROM {table}"""


_GOLD_RECORD = f"""SELECT count(DISTINCT date_trunc('month', created_at)) AS row_count, {len(MONTH_COLUMNS)} AS column_count,
    'order_performance' AS query_name, 'gold' AS layer, 'SUCCESS' AS status, 'parquet' AS format, '{','.join(MONTH_COLUMNS)}' AS columns,
    'quaymark' AS framework, '1.0.0' AS framework_version FROM {{b_orders}}"""
_QUOTED_COLUMNS = ",".join(f'"{c}"' for c in MONTH_COLUMNS)
_GOLD_JSON = f'''SELECT '{{{{"row_count":' || count(DISTINCT date_trunc('month', created_at)) || ',"column_count":{len(MONTH_COLUMNS)},'
    || '"query_name":"order_performance","target_table":"gold.order_performance","layer":"gold","object_path":"/gold/order_performance",'
    || '"status":"SUCCESS","format":"parquet","processing_duration":null,"columns":[{_QUOTED_COLUMNS}],'
    || '"framework":"quaymark","framework_version":"1.0.0"}}}}' AS record FROM {{b_orders}}'''
ORACLES |= {
    "meta_bronze": _record("{r_employees}", "emp_id", EMPLOYEE_COLUMNS, "bronze", "csv", False, "employees"),
    "layer_bronze": _record("{r_employees}", "emp_id", EMPLOYEE_COLUMNS, "bronze", "csv", False, "employees"),
    "meta_silver": _record("{b_orders}", "order_id", ORDER_COLUMNS, "silver", "parquet", True, "orders"),
    "layer_silver": _record(f"({ORACLES['silver_brands']}) t", "brand_id", BRAND_COLUMNS, "silver", "parquet", True),
    "agg_approx_distinct": """SELECT subsidiary_id, count(DISTINCT product_id) AS products, true AS within FROM {b_order_items} GROUP BY 1""",
    "ts_percentiles_approx": "SELECT measurement, count(value) AS samples, true AS within FROM {b_metrics} GROUP BY 1 HAVING count(value) > 0",
    "meta_as_json": _GOLD_JSON,
    "meta_gold": _GOLD_RECORD,
    "layer_gold": _GOLD_RECORD,
}

#: What gold reads in a run over all layers, by the binding that stands in for it elsewhere.
_WRITTEN = {
    "b_orders": "o_orders", "b_order_items": "o_order_items", "b_products": "o_products", "b_customers": "w_customers",
    "b_brands": "w_brands", "b_categories": "w_categories", "b_subsidiaries": "r_subsidiaries",
    "b_program_sales": "o_program_sales", "b_product_sales": "w_product_sales", "b_payments": "o_payments", "b_reviews": "w_reviews",
    "o_customers": "w_customers", "o_reviews_b": "w_reviews",
}
O |= {
    "w_customers": ORACLES["silver_customers"],
    "w_brands": ORACLES["silver_brands"],
    "w_categories": ORACLES["silver_categories"],
    "w_product_sales": ORACLES["silver_product_sales"],
    "w_reviews": f"SELECT *, review_no AS review_id, {SENTIMENT} AS review_sentiment, {off(0, 1, "'reply'", 'order_id', 'order_item_id')} = 0 AS has_reply, "
                 f"{later('created_at', off(86400, 5 * 86400 - 1, "'replied'", 'order_id', 'order_item_id'))} AS replied_at FROM {{o_reviews}}",
}
ALL |= O


def _on_written(text: str) -> str:
    """A gold query's text, reading what silver wrote."""
    for name in names_in(text):
        if name in _WRITTEN:
            text = text.replace(f"{{{name}}}", f"{{{_WRITTEN[name]}}}")
        elif name in O and name not in _WRITTEN.values() and any(n in _WRITTEN for n in bindings_of(name)):
            ALL[f"w_{name}"] = _on_written(O[name])
            text = text.replace(f"{{{name}}}", f"{{w_{name}}}")
    return text


def bindings_of(name: str) -> list[str]:
    seen: list[str] = []
    _needed(ALL[name], seen)
    return seen


def _counted(layer: str, name: str, text: str, quarantined: str = "0", listed: bool = True) -> str:
    return (f"SELECT '{layer}' AS layer, '{name}' AS table_name, 'SUCCESS' AS status, (SELECT count(*) FROM ({text}) t) AS row_count, "
            f"CAST({quarantined} AS BIGINT) AS quarantined, {str(listed).lower()} AS listed")


_RAW = ("users", "brands", "categories", "employees", "products", "subsidiaries", "sub_products", "program_sales", "orders",
        "order_items", "payments", "carts", "cart_items", "user_behaviors")
_GOLD = [n.removeprefix("gold_") for n in ORACLES if n.startswith("gold_") and not n.endswith("_exact")]
_SILVER = {n.removeprefix("silver_"): text for n, text in ORACLES.items() if n.startswith("silver_")}
_SILVER |= {n: f"SELECT * FROM {{o_{n}}}" for n in ("carts_base", "orders_base")}
_REJECTED = "(SELECT count(*) FROM {o_judged} WHERE reasons <> '')"
ORACLES["run_warehouse"] = " UNION ALL ".join([
    *[_counted("bronze", n, f"SELECT * FROM {{r_{n}}}", listed=False) for n in _RAW],
    _counted("bronze", "addresses", "SELECT * FROM {addresses}", listed=False),
    *[_counted("silver", n, text, _REJECTED if n == "behaviors" else "0") for n, text in _SILVER.items()],
    *[_counted("gold", n, _on_written(ORACLES[f"gold_{n}"])) for n in _GOLD],
])

_AGAIN = ("brands", "categories", "sub_products", "products", "subsidiaries", "program_sales")


def _attempt(number: int, layer: str, name: str, text: str | None, status: str = "SUCCESS", error: str = "NULL", resumed: bool = False) -> str:
    rows = f"(SELECT count(*) FROM ({text}) t)" if text else "CAST(NULL AS BIGINT)"
    return (f"SELECT CAST({number} AS INT) AS attempt, '{layer}' AS layer, '{name}' AS table_name, '{status}' AS status, {rows} AS row_count, "
            f"{str(resumed).lower()} AS resumed, CAST({error} AS VARCHAR) AS error")


def _stopped_and_resumed() -> str:
    parts = []
    for number, fails in ((1, True), (2, False)):
        parts += [_attempt(number, "bronze", n, f"SELECT * FROM {{r_{n}}}", resumed=not fails) for n in _AGAIN]
        stopped = False
        for n in ("brands", "categories", "sub_products", "products", "subsidiaries", "program_sales"):
            if fails and n == "products":
                parts.append(_attempt(number, "silver", n, None, "FAILED", "'no products today'"))
                stopped = True
            elif stopped:
                parts.append(_attempt(number, "silver", n, None, "NOT RUN"))
            else:
                parts.append(_attempt(number, "silver", n, _SILVER[n], resumed=not fails and n in ("brands", "categories", "sub_products")))
        for n in ("category_metrix", "category_status"):
            text = _on_written(ORACLES[f"gold_{n}"])
            parts.append(_attempt(number, "gold", n, None, "NOT RUN") if fails else _attempt(number, "gold", n, text))
    return " UNION ALL ".join(parts)


ORACLES["run_stopped_and_resumed"] = _stopped_and_resumed()
ORACLES["stream_log_routes"] = f"""SELECT *, CASE WHEN dag_id LIKE '%bronze%' THEN 'bronze' WHEN dag_id LIKE '%silver%' THEN 'silver'
        WHEN dag_id LIKE '%gold%' THEN 'gold' WHEN dag_id LIKE '%master%' THEN 'orchestration' END AS layer,
        CASE WHEN regexp_matches(log_message, '(?i)(error|exception|failed|traceback|fatal)') THEN 'high'
             WHEN log_level = 'warning' THEN 'medium' ELSE 'low' END AS severity, CASE WHEN tags <> '' THEN 'failed' ELSE 'parsed' END AS route
    FROM ({ORACLES['log_structure_lines']}) t WHERE NOT coalesce(log_message LIKE '%Heartbeat%' AND log_level = 'debug', false)"""


def all_sql() -> dict[str, str]:
    return {name: complete(text) for name, text in ORACLES.items()}
