"""Business rules: recodes, bands and status decisions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .hashing import weighted_choice
from .text import canonical

# Accepted spellings of each canonical word.
DEVICES = {
    "Desktop": ("desktop", "pc", "computer"),
    "Mobile": ("mobile", "phone", "smartphone"),
    "Tablet": ("tablet", "ipad"),
}
EVENT_TYPES = {
    "view": ("view", "page_view", "product_view"),
    "click": ("click", "button_click", "link_click"),
    "search": ("search", "query", "search_query"),
    "add_to_cart": ("add_to_cart", "cart_add", "add_cart"),
    "remove_from_cart": ("remove_from_cart", "cart_remove", "remove_cart"),
    "checkout": ("checkout", "begin_checkout"),
    "purchase": ("purchase", "order", "buy"),
    "wishlist": ("wishlist", "add_to_wishlist", "save"),
}
GENDERS = {"Male": ("male", "m"), "Female": ("female", "f")}

# Lower bound of each spend rank, in currency units.
SPEND_RANKS = (
    ("COPPER", 0),
    ("SILVER", 50_000_000),
    ("GOLD", 120_000_000),
    ("PLATINUM", 250_000_000),
    ("DIAMOND", 450_000_000),
    ("VIP", 780_000_000),
)

# Percentages of the weighted choices.
EVENT_WEIGHTS = (
    ("view", 35), ("search", 20), ("click", 15), ("add_to_cart", 12),
    ("wishlist", 7), ("checkout", 5), ("remove_from_cart", 3), ("purchase", 3),
)
SCORE_WEIGHTS = (
    (5.0, 30), (4.5, 20), (4.0, 15), (3.5, 10), (3.0, 10), (2.5, 5), (2.0, 4), (1.5, 3), (1.0, 3),
)
REVIEW_STATUS_WEIGHTS = (("PUBLISHED", 95), ("HIDDEN", 3), ("REPORTED", 2))
CART_STATUS_WEIGHTS = (("ACTIVE", 85), ("ABANDONED", 10), ("EXPIRED", 5))
COMMENT_WEIGHTS = (("NORMAL", 85), ("TITLE_ONLY", 5), ("MESSAGE_ONLY", 8), ("MISSING_BOTH", 2))
PAYMENT_METHODS = ("COD", "BANKING", "MOMO", "ZALOPAY", "VNPAY", "CREDIT_CARD")
ONLINE_METHODS = ("BANKING", "MOMO", "ZALOPAY", "VNPAY", "CREDIT_CARD")


def first_match(cases: Sequence[tuple[Column, object]], otherwise: object) -> Column:
    """The value of the first condition that holds."""
    head, *tail = cases
    out = F.when(head[0], F.lit(head[1]))
    for test, value in tail:
        out = out.when(test, F.lit(value))
    return out.otherwise(F.lit(otherwise))


def recode(c: Column, spellings: Mapping[str, Sequence[str]], default: str) -> Column:
    word = canonical(c)
    return first_match([(word.isin(*known), name) for name, known in spellings.items()], default)


def band(c: Column, bounds: Sequence[tuple[str, float]]) -> Column:
    """Name of the highest lower bound reached; the lowest name below all of them or for null."""
    return first_match([(c >= F.lit(low), name) for name, low in reversed(bounds[1:])], bounds[0][0])


def spend_rank(spent: Column) -> Column:
    return band(F.coalesce(spent, F.lit(0)), SPEND_RANKS)


def level(c: Column, high: float, medium: float) -> Column:
    return first_match([(c > F.lit(high), "HIGH"), (c > F.lit(medium), "MEDIUM")], "LOW")


def order_status(confirmed: Column, delivered: Column) -> Column:
    """From the timeline. CONFIRMED cannot occur: every confirmed order counts as shipped."""
    return first_match([(delivered.isNotNull(), "DELIVERED"), (confirmed.isNotNull(), "SHIPPED")], "PENDING")


def payment_status(method: Column, status: Column, *key: Column) -> Column:
    """Cash is paid on delivery; online is paid at once and half of the cancellations are refunded."""
    cancelled = weighted_choice((("REFUNDED", 50), ("FAILED", 50)), *key)
    cash = first_match([(status == "DELIVERED", "SUCCESS"), (status == "CANCELLED", "FAILED")], "PENDING")
    online = (
        F.when(status.isin("CONFIRMED", "SHIPPED", "DELIVERED"), "SUCCESS")
        .when(status == "CANCELLED", cancelled)
        .otherwise("PENDING")
    )
    return F.when(method == "COD", cash).otherwise(online)


def payment_channel(method: Column) -> Column:
    return first_match([(method.isin(*ONLINE_METHODS), "ONLINE")], "OFFLINE")


def cart_status(updated: Column, as_of: Column, *key: Column) -> Column:
    """Old carts have expired; the others are spread by weight."""
    return F.when(F.datediff(as_of, updated) > 120, "EXPIRED").otherwise(
        weighted_choice(CART_STATUS_WEIGHTS, *key)
    )


def stock_status(quantity: Column) -> Column:
    return first_match([(quantity > 0, "ACTIVE")], "INACTIVE")


def sentiment(score: Column) -> Column:
    return first_match([(score >= 4.0, "Positive"), (score < 3.0, "Negative")], "Neutral")


def sentiment_flags(score: Column) -> dict[str, Column]:
    return {
        "is_positive_review": score >= 4.0,
        "is_neutral_review": (score >= 3.0) & (score < 4.0),
        "is_negative_review": score < 3.0,
        "review_sentiment": sentiment(score),
    }


def presence_flags(first: Column, second: Column) -> dict[str, Column]:
    """Which of a title and a message are there."""
    return {
        "is_missing_comment": first.isNull() & second.isNull(),
        "has_title_only": first.isNotNull() & second.isNull(),
        "has_message_only": first.isNull() & second.isNotNull(),
        "is_complete_review": first.isNotNull() & second.isNotNull(),
    }


def shipping_zone(branch_city: Column, branch_district: Column, city: Column, district: Column) -> Column:
    """1 same district, 2 same city, 3 elsewhere or unknown."""
    same_city = branch_city == city
    return first_match([(same_city & (branch_district == district), 1), (same_city, 2)], 3)


def lookup_gender(first_name: Column, female: Sequence[str], male: Sequence[str]) -> Column:
    return first_match([(first_name.isin(*female), "Female"), (first_name.isin(*male), "Male")], "Unknown")


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """First rule that holds. The definition's rule for 'Cannot Lose Them' is left out: loyal customers cover all of it."""
    return first_match(
        [
            ((r >= 4) & (f >= 4) & (m >= 4), "Champions"),
            ((f >= 4) & (m >= 4), "Loyal Customers"),
            ((r >= 4) & (f >= 3), "Potential Loyalists"),
            ((m >= 4) & (f <= 3), "Big Spenders"),
            ((r >= 4) & (f <= 2), "New Customers"),
            ((r >= 3) & (f >= 2) & (m >= 2), "Promising"),
            ((r >= 3) & (f >= 3), "Need Attention"),
            ((r <= 2) & ((f >= 3) | (m >= 3)), "At Risk"),
            ((r <= 2) & (f >= 2) & (m >= 2), "Hibernating"),
            ((r <= 2) & (f <= 2) & (m <= 2), "Lost"),
        ],
        "Others",
    )
