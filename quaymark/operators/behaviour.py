"""Customer behaviour: sessions and funnel repair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import sequence_id
from ..functions.times import whole_seconds
from ..session import stage
from .ordered import ordered

GAP_MINUTES = 30


def sessionize(
    events: DataFrame,
    user: str = "acc_id",
    time: str = "event_time",
    tie: Sequence[str] = ("event_id",),
    gap_minutes: int = GAP_MINUTES,
    name: str = "session_no",
) -> DataFrame:
    """Number the sessions of each user: a new one starts after more than the gap, in whole seconds."""
    rows = ordered(events, [user], [time, *tie])
    seen = rows.previous(rows.frame, time, "_before")
    idle = whole_seconds(F.col(time)) - whole_seconds(F.col("_before"))
    opens = F.when(F.col("_before").isNull() | (idle > gap_minutes * 60), 1).otherwise(0)
    marked = seen.withColumn("_opens", opens)
    return rows.done(rows.running_sum(marked, F.col("_opens"), name)).drop("_before", "_opens")


def repair_funnel(
    events: DataFrame,
    session: Sequence[str] = ("acc_id", "session_no"),
    order: Sequence[str] = ("event_time", "event_id"),
    kind: str = "event_type",
) -> DataFrame:
    """Demote events whose earlier step is missing in the session.

    A purchase needs a checkout before it, a checkout and a removal need an add to cart. Earlier
    events count with their original type, also when they are demoted themselves.
    """
    rows = ordered(events, list(session), list(order))
    carts = F.when(F.col(kind) == "add_to_cart", 1).otherwise(0)
    checkouts = F.when(F.col(kind) == "checkout", 1).otherwise(0)
    counted = rows.running_sum(rows.frame, carts, "_carts", inclusive=False)
    counted = rows.running_sum(counted, checkouts, "_checkouts", inclusive=False)
    no_cart, no_checkout = F.col("_carts") == 0, F.col("_checkouts") == 0
    fixed = (
        F.when((F.col(kind) == "purchase") & no_checkout, "view")
        .when((F.col(kind) == "checkout") & no_cart, "add_to_cart")
        .when((F.col(kind) == "remove_from_cart") & no_cart, "view")
        .otherwise(F.col(kind))
    )
    return rows.done(counted.withColumn(kind, fixed)).drop("_carts", "_checkouts")


def rebuild_sessions(events: DataFrame, user: str = "acc_id") -> DataFrame:
    """Sessions, repaired funnels and a global session id.

    Sessions are numbered through from user to user in the order of their keys: a user's first number follows from
    how many sessions the users before have, so only users are sorted.
    """
    numbered = stage(sessionize(events, user), "sessions")
    repaired = repair_funnel(numbered, (user, "session_no"))
    each = numbered.groupBy(user).agg(F.max("session_no").alias("_sessions"))
    users = ordered(each, [], [user])
    before = users.done(users.running_sum(users.frame, F.col("_sessions"), "_start", inclusive=False))
    renamed = before.select(F.col(user).alias("_user"), "_start")
    keyed = repaired.join(renamed, repaired[user].eqNullSafe(renamed["_user"]))
    return keyed.withColumn("session_id", sequence_id(F.col("_start") + F.col("session_no"), "SS", 8)).drop(
        "_user", "_start", "session_no"
    )
