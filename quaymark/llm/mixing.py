"""Mixing by iterative proportional fitting, in DataFrame operations only.

Token weights per cell (source, language, topic) are raked: each round scales the cells to the target total of
every source, then language, then topic. A document of a cell is kept with the probability that its calibrated
weight asks for, scaled so that the cell in greatest demand is kept whole, and decided by a digest of its id. That
scale is the one `oracle` states; there the rarest cell sets what share of all documents is kept. With a budget
(`keep`, a share of all tokens) no cell sets it: no cell and no value is asked for more than it has, what it falls
short by goes to the others, and the kept tokens add up to the budget.

The targets flatten the mix: a value's share is its token share to a power, normalised. Cells live in a table
however many there are; each round aggregates them per margin and is written, so lineage stays short.

Cases: null sources and languages are values of their own; a null or blank text has no token and is kept when its
cell is (a cell without tokens keeps all its rows); repeated rows share their fate; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaymark.session import stage

from .common import unit_hash

ROUNDS = 12
POWER = 0.9
MARGINS = ("source", "lang", "topic")
#: Digits of a probability; finer ones would depend on the order of summation.
DIGITS = 9
#: The budget of the pipeline's mixing: the share of all tokens that is kept, whatever cells there are.
KEEP = 0.6
SEED = "mix"
WORD = "[^\\x20\\x09-\\x0D]+"


def words(text: str = "text") -> Column:
    """White-space words of a text: the token weight of a document."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def length_topic(tokens: Column) -> Column:
    """A stand-in for tables without a topic column: what kind of text it is, by its length."""
    return F.when(tokens < 64, "note").when(tokens < 256, "short").when(tokens < 1024, "article").otherwise("book")


def facts(docs: DataFrame, key: str = "doc_id", text: str = "text", topic: str | None = None) -> DataFrame:
    """doc_id, source, lang, topic, tokens: all that mixing reads of a document."""
    narrow = docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"), "source", "lang", words(text).alias("tokens"),
        *([F.col(f"`{topic}`").alias("topic")] if topic else []),
    )
    return narrow if topic else narrow.withColumn("topic", length_topic(F.col("tokens")))


def _target(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """Adds the total that each value of a margin should get: its share to a power, of all tokens."""
    share = cells.groupBy(margin).agg(F.sum("tokens").alias("_n")).withColumn("_flat", F.pow(F.col("_n").cast("double"), F.lit(power)))
    whole = share.agg(F.sum("_flat").alias("_all_flat"), F.sum("_n").alias("_all"))
    value = F.col("_flat") / F.col("_all_flat") * F.col("_all")
    wanted = share.crossJoin(F.broadcast(whole)).select(F.col(margin).alias("_value"), value.alias(f"_{margin}"))  # one row
    return cells.join(wanted, cells[margin].eqNullSafe(wanted["_value"])).drop("_value")


def rake(rows: DataFrame, power: float = POWER, rounds: int = ROUNDS) -> DataFrame:
    """source, lang, topic, tokens, weight: the fitted weight of every cell."""
    cells = rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens"))
    for margin in MARGINS:
        cells = _target(cells, margin, power)
    cells = stage(cells.withColumn("weight", F.col("tokens").cast("double")), "cells")
    for _ in range(rounds):
        for margin in MARGINS:
            total = F.sum("weight").over(Window.partitionBy(margin))
            cells = cells.withColumn("weight", F.when(total > 0, F.col("weight") * F.col(f"_{margin}") / total).otherwise(0.0))
        cells = stage(cells, "cells")
    return cells.select(*MARGINS, "tokens", "weight")


def _factor(rows: DataFrame, weight: str, most: str, budget: float) -> float:
    """The factor at which the weights, none above its own `most`, add up to the budget."""
    factor, below = 0.0, None
    while True:  # Newton's steps on a concave sum: from below, and exact once no further row reaches its most
        free = F.col(weight) * factor < F.col(most)
        row = rows.where((F.col(weight) > 0) & (F.col(most) > 0)).agg(
            F.count(F.when(free, 1)), F.sum(F.when(free, F.col(weight))), F.sum(F.when(~free, F.col(most)))
        ).first()
        if not row[0]:  # all are whole
            return factor
        if row[0] == below:
            return factor
        below, factor = row[0], max(factor, (budget - float(row[2] or 0)) / row[1])


def rake_within(rows: DataFrame, keep: float, power: float = POWER, rounds: int = ROUNDS) -> DataFrame:
    """source, lang, topic, tokens, weight: fitted weights, none above the tokens of its cell, that add up to
    the share `keep` of all tokens."""
    cells = stage(rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens")), "cells")
    budget = keep * float(cells.agg(F.sum("tokens")).first()[0] or 0)
    wanted = cells
    for margin in MARGINS:
        share = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("_n"))
        share = stage(share.withColumn("_flat", F.pow("_n", F.lit(power))), "share")
        factor = _factor(share, "_flat", "_n", budget)
        value = F.least(F.col("_n"), F.col("_flat") * factor)
        share = share.select(F.col(margin).alias("_value"), value.alias(f"_{margin}"))
        wanted = wanted.join(share, wanted[margin].eqNullSafe(share["_value"])).drop("_value")
    cells = stage(wanted.withColumn("weight", F.col("tokens").cast("double")), "cells")
    for _ in range(rounds):
        for margin in MARGINS:
            total = F.sum("weight").over(Window.partitionBy(margin))
            fitted = F.least(F.col("weight") * F.col(f"_{margin}") / total, F.col("tokens").cast("double"))
            cells = cells.withColumn("weight", F.when(total > 0, fitted).otherwise(0.0))
        cells = stage(cells, "cells")
    factor = _factor(cells, "weight", "tokens", budget)
    return cells.select(*MARGINS, "tokens", F.least(F.col("weight") * factor, F.col("tokens").cast("double")).alias("weight"))


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", topic: str | None = None, power: float = POWER,
    keep: float | None = None,
) -> DataFrame:
    """doc_id, source, lang, topic, tokens, probability, kept for every row; `keep` is a budget as a share of all tokens."""
    rows = stage(facts(docs, key, text, topic), "facts")
    cells = rake(rows, power) if keep is None else rake_within(rows, keep, power)
    cells = cells.withColumn("_ratio", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")))
    most = cells.agg((F.max("_ratio") if keep is None else F.lit(1.0)).alias("_most"))
    chance = F.round(F.coalesce(F.col("_ratio") / F.col("_most"), F.lit(1.0)), DIGITS)
    odds = cells.crossJoin(F.broadcast(most)).select(*(F.col(m).alias(f"_{m}") for m in MARGINS), chance.alias("probability"))  # one row
    same = [rows[m].eqNullSafe(odds[f"_{m}"]) for m in MARGINS]
    kept = F.col("probability") > unit_hash(F.lit(SEED), F.coalesce("doc_id", F.lit(0)))
    return rows.join(odds, same).select("doc_id", *MARGINS, "tokens", "probability", kept.alias("kept"))


def sample(
    docs: DataFrame, key: str = "doc_id", text: str = "text", topic: str | None = None, power: float = POWER,
    keep: float | None = None,
) -> DataFrame:
    """The documents drawn, with all their columns."""
    facets = F.col(f"`{topic}`") if topic else length_topic(words(text))
    rows = docs.select(
        F.struct("*").alias("row"), F.col(f"`{key}`").cast("long").alias("row_key"), F.col("source").alias("row_source"),
        F.col("lang").alias("row_lang"), facets.alias("row_topic"),
    )
    odds = mix(docs, key, text, topic, power, keep).groupBy(*MARGINS).agg(F.max("probability").alias("chance"))
    odds = stage(odds, "odds")
    same = [rows[f"row_{m}"].eqNullSafe(odds[m]) for m in MARGINS]
    drawn = F.col("chance") > unit_hash(F.lit(SEED), F.coalesce("row_key", F.lit(0)))
    return rows.join(odds, same).where(drawn).select("row.*")


def oracle(power: float = POWER, rounds: int = ROUNDS) -> str:
    """The same in SQL: one common table expression per margin and round."""
    parts = [
        f"""f AS MATERIALIZED (
            SELECT doc_id, source, lang, tokens, CASE WHEN tokens < 64 THEN 'note' WHEN tokens < 256 THEN 'short'
                   WHEN tokens < 1024 THEN 'article' ELSE 'book' END AS topic
            FROM (SELECT doc_id, source, lang, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS tokens
                  FROM documents))""",
        "c0 AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM f GROUP BY ALL)",
    ]
    for margin in MARGINS:
        parts.append(f"""t_{margin} AS MATERIALIZED (
            SELECT v, pow(n, {power}) / sum(pow(n, {power})) OVER () * sum(n) OVER () AS wanted
            FROM (SELECT {margin} AS v, sum(tokens) AS n FROM c0 GROUP BY 1))""")
    parts.append("w0 AS MATERIALIZED (SELECT *, tokens AS weight FROM c0)")
    last = "w0"
    for number in range(rounds):
        for margin in MARGINS:
            name = f"w{number + 1}_{margin}"
            parts.append(f"""{name} AS MATERIALIZED (
                SELECT c.* EXCLUDE (weight), CASE WHEN total > 0 THEN weight * wanted / total ELSE 0 END AS weight
                FROM (SELECT *, sum(weight) OVER (PARTITION BY {margin}) AS total FROM {last}) AS c
                JOIN t_{margin} ON v IS NOT DISTINCT FROM {margin})""")
            parts[-1] = parts[-1].replace("EXCLUDE (weight)", "EXCLUDE (weight, total)")
            last = name
    ratio = "CASE WHEN tokens > 0 THEN weight / tokens END"
    parts.append(f"""o AS MATERIALIZED (
        SELECT source, lang, topic, round(coalesce(({ratio}) / max({ratio}) OVER (), 1.0), {DIGITS}) AS probability FROM {last})""")
    hashed = f"(('0x' || substr(md5('{SEED}|' || coalesce(doc_id, 0)), 1, 13))::BIGINT + 0.5) / 4503599627370496"
    return f"""WITH {", ".join(parts)}
        SELECT doc_id, f.source, f.lang, f.topic, f.tokens, probability, probability > {hashed} AS kept
        FROM f JOIN o ON f.source IS NOT DISTINCT FROM o.source AND f.lang IS NOT DISTINCT FROM o.lang AND f.topic = o.topic"""
