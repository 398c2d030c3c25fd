"""Mixing sources to target weights: iterative proportional fitting, then calibrated sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.session import lookup_join, written

_WORD = "[^\\x20\\x09-\\x0D]+"
_MARGINS = ("m_source", "m_lang", "m_topic")


def form_topic(text: Column) -> Column:
    """A topic where no column has one: the form of the text."""
    has = lambda part: F.contains(text, F.lit(part))
    return (
        F.when(has(" | "), "table")
        .when(has("!! "), "shouting")
        .when(has("*** ") | has("%%% "), "noise")
        .when(F.length(text) >= 10_000, "long")
        .otherwise("prose")
    )


def _draw(id_col: Column) -> Column:
    """A number below 2**32 from the identifier."""
    return F.conv(F.substring(F.md5(F.coalesce(id_col.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("double")


def rake(cells: DataFrame, powers: tuple[float, float, float], rounds: int) -> DataFrame:
    """``cells`` (m_source, m_lang, m_topic, tokens) with ``weight``: shares that add up to the target margins.

    The target share of a value is its token share to the margin's power, scaled to 1. A round scales all cells of
    a value to its target, for one margin after the other; the cells are one row per combination of values.
    """
    everything = Window.partitionBy(F.lit(0))
    out = cells.withColumn("weight", F.col("tokens") / F.sum("tokens").over(everything))
    for margin, power in zip(_MARGINS, powers, strict=True):
        totals = cells.groupBy(margin).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("t"))
        goal = totals.select(margin, (F.col("t") / F.sum("t").over(everything)).alias(f"goal_{margin}"))
        out = lookup_join(out, goal, margin)
    out = written(out, "cells")
    for _ in range(rounds):
        for margin in _MARGINS:
            total = F.sum("weight").over(Window.partitionBy(margin))
            out = out.withColumn("weight", F.col("weight") * F.col(f"goal_{margin}") / total)
    return out.select(*_MARGINS, "tokens", "weight")


def calibrate(raked: DataFrame, share: float) -> DataFrame:
    """Probability of each cell so that the expected tokens are ``share`` of all, in the raked proportions.

    A cell cannot give more than it has. Cells are taken by falling weight per token; those before the first cell
    whose probability stays below 1 are kept whole, and the others share what is left of the budget.
    """
    ratio = F.col("weight") / F.col("tokens")
    order = Window.orderBy(F.desc("ratio"), *_MARGINS)
    rows = raked.filter("tokens > 0").withColumn("ratio", ratio)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    scaled = rows.withColumn(
        "scale",
        (share * F.sum("tokens").over(Window.partitionBy(F.lit(0))) - F.coalesce(F.sum("tokens").over(before), F.lit(0)))
        / F.sum("weight").over(after),
    )
    chosen = scaled.filter(F.col("scale") * F.col("ratio") <= 1).agg(F.max(F.struct("ratio", "scale")).alias("s"))
    found = chosen.select("s.scale").first()[0]  # one number; none if every cell is kept whole
    probability = F.least(F.lit(1.0), F.col("ratio") * F.lit(float("inf") if found is None else float(found)))
    return rows.select(*_MARGINS, probability.alias("probability"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    topic: Column | None = None,
    powers: tuple[float, float, float] = (0.7, 0.7, 0.7),
    share: float = 0.5,
    rounds: int = 10,
    payload: bool = False,
) -> DataFrame:
    """One row per input row: doc_id, source, lang, topic, n_tokens, probability, sampled (and ``row`` if asked).

    Token weights are raked to target shares of source, language and topic, each the token share to its power,
    so that a power below 1 lifts the small values. Documents are then kept with the probability of their cell,
    by a hash of the identifier: expected tokens are ``share`` of all where the cells have enough.

    ``topic`` defaults to the form of the text. Missing values of a margin are a value of their own, shown as
    empty. A document without words has probability 1 and no weight. Rows that repeat an identifier are drawn
    alike. No other column is read unless ``payload`` asks for the row, nested. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = form_topic(text) if topic is None else topic
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("m_source"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("m_lang"),
        F.coalesce(found.cast("string"), F.lit("")).alias("m_topic"),
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias("n_tokens"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if payload else []),
    )
    cells = rows.filter("n_tokens > 0").groupBy(*_MARGINS).agg(F.sum("n_tokens").alias("tokens"))
    raked = written(rake(written(cells, "cells"), powers, rounds), "raked")
    chances = written(calibrate(raked, share), "chances")
    drawn = lookup_join(rows, chances, list(_MARGINS)).withColumn(
        "p", F.when(F.col("n_tokens") == 0, F.lit(1.0)).otherwise(F.coalesce("probability", F.lit(1.0)))
    )
    return drawn.select(
        "doc_id",
        F.col("m_source").alias("source"),
        F.col("m_lang").alias("lang"),
        F.col("m_topic").alias("topic"),
        "n_tokens",
        F.col("p").alias("probability"),
        (_draw(F.col("doc_id")) < F.col("p") * 4294967296.0).alias("sampled"),
        *(["row"] if payload else []),
    )


def keep_sampled(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns."""
    return mix(docs, payload=True, **options).filter("sampled").select("row.*")
