"""Shards with the mixture of the whole: sources interleaved by fractional rank, cut at equal counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowsieve.session import lookup_join, written

_KEY = ["doc_id", "source", "size", "text_crc32"]


def _draw(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]).cast("binary"))


def _fraction(draw: Column) -> Column:
    """The first 52 bits of a digest as a number from 0 up to 1."""
    return F.conv(F.substring(draw, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def _key(id_col: str, text_col: str, source_col: str) -> list[Column]:
    """What the ranking knows of a row: identifier, source, size and checksum."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    return [
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
    ]


def interleaved(
    docs: DataFrame,
    shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 13,
    rows_per_cell: int = 100_000,
) -> DataFrame:
    """One row per input row: doc_id, source, size, text_crc32, shard (0 to ``shards`` - 1), slot (gapless from 0).

    Within its source every row has a rank in the order of a seeded digest. Its fractional rank is (rank + u) / rows,
    with one draw u per source, so that sources of few rows do not all stand in the middle. Rows in the order of
    fractional ranks are cut into shards whose counts differ by one at most; of each source a shard holds its share
    up to one row on either side. Equal texts are not kept together: a group may be larger than a shard.

    Both rankings count per cell of a bounded number of rows and add the cells before: a digest and a fractional rank
    are spread evenly, whatever the source. Rows that are equal in identifier, source, size and checksum are one row
    with a count until they have their ranks, and are spread again in pieces.

    A null text has size 1, a null or empty source is one source, null identifiers are ranked like any other. No
    column but the three named is read. An empty table gives no rows.
    """
    counted = docs.select(*_key(id_col, text_col, source_col)).groupBy(*_KEY).agg(F.count(F.lit(1)).alias("copies"))
    base = written(counted.withColumn("draw", _draw(F.lit(seed), F.coalesce("doc_id", F.lit(-1)), F.col("text_crc32"), F.col("size"))), "shard-rows")
    totals = written(
        base.groupBy("source").agg(F.sum("copies").alias("rows"), F.count(F.lit(1)).alias("distinct_rows")), "shard-sources"
    )
    n = totals.agg(F.sum("rows").alias("n")).first()["n"] or 0

    celled = lookup_join(base, totals, "source").withColumn(
        "cell", F.floor(_fraction(F.col("draw")) * F.ceil(F.col("distinct_rows") / rows_per_cell))
    )
    cells = written(celled.groupBy("source", "cell").agg(F.sum("copies").alias("in_cell")), "shard-cells")
    before = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    bases = cells.select("source", "cell", F.coalesce(F.sum("in_cell").over(before), F.lit(0)).alias("base"))
    inside = (
        Window.partitionBy("source", "cell").orderBy("draw", "doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = written(
        lookup_join(celled, bases, ["source", "cell"]).select(
            *_KEY, "rows", "copies", (F.col("base") + F.coalesce(F.sum("copies").over(inside), F.lit(0))).alias("first")
        ),
        "shard-ranks",
    )

    few = ranked.filter(F.col("copies") <= rows_per_cell).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    low = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(rows_per_cell).cast("long")))
    pieces = ranked.filter(F.col("copies") > rows_per_cell).withColumn("low", low).repartition(*_KEY, "low")
    high = F.least(F.col("low") + rows_per_cell, F.col("copies")) - 1
    many = pieces.withColumn("copy", F.explode(F.sequence("low", high))).drop("low")
    start = _fraction(_draw(F.lit(seed), F.col("source")))
    placed = few.unionByName(many).withColumn("rank", F.col("first") + F.col("copy")).withColumn(
        "place", (F.col("rank") + start) / F.col("rows")
    )
    placed = placed.withColumn("stripe", F.floor(F.col("place") * F.lit(max(1, -(-n // rows_per_cell)))))
    # One row per stripe of about rows_per_cell rows.
    stripes = written(placed.groupBy("stripe").agg(F.count(F.lit(1)).alias("in_stripe")), "shard-stripes")
    earlier = Window.orderBy("stripe").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stripes.select("stripe", F.coalesce(F.sum("in_stripe").over(earlier), F.lit(0)).alias("offset"))
    order = Window.partitionBy("stripe").orderBy("place", "source", "rank")
    found = lookup_join(placed, offsets, "stripe").withColumn("position", F.col("offset") + F.row_number().over(order) - 1)
    total = max(n, 1)
    shard = found.withColumn("shard", F.expr(f"cast(position * {shards}L div {total}L as int)"))
    return shard.select(*_KEY, "shard", F.expr(f"position - (shard * {total}L + {shards - 1}L) div {shards}L").alias("slot"))


def write_shards(
    docs: DataFrame, folder: str, shards: int = 8, files: int = 4, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source", **options,
) -> None:
    """Write the rows of ``docs`` below ``folder``, one folder per shard, in the order of slots, with all their columns.

    Rows that are equal in identifier, source, size and checksum are written with the columns of one of them.
    """
    where = interleaved(docs, shards, id_col, text_col, source_col, **options)
    rows = docs.select(F.struct(*_key(id_col, text_col, source_col)).alias("k"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    placed = where.select(F.struct(*_KEY).alias("k"), "shard", "slot").join(rows.dropDuplicates(["k"]), "k")
    (
        placed.repartitionByRange(shards * files, "shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .select("row", "slot", "shard")
        .write.partitionBy("shard")
        .parquet(folder)
    )
