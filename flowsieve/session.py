"""Session helpers: shared scratch folder, written intermediates, size-checked broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when a count shows at most this many rows.
BROADCAST_ROWS = 200_000


def build_session(master: str = "local[8]", app: str = "flowsieve", **conf) -> SparkSession:
    """Session used by the tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FLOWSIEVE_DRIVER_MEMORY", "6g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder for written intermediates: the one the cluster names, else a new one for local runs."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="flowsieve-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody has written to yet below the shared folder."""
    return f"{scratch_root(spark)}/flowsieve/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def has_at_most(df: DataFrame, rows: int) -> bool:
    """True when ``df`` has at most ``rows`` rows; stops counting right after the bound."""
    return df.limit(rows + 1).count() <= rows


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    key: str | list[str],
    max_rows: int = BROADCAST_ROWS,
    hot_rows: int = 2_000_000,
    salts: int = 64,
) -> DataFrame:
    """Left join of ``rows`` with a table that has one row per ``key``.

    A table with at most ``max_rows`` rows is broadcast. A larger one is joined by key, and keys
    with more than ``hot_rows`` rows on the left are spread over ``salts`` tasks.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if has_at_most(table, max_rows):
        return rows.join(F.broadcast(table), keys, "left")
    hot = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows).select(*keys)
    if hot.isEmpty():
        return rows.join(table, keys, "left")
    if not has_at_most(hot, max_rows):
        raise ValueError(f"more than {max_rows} keys exceed {hot_rows} rows: raise hot_rows")
    flag = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    spread = rows.join(flag, keys, "left").withColumn(
        "_salt",
        F.when(F.col("_hot"), F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")).otherwise(F.lit(0)),
    )
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    copies = table.join(flag, keys, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0))))
    )
    return spread.drop("_hot").join(copies.drop("_hot"), [*keys, "_salt"], "left").drop("_salt")
