"""Scans, sinks, base features and rate tables."""

from __future__ import annotations

import uuid
import zipfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowsieve.functions import columns as C
from flowsieve.operators import rates as R
from flowsieve.operators.sampling import smallest_draws
from flowsieve.plans.star import featured, payments, payments_sql, table
from flowsieve.session import scratch_path, written
from flowsieve.sources import archives as A
from flowsieve.sources import payments as S
from flowsieve.sources.schema import CSV_HEADER

TXN = payments_sql()
_SUMMED = """CAST(sum(CAST(amount_paid AS DECIMAL(18,4))) AS DOUBLE) AS paid,
  CAST(sum(CAST(amount_received AS DECIMAL(18,4))) AS DOUBLE) AS received"""


def _by_bank(df):
    """Per bank and minute-of-day half: enough to notice any lost or changed row."""
    return df.groupBy("from_bank", "payment_currency", C.hour_or_missing(F.col("ts")).alias("hour")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("is_laundering")).cast("long").alias("positives"),
        F.sum(C.money(F.col("amount_paid"))).cast("double").alias("paid"),
        F.sum(C.money(F.col("amount_received"))).cast("double").alias("received"),
    )


_BY_BANK_SQL = f"""WITH {TXN} SELECT from_bank, payment_currency, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n,
  CAST(sum(is_laundering) AS BIGINT) AS positives, {_SUMMED} FROM txn GROUP BY ALL"""


def scan_transactions(spark, sf_dir):
    path = scratch_path(spark, "payments-csv")
    S.write_csv(payments(spark, sf_dir), path)
    return _by_bank(S.read_csv(spark, path))


def scan_pruned(spark, sf_dir):
    path = scratch_path(spark, "payments-csv")
    S.write_csv(payments(spark, sf_dir), path)
    return S.read_csv(spark, path).groupBy("payment_format").agg(
        F.count(F.lit(1)).alias("n"), F.sum(C.money(F.col("amount_paid"))).cast("double").alias("paid")
    )


def _pack(folder):
    """Every batch of rows becomes one ZIP below ``folder`` with the CSV in a sub-folder; the rows are the paths."""

    def run(batches):
        files, root = A.open_folder(folder)
        for batch in batches:
            path = f"{root}/{uuid.uuid4().hex}.zip"
            with files.open_output_stream(path) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr(f"export/{S.MEMBER.upper()}", batch.to_csv(index=False, header=CSV_HEADER))
            yield batch.iloc[:1, :0].assign(path=path, rows=len(batch))

    return run


def ingest_archives(spark, sf_dir):
    folder = scratch_path(spark, "archives")
    A.make_folder(folder)
    packed = S.raw_columns(payments(spark, sf_dir)).mapInPandas(_pack(folder), "path string, rows long")
    # What a repeated task left behind is in the folder as well, but not in this list.
    listed = written(packed, "packed")
    names = F.regexp_extract("path", r"([^/]+)$", 1)
    rows = S.read_archives(spark, folder, within=listed.select(names.alias("archive")))
    return _by_bank(rows)


def feature_store_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "feature-store")
    S.write_feature_store(featured(spark, sf_dir), path)
    week = S.read_feature_store(spark, path, "2022-09-05", "2022-09-11")
    return week.groupBy(F.col("event_date").cast("string").alias("event_date"), "weekday").agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_weekend").cast("long").alias("weekend_rows"),
        F.sum(C.money(F.col("amount_diff"))).cast("double").alias("amount_diff"),
    )


def result_sink(spark, sf_dir):
    table_ = R.payment_format_rates(payments(spark, sf_dir))
    path = scratch_path(spark, "result")
    S.write_result(table_, path)
    return S.read_result(spark, path, table_.schema)


_COUNTS = T.MapType(T.StringType(), T.LongType())
_DOCUMENT = T.StructType(
    [T.StructField("total_rows", T.LongType()), T.StructField("positive_rows", T.LongType())]
    + [T.StructField(f"{p}_{k}", _COUNTS) for p in ("payment", "currency", "hourly") for k in ("counts", "pos")]
)


def stats_json(spark, sf_dir):
    path = scratch_path(spark, "stats")
    R.stats_document(payments(spark, sf_dir)).write.text(path)
    stored = spark.read.text(path, wholetext=False).withColumnRenamed("value", "document")
    parsed = stored.select(F.from_json("document", _DOCUMENT).alias("d"), "document")
    sections = [f.name for f in _DOCUMENT.fields if isinstance(f.dataType, T.MapType)]
    rate = F.round(F.get_json_object("document", "$.positive_rate").cast("double"), 9).alias("positive_rate")
    totals = parsed.select("d.total_rows", "d.positive_rows", rate).unpivot(
        ["positive_rate"], ["total_rows", "positive_rows"], "section", "value"
    )
    counts = parsed.unpivot(["document"], [F.col(f"d.{n}").alias(n) for n in sections], "section", "counts")
    return counts.select("section", F.explode("counts").alias("key", "value"), rate).unionByName(
        totals.withColumn("key", F.lit(""))
    )


_STATS_SQL = f"""WITH {TXN}, parts AS (
  SELECT 'total_rows' AS section, '' AS key, count(*) AS value FROM txn
  UNION ALL SELECT 'positive_rows', '', CAST(sum(is_laundering) AS BIGINT) FROM txn
""" + "".join(
    f"""  UNION ALL SELECT '{p}_counts', CAST({c} AS VARCHAR), count(*) FROM txn GROUP BY 2
  UNION ALL SELECT '{p}_pos', CAST({c} AS VARCHAR), CAST(sum(is_laundering) AS BIGINT) FROM txn GROUP BY 2
"""
    for p, c in (("payment", "payment_format"), ("currency", "payment_currency"), ("hourly", "hour(ts)"))
) + """) SELECT section, key, value,
  round((SELECT CAST(sum(is_laundering) AS DOUBLE) / count(*) FROM txn), 9) AS positive_rate FROM parts"""


def quality_profile(spark, sf_dir):
    return R.quality_profile(table(spark, sf_dir, "lineitem"))


_LINE = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag "
    "l_linestatus l_shipdate"
).split()
_QUALITY_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS rows FROM lineitem" for c in _LINE
) + f""" UNION ALL SELECT '<duplicate rows>', (SELECT count(*) FROM lineitem)
  - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(_LINE)} FROM lineitem))"""

_BASE = [
    "hour", "weekday", "is_weekend", "log_amount_paid", "log_amount_received", "amount_diff", "same_currency",
    "same_bank", "from_account_id", "to_account_id",
]


def base_features(spark, sf_dir):
    rounded = {"log_amount_paid", "log_amount_received", "amount_diff"}
    return featured(spark, sf_dir).select(
        "row_key", *[(F.round(c, 6) + F.lit(0.0)).alias(c) if c in rounded else F.col(c) for c in _BASE]
    )


_BASE_SQL = f"""WITH {TXN} SELECT row_key, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS weekday,
  CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend,
  round(ln(1 + greatest(amount_paid, 0)), 6) AS log_amount_paid,
  round(ln(1 + greatest(amount_received, 0)), 6) AS log_amount_received,
  round(amount_paid - amount_received, 6) + CAST(0 AS DOUBLE) AS amount_diff,
  CASE WHEN payment_currency = receiving_currency THEN 1 ELSE 0 END AS same_currency,
  CASE WHEN from_bank = to_bank THEN 1 ELSE 0 END AS same_bank,
  s AS from_account_id, r AS to_account_id FROM txn"""


def label_strings(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    name = F.concat(F.col("p_name"), F.lit(" + "), F.col("p_type"))
    kind = C.relabel(F.col("p_type"), {"ECONOMY": "Economy parts", "STANDARD": "Standard parts"})
    return parts.select("p_partkey", C.slug(name).alias("slug"), F.concat("p_brand", F.lit("\n"), kind).alias("label"))


def amount_histogram(spark, sf_dir):
    return R.amount_histogram(payments(spark, sf_dir)).withColumn("density", F.round("density", 9))


_HISTOGRAM_SQL = f"""WITH {TXN}, v AS (SELECT is_laundering, log10(greatest(amount_paid, 0.0001)) AS x FROM txn),
span AS (SELECT min(x) AS lo, (max(x) - min(x)) / 60 AS width FROM v),
c AS (SELECT is_laundering, CAST(least(floor((x - lo) / width), 59) AS INTEGER) AS bin, count(*) AS n
  FROM v, span GROUP BY 1, 2)
SELECT is_laundering, bin, n, round(n / (sum(n) OVER (PARTITION BY is_laundering) * (SELECT width FROM span)), 9) AS density
FROM c"""


def amount_sample(spark, sf_dir):
    sample = smallest_draws(payments(spark, sf_dir), "row_key", 3000, 42, group="is_laundering")
    return sample.select("row_key", "is_laundering", "amount_paid")


_AMOUNT_SAMPLE_SQL = f"""WITH {TXN} SELECT row_key, is_laundering, amount_paid FROM txn
QUALIFY row_number() OVER (PARTITION BY is_laundering ORDER BY md5('42#' || row_key), row_key) <= 3000"""


def _rate_sql(key: str, name: str) -> str:
    return f"""WITH {TXN} SELECT {key} AS {name}, count(*) AS transactions, CAST(sum(is_laundering) AS BIGINT) AS laundering,
  CAST(sum(is_laundering) AS DOUBLE) / count(*) AS laundering_rate FROM txn GROUP BY 1"""


QUERIES = {
    "payment_format_rates": lambda spark, d: R.payment_format_rates(payments(spark, d)),
    "currency_rates": lambda spark, d: R.rates_by(payments(spark, d), F.col("payment_currency"), "payment_currency"),
    "hourly_rates": lambda spark, d: R.hourly_rates(payments(spark, d)),
    "base_rate": lambda spark, d: R.base_rate(payments(spark, d)),
    "label_share": lambda spark, d: R.label_share(payments(spark, d)),
    "amount_histogram": amount_histogram,
    "amount_sample": amount_sample,
    "base_features": base_features,
    "label_strings": label_strings,
    "quality_profile": quality_profile,
    "scan_transactions": scan_transactions,
    "scan_pruned": scan_pruned,
    "ingest_archives": ingest_archives,
    "feature_store_roundtrip": feature_store_roundtrip,
    "result_sink": result_sink,
    "stats_json": stats_json,
}
SQL = {
    "payment_format_rates": _rate_sql("payment_format", "payment_format"),
    "currency_rates": _rate_sql("payment_currency", "payment_currency"),
    "hourly_rates": _rate_sql("CAST(hour(ts) AS INTEGER)", "hour"),
    "base_rate": f"""WITH {TXN} SELECT count(*) AS total_rows, CAST(sum(is_laundering) AS BIGINT) AS positive_rows,
  CAST(sum(is_laundering) AS DOUBLE) / count(*) AS positive_rate FROM txn""",
    "label_share": f"""WITH {TXN} SELECT is_laundering, count(*) AS n,
  CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM txn) AS share FROM txn GROUP BY 1""",
    "amount_histogram": _HISTOGRAM_SQL,
    "amount_sample": _AMOUNT_SAMPLE_SQL,
    "base_features": _BASE_SQL,
    "label_strings": """SELECT p_partkey,
  replace(replace(lower(p_name || ' + ' || p_type), ' ', '_'), '+', 'plus') AS slug,
  p_brand || chr(10) || CASE p_type WHEN 'ECONOMY' THEN 'Economy parts' WHEN 'STANDARD' THEN 'Standard parts'
    ELSE p_type END AS label FROM part""",
    "quality_profile": _QUALITY_SQL,
    "scan_transactions": _BY_BANK_SQL,
    "scan_pruned": f"""WITH {TXN} SELECT payment_format, count(*) AS n,
  CAST(sum(CAST(amount_paid AS DECIMAL(18,4))) AS DOUBLE) AS paid FROM txn GROUP BY 1""",
    "ingest_archives": _BY_BANK_SQL,
    "feature_store_roundtrip": f"""WITH {TXN} SELECT strftime(ts, '%Y-%m-%d') AS event_date,
  CAST(isodow(ts) - 1 AS INTEGER) AS weekday, count(*) AS n,
  count(*) FILTER (isodow(ts) >= 6) AS weekend_rows,
  CAST(sum(CAST(amount_paid - amount_received AS DECIMAL(18,4))) AS DOUBLE) AS amount_diff
  FROM txn WHERE CAST(ts AS DATE) BETWEEN DATE '2022-09-05' AND DATE '2022-09-11' GROUP BY 1, 2""",
    "result_sink": _rate_sql("payment_format", "payment_format"),
    "stats_json": _STATS_SQL,
}
