"""Readers, sinks, column functions."""

import math
import zipfile

import pytest
from pyspark.sql import functions as F

from flowsieve.functions import columns as C
from flowsieve.operators import rates as R
from flowsieve.operators.features import add_base_features
from flowsieve.operators.reports import log_upsert
from flowsieve.sources import payments as S

HEADER = "Timestamp,From Bank,Account,To Bank,Account,Amount Received,Receiving Currency,Amount Paid,Payment Currency,Payment Format,Is Laundering"
LINES = [
    "2022/09/01 00:20,010,800A,10,800B,3697.34,US Dollar,3697.34,US Dollar,Wire,0",
    "not a time,3208,800C,1,800D,0.01,Euro,0.01,,Cheque,1",
    "2022/09/03 23:59,11,800E,12,800F,-5,Euro,7,Yen,ACH,0",
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("payments")
    (path / "transactions.csv").write_text("\n".join([HEADER, *LINES]) + "\n")
    return path


def test_csv_by_position(spark, folder):
    rows = S.read_csv(spark, str(folder / "transactions.csv")).orderBy("from_account").collect()
    assert rows[0]["from_bank"] == 10 and rows[0]["to_account"] == "800B"
    assert rows[1]["ts"] is None and rows[1]["payment_currency"] is None
    assert [r["is_laundering"] for r in rows] == [0, 1, 0]


def test_base_features(spark, folder):
    rows = add_base_features(S.read_csv(spark, str(folder / "transactions.csv"))).orderBy("from_account").collect()
    a, b, c = rows
    assert (a["hour"], a["weekday"], a["is_weekend"], a["same_currency"], a["same_bank"]) == (0, 3, 0, 1, 1)
    assert a["from_account_id"] == "10_800A"
    assert (b["hour"], b["weekday"], b["is_weekend"], b["same_currency"]) == (-1, -1, 0, 0)
    assert (c["weekday"], c["is_weekend"], c["log_amount_received"], c["amount_diff"]) == (5, 1, 0.0, 12.0)
    assert c["log_amount_paid"] == pytest.approx(math.log1p(7))


def test_folder_prefers_plain_csv(spark, folder):
    assert S.read_folder(spark, str(folder)).count() == 3


def make_zip(path, member, lines):
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("readme.txt", "x")
        archive.writestr(member, "\n".join([HEADER, *lines]) + "\n")


def test_archives(spark, tmp_path):
    make_zip(tmp_path / "one.zip", "deep/down/TRANSACTIONS.csv", LINES[:2])
    make_zip(tmp_path / "two.ZIP", "transactions.csv", LINES[2:])
    rows = S.read_folder(spark, str(tmp_path)).collect()
    assert sorted(r["from_account"] for r in rows) == ["800A", "800C", "800E"]
    assert {r["from_bank"] for r in rows} == {10, 3208, 11}
    assert S.read_folder(spark, str(tmp_path), known_archive="one.zip").count() == 2


def test_archives_and_plain_files_read_alike(spark, tmp_path):
    """Broken numbers, missing fields, quotes, blank lines and lines too long or short."""
    odd = [
        "2022/09/01 00:20,x1,800A,10,800B,3.5e,US Dollar,,US Dollar,Wire,0", "2022/09/01 00:21,1,A,2", "",
        '2022/09/01 00:22,1,"A,B",2,C,1.5,Euro,2.5,Euro,"say ""hi""",1', "2022/09/01 00:23,1,A,2,B,1,Euro,1,Euro,ACH,0,more",
    ] + [f"2022/09/01 00:24,{i},Ä{i},2,B,1,Euro,1,Euro,ACH,0" for i in range(20_000)]
    (tmp_path / "plain" / "deep").mkdir(parents=True)
    (tmp_path / "plain" / "deep" / "Transactions.CSV").write_text("\n".join([HEADER, *odd]) + "\n")
    (tmp_path / "packed" / "deep").mkdir(parents=True)
    make_zip(tmp_path / "packed" / "deep" / "one.zip", "transactions.csv", odd)
    plain, packed = (S.read_folder(spark, str(tmp_path / d)) for d in ("plain", "packed"))
    assert plain.schema == packed.schema
    assert plain.exceptAll(packed).isEmpty() and packed.exceptAll(plain).isEmpty() and packed.count() == 20_004
    assert packed.filter("from_account = 'A,B'").first()["payment_format"] == 'say "hi"'


def test_missing_member_is_an_error(spark, tmp_path):
    make_zip(tmp_path / "one.zip", "other.csv", LINES)
    with pytest.raises(Exception, match="holds no"):
        S.read_folder(spark, str(tmp_path)).count()


def test_empty_folder_is_an_error(spark, tmp_path):
    (tmp_path / "notes.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        S.read_folder(spark, str(tmp_path))


def test_feature_store_prunes_dates(spark, folder, tmp_path):
    rows = S.read_csv(spark, str(folder / "transactions.csv")).filter("ts is not null")
    S.write_feature_store(rows, str(tmp_path / "store"))
    part = S.read_feature_store(spark, str(tmp_path / "store"), "2022-09-02")
    assert part.count() == 1
    assert "PartitionFilters: [isnotnull(event_date" in part._jdf.queryExecution().toString()


def test_null_groups_are_kept(spark, folder):
    rows = S.read_csv(spark, str(folder / "transactions.csv"))
    rates = {r["payment_currency"]: r["transactions"] for r in R.rates_by(rows, F.col("payment_currency"), "payment_currency").collect()}
    assert rates == {"US Dollar": 1, "Yen": 1, None: 1}
    assert [r["hour"] for r in R.hourly_rates(rows).collect()] == [-1, 0, 23]


def test_quality_profile(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (1, None)], "a int, b string")
    got = {r["column_name"]: r["rows"] for r in R.quality_profile(df).collect()}
    assert got == {"a": 0, "b": 3, "<duplicate rows>": 2}


def test_stats_document_round_trip(spark, folder):
    rows = S.read_csv(spark, str(folder / "transactions.csv"))
    assert R.positive_rate_of(R.stats_document(rows)).first()[0] == pytest.approx(1 / 3)


def test_histogram_integrates_to_one(spark):
    rows = [(float(i), int(i % 7 == 0)) for i in range(1, 300)]
    hist = R.amount_histogram(spark.createDataFrame(rows, "amount_paid double, is_laundering int")).collect()
    width = math.log10(299) / 60
    for y in (0, 1):
        assert sum(r["density"] for r in hist if r["is_laundering"] == y) * width == pytest.approx(1.0)


def test_log_upsert(spark):
    schema = "stage string, lesson string"
    old = spark.createDataFrame([("a", "1"), ("b", "2")], schema)
    new = spark.createDataFrame([("b", "3"), ("c", "4")], schema)
    assert sorted(tuple(r) for r in log_upsert(old, new).collect()) == [("a", "1"), ("b", "3"), ("c", "4")]


def test_text_helpers(spark):
    df = spark.createDataFrame([("Random Forest + Graph",)], "m string")
    row = df.select(C.slug(F.col("m")).alias("s"), C.params_json({"b": 2, "a": 1}).alias("p")).first()
    assert row["s"] == "random_forest_plus_graph" and row["p"] == '{"a":"1","b":"2"}'
    odd = spark.createDataFrame([(float("inf"),), (float("nan"),), (None,), (2.0,)], "x double")
    assert [r[0] for r in odd.select(C.finite_or_zero(F.col("x"))).collect()] == [0, 0, 0, 2]
