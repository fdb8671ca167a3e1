"""Scalar helpers (F1-F16) on hand-made rows."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from farelane.functions import columns as C


def test_payment_description_and_default(spark):
    df = spark.createDataFrame([(1,), (2,), (6,), (7,), (None,)], "p bigint")
    out = df.select(C.payment_description("p").alias("d"),
                    C.payment_default(C.safe_cast("p")).alias("c")).collect()
    assert [r.d for r in out] == ["Credit card", "Cash", "Voided trip", "EMPTY", "EMPTY"]
    assert [r.c for r in out] == [1, 2, 6, 7, 0]


def test_safe_cast(spark):
    df = spark.createDataFrame([("7",), ("x",), ("1.0",), (None,)], "s string")
    assert [r[0] for r in df.select(C.safe_cast("s")).collect()] == [7, None, None, None]
    d = spark.createDataFrame([(1.5,), (2.5,), (-2.5,)], "x double")
    assert [r[0] for r in d.select(C.safe_cast("x", round_fraction=True)).collect()] == [2, 3, -3]


def test_surrogate_key_matches_md5_of_joined_text(spark):
    df = spark.createDataFrame([("1", dt.datetime(2019, 1, 1, 0, 46, 40)), (None, None)],
                               "v string, t timestamp_ntz")
    got = [r[0] for r in df.select(C.surrogate_key("v", "t")).collect()]
    tok = C.SURROGATE_NULL_TOKEN
    assert got[0] == hashlib.md5(b"1-2019-01-01 00:46:40").hexdigest()
    assert got[1] == hashlib.md5(f"{tok}-{tok}".encode()).hexdigest()


def test_row_hash_has_no_separator_and_blank_nulls(spark):
    df = spark.createDataFrame([("1", "12", None), ("11", "2", None)], "a string, b string, c string")
    h = [r[0] for r in df.select(C.row_hash("a", "b", "c")).collect()]
    assert h[0] == h[1] == hashlib.md5(b"112").hexdigest()
    h2 = [r[0] for r in df.select(C.row_hash("a", "b", sep="|")).collect()]
    assert h2[0] != h2[1]
    k = df.select(C.row_key("a", "b")).first()[0]
    assert bytes(k) == hashlib.md5(b"112").digest()


def test_iso_duration_quarter_label(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2019, 1, 1, 0, 46, 40), dt.datetime(2019, 1, 1, 0, 46, 40)),
         (dt.datetime(2019, 1, 1, 0, 0, 0), dt.datetime(2019, 1, 1, 0, 0, 59, 900000)),
         (dt.datetime(2019, 1, 1, 0, 0, 1), dt.datetime(2019, 1, 1, 0, 0, 0, 500000)),
         (dt.datetime(2020, 5, 6, 0, 0, 0), dt.datetime(2020, 5, 5, 0, 0, 0))],
        "a timestamp_ntz, b timestamp_ntz")
    out = df.select(C.iso_utc("a").alias("iso"), C.trip_seconds("a", "b").alias("s"),
                    C.year_quarter("a").alias("yq"), C.period_start("a", "quarter").alias("q"),
                    C.year_of("a").alias("y")).collect()
    assert out[0].iso == "2019-01-01T00:46:40+00:00"
    assert [r.s for r in out] == [0, 59, 0, -86400]
    assert out[3].yq == "2020/Q2"
    assert out[3].q == dt.datetime(2020, 4, 1)
    assert out[3].y == 2020


def test_service_zone_label(spark):
    df = spark.createDataFrame([("Boro Zone",), ("Yellow Zone",), ("N/A",)], "z string")
    assert [r[0] for r in df.select(C.service_zone_label("z")).collect()] == [
        "Green Zone", "Yellow Zone", "N/A"]


# Published report lines (the growth numbers and sentences must round-trip).
GOLDEN = [
    ("2020/Q1", "Green", -56.58, 1), ("2020/Q1", "Yellow", -21.13, 1),
    ("2020/Q2", "Green", -92.82, 2), ("2020/Q2", "Yellow", -92.23, 2),
    ("2020/Q3", "Green", -86.62, 3), ("2020/Q3", "Yellow", -77.86, 3),
    ("2020/Q4", "Green", -84.43, 4), ("2020/Q4", "Yellow", -70.6, 4),
]


def test_growth_statement_golden(spark):
    df = spark.createDataFrame(GOLDEN, "yq string, s string, g double, q bigint")
    got = [r[0] for r in df.select(C.growth_statement("yq", "s", "g", "q", 2019)).collect()]
    want = [f"In {yq}, {s} Taxi had {g}% revenue growth compared to 2019/Q{q}" for yq, s, g, q in GOLDEN]
    assert got == want
    assert got[-1] == "In 2020/Q4, Yellow Taxi had -70.6% revenue growth compared to 2019/Q4"


def test_growth_statement_positive_and_integral(spark):
    df = spark.createDataFrame([("2020/Q4", "Yellow", 34.5617, 4), ("2020/Q1", "Green", -56.0, 1)],
                               "yq string, s string, g double, q bigint")
    got = [r[0] for r in df.select(C.growth_statement("yq", "s", "g", "q", 2019)).collect()]
    assert got[0] == "In 2020/Q4, Yellow Taxi had +34.56% revenue growth compared to 2019/Q4"
    assert got[1] == "In 2020/Q1, Green Taxi had -56% revenue growth compared to 2019/Q1"


def test_pct_growth_divide_by_zero_is_null(spark):
    df = spark.createDataFrame([(150.0, 100.0), (1.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(C.pct_growth("a", "b")).collect()] == [50.0, None]


def test_scale_conf_sizes_partitions():
    from farelane.session import scale_conf
    c = scale_conf(100 * 2**40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert int(scale_conf(10, 8)["spark.sql.shuffle.partitions"]) == 16
