from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cauce.functions import (
    count_line,
    is_missing,
    parse_event_time,
    rate_per_100k,
    safe_ratio,
    timestamp_text,
    to_code,
    to_count,
    to_key,
    to_name,
)


def values(spark, data, data_type, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, x {data_type}")
    picked = df.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()
    return [r["y"] for r in picked]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_event_time_never_raises(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        texts = ["2010-01-01T00:00:00.000", "2010-01-01 10:11:12.5", "2010-02-30", "", "garbage", None]
        assert values(spark, texts, "string", parse_event_time) == [
            datetime(2010, 1, 1),
            datetime(2010, 1, 1, 10, 11, 12, 500000),
            None,
            None,
            None,
            None,
        ]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_event_time_with_offset(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Bogota")
    try:
        text = ["2020-06-01T12:00:00Z", "2020-06-01T12:00:00"]
        noon = datetime(2020, 6, 1, 12)
        assert values(spark, text, "string", parse_event_time) == [noon, noon]
        assert values(spark, text, "string", lambda x: parse_event_time(x, zoned=True)) == [
            datetime(2020, 6, 1, 7),
            noon,
        ]
    finally:
        spark.conf.unset("spark.sql.session.timeZone")


def test_count_is_cut_toward_zero(spark):
    data = [1.7, -1.7, float("nan"), 3e9, 0.0, None, float("inf"), 1e30]
    assert values(spark, data, "double", to_count) == [1, -1, None, 3_000_000_000, 0, None, None, None]


def test_a_time_without_a_date_is_no_timestamp(spark):
    texts = ["12:30:00", "T12:30", "2024-05-06T12:30:00", "bad", None]
    for zoned in (False, True):
        found = values(spark, texts, "string", lambda c: parse_event_time(c, zoned))
        assert [t is None for t in found] == [True, True, False, True, True]


def test_codes_and_keys(spark):
    codes = [" 05 ", "5", "\t5", "x", "", None]
    assert values(spark, codes, "string", to_code) == ["05", "5", "\t5", "x", "", None]
    assert values(spark, [" 05 ", "5", "x", "", None], "string", to_key) == [5, 5, None, None, None]
    assert values(spark, [7, None], "int", to_code) == ["7", None]


def test_names_keep_tabs_and_enye(spark):
    assert values(spark, ["  nariño ", "\tx ", None], "string", to_name) == ["NARIÑO", "\tX", None]


def test_rates(spark):
    df = spark.createDataFrame([(1, 3), (5, 0), (5, None), (None, 3)], "e int, p bigint")
    rate = df.select(rate_per_100k(F.col("e"), F.col("p")).alias("r")).collect()
    assert [r["r"] for r in rate] == [33333.3333, None, None, None]
    ratio = df.select(safe_ratio(F.col("e"), F.col("p")).alias("r")).collect()
    assert [r["r"] for r in ratio] == [1 / 3, None, None, None]


def test_texts_for_reports(spark):
    df = spark.range(1)
    line = df.select(count_line(F.lit("id"), F.lit(12)).alias("x")).first()["x"]
    assert line == "  id             : 12"
    ts = F.lit("2024-05-06 07:08:09.9").cast("timestamp_ntz")
    assert df.select(timestamp_text(ts).alias("x")).first()["x"] == "2024-05-06 07:08:09"


def test_missing(spark):
    assert values(spark, [1.0, float("nan"), None], "double", lambda x: is_missing(x, "double")) == [
        False,
        True,
        True,
    ]
