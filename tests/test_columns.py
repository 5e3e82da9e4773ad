import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardlake.functions import columns as C

NTZ = "a timestamp_ntz, b timestamp_ntz"


def value(spark, column, schema, row):
    return spark.createDataFrame([row], schema).select(column.alias("v")).first()[0]


@pytest.mark.parametrize(
    "birth, as_of, age",
    [
        (dt.date(2000, 2, 29), dt.date(2001, 2, 28), 0),
        (dt.date(2000, 2, 29), dt.date(2001, 3, 1), 1),
        (dt.date(1980, 6, 15), dt.date(2000, 6, 14), 19),
        (dt.date(1980, 6, 15), dt.date(2000, 6, 15), 20),
        (dt.date(2001, 6, 1), dt.date(2000, 1, 1), -1),
        (None, dt.date(2000, 1, 1), None),
    ],
)
def test_age(spark, birth, as_of, age):
    assert value(spark, C.age_years(F.col("a"), F.col("b")), "a date, b date", (birth, as_of)) == age


@pytest.mark.parametrize("age, band", [(0, "0-18"), (18, "0-18"), (19, "19-35"), (60, "36-60"), (61, "60+"), (None, "60+")])
def test_age_band(spark, age, band):
    assert value(spark, C.age_band(F.col("a")), "a int", (age,)) == band


@pytest.mark.parametrize("minutes, hours", [(29, 0), (30, 1), (90, 2), (-30, -1), (149, 2)])
def test_stay_hours_round_half_away_from_zero(spark, minutes, hours):
    start = dt.datetime(2000, 1, 1)
    row = (start, start + dt.timedelta(minutes=minutes))
    assert value(spark, C.stay_hours(F.col("a"), F.col("b")), NTZ, row) == hours


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize("moment", [dt.datetime(2000, 4, 2, 2, 30, 0, 7), dt.datetime(1955, 1, 1, 23, 59, 59, 999999)])
def test_epoch_micros_ignore_the_session_zone(spark, zone, moment):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        micros = value(spark, C.epoch_micros(F.col("a")), "a timestamp_ntz", (moment,))
        back = value(spark, C.micros_to_timestamp(F.col("a")), "a bigint", (micros,))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert micros == (moment - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    assert back == moment


@pytest.mark.parametrize(
    "day, year, quarter",
    [(dt.date(2000, 6, 30), 2000, 4), (dt.date(2000, 7, 1), 2001, 1), (dt.date(2000, 12, 31), 2001, 2), (dt.date(2001, 1, 1), 2001, 3)],
)
def test_fiscal_calendar(spark, day, year, quarter):
    assert value(spark, C.fiscal_year(F.col("a")), "a date", (day,)) == year
    assert value(spark, C.fiscal_quarter(F.col("a")), "a date", (day,)) == quarter


def test_rounding_and_guards(spark):
    assert value(spark, C.rounded(F.col("a"), 2), "a double", (2.675,)) == 2.68
    assert value(spark, C.rounded(F.col("a"), 2), "a double", (-2.675,)) == -2.68
    assert value(spark, C.percent(F.col("a"), F.col("b"), 2), "a int, b int", (1, 0)) == 0.0
    assert value(spark, C.ratio(F.col("a"), F.col("b")), "a int, b int", (1, 0)) is None


def test_texts(spark):
    assert value(spark, C.joined_text(F.col("a"), F.lit(" "), F.col("b")), "a string, b string", (None, "x")) is None
    assert value(spark, C.month_name(F.col("a")), "a int", (5,)) == "May      "
    assert value(spark, C.date_key(F.col("a")), "a date", (dt.date(2001, 3, 4),)) == 20010304
