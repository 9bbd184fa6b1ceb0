import math
import random
import statistics
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeworks.functions import (
    decode,
    encode_reading,
    encode_result,
    epoch_ms,
    BAND,
    PIECES,
    band_pieces,
    exact_sum_columns,
    exact_sum_value,
    from_epoch_ms,
    iso_text,
    parse_iso,
    round_half_even_2,
    window_label,
)
from helpers import JOB_FAILED, at, readings


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_rounding_of_known_ties(spark):
    values = [2.675, 1.335, 0.125, 0.375, 53.495, -0.125, -2.675, 1e15, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(round_half_even_2(F.col("x"))).collect()]
    assert got == [round(v, 2) for v in values]
    assert got[:5] == [2.67, 1.33, 0.12, 0.38, 53.49]


def test_rounding_equals_python_on_means_and_medians(spark):
    rng = random.Random(7)
    values = []
    for _ in range(20_000):
        xs = [round(rng.uniform(-40, 95), 2) for _ in range(rng.randint(1, 9))]
        values += [sum(xs) / len(xs), statistics.median(xs)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(round_half_even_2(F.col("x"))).collect()]
    assert got == [round(v, 2) for v in values]


def test_rounding_passes_non_finite_through(spark):
    df = spark.createDataFrame([(math.nan,), (math.inf,), (-math.inf,)], "x double")
    nan, up, down = (r[0] for r in df.select(round_half_even_2(F.col("x"))).collect())
    assert math.isnan(nan) and up == math.inf and down == -math.inf


@pytest.mark.parametrize(
    ("text", "micros"), [("01.000Z", 0), ("01.1Z", 100_000), ("01.123456Z", 123_456)]
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_iso_text_parses_as_utc_in_any_zone(spark, text, micros, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = texts(spark, "2024-01-15T14:23:" + text)
        got = df.select(F.unix_micros(parse_iso(F.col("value")))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == int(at(1).timestamp()) * 1_000_000 + micros


@pytest.mark.parametrize(
    "text",
    [
        "2024-01-15T14:23:01Z",
        "2024-01-15T14:23:01.000+00:00",
        "2024-01-15T14:23:01.000",
        "2024-01-15T14:23:01.1234567Z",
        "2024-1-15T14:23:01.000Z",
        "2024-01-15 14:23:01.000Z",
        "soon",
    ],
)
def test_other_time_texts_fail(spark, text):
    with pytest.raises(JOB_FAILED):
        texts(spark, text).select(parse_iso(F.col("value"))).collect()


def test_epoch_milliseconds_cut_finer_digits(spark):
    df = spark.sql("SELECT timestamp_micros(1705328581123999) AS t, timestamp_micros(-1500) AS b")
    row = df.select(epoch_ms(F.col("t")), epoch_ms(F.col("b"))).first()
    assert tuple(row) == (1705328581123, -1)
    back = df.select(F.unix_micros(from_epoch_ms(epoch_ms(F.col("t"))))).first()[0]
    assert back == 1705328581123000


def test_iso_text_and_label_in_another_zone(spark, other_zone):
    # 07:30 UTC on this day is inside the hour New York skips.
    df = spark.sql(
        "SELECT timestamp_millis(1705328581007) AS t, timestamp_seconds(1710055800) AS gap"
    )
    assert df.select(iso_text(F.col("t"))).first()[0] == "2024-01-15T14:23:01.007Z"
    assert df.select(iso_text(F.col("gap"))).first()[0] == "2024-03-10T07:30:00.000Z"
    assert df.select(window_label(F.col("t"))).first()[0] == "14:23"


def test_label_before_the_epoch(spark):
    df = spark.sql("SELECT timestamp_seconds(-60) AS t")
    assert df.select(window_label(F.col("t"))).first()[0] == "23:59"


def exact_sums(df):
    """The sums of ``x`` by ``k``."""
    pieces = exact_sum_columns(F.col("x"))
    banded = (
        df.select("k", *[c.alias(k) for k, c in pieces.items()])
        .groupBy("k", BAND)
        .agg(*[F.sum(k).alias(k) for k in PIECES])
    )
    whole = banded.groupBy("k").agg(F.collect_list(band_pieces()).alias("bands"))
    return dict(whole.select("k", exact_sum_value(F.col("bands"))).collect())


def exact_mean_sum(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    return exact_sums(df.withColumn("k", F.lit(0)))[0]


@settings(max_examples=25, deadline=None)
@given(
    st.lists(
        st.floats(0.01, 1e5).flatmap(lambda x: st.sampled_from([x, -x])), min_size=1, max_size=60
    )
)
def test_sum_is_the_correctly_rounded_one(spark, xs):
    assert exact_mean_sum(spark, xs) == math.fsum(xs)


def test_sum_of_two_equals_float_addition(spark):
    rng = random.Random(3)
    rows = [(i, round(rng.uniform(-50, 50), 2)) for i in range(4000) for _ in range(2)]
    df = spark.createDataFrame(rows, "k int, x double").repartition(7)
    got = exact_sums(df)
    want = {}
    for k, x in rows:
        want[k] = want[k] + x if k in want else x
    assert got == want


def test_sum_of_mixed_sizes_does_not_depend_on_order(spark):
    rng = random.Random(9)
    xs = [rng.uniform(-1, 1) * 2.0 ** rng.randint(-40, 900) for _ in range(400)]
    xs += [131072.0, -131072.0, 131071.99, 2.0**25, 1e6 + 0.25, -1e6, 1.7976931348623157e308, -1.7e308]
    sums = set()
    for seed in range(4):
        random.Random(seed).shuffle(xs)
        df = spark.createDataFrame([(0, x) for x in xs], "k int, x double").repartition(seed + 1)
        sums.add(exact_sums(df)[0])
    assert len(sums) == 1
    assert sums.pop() == pytest.approx(math.fsum(xs), rel=1e-15)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.floats(131072, 1e300), min_size=1, max_size=1))
def test_sum_of_one_large_value_is_that_value(spark, xs):
    assert exact_mean_sum(spark, xs) == xs[0]


def test_sum_keeps_extreme_and_non_finite_values(spark):
    assert exact_mean_sum(spark, [1e300, 1.5]) == 1e300 + 1.5
    assert exact_mean_sum(spark, [math.inf, 1.0]) == math.inf
    assert math.isnan(exact_mean_sum(spark, [math.nan, 1.0]))
    assert math.isnan(exact_mean_sum(spark, [math.inf, -math.inf]))


# Field names and the format of the time are fixed values; the rest is made up.
GOOD = (
    '{"device_id":"boiler-7","type_id":3,"event_time":"2024-01-15T14:23:01.000Z",'
    '"temperature":18.25,"humidity":40.5}'
)


def test_decode_of_the_documented_message(spark):
    row = decode(texts(spark, GOOD)).first()
    assert row.asDict() == {
        "device_id": "boiler-7",
        "type_id": 3,
        "temperature": 18.25,
        "humidity": 40.5,
        "event_time": datetime(2024, 1, 15, 14, 23, 1),
    }


def test_decode_ignores_unknown_fields_and_takes_whole_numbers(spark):
    text = GOOD.replace("40.5", '61,"firmware":{"v":2}')
    assert decode(texts(spark, text)).first().humidity == 61.0


def test_decode_cuts_to_milliseconds(spark):
    text = GOOD.replace("01.000Z", "01.123456Z")
    assert decode(texts(spark, text)).first().event_time == datetime(2024, 1, 15, 14, 23, 1, 123000)


def test_surrounding_space_and_repeated_fields(spark):
    text = "  " + GOOD[:-1] + ',"humidity":1.5}  '
    assert decode(texts(spark, text)).first().humidity == 1.5


def test_bare_nan_passes(spark):
    assert math.isnan(decode(texts(spark, GOOD.replace("18.25", "NaN"))).first().temperature)


@pytest.mark.parametrize("text", ['NaN,"note":"NaN, -Infinity]"', '-Infinity,"note":"],["'])
def test_bare_words_and_brackets_in_strings_pass(spark, text):
    row = decode(texts(spark, GOOD.replace("18.25", text))).first()
    assert not math.isfinite(row.temperature)


BAD = {
    "text": "not json",
    "truncated": GOOD[:40],
    "missing device": GOOD.replace('"device_id":"boiler-7",', ""),
    "missing type": GOOD.replace('"type_id":3,', ""),
    "missing time": GOOD.replace('"event_time":"2024-01-15T14:23:01.000Z",', ""),
    "missing humidity": GOOD.replace(',"humidity":40.5', ""),
    "null device": GOOD.replace('"boiler-7"', "null"),
    "null message": None,
    "text after it": GOOD + " and more",
    "second message after it": GOOD + GOOD,
    "second message after a comma": GOOD + "," + GOOD,
    "closed twice": GOOD + "}",
    "closed twice and a second message": GOOD + "}" + GOOD,
    "a further member after it": GOOD + ',"x":1',
    "a second message as a member": GOOD + ',"message":' + GOOD,
    "a forged end": GOOD + ',"whole":true} trailing',
    "a forged end and a second message": GOOD + ',"whole":true}' + GOOD,
    "list end and beginning": GOOD + "],[" + GOOD,
    "in a list": "[" + GOOD + "]",
    "only a list end": GOOD + "]",
    "comment after it": GOOD + " // checked",
    "single quotes": GOOD.replace('"', "'"),
    "empty": "",
    "null literal": "null",
    "type as text": GOOD.replace(":3,", ':"3",'),
    "type as fraction": GOOD.replace(":3,", ":3.7,"),
    "bad time": GOOD.replace("01.000Z", "01Z"),
}


@pytest.mark.parametrize("case", BAD)
def test_bad_messages_fail_the_job_even_when_only_counted_by_window(spark, case):
    df = decode(texts(spark, GOOD, BAD[case]))
    with pytest.raises(JOB_FAILED):
        df.groupBy(F.window("event_time", "1 minute"), "type_id").count().collect()


def test_reading_round_trip(spark):
    df = readings(spark, [(1, 1.25, 20.5, 50.0), (2, 59.999, -3.25, 60.25)])
    again = decode(df.select(encode_reading().alias("value")))
    assert sorted(again.collect()) == sorted(df.collect())


def test_result_message_is_the_documented_one(spark):
    df = spark.createDataFrame(
        [("14:23", "Multi-Sensor", 27.41, 62.5)],
        "window_time string, type_name string, avg_temperature double, median_humidity double",
    )
    assert df.select(encode_result()).first()[0] == (
        '{"window_time":"14:23","type_name":"Multi-Sensor",'
        '"avg_temperature":27.41,"median_humidity":62.5}'
    )
