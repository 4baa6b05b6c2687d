"""Column helpers C1-C14 (X15-X18 and the documented edges)."""

from __future__ import annotations

import datetime as dt
import math
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from visitscope.functions import (
    after,
    before,
    date_hour,
    format_date,
    format_time,
    get_field,
    minus_seconds,
    pack,
    pad_two,
    parse_time,
    round_half_up,
    set_field,
    today_date,
    trim_comma,
    yesterday_date,
)


def one(spark, col, value=None, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(col.alias("r")).collect()[0]["r"]


def test_x15_packed_get_and_set(spark):
    v = F.col("v")
    assert one(spark, get_field(v, "b"), "a=1|b=2") == "2"
    assert one(spark, get_field(v, "z"), "a=1|b=2") is None
    assert one(spark, set_field(v, "a", "9"), "a=1|b=2") == "a=9|b=2"
    assert one(spark, set_field(v, "z", "9"), "a=1|b=2") == "a=1|b=2"


def test_packed_repeated_and_second_equals(spark):
    v = F.col("v")
    assert one(spark, get_field(v, "a"), "a=1|a=2") == "1"
    assert one(spark, get_field(v, "a"), "a=x=y|b=2") == "x=y"
    assert one(spark, set_field(v, "a", "0"), "a=1|a=2") == "a=0|a=2"
    assert one(spark, get_field(v, "k"), "k=|b=2") == ""


def test_pack_order_and_nulls(spark):
    got = one(spark, pack([("x", F.lit(1)), ("y", F.col("v")), ("z", F.lit("t"))]), None)
    assert got == "x=1|y=|z=t"


def test_x16_trim_comma(spark):
    v = F.col("v")
    assert one(spark, trim_comma(v), ",,a,,") == ",a,"
    assert one(spark, trim_comma(v), ",") == ""
    assert one(spark, trim_comma(v), "a,b,") == "a,b"
    assert one(spark, trim_comma(v), "a,\n") == "a,\n"


def test_x17_pad_two(spark):
    v = F.col("v")
    assert [one(spark, pad_two(v), s) for s in ["5", "12", "123"]] == ["05", "12", "0123"]


def test_x18_bad_time_text(spark):
    v = F.col("v")
    good = F.lit("2018-04-09 12:00:00")
    assert one(spark, before(v, good), "not a time") is False
    assert one(spark, after(v, good), "not a time") is False
    assert one(spark, minus_seconds(v, good), "not a time") == 0


def test_time_compare_and_minus(spark):
    v = F.col("v")
    assert one(spark, before(v, F.lit("2018-04-09 12:00:01")), "2018-04-09 12:00:00") is True
    assert one(spark, after(v, F.lit("2018-04-09 10:00:00")), "2018-04-09 9:00:00") is False
    assert one(spark, minus_seconds(v, F.lit("2018-04-09 7:05:09")), "2018-04-09 17:05:09") == 36000
    assert one(spark, minus_seconds(F.lit("2018-04-09 7:05:09"), v), "2018-04-09 17:05:09") == -36000
    # beyond an int: 0
    assert one(spark, minus_seconds(v, F.lit("1900-01-01 0:00:00")), "2100-01-01 0:00:00") == 0


def test_parse_and_format(spark):
    v = F.col("v")
    ts = one(spark, parse_time(v), "2018-04-09 7:05:09")
    assert ts == dt.datetime(2018, 4, 9, 7, 5, 9)
    assert one(spark, parse_time(v), "2018-04-09") is None
    assert one(spark, format_time(parse_time(v)), "2018-04-09 7:05:09") == "2018-04-09 07:05:09"
    assert one(spark, format_date(parse_time(v)), "2018-04-09 7:05:09") == "2018-04-09"
    assert one(spark, date_hour(parse_time(v)), "2018-04-09 7:05:09") == "2018-04-09_07"


def test_today_and_yesterday(spark):
    today = one(spark, today_date())
    yesterday = one(spark, yesterday_date())
    d = dt.date.fromisoformat(today)
    assert dt.date.fromisoformat(yesterday) == d - dt.timedelta(days=1)


def _exact_half_up(x: float, scale: int) -> float:
    q = Decimal(1).scaleb(-scale)
    with localcontext() as ctx:
        ctx.prec = 1200
        return float(Decimal(x).quantize(q, rounding=ROUND_HALF_UP))


def test_round_half_up_binary_ties(spark):
    v = F.col("v")
    assert one(spark, round_half_up(v, 2), 1.005, "double") == 1.0
    assert one(spark, round_half_up(v, 2), 2.675, "double") == 2.67
    assert one(spark, round_half_up(v, 1), 0.25, "double") == 0.3
    assert one(spark, round_half_up(v, 1), -0.25, "double") == -0.3
    assert one(spark, round_half_up(v, 0), 2.5, "double") == 3.0
    assert one(spark, round_half_up(v, 2), None, "double") is None
    assert math.isnan(one(spark, round_half_up(v, 2), float("nan"), "double"))
    assert one(spark, round_half_up(v, 2), 1e300, "double") == 1e300
    assert one(spark, round_half_up(v, 12), 0.1234567890125, "double") == _exact_half_up(0.1234567890125, 12)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(min_value=-1e9, max_value=1e9, allow_nan=False), min_size=1, max_size=40),
       st.integers(min_value=0, max_value=4))
def test_round_half_up_matches_exact_decimal(spark, values, scale):
    df = spark.createDataFrame([(x,) for x in values], "v double")
    got = [r["r"] for r in df.select(round_half_up("v", scale).alias("r")).collect()]
    assert got == [_exact_half_up(x, scale) for x in values]


def test_round_half_up_rejects_bad_scale():
    with pytest.raises(ValueError):
        round_half_up("v", 16)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.floats(min_value=-1000, max_value=1000, allow_nan=False), min_size=1, max_size=40),
       st.integers(min_value=5, max_value=15))
def test_round_half_up_large_scales(spark, values, scale):
    df = spark.createDataFrame([(x,) for x in values], "v double")
    got = [r["r"] for r in df.select(round_half_up("v", scale).alias("r")).collect()]
    assert got == [_exact_half_up(x, scale) for x in values]


def test_round_half_up_decimal_ties_from_text(spark):
    # values whose shortest text is a tie: the stored double decides
    texts = ["0.125", "0.375", "1.005", "1.015", "1.025", "2.675", "8.345", "123456.785", "0.0005"]
    values = [float(t) for t in texts]
    df = spark.createDataFrame([(x,) for x in values], "v double")
    for scale in (0, 1, 2, 3):
        got = [r["r"] for r in df.select(round_half_up("v", scale).alias("r")).collect()]
        assert got == [_exact_half_up(x, scale) for x in values], scale


def test_round_half_up_near_two_to_the_53(spark):
    values = [451.05671128624044, 4503.599627370497, 9007.199254740991, 123456.78901234567,
              0.5000000000000001, 4.5e15 + 0.5, 9.007199254740993e15, 1e-300]
    df = spark.createDataFrame([(x,) for x in values], "v double")
    for scale in (0, 2, 11, 12, 13, 15):
        got = [r["r"] for r in df.select(round_half_up("v", scale).alias("r")).collect()]
        assert got == [_exact_half_up(x, scale) for x in values], scale


def test_packed_set_escapes_and_edges(spark):
    v = F.col("v")
    assert one(spark, set_field(v, "b", F.lit("$1\\x")), "a=1|b=2|c=3") == "a=1|b=$1\\x|c=3"
    assert one(spark, set_field(v, "a.b", "7"), "axb=1|a.b=2") == "axb=1|a.b=7"
    assert one(spark, set_field(v, "b", "7"), "a=1|b|c=3") == "a=1|b=7|c=3"
    assert one(spark, set_field(v, "c", "7"), "a=1|bc=2|c=3||") == "a=1|bc=2|c=7"
    assert one(spark, set_field(v, "z", "7"), "a=1||") == "a=1"
    assert one(spark, get_field(v, "a.b"), "axb=1|a.b=2") == "2"
    assert one(spark, get_field(v, "b"), "ab=1|b=2") == "2"
    assert one(spark, get_field(v, "b"), None) is None


def test_packed_long_records(spark):
    # entries by the ten thousand, found or not: no regular expression recursion
    entries = [f"f{i}=v{i}" for i in range(12_000)]
    long = "|".join(entries)
    df = spark.createDataFrame([(long,)], "p string")
    hit, miss, last, name = df.select(
        set_field("p", "f11999", F.lit("new")), set_field("p", "nowhere", F.lit("x")),
        get_field("p", "f11999"), get_field("p", "nowhere")).first()
    assert hit == "|".join([*entries[:-1], "f11999=new"])
    assert miss == long and last == "v11999" and name is None
    bars = spark.createDataFrame([("a=1" + "|" * 20_000 + "b=2",)], "p string")
    assert bars.select(set_field("p", "b", F.lit("3"))).first()[0] == "a=1" + "|" * 20_000 + "b=3"


def test_packed_field_boundaries(spark):
    rows = [("ab=1|b=2|b=3", "b"), ("b|a=1", "b"), ("|b=1", "b"), ("x=b=1", "b"), ("b=1||", "b"), ("a.b=1", "b"), ("", "b"), (None, "b")]
    for packed, field in rows:
        df = spark.createDataFrame([(packed,)], "p string")
        got = df.select(get_field("p", field), set_field("p", field, F.lit("N$1\\"))).first()
        if packed is None:
            assert tuple(got) == (None, None)
            continue
        parts, value, done = packed.split("|"), None, False
        for i, part in enumerate(parts):
            name, eq, rest = part.partition("=")
            if name == field and value is None and eq:
                value = rest
            if name == field and not done:
                parts[i], done = field + "=N$1\\", True
        assert tuple(got) == (value, "|".join(parts).rstrip("|")), packed


@pytest.mark.parametrize("text,want", [
    ("2024-01-05 07:05:09.0", "2024-01-05 07:05:09"), ("2024-01-05 07:05:09.123", "2024-01-05 07:05:09"),
    ("2024-1-5 7:5:9", "2024-01-05 07:05:09"), ("2024-01-05 07:05:09 x", "2024-01-05 07:05:09"),
    (" 2024-01-05   07:05:09+02:00", "2024-01-05 07:05:09"), ("2024-01-05T07:05:09", None), ("2024/01/05 07:05:09", None),
    ("2024-02-30 07:05:09", None), ("2024-01-05 25:00:00", None), ("2024-01-05 07:05", None), ("", None), ("x", None), (None, None),
])
def test_lenient_times(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    got, early, diff = df.select(format_time(parse_time("t")), before("t", F.lit("2030-01-01 0:0:0.5")),
                                 minus_seconds("t", F.lit("2024-01-05 07:05:00.9"))).first()
    assert got == want and early is (want is not None) and diff == (9 if want else 0)
