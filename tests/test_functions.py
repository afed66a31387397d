from __future__ import annotations

import random
import hashlib
import hmac
from datetime import date, datetime, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sedimenta import functions as fn
from sedimenta.functions.keys import NULL_IN_KEY


def one(spark, column, **values):
    """Value of `column` over one row of the given columns."""
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "text, integer, number",
    [
        ("2.7", 3, 2.7),
        ("2.5", 3, 2.5),
        ("-2.5", -3, -2.5),
        (" 12 ", 12, 12.0),
        ("1e2", 100, 100.0),
        ("1_000", 1000, 1000.0),
        ("12.", 12, 12.0),
        (".5", 1, 0.5),
        ("1d", None, None),
        ("", None, None),
        ("abc", None, None),
        ("1,5", None, None),
        ("2147483648", None, 2147483648.0),
        ("99999999999999999999999999999999999999999999", None, 1e44),
    ],
)
def test_number_casts(spark, text, integer, number):
    assert one(spark, fn.to_int(F.col("t")), t=text) == integer
    assert one(spark, fn.to_double(F.col("t")), t=text) == number


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-1-5", date(2025, 1, 5)),
        (" 2025-01-05 ", date(2025, 1, 5)),
        ("2025/01/05", date(2025, 1, 5)),
        ("2025-01-05 10:00:00", date(2025, 1, 5)),
        ("2025", None),
        ("05-01-2025", None),
        ("2025-13-01", None),
        ("2025-02-30", None),
        ("20250105", None),
        ("2025-01-05x", None),
    ],
)
def test_date_cast(spark, text, expected):
    assert one(spark, fn.to_date(F.col("t")), t=text) == expected


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(min_value=-(10**11), max_value=10**11))
def test_number_text_is_the_shortest_text(spark, micros):
    value = micros / 1_000_000
    assert one(spark, fn.number_text("v"), v=value) == repr(value)


@pytest.mark.parametrize("value, text", [(0.0, "0.0"), (3.0, "3.0"), (0.0001, "0.0001"), (1e-5, "1e-05"), (1.2e-5, "1.2e-05"), (1e-6, "1e-06")])
def test_number_text_of_small_values(spark, value, text):
    assert one(spark, fn.number_text("v"), v=value) == text


@pytest.mark.parametrize(
    "value, text", [(3.0, "3"), (2.5, "2.5"), (0.1234567, "0.123457"), (1234567.25, "1234567.25"), (-0.0000001, "0"), (float("nan"), "nan")]
)
def test_cell_text_of_numbers(spark, value, text):
    assert one(spark, fn.cell_text(number=F.col("v")), v=value) == text


def test_cell_text_of_other_cells(spark):
    assert one(spark, fn.cell_text(moment=F.col("v")), v=datetime(2026, 5, 27, 14, 13)) == "2026-05-27"
    assert one(spark, fn.cell_text(other=F.col("v")), v="x") == "x"
    assert one(spark, fn.cell_text(number=F.col("v").cast("double"), other=F.lit(None).cast("string")), v=None) == ""


def test_blank_to_null(spark):
    assert one(spark, fn.blank_to_null(F.col("t")), t="   ") is None
    assert one(spark, fn.blank_to_null(F.col("t").cast("string")), t=None) is None
    assert one(spark, fn.blank_to_null(F.col("t")), t=" a ") == "a"


def test_surrogate_key_takes_nulls(spark):
    expected = hashlib.md5(f"a-{NULL_IN_KEY}-3".encode()).hexdigest()
    got = one(spark, fn.surrogate_key("a", F.col("b").cast("string"), "c"), a="a", b=None, c=3)
    assert got == expected


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(max_size=50), st.binary(min_size=1, max_size=64))
def test_hmac_is_the_standard_one(spark, message, key):
    message = message.encode("utf-8", "ignore").decode()
    assert one(spark, fn.hmac_sha256(F.col("m"), key), m=message) == hmac.new(key, message.encode(), hashlib.sha256).hexdigest()


def test_fingerprint_ignores_the_order_of_keys(spark):
    a = one(spark, fn.fingerprint({"x": F.col("x"), "y": F.col("y").cast("string")}), x=1, y=None)
    b = one(spark, fn.fingerprint({"y": F.col("y").cast("string"), "x": F.col("x")}), x=1, y=None)
    assert a == b == hashlib.sha256(b'{"x":1,"y":null}').hexdigest()[:16]


def test_rounding_is_by_decimal_digits(spark):
    assert one(spark, fn.round_half_up(F.col("v"), 2), v=1.005) == 1.01


@pytest.mark.parametrize("value", [1.0049999996, 1e12, 1e25, -2.5e30, float("inf"), 0.005, -1.005])
def test_rounding_neither_rounds_twice_nor_fails(spark, value):
    want = {1.0049999996: 1.0, 0.005: 0.01, -1.005: -1.01}.get(value, value)
    assert one(spark, fn.round_half_up(F.col("v"), 2), v=value) == want


@pytest.mark.parametrize(
    "value, text",
    [(0.1234567, "0.1234567"), (1e-7, "1e-07"), (1e12, "1000000000000.0"), (1.5e15, "1500000000000000.0"), (1e16, "1e+16"), (-1.25e100, "-1.25e+100"),
     (float("inf"), "inf"), (float("-inf"), "-inf"), (float("nan"), "nan"), (-0.0, "0.0"), (0.00025, "0.00025"), (123456789.125, "123456789.125"), (-5e-324, None)],
)
def test_number_text_keeps_every_digit(spark, value, text):
    got = one(spark, fn.number_text("v"), v=value)
    assert got == text if text is not None else float(got) == value


def test_number_texts_of_all_magnitudes(spark):
    rnd = random.Random(5)
    values = [rnd.choice((1, -1)) * rnd.random() * 10.0 ** rnd.randint(-12, 20) for _ in range(3000)]
    values += [float(f"{m}e{p}") for m in ("1", "1.5", "9.999999999999999") for p in range(-8, 20)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", fn.number_text("v").alias("t"), fn.number_texts("v", "v").alias("ts")).collect()
    assert all(float(r["t"]) == r["v"] and r["ts"] == [r["t"]] * 2 for r in rows)
    # repr() switches to exponents where this text does; Java may write one digit more than the shortest
    assert sum(r["t"] == repr(r["v"]) for r in rows) > 0.9 * len(rows)
    assert all(("e" in r["t"]) == ("e" in repr(r["v"])) for r in rows)


@pytest.mark.parametrize("zone", ["UTC", "America/Santiago", "Europe/Berlin", "Pacific/Auckland"])
def test_instants_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # every ten minutes around both changes of the clock in Chile in 2025
        starts = [1743850800 + 600 * i for i in range(48)] + [1757203200 + 600 * i for i in range(48)]
        df = spark.createDataFrame([(s,) for s in starts], "s long").select("s", F.timestamp_seconds("s").alias("t"))
        for r in df.select("s", fn.utc_iso(F.col("t")).alias("x")).collect():
            assert r["x"] == datetime.fromtimestamp(r["s"], timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.000Z")
        civil = F.lit("2025-09-06 20:30:00").cast("timestamp_ntz")
        assert df.limit(1).select(fn.local_to_utc(civil, "America/Santiago")).first()[0] == "2025-09-07T00:30:00.000Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_times(spark):
    moment = datetime(2026, 5, 27, 10, 13, 57)
    assert one(spark, fn.local_to_utc(F.col("v").cast("timestamp_ntz"), "America/Santiago"), v=moment) == "2026-05-27T14:13:57.000Z"
    assert one(spark, fn.utc_iso(F.col("v")), v=moment) == "2026-05-27T10:13:57.000Z"


def test_year_from_position(spark):
    years = [one(spark, fn.year_from_position(F.col("c"), 2025), c=c) for c in ("column01", "column52", "column53", "column71", "column106")]
    assert years == [2025, 2025, 2026, 2026, 2026]
