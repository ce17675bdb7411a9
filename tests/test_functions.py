import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from yearwheel.functions import (
    length_of_stay_band,
    measure_text,
    quarter_end_date,
    quoted,
    recode,
    year_end_description,
    year_end_label,
    year_end_quarter,
    year_end_year,
)
from yearwheel.functions.periods import lagged_month_end
from yearwheel.functions.recode import DESTINATION_RULES, PURPOSE_RULES

BANDS = {
    0.0: "0 nights",
    1.0: "1 nights",
    1.5: "1.5 nights",
    14.0: "14 nights",
    14.5: "Error - more than one year",
    15.0: "15 nights to less than one month",
    30.4374: "15 nights to less than one month",
    30.4375: "One month to less than two months",
    60.875: "Two months to less than three months",
    91.3125: "Three months to less than six months",
    182.625: "Six months to less than one year",
    365.2499: "Six months to less than one year",
    365.25: "Error - more than one year",
    None: None,
}


def test_length_of_stay_bands(table):
    df = table("x double", [(x,) for x in BANDS]).withColumn("band", length_of_stay_band(F.col("x")))
    assert {r.x: r.band for r in df.collect()} == BANDS


def test_length_of_stay_of_decimals_prints_whole_numbers(table):
    df = table("x decimal(9,2)", [(Decimal("3.00"),), (Decimal("3.50"),)])
    bands = [r[0] for r in df.select(length_of_stay_band(F.col("x"))).collect()]
    assert bands == ["3 nights", "3.5 nights"]


@pytest.mark.parametrize(
    ("quarter", "labels"),
    [
        (1, ["YEMar2001", "YEJun2001", "YESep2001", "YEDec2001"]),
        (2, ["YEMar2002", "YEJun2001", "YESep2001", "YEDec2001"]),
        (3, ["YEMar2002", "YEJun2002", "YESep2001", "YEDec2001"]),
        (4, ["YEMar2002", "YEJun2002", "YESep2002", "YEDec2001"]),
        (None, [None] * 4),
    ],
)
def test_year_end_labels(table, quarter, labels):
    df = table("y int, q int", [(2001, quarter)])
    names = ["YEMar", "YEJun", "YESep", "YEDec"]
    got = df.select(*[year_end_label(n, F.col("y"), F.col("q")) for n in names]).first()
    assert list(got) == labels


def test_year_end_label_is_taken_apart(table):
    df = table("l string", [("YEMar2003",), ("YEDec1999",)])
    label = F.col("l")
    got = df.select(year_end_year(label), year_end_quarter(label), year_end_description(label)).collect()
    assert [tuple(r) for r in got] == [(2003, 1, "YEMar 2003"), (1999, 4, "YEDec 1999")]


def test_month_ends(table):
    df = table("y int, q int", [(2000, 1), (2000, 2), (2000, 3), (2000, 4)])
    end = quarter_end_date(F.col("y"), F.col("q"))
    got = [tuple(r) for r in df.select(end, lagged_month_end(end, 3), lagged_month_end(end, 9)).collect()]
    assert got[0] == (dt.date(2000, 3, 31), dt.date(1999, 12, 31), dt.date(1999, 6, 30))
    assert got[1][0] == dt.date(2000, 6, 30) and got[1][1] == dt.date(2000, 3, 31)
    assert got[3] == (dt.date(2000, 12, 31), dt.date(2000, 9, 30), dt.date(2000, 3, 31))


def test_recode_is_exact_in_blanks_and_case(table):
    values = ["REFUSED", "Refused", "Business   ", "Business  ", "Visiting relatives", "Skiing", None]
    df = table("v string", [(v,) for v in values])
    got = [r[0] for r in df.select(recode(F.col("v"), PURPOSE_RULES)).collect()]
    assert got == ["Refused", "Refused", "Business", "Business  ", "Visiting Relatives", "Skiing", None]
    other = table("v string", [("Other   ",), ("Other ",)])
    assert [r[0] for r in other.select(recode(F.col("v"), DESTINATION_RULES)).collect()] == ["Other", "Other "]


def test_measures_as_text(table):
    df = table("x double", [(x,) for x in (0.5, 1.5, 2.5, -0.3, 1e15, 8486492593.1)])
    got = [tuple(r) for r in df.select(measure_text(F.col("x")), measure_text(F.col("x"), 2)).collect()]
    assert [g[0] for g in got] == ["0", "2", "2", "0", "1000000000000000", "8486492593"]
    assert got[0][1] == "0.50" and got[5][1] == "8486492593.10"


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.decimals(-(10**12), 10**12, places=2), min_size=1, max_size=20))
def test_decimal_text_agrees_with_half_even_rounding(table, values):
    df = table("x decimal(18,2)", [(v,) for v in values])
    got = [tuple(r) for r in df.select("x", measure_text(F.col("x")), measure_text(F.col("x"), 2)).collect()]
    for x, whole, cents in got:
        assert Decimal(whole) == x.quantize(Decimal(1), rounding="ROUND_HALF_EVEN")
        assert cents == f"{x:.2f}"


def test_quoted(table):
    assert table("v string", [("a, b",)]).select(quoted(F.col("v"))).first()[0] == '"a, b"'


def test_shuffle_partitions_follow_what_is_shuffled(spark, tmp_path):
    from yearwheel.session import shuffle_partitions, shuffled_bytes

    assert [shuffle_partitions(n) for n in (10**9, 10**12, 10**14)] == [200, 3726, 372530]
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "repeat('x', 100) AS a", "repeat('y', 100) AS b").write.parquet(path)
    whole = spark.read.parquet(path)
    assert 0 < shuffled_bytes(whole.select("id")) < shuffled_bytes(whole)
