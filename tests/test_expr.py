"""Scalar expressions on hand-written edge rows."""

from pyspark.sql import functions as F

from arearisk.functions import expr as X
from conftest import rows


def one(spark, data, schema, *exprs):
    df = spark.createDataFrame(data, schema)
    return [tuple(r) for r in df.select(*exprs).collect()]


def test_ordinal_street_names(spark):
    names = ["WEST 14 ST", "111 ST", "22 ST", "3 AVE", "110 ST", "AVE OF THE AMER", "1 AVE", "101 ST",
             "12 ST", "BROADWAY", " 2 AVE ", "E 213 ST"]
    got = one(spark, [(n,) for n in names], "n string", X.ordinal_street_name("n").alias("o"))
    assert [g[0] for g in got] == ["WEST 14th ST", "111th ST", "22nd ST", "3rd AVE", "110th ST",
                                   "AVE OF THE AMERICAS", "1st AVE", "101st ST", "12th ST", "BROADWAY",
                                   "2nd AVE", "E 213th ST"]


def test_labels(spark):
    got = one(spark, [(241, 38.0, "TAXI", 1330, 6658)], "n long, p double, name string, k long, t long",
              X.label_count_pct0("n", "p"),
              X.label_name_count_pct("name", "k", X.share_pct("k", "t")))
    assert got == [("241: 38.0%", "TAXI: 1330: 19.98%")]


def test_share_and_rates_zero_denominators(spark):
    got = one(spark, [(3, 0, 0)], "a long, b long, z long",
              X.share_pct("a", "z"), X.rate_per_1000("a", "z"), X.ratio_rounded("a", "z"),
              X.label_count_pct0("b", X.share_pct("b", "z")))
    assert got == [(0.0, None, None, "0: 0.0%")]


def test_rate_rounding(spark):
    got = one(spark, [(1598, 1858000, 545, 1598)], "a long, v long, i long, n long",
              X.rate_per_1000("a", "v"), X.rate_per_1000("i", "n"))
    assert got == [(0.86, 341.05)]


def test_case_class(spark):
    data = [("PASSENGER VEHICLE",), ("SMALL COM VEH(4 TIRES)",), ("Driver Inattention",), ("123",), ("",)]
    got = one(spark, data, "c string", "c", X.case_class_upper("c"))
    assert got == [("PASSENGER VEHICLE", True), ("SMALL COM VEH(4 TIRES)", True),
                   ("Driver Inattention", False), ("123", False), ("", False)]


def test_capitalize_and_upper(spark):
    got = one(spark, [("NEW YORK", "Street Sign - Missing")], "c string, k string",
              X.capitalize_label("c"), X.upper_label("k"))
    assert got == [("New york", "STREET SIGN - MISSING")]


def test_int_casts(spark):
    data = [("00083",), (" 12 ",), ("x",), ("",), ("12.0",), ("-4",)]
    got = one(spark, data, "s string", "s", X.lenient_int("s"), X.normalize_int_key("s"), X.is_int_text("s"))
    assert got == [("00083", 83, "83", True), (" 12 ", 12, "12", True), ("x", 0, None, False),
                   ("", 0, None, False), ("12.0", 0, None, False), ("-4", -4, "-4", True)]


def test_floor_fraction_and_idiv(spark):
    got = one(spark, [(7, 0, 100)], "a long, z long, v long",
              X.floor_fraction("a", 2), X.floor_fraction("v", 3), X.floor_fraction("v", 3, 2),
              X.idiv("a", "z"), X.idiv("v", 7))
    assert got == [(3, 33, 66, None, 14)]


def test_count_nonempty_and_hsum(spark):
    got = one(spark, [("a", "", None, "b")], "a string, b string, c string, d string",
              X.count_nonempty(["a", "b", "c", "d"]), X.hsum([F.lit(1), F.lit(2), F.lit(3)]))
    assert got == [(2, 6)]


def test_concat_fields_keeps_empty_parts(spark):
    got = one(spark, [("Rough", " Pitted", "")], "a string, b string, c string",
              X.concat_fields("a", "b"), X.concat_fields("a", "c", "b"))
    assert got == [("Rough  Pitted", "Rough   Pitted")]


def test_rows_helper(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "x int, y string")
    assert rows(df) == [(1, "a"), (2, "b")]
