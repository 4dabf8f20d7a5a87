"""Parametrised scalar cases (money, dates, nullish, rates, ambiguity, keys, labels, FX)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from billframe import functions as BF
from billframe.operators.fx import to_gbp


def _one(spark, col_fn, values, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(col_fn(F.col("v"))).collect()]


MONEY = [("7,250.00", "7250"), ("Rs. 4,180.50", "4180.50"), ("INR 91.07", "91.07"), ("£36.00", "36"),
         ("2 4 6,018.00", "246018"), ("", "0"), (None, "0"), ("null", "0"), ("N/A", "0"), ("-", "0"),
         ("(310.00)", "-310"), ("-4,400.00", "-4400"), ("(-5)", "5")]


def test_money_values(spark):
    got = _one(spark, BF.money_value, [m for m, _ in MONEY])
    assert [Decimal(g).normalize() for g in got] == [Decimal(e).normalize() for _, e in MONEY]


def test_money_errors(spark):
    assert _one(spark, BF.money_error, ["nine hundred", "₹(5)", "12abc", "91.07"]) == [True, True, True, False]


DATES = [("19-08-2021", dt.date(2021, 8, 19)), ("27/03/2024", dt.date(2024, 3, 27)), ("2023-02-14", dt.date(2023, 2, 14)),
         ("9 Nov 2022", dt.date(2022, 11, 9)), ("9 November 2022", dt.date(2022, 11, 9)),
         ("30-Sep-2024", dt.date(2024, 9, 30)), ("17.12.2023", dt.date(2023, 12, 17)),
         ("March 8, 2022", dt.date(2022, 3, 8)), ("06/09/2023", dt.date(2023, 9, 6)),
         ("08/21/2024", dt.date(2024, 8, 21)), ("some Friday", None), (None, None), ("30-02-2024", None),
         ("9  Nov   2022", dt.date(2022, 11, 9)), ("123-05-2022", None)]


def test_dates(spark):
    assert _one(spark, BF.parse_date, [d for d, _ in DATES]) == [e for _, e in DATES]


@pytest.mark.parametrize("raw,expected", [("06/09/2023", True), ("10-12-2024", True), ("19-08-2021", False),
                                          ("2023-02-14", False), ("9 Nov 2022", False), (None, False), ("5/5/25", True)])
def test_ambiguous(spark, raw, expected):
    assert _one(spark, BF.date_is_ambiguous, [raw]) == [expected]


def test_nullish(spark):
    vals = ["null", "None", "NaN", "n/a", "NA", "", "   ", None, " Acme "]
    assert _one(spark, BF.optional_text, vals) == ["N/A"] * 8 + ["Acme"]
    assert _one(spark, BF.mandatory_text_error, vals) == [True] * 8 + [False]


def test_rate_nonzero(spark):
    vals = ["4%+4%", "12%", "7%", "0%", "0%+0%", "N/A", "", None]
    assert _one(spark, BF.rate_is_nonzero, vals) == [True, True, True, False, False, False, False, False]


def test_key_fold(spark):
    vals = ["Pier Nine//2019-20/88", "Pier  Nine // 2019-20 / 88", "pier nine 2019 20 88",
            "PIER-NINE/2019/20/88", "Café", "Cafe", None, "ﬁne ½"]
    got = _one(spark, BF.fold_key, vals)
    assert got[:4] == ["PIERNINE20192088"] * 4
    assert got[4] == got[5] == "CAFE"
    assert got[6] == ""
    assert got[7] == "FINE12"


def test_labels(spark):
    vals = ["-\nRebate (SPRING)", "Bill   Issued:\n", "•  Shop Name", "", None]
    assert _one(spark, BF.normalize_label, vals) == ["Rebate (SPRING)", "Bill Issued:", "Shop Name", "", ""]


def test_fx_half_up(spark):
    df = spark.createDataFrame([("7250",), ("91.07",), ("0",), ("1.25",)], "a string")
    got = [r[0] for r in df.select(to_gbp(F.col("a").cast("decimal(28,8)"), F.lit(125).cast("decimal(18,8)"))).collect()]
    assert [Decimal(g).quantize(Decimal("0.01")) for g in got] == [Decimal("58.00"), Decimal("0.73"), Decimal("0.00"), Decimal("0.01")]


def test_sub_penny_is_zero_total(spark):
    from billframe.operators.records import build_records

    fields = {"date": "19-08-2021", "company_name": "A", "buyer_name": "B", "invoice_reference_number": "R",
              "product_name": "", "product_amount": "10", "total_amount": "0.40", "vat_tax_label": "",
              "vat_tax_percentage": "", "vat_tax_amount": "", "coupon_discount_amount": "", "mode_of_payment": "",
              "currency": "INR"}
    df = spark.createDataFrame([("x.pdf", 1, fields)], "source_file string, load_order long, fields map<string,string>")
    df = df.select("source_file", "load_order", F.struct(*[F.col("fields")[k].alias(k) for k in fields]).alias("fields"))
    r = build_records(df).collect()[0]
    assert r["total_amount"] == Decimal("0")
    assert "ZERO_TOTAL_AMOUNT" in r["dq_flags"]
