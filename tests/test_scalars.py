import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgermill.functions import merchant_ids, numbers, text
from ledgermill.plans.periods import month_spine

MONEY = {
    "money_ceil": {"0.07": 0.08, "1.1": 1.11, "-1.234": -1.23, "(12.30)": 0.0, "$1,234.50": 1234.5, "1d": 0.0,
                   "Infinity": 0.0, "": 0.0, None: 0.0, "12e2": 1200.0},
    "money_paren": {"(12.30)": -12.3, "($1,000.00)": -1000.0, "$5": 5.0, "abc": None, None: None},
    "money_paren_plain": {"(5.00)": -5.0, "2.675": 2.67, "1.115": 1.11, "0.125": 0.12, "$5": None, "": None},
    "money_lenient": {"=A1": 0.0, None: 0.0, "x": 0.0, "3.14159": 3.14},
    "money_strict": {"$1,000": 1000.0, "1d": None, "(5)": None},
    "money_coerce": {"$1,000": 1000.0, "n/a": None},
    "integral_text": {"123.7": "123", "6354000000000123": "6354000000000123", "1.5E3": "1500", "x": None},
}


@pytest.mark.parametrize("rule", MONEY)
def test_number_rules(spark, rule):
    cases = MONEY[rule]
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r.v: r.x for r in df.select("v", getattr(numbers, rule)(F.col("v")).alias("x")).collect()}
    assert got == cases


IDS = [("12-34", "s"), ("1234", "s"), ("1234", "n"), ("12.5", "n"), ("7.0", "n"), ("Total", "s"), (None, "s"), ("12.0", "s")]
EXPECTED_IDS = {
    "dash": ["12-34", "1234", "1234", "12.5", "7", None, None, None],
    "numeric": [None, "1234", "1234", "12", "7", None, None, "12"],
    "integral_kind": [None, None, "1234", None, "7", None, None, None],
    "digit_string": [None, "1234", None, None, None, None, None, None],
    "int_or_digits": [None, "1234", "1234", None, "7", None, None, None],
    "dash_text": ["12-34", "1234", "1234", None, "7", None, None, None],
}


@pytest.mark.parametrize("rule", EXPECTED_IDS)
def test_merchant_ids(spark, rule):
    df = spark.createDataFrame([(i, (v, k)) for i, (v, k) in enumerate(IDS)], "i int, c struct<value:string,kind:string>")
    out = df.select("i", getattr(merchant_ids, rule)(F.col("c")).alias("x")).orderBy("i").collect()
    assert [r.x for r in out] == EXPECTED_IDS[rule]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_similarity_is_lcs_ratio(spark):
    random.seed(3)
    def word():
        return "".join(random.choice("abcd é") for _ in range(random.randint(0, 140)))
    pairs = [("firstdirect financial", "first direct financial"), ("", "x"), ("x", "")] + [(word(), word()) for _ in range(150)]
    df = spark.createDataFrame(pairs, "t string, k string")
    out = df.select("t", "k", text.similarity(F.col("t"), F.col("k"), text.key_masks(F.col("k"))).alias("s")).collect()
    for r in out:
        assert r.s == (round(200 * lcs(r.t, r.k) / (len(r.t) + len(r.k))) if r.t and r.k else 0)
    assert out[0].s == 98


def test_dates_in_names(spark):
    df = spark.createDataFrame([("X May 2024.csv",), ("X y  february 2023",), ("Sept 2024",), ("a",)], "v string")
    got = [r.m for r in df.select(text.month_from_tokens(F.col("v")).alias("m")).collect()]
    assert got == [dt.date(2024, 5, 1), dt.date(2023, 2, 1), None, None]


def test_month_spine_overshoots_and_drifts():
    assert month_spine("2024-01-01", "2024-03-15")[-1] == dt.date(2024, 4, 1)
    assert month_spine("2024-03-01", "2024-01-01") == [dt.date(2024, 3, 1)]
    assert [d.day for d in month_spine("2024-01-31", "2024-03-01")] == [31, 29, 29]
