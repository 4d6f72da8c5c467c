import math

import numpy as np
import pandas as pd
from helpers import apply
from pyspark.sql import functions as F

from tillroll.functions import numbers

TEXTS = [
    "1", "1.5", " 2 ", "\t3\n", "1e3", "1E-2", "1e", "1e+", ".5", "5.", ".", "+5", "-5", "--5", "1 000", "1,000",
    "inf", "-inf", "+inf", "Infinity", "INF", "iNfinity", "nan", "NaN", "-nan", "1d", "1f", "1D", "1F", "0x10",
    "0x1p3", "1_000", "True", "", "  ", "1e400", "-1e400", "1e-400", "12345678901234567890", " 5", "\x1c5",
    "5e5d", "1.2.3", "1e3.5", "00012", "-0", "infd", "in f", "abc", "933.35",
]


def test_coercion_equals_pandas(spark):
    expected = pd.to_numeric(pd.Series(TEXTS, dtype=object), errors="coerce")
    got = apply(spark, TEXTS, numbers.coerce_number)
    assert got == [None if math.isnan(x) else x for x in expected]


def test_missing_discount_is_zero(spark):
    assert apply(spark, [None, "x", "7.5"], numbers.discount_or_zero) == [0.0, 0.0, 7.5]


def test_rounding_equals_numpy(spark):
    rng = np.random.default_rng(3)
    values = [*(rng.integers(0, 10**7, 4000) / 1000.0), *rng.uniform(-1e5, 1e5, 2000), 0.125, 2.675, 1.005, -0.005]
    got = apply(spark, [float(v) for v in values], numbers.round_cents, "double")
    assert got == np.round(values, 2).tolist()


def test_amounts(spark):
    lines = spark.createDataFrame(
        [("Electronics", 1.0, 50.25, 20.0), ("Toys", 2.5, 10.0, 0.0), (None, 1.0, 100.0, 150.0)],
        "category string, quantity double, unit_price double, discount_percent double",
    )
    got = numbers.derive_amounts(lines).orderBy(F.col("gross_amount")).select(
        "gross_amount", "discount_amount", "net_amount", "cost_ratio", "cost_amount", "profit_amount"
    )
    assert [tuple(r) for r in got.collect()] == [
        (25.0, 0.0, 25.0, 0.6, 15.0, 10.0),
        (50.25, 10.05, 40.2, 0.68, 34.17, 6.03),
        (100.0, 150.0, -50.0, 0.6, 60.0, -110.0),
    ]
