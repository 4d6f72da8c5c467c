from datetime import date

from helpers import apply, one_column, tuples
from pyspark.sql import functions as F

from tillroll.functions import dates

CASES = {
    "2024-06-01": date(2024, 6, 1),
    "2024-6-1": date(2024, 6, 1),
    "2024-06- 1": date(2024, 6, 1),
    " 2024-06-01 ": date(2024, 6, 1),
    "01/12/2024": date(2024, 12, 1),
    "1/2/2024": date(2024, 2, 1),
    "12-01-2024": date(2024, 12, 1),
    "6-15-2024": date(2024, 6, 15),
    "06- 5-2024": date(2024, 6, 5),
    "15-Aug-2025": date(2025, 8, 15),
    "5-aug-2025": date(2025, 8, 5),
    "15-AUG-2025": date(2025, 8, 15),
    "29/02/2024": date(2024, 2, 29),
    "0001-01-01": date(1, 1, 1),
    "29/02/2023": None,
    "31/02/2024": None,
    "13-01-2024x": None,
    "15-06-2024": None,
    "06/15/2024": None,
    "24-06-01": None,
    "2024/06/01": None,
    "2024-06-01 00:00:00": None,
    "2024-06-01T00:00:00": None,
    "2024-06": None,
    "2024": None,
    "2024-00-10": None,
    "2024-10-00": None,
    "0000-01-01": None,
    "01/01/0000": None,
    "01-01-0000": None,
    "01-Jan-0000": None,
    "12024-06-01": None,
    "+2024-06-01": None,
    "15-August-2025": None,
    "15-Abc-2025": None,
    "15 Aug 2025": None,
    "/": None,
    "": None,
    None: None,
}


def test_formats(spark):
    got = apply(spark, list(CASES), dates.parse_order_date)
    assert dict(zip(CASES, got)) == CASES


def test_attributes(spark):
    days = one_column(spark, [date(2024, 12, 1), date(2025, 8, 15)], "date").select(*dates.date_attributes(F.col("c")))
    assert sorted(tuples(days, "*")) == [
        (20241201, date(2024, 12, 1), 2024, 4, 12, "December", 1, "Sunday"),
        (20250815, date(2025, 8, 15), 2025, 3, 8, "August", 15, "Friday"),
    ]
