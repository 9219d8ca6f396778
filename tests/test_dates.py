from datetime import datetime

import pytest
from pyspark.sql import functions as F

from textloom.functions.dates import NAMES, parse_date

DAY = datetime(2021, 2, 3)
CASES = {
    "epoch_millis": ("1612310400000", DAY), "epoch_second": ("1612310400", DAY),
    "date_optional_time": ("2021-02-03T04:05:06.007Z", datetime(2021, 2, 3, 4, 5, 6, 7000)), "strict_date_optional_time": ("2021-02-03", DAY),
    "strict_date_optional_time_nanos": ("2021-02-03T04:05:06.000007Z", datetime(2021, 2, 3, 4, 5, 6, 7)),
    "basic_date": ("20210203", DAY), "basic_date_time": ("20210203T040506.007+0100", datetime(2021, 2, 3, 3, 5, 6, 7000)),
    "basic_date_time_no_millis": ("20210203T040506Z", datetime(2021, 2, 3, 4, 5, 6)), "basic_ordinal_date": ("2021034", DAY),
    "basic_ordinal_date_time": ("2021034T040506.007Z", datetime(2021, 2, 3, 4, 5, 6, 7000)), "basic_ordinal_date_time_no_millis": ("2021034T040506Z", datetime(2021, 2, 3, 4, 5, 6)),
    "basic_time": ("040506.007Z", datetime(1970, 1, 1, 4, 5, 6, 7000)), "basic_time_no_millis": ("040506Z", datetime(1970, 1, 1, 4, 5, 6)),
    "basic_t_time": ("T040506.007Z", datetime(1970, 1, 1, 4, 5, 6, 7000)), "basic_t_time_no_millis": ("T040506Z", datetime(1970, 1, 1, 4, 5, 6)),
    "basic_week_date": ("2021W053", DAY), "basic_week_date_time": ("2021W053T040506.007Z", datetime(2021, 2, 3, 4, 5, 6, 7000)),
    "basic_week_date_time_no_millis": ("2021W053T040506Z", datetime(2021, 2, 3, 4, 5, 6)),
    "date": ("2021-02-03", DAY), "date_hour": ("2021-02-03T04", datetime(2021, 2, 3, 4)), "date_hour_minute": ("2021-02-03T04:05", datetime(2021, 2, 3, 4, 5)),
    "date_hour_minute_second": ("2021-02-03T04:05:06", datetime(2021, 2, 3, 4, 5, 6)),
    "date_hour_minute_second_fraction": ("2021-02-03T04:05:06.007", datetime(2021, 2, 3, 4, 5, 6, 7000)),
    "date_hour_minute_second_millis": ("2021-02-03T04:05:06.007", datetime(2021, 2, 3, 4, 5, 6, 7000)),
    "date_time": ("2021-02-03T04:05:06.007+01:00", datetime(2021, 2, 3, 3, 5, 6, 7000)), "date_time_no_millis": ("2021-02-03T04:05:06Z", datetime(2021, 2, 3, 4, 5, 6)),
    "hour": ("04", datetime(1970, 1, 1, 4)), "hour_minute": ("04:05", datetime(1970, 1, 1, 4, 5)), "hour_minute_second": ("04:05:06", datetime(1970, 1, 1, 4, 5, 6)),
    "hour_minute_second_fraction": ("04:05:06.007", datetime(1970, 1, 1, 4, 5, 6, 7000)), "hour_minute_second_millis": ("04:05:06.007", datetime(1970, 1, 1, 4, 5, 6, 7000)),
    "ordinal_date": ("2021-034", DAY), "ordinal_date_time": ("2021-034T04:05:06.007Z", datetime(2021, 2, 3, 4, 5, 6, 7000)), "ordinal_date_time_no_millis": ("2021-034T04:05:06Z", datetime(2021, 2, 3, 4, 5, 6)),
    "time": ("04:05:06.007Z", datetime(1970, 1, 1, 4, 5, 6, 7000)), "time_no_millis": ("04:05:06Z", datetime(1970, 1, 1, 4, 5, 6)),
    "t_time": ("T04:05:06.007Z", datetime(1970, 1, 1, 4, 5, 6, 7000)), "t_time_no_millis": ("T04:05:06Z", datetime(1970, 1, 1, 4, 5, 6)),
    "week_date": ("2021-W05-3", DAY), "week_date_time": ("2021-W05-3T04:05:06.007Z", datetime(2021, 2, 3, 4, 5, 6, 7000)), "week_date_time_no_millis": ("2021-W05-3T04:05:06Z", datetime(2021, 2, 3, 4, 5, 6)),
    "weekyear": ("2021", datetime(2021, 1, 4)), "weekyear_week": ("2021-W05", datetime(2021, 2, 1)), "weekyear_week_day": ("2021-W05-3", DAY),
    "year": ("2021", datetime(2021, 1, 1)), "year_month": ("2021-02", datetime(2021, 2, 1)), "year_month_day": ("2021-02-03", DAY), "dd.MM.yyyy": ("03.02.2021", DAY),
}


def test_all_names_are_tried():
    assert {n.removeprefix("strict_").removesuffix("_nanos") for n in NAMES} <= {n.removeprefix("strict_").removesuffix("_nanos") for n in CASES}
    assert len(NAMES) == 79


def test_every_format(spark):
    names = sorted(set(CASES) | {n for n in NAMES if n.removeprefix("strict_") in CASES})
    case = lambda n: CASES.get(n) or CASES[n.removeprefix("strict_")]
    one = spark.range(1).select(*[parse_date(F.lit(case(n)[0]), n).cast("string").alias(f"c{i}") for i, n in enumerate(names)]).first()
    for i, n in enumerate(names):
        got = datetime.fromisoformat(one[i]) if one[i] else None
        assert got == case(n)[1], n


@pytest.mark.parametrize("name", sorted(set(CASES) - {"epoch_millis", "epoch_second"}))
def test_malformed_is_null(spark, name):
    bad = spark.range(1).select(*[parse_date(F.lit(v), name).isNull().alias(f"c{i}") for i, v in enumerate(("", "x", "20-1-1", "2021-W60x"))]).first()
    assert all(bad)
