import datetime
import math
import random

import numpy as np
from pyspark.sql import functions as F

from lavra.operators import quality
from lavra.operators.quality import ColumnRule

SCHEMA = "id string, created_at timestamp, status string, page_count int, extraction_duration_in_seconds double, error_log string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def day(n):
    return datetime.datetime(2020, 1, n, 12)


def test_violations(spark):
    df = frame(spark, [
        ("a", day(1), "EXTRACTED", 1, 0.0, None), ("b", day(1), "FAILED", 0, math.nan, " "), ("c", day(1), "x", 5001, math.inf, None), ("d", day(1), None, None, None, None),
        ("e", day(1), "EXTRACTED", 5000, 7200.0, ""), ("b", day(2), "FAILED", 1, 1.0, "e"), (None, day(1), "x", 0, -1.0, None),
    ])
    got = {(r.field_name, r.case_key) for r in quality.violations(df, quality.EXTRACTION_RULES, "id").collect()}
    assert got == {("page_count", "b"), ("extraction_duration_in_seconds", "b"), ("error_log", "b"), ("status", "c"), ("page_count", "c"), ("extraction_duration_in_seconds", "c"), ("error_log", "e")}


def test_empty_table(spark):
    df = frame(spark, [])
    assert quality.shifts(df, quality.EXTRACTION_RULES, F.to_date("created_at")).count() == 0
    assert quality.profile(df, quality.EXTRACTION_RULES, F.to_date("created_at")).count() == 0


def test_statistics_equal_numpy(spark):
    r = random.Random(4)
    rows = [(str(k), day(1 + k % 3), r.choice(["EXTRACTED", "FAILED", None]), r.choice([None, *range(-2, 30)]), r.choice([None, math.nan, round(r.random() * (50 + 60 * (k % 3 == 2)), 2)]), None) for k in range(900)]
    got = {(x.field_name, x.load.day): x for x in quality.profile(frame(spark, rows), quality.EXTRACTION_RULES, F.to_date("created_at")).collect()}
    values = {d: np.array(sorted(x[4] for x in rows if x[1].day == d and x[4] is not None and not math.isnan(x[4]))) for d in (1, 2, 3)}
    for d, v in values.items():
        x = got["extraction_duration_in_seconds", d]
        assert x.median == np.median(v) and x.n_rows == 300 and x.lowest == v[0] and x.highest == v[-1]
        assert x.n_distinct == len(set(v)) + 1  # NaN is a value
        if d > 1:
            grid = np.concatenate([values[d - 1], v])
            ks = np.abs(np.searchsorted(values[d - 1], grid, side="right") / len(values[d - 1]) - np.searchsorted(v, grid, side="right") / len(v)).max()
            assert math.isclose(x.ks, ks)
        else:
            assert x.ks is None
    moved = {(x.field_name, x.load.day) for x in quality.shifts(frame(spark, rows), quality.EXTRACTION_RULES, F.to_date("created_at")).collect()}
    assert ("extraction_duration_in_seconds", 3) in moved and not any(d == 1 for _, d in moved)


def test_extra_columns_and_one_hot_value(spark):
    df = frame(spark, [(str(k), day(1 + (k > 60)), "EXTRACTED", 7, 1.0, None) for k in range(100)]).withColumn("n", F.lit(1)).withColumn("load", F.lit("x")).withColumn("field_name", F.lit("y"))
    rules = [ColumnRule("page_count", lambda: F.lit(False), numeric=True)]
    rows = quality.profile(df, rules, F.to_date("created_at")).collect()
    assert {(r.n_rows, r.n_distinct, r.median, r.ks) for r in rows} == {(61, 1, 7.0, None), (39, 1, 7.0, 0.0)}
