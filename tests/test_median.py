"""Exact medians by narrowing brackets equal a plain median, whatever the bracket size."""

import math
import random
import statistics

import pytest

from stayput.operators import clean


@pytest.mark.parametrize("rows_per_bucket", [1, 50, 200_000])
def test_medians(spark, rows_per_bucket):
    rng = random.Random(3)
    rows = [(rng.gauss(0, 1), float(rng.randint(0, 2)), 5.0 if i % 3 else None, float("nan") if i % 7 == 0 else float(i), None)
            for i in range(3001)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    want = {}
    for k, c in enumerate("abcd"):
        vals = [r[k] for r in rows if r[k] is not None and not math.isnan(r[k])]
        want[c] = statistics.median(vals)
    got = clean.fit_median(df, list("abcde"), rows_per_bucket=rows_per_bucket)
    assert got == {**want, "e": None}
    two = spark.createDataFrame([(1.0,), (2.0,)] * 500, "x double")
    assert clean.fit_median(two, ["x"], rows_per_bucket=rows_per_bucket) == {"x": 1.5}
