import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from varqa.functions.numbers import round_exact


def rounded(spark, values, places):
    df = spark.createDataFrame(pd.DataFrame({"x": np.array(values, np.float64)}))
    got = df.select("x", round_exact(F.col("x"), places).alias("y")).toPandas()
    return list(zip(got.x.tolist(), got.y.tolist()))


@pytest.mark.parametrize("places", [0, 2, 4, 10])
def test_equals_pythons_round(spark, places):
    r = np.random.default_rng(places)
    ties = (r.integers(-(10**6), 10**6, 50_000) * 10 + 5) / 10.0 ** (places + 1)  # decimal ties, few of them exact
    exact = r.integers(-4000, 4000, 20_000) / 2.0 ** r.integers(0, 6, 20_000)  # exact in binary
    values = np.concatenate((r.random(150_000), r.normal(size=50_000) * 10.0 ** r.integers(-20, 20, 50_000), ties, np.nextafter(ties, 0), np.nextafter(ties, 9e9), exact, [2.675, 0.125, 0.375, 1e300, 5e-324, 0.5, 1.5, 2**52 + 0.5, 2.0**53]))
    assert all(y == round(x, places) for x, y in rounded(spark, values, places))


def test_odd_values(spark):
    got = [y for _, y in rounded(spark, [0.0, -0.0, -0.001, math.inf, -math.inf], 2)]
    assert got[0] == 0 and math.copysign(1, got[1]) == math.copysign(1, got[2]) == -1 and got[3:] == [math.inf, -math.inf]
    assert math.isnan(spark.sql("select double('NaN') as x").select(round_exact(F.col("x"), 2)).first()[0])
    assert spark.sql("select cast(null as double) as x").select(round_exact(F.col("x"), 2)).first()[0] is None
