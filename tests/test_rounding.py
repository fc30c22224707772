"""The oracle's rounding twin agrees with ``stable_round`` value for value."""

import duckdb
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from soarcast.functions import stable_round
from soarcast.oracle import R

finite = st.floats(min_value=-1e7, max_value=1e7, allow_nan=False, allow_infinity=False)
halves = st.builds(lambda k, s: k / 10 ** s + 5 / 10 ** (s + 1), st.integers(-10 ** 6, 10 ** 6), st.integers(0, 3))
sums = st.builds(lambda a, b, c: a / 100 + b / 100 + c / 100, *[st.integers(-10 ** 5, 10 ** 5)] * 3)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(finite, halves, sums), min_size=50, max_size=300))
def test_rounding_twin(spark, values):
    pdf = pd.DataFrame({"x": [float(v) for v in values]})
    df = spark.createDataFrame(pdf)
    cols = [stable_round("x", n).alias(f"r{n}") for n in range(4)]
    got = [tuple(r) for r in df.select("x", *cols).collect()]
    sql = "SELECT x, " + ", ".join(f"{R('x', n)} AS r{n}" for n in range(4)) + " FROM pdf"
    want = duckdb.sql(sql).fetchall()
    assert sorted(got) == sorted(want)
