"""global_rank equals rank() OVER (ORDER BY ...) on data with ties and NULLs."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from soarcast.operators import global_rank


def _frame(spark, n, n_distinct, null_share, hot_share, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        r = rnd.random()
        if r < null_share:
            v = None
        elif r < null_share + 0.02:
            v = float("nan")
        elif r < null_share + hot_share:
            v = 42.0  # one value holding a large share of the rows
        else:
            v = float(rnd.randrange(n_distinct)) / 7
        rows.append((i, v))
    return spark.createDataFrame(rows, "id long, v double")


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("nulls_last", [True, False])
@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_global_rank_equals_window_rank(spark, ascending, nulls_last, buckets):
    df = _frame(spark, 3000, 400, 0.05, 0.33, seed=buckets)
    col = F.col("v")
    order = (col.asc_nulls_last() if nulls_last else col.asc_nulls_first()) if ascending else (
        col.desc_nulls_last() if nulls_last else col.desc_nulls_first())
    expected = {r.id: r.rk for r in df.select("id", F.rank().over(Window.orderBy(order)).alias("rk")).collect()}
    got = {r.id: r.rk for r in global_rank(df, "v", ascending, nulls_last, alias="rk", buckets=buckets).collect()}
    assert got == expected


def test_global_rank_empty_and_all_null(spark):
    empty = spark.createDataFrame([], "id long, v double")
    assert global_rank(empty, "v").count() == 0
    nulls = spark.createDataFrame([(1, None), (2, None)], "id long, v double")
    assert {r.rank for r in global_rank(nulls, "v").collect()} == {1}


def test_global_rank_keeps_rows_and_columns(spark):
    df = _frame(spark, 500, 50, 0.0, 0.0, seed=7)
    out = global_rank(df, "v")
    assert out.count() == 500 and out.columns == ["id", "v", "rank"]


def test_global_rank_rejects_non_numeric(spark):
    df = spark.createDataFrame([("a",), ("b",)], "s string")
    with pytest.raises(TypeError):
        global_rank(df, "s")
