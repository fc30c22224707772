"""The cell-day join on hand-made halves: which days pair up, and with what."""

from soarcast.operators import CELL_DAY_KEYS, join_on_cell_day
from soarcast.plans import marts, preview

KEYS = "year int, month int, day int, latitude double, longitude double"


def test_only_days_with_both_halves_pair_up(spark):
    left = spark.createDataFrame(
        [(2020, 6, 1, 45.0, 20.0, 11.5), (2020, 6, 2, 45.0, 20.0, 12.5), (2020, 6, 3, None, 20.0, 13.5), (2020, 6, 4, 45.0, 20.0, 14.5)],
        f"{KEYS}, morning_temp double")
    right = spark.createDataFrame(
        [(2020, 6, 1, 45.0, 20.0, "expert"), (2020, 6, 1, 45.0, 20.0, "student"), (2020, 6, 2, 45.0, 20.25, "expert"),
         (2020, 6, 3, None, 20.0, "expert"), (2021, 6, 4, 45.0, 20.0, "expert")],
        f"{KEYS}, afternoon_category string")
    joined = join_on_cell_day(left, right)
    assert CELL_DAY_KEYS[:3] == ("year", "month", "day")
    assert sorted(joined.columns) == sorted(["year", "month", "day", "latitude", "longitude", "morning_temp", "afternoon_category"])
    # a day that appears twice on one side pairs twice; a missing side or a NULL key pairs with nothing
    assert sorted(r.afternoon_category for r in joined.collect()) == ["expert", "student"]
    assert {(r.day, r.morning_temp) for r in joined.collect()} == {(1, 11.5)}
    kept = {(r.day, r.afternoon_category) for r in join_on_cell_day(left, right, "left").collect()}
    assert kept == {(1, "expert"), (1, "student"), (2, None), (3, None), (4, None)}


def test_preview_keeps_the_order_of_a_mart(spark):
    mart = spark.createDataFrame([(h, float(h)) for h in range(24)], "hour int, avg_cape double").coalesce(1)
    assert [r.hour for r in preview(mart, 5).collect()] == [0, 1, 2, 3, 4]
    assert marts.preview is preview
