"""The ten curated marts over transformed grid observations (Q1-Q10).

Every function takes the observation frame (``sources.read_transformed`` or
``functions.transform`` output) and returns a lazy mart. All of them aggregate first
(partial + final hash aggregate, so each task pre-combines before the shuffle) and
only then apply windows; the windows run on calendar-sized frames (<= 12 months,
24 hours, 4x24 season-hours, one row per year), except the per-cell rank of Q2,
which uses the distributed ``global_rank``.

Output column names, their order and the rounding digits are fixed values of the marts'
contract; everything else here is this library's own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.cells import CELL, position, with_cell_id
from ..functions.derive import danger_flag, sky_bucket, xc_flag
from ..functions.numeric import count_where, ratio, safe_corr, stable_round
from ..operators.aggregates import distinct_count, per_unit
from ..operators.filters import (
    afternoon_condition,
    diurnal_slice,
    flying_hours,
    in_months,
    morning_condition,
)
from ..operators.joins import CELL_DAY_KEYS, join_on_cell_day
from ..operators.windows import centred_mean, change_from_previous, global_rank, running_total, small_rank

CATEGORIES = ("student", "beginner", "expert")


def _category(name: str):
    return F.col("flying_category") == name


def _flyable():
    return F.col("flying_category") != R.FLYING_FALLBACK


class Rows:
    """How a mart takes its measures from observation rows."""

    @staticmethod
    def mean(col: str):
        return F.avg(col)

    @staticmethod
    def rows():
        return F.count(F.lit(1))

    @staticmethod
    def rows_where(cond):
        return count_where(cond)

    @staticmethod
    def dangerous():
        return F.sum(danger_flag())

    @staticmethod
    def suits_xc():
        return F.sum(xc_flag())


class Rollup(Rows):
    """The same measures from ``calendar_rollup``: sums and counts of its groups."""

    @staticmethod
    def mean(col: str):
        return F.try_divide(F.sum(f"sum_{col}"), F.sum(f"n_{col}"))

    @staticmethod
    def rows():
        return F.sum("n_rows")

    @staticmethod
    def rows_where(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("n_rows"))), F.lit(0))

    @staticmethod
    def dangerous():
        return F.sum("n_dangerous")

    @staticmethod
    def suits_xc():
        return F.sum("n_xc")


ROLLUP_KEYS = ("year", "month", "hour", "season", "time_of_day", "flying_category")
ROLLUP_MEASURES = ("cape", "blh", "wind_speed", "cloud_base_m", "temp_c")


def calendar_rollup(obs: DataFrame) -> DataFrame:
    """One row per calendar hour of a month, year and category: row count, sum and number of
    non-NULL values of each measure, dangerous and cross-country hours.

    At most years x 12 x 24 x 4 rows (season and time of day follow from month and hour; NULL
    keys add a few), from one scan with partial aggregation. Q1, Q3, Q4, Q6, Q7, Q9 and Q10
    are sums over it.
    """
    return obs.groupBy(*ROLLUP_KEYS).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.sum(c).alias(f"sum_{c}") for c in ROLLUP_MEASURES],
        *[F.count(c).alias(f"n_{c}") for c in ROLLUP_MEASURES],
        F.sum(danger_flag()).alias("n_dangerous"),
        F.sum(xc_flag()).alias("n_xc"),
    )


def percent(count, m: type[Rows]):
    """``100 * count / rows`` as double."""
    return ratio(count * F.lit(100.0), m.rows())


def _sorted_small(df: DataFrame, *cols) -> DataFrame:
    """Total order of a calendar-sized frame (<= a few hundred rows) without a range
    shuffle and its sampling job: one partition, sorted locally."""
    return df.coalesce(1).sortWithinPartitions(*cols)


def grid_keys(obs: DataFrame) -> DataFrame:
    """Distinct (year, cell): one plain aggregation, from which both grid counts follow without
    copying the observations."""
    return with_cell_id(obs).select("year", CELL).distinct()


def grid_counts(obs: DataFrame) -> DataFrame:
    """One row: ``n_cells`` (distinct latitude/longitude) and ``n_years`` (distinct years),
    NULL combinations included, as ``distinct().count()`` counts them."""
    return counts_of(grid_keys(obs))


def counts_of(keys: DataFrame) -> DataFrame:
    """``grid_counts`` from ``grid_keys``."""
    return keys.agg(
        F.count_distinct(CELL).alias("n_cells"),
        F.count_distinct(F.struct("year")).alias("n_years"),
    )


def _cells(obs: DataFrame, n_cells):
    return distinct_count(grid_keys(obs), CELL) if n_cells is None else F.lit(n_cells)


def _years(obs: DataFrame, n_years):
    return distinct_count(grid_keys(obs), "year") if n_years is None else F.lit(n_years)


def category_hours_by_month(obs: DataFrame, n_cells: int | None = None, m: type[Rows] = Rows) -> DataFrame:
    """Q1: hours per grid cell in each flight category by month, with running totals.

    ``n_cells`` may be passed in when several marts share it (see ``run_batch``);
    otherwise it is a lazy scalar subquery over ``obs``.
    """
    n_cells = _cells(obs, n_cells)
    out = obs.groupBy("month").agg(
        *[stable_round(per_unit(m.rows_where(_category(c)), n_cells), 1).alias(f"{c}_hours") for c in CATEGORIES]
    )
    out = running_total(out, "student_hours", "month", 1, "cumulative_student")
    out = running_total(out, "expert_hours", "month", 1, "cumulative_expert")
    return _sorted_small(out, "month")


def cell_conditions(obs: DataFrame) -> DataFrame:
    """Per grid cell: spread and mean of wind, CAPE and cloud base in the flying hours of the season."""
    by_cell = flying_hours(with_cell_id(obs), R.FLYING_SEASON_MONTHS, R.MIDDAY_HOURS).groupBy(CELL)
    return conditions_of(by_cell, F.stddev_samp, F.avg, F.count(F.lit(1)))


def conditions_of(by_cell, spread, mean, hours) -> DataFrame:
    """``cell_conditions`` from rows grouped by cell; the functions say how measures are taken from them."""
    return by_cell.agg(
        position("latitude"), position("longitude"),
        stable_round(spread("wind_speed"), 3).alias("wind_stddev"),
        stable_round(spread("cape"), 3).alias("cape_stddev"),
        stable_round(spread("cloud_base_m"), 3).alias("cloud_base_stddev"),
        stable_round(mean("wind_speed"), 2).alias("avg_wind"),
        stable_round(mean("cape"), 2).alias("avg_cape"),
        stable_round(mean("cloud_base_m"), 2).alias("avg_cloud_base"),
        hours.alias("total_hours"),
    ).drop(CELL)


def rank_cells(cells: DataFrame, buckets: int | None = None) -> DataFrame:
    """Stability score and rank (1 = most stable) of ``cell_conditions``.

    The rank reads the cells more than once, so a caller that builds from a large zone writes
    them first, as ``run_batch`` does.
    """
    w_wind, w_cape, w_base = R.STABILITY_WEIGHTS
    score = F.col("wind_stddev") * w_wind + F.col("cape_stddev") * w_cape + F.col("cloud_base_stddev") * w_base
    return global_rank(cells.withColumn("stability_score", stable_round(score, 3)), "stability_score",
                       ascending=True, nulls_last=True, alias="stability_rank", buckets=buckets)


def cell_stability(obs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Q2: variability of wind, CAPE and cloud base per grid cell in the flying hours
    of the season, a weighted stability score and its rank (1 = most stable).

    Cells whose score is NULL (a single hour, hence no standard deviation) rank last.
    ``buckets`` spreads the rank over that many tasks (default: the shuffle partitions).
    """
    return rank_cells(cell_conditions(obs), buckets)


def top_stable_cells(stability: DataFrame, n: int = 10) -> DataFrame:
    """Q2 report: the ``n`` most stable cells (rank, then position breaks ties; cells
    without a position come last)."""
    return stability.orderBy(F.col("stability_rank").asc_nulls_last(), *_position()).limit(n)


def top_unstable_cells(stability: DataFrame, n: int = 10) -> DataFrame:
    """Q2 report: the ``n`` least stable cells (highest score first, NULL scores last)."""
    return stability.orderBy(F.col("stability_score").desc_nulls_last(), *_position()).limit(n)


def _position():
    return F.col("latitude").asc_nulls_last(), F.col("longitude").asc_nulls_last()


def hourly_conditions(obs: DataFrame, m: type[Rows] = Rows) -> DataFrame:
    """Q3: mean conditions and flyable share per hour of day in the flying season,
    with centred 3-hour means of CAPE and boundary-layer height."""
    out = in_months(obs).groupBy("hour").agg(
        stable_round(m.mean("cape"), 2).alias("avg_cape"),
        stable_round(m.mean("blh"), 2).alias("avg_blh"),
        stable_round(m.mean("wind_speed"), 2).alias("avg_wind"),
        stable_round(m.mean("cloud_base_m"), 2).alias("avg_cloud_base"),
        stable_round(percent(m.rows_where(_flyable()), m), 1).alias("flyable_pct"),
    )
    out = centred_mean(out, "avg_cape", "hour", 2, "cape_rolling_avg")
    out = centred_mean(out, "avg_blh", "hour", 2, "blh_rolling_avg")
    return _sorted_small(out, "hour")


def category_by_hour(obs: DataFrame, n_cells: int | None = None, n_years: int | None = None, m: type[Rows] = Rows) -> DataFrame:
    """Q4: flyable hours per cell and year by hour of day and category (daylight hours
    of the season), mean conditions, the rank of expert hours and the CAPE change.

    The cell and year denominators come from *all* observations, not the slice. The
    ``*_days`` columns keep the reference's names; their unit is hours per cell and year.
    """
    n_cells, n_years = _cells(obs, n_cells), _years(obs, n_years)
    sliced = flying_hours(obs, R.FLYING_SEASON_MONTHS, R.DAYLIGHT_HOURS, flyable_only=True)
    out = sliced.groupBy("hour").agg(
        *[stable_round(per_unit(m.rows_where(_category(c)), n_cells, n_years), 1).alias(f"{c}_days")
          for c in CATEGORIES],
        stable_round(m.mean("cape"), 1).alias("avg_cape"),
        stable_round(m.mean("blh"), 1).alias("avg_blh"),
        stable_round(m.mean("wind_speed"), 2).alias("avg_wind"),
        stable_round(m.mean("cloud_base_m"), 0).alias("avg_cloud_base"),
    )
    out = small_rank(out, "expert_days", ascending=False, alias="expert_rank")
    out = change_from_previous(out, "avg_cape", "hour", 1, "cape_change")
    return _sorted_small(out, "hour")


def cape_cloudbase_correlation(obs: DataFrame) -> DataFrame:
    """Q5: monthly correlation of CAPE with cloud base and with boundary-layer height
    in the flying hours, ranked by the first. A constant input gives NULL."""
    by_month = flying_hours(obs, R.FLYING_SEASON_MONTHS, R.MIDDAY_HOURS).groupBy("month")
    return correlation_mart(by_month, safe_corr, F.avg)


def correlation_mart(by_month, corr, mean) -> DataFrame:
    """Q5 from rows grouped by month; ``corr`` and ``mean`` say how measures are taken from them."""
    out = by_month.agg(
        stable_round(corr("cape", "cloud_base_m"), 3).alias("cape_cloudbase_corr"),
        stable_round(corr("cape", "blh"), 3).alias("cape_blh_corr"),
        stable_round(mean("cape"), 1).alias("avg_cape"),
        stable_round(mean("cloud_base_m"), 0).alias("avg_cloud_base"),
        stable_round(mean("blh"), 0).alias("avg_blh"),
    )
    out = small_rank(out, "cape_cloudbase_corr", ascending=False, alias="correlation_rank")
    return _sorted_small(out, "month")


def danger_by_season(obs: DataFrame, m: type[Rows] = Rows) -> DataFrame:
    """Q6: share of dangerous hours by season and time of day, ranked within season."""
    out = obs.groupBy("season", "time_of_day").agg(
        stable_round(percent(m.dangerous(), m), 1).alias("dangerous_pct"),
        stable_round(m.mean("wind_speed"), 2).alias("avg_wind"),
        stable_round(m.mean("cape"), 1).alias("avg_cape"),
        m.rows().alias("total_hours"),
    )
    out = small_rank(out, "dangerous_pct", ascending=False, partition_by=("season",), alias="danger_rank")
    return _sorted_small(out, "season", "time_of_day")


def xc_months(obs: DataFrame, n_cells: int | None = None, n_years: int | None = None, m: type[Rows] = Rows) -> DataFrame:
    """Q7: cross-country-suitable hours per cell and year by month, ranked, with the
    change from the previous month (``xc_days`` keeps the reference's name; unit: hours)."""
    n_cells, n_years = _cells(obs, n_cells), _years(obs, n_years)
    out = obs.groupBy("month").agg(
        stable_round(per_unit(m.suits_xc(), n_cells, n_years), 1).alias("xc_days"),
        stable_round(m.mean("cape"), 1).alias("avg_cape"),
        stable_round(m.mean("blh"), 1).alias("avg_blh"),
        stable_round(m.mean("cloud_base_m"), 0).alias("avg_cloud_base"),
        stable_round(m.mean("wind_speed"), 2).alias("avg_wind"),
    )
    out = small_rank(out, "xc_days", ascending=False, alias="xc_rank")
    out = change_from_previous(out, "xc_days", "month", 1, "xc_days_change")
    return _sorted_small(out, "month")


def cell_day_halves(obs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per (cell, summer day): the warm-morning means, and the afternoon's best category and means."""
    days = with_cell_id(diurnal_slice(obs)).filter("latitude IS NOT NULL AND longitude IS NOT NULL")
    mean = lambda c, name: stable_round(F.avg(c), 2).alias(name)
    mornings = days.filter(morning_condition()).groupBy(*CELL_DAY_KEYS).agg(
        position("latitude"), position("longitude"), mean("temp_c", "morning_temp"), mean("wind_speed", "morning_wind"), mean("cape", "morning_cape"), mean("tcc", "morning_tcc"))
    afternoons = days.filter(afternoon_condition()).groupBy(*CELL_DAY_KEYS).agg(
        F.max("flying_category").alias("afternoon_category"), mean("cape", "afternoon_cape"), mean("blh", "afternoon_blh"))
    return mornings, afternoons


def joined_cell_days(obs: DataFrame) -> DataFrame:
    """``cell_day_outlook`` by the general cell-day join of its two halves."""
    return join_on_cell_day(*cell_day_halves(obs)).drop(CELL).withColumn("morning_sky", sky_bucket("morning_tcc"))


def cell_day_outlook(obs: DataFrame) -> DataFrame:
    """Per (cell, summer day): warm-morning means and the afternoon's best category.

    Equivalent to aggregating the warm-morning rows and the afternoon rows separately
    by (year, month, day, position) and inner-joining the two, but done as
    ONE conditional aggregation: the source is shuffled once, and only cell-days that
    have both a warm-morning row and an afternoon row (and non-NULL keys, as an inner
    join requires) are kept. The afternoon category is the lexicographic maximum, so a
    ``not_flyable`` hour outranks ``beginner`` and ``expert`` but not ``student``.
    """
    is_morning = morning_condition()
    is_afternoon = afternoon_condition()

    def morning(c):
        return F.when(is_morning, F.col(c))

    per_day = with_cell_id(diurnal_slice(obs)).groupBy(*CELL_DAY_KEYS).agg(
        position("latitude"), position("longitude"),
        F.count_if(is_morning).alias("_morning_rows"),
        F.count_if(is_afternoon).alias("_afternoon_rows"),
        stable_round(F.avg(morning("temp_c")), 2).alias("morning_temp"),
        stable_round(F.avg(morning("wind_speed")), 2).alias("morning_wind"),
        stable_round(F.avg(morning("cape")), 2).alias("morning_cape"),
        stable_round(F.avg(morning("tcc")), 2).alias("morning_tcc"),
        F.max(F.when(is_afternoon, F.col("flying_category"))).alias("afternoon_category"),
        stable_round(F.avg(F.when(is_afternoon, F.col("cape"))), 2).alias("afternoon_cape"),
        stable_round(F.avg(F.when(is_afternoon, F.col("blh"))), 2).alias("afternoon_blh"),
    )
    keys_present = [F.col(k).isNotNull() for k in ("year", "month", "day", "latitude", "longitude")]
    cond = (F.col("_morning_rows") > 0) & (F.col("_afternoon_rows") > 0)
    for k in keys_present:
        cond = cond & k
    return (
        per_day.filter(cond)
        .drop("_morning_rows", "_afternoon_rows", CELL)
        .withColumn("morning_sky", sky_bucket("morning_tcc"))
    )


def sky_days(obs: DataFrame) -> DataFrame:
    """Cell-days of a year by morning sky: counts and sums, from which Q8 follows."""
    return cell_day_outlook(obs).groupBy("year", "morning_sky").agg(
        F.count(F.lit(1)).alias("n_days"),
        F.count_if(F.col("afternoon_category") != R.FLYING_FALLBACK).alias("n_flyable"),
        *[agg(c).alias(f"{name}_{c}") for c in ("morning_temp", "morning_wind") for name, agg in (("sum", F.sum), ("n", F.count))],
    )


def sky_outlook(days: DataFrame) -> DataFrame:
    """Q8 from ``sky_days``."""
    out = days.groupBy("morning_sky").agg(
        stable_round(ratio(F.sum("n_flyable") * F.lit(100.0), F.sum("n_days")), 1).alias("flyable_pct"),
        stable_round(Rollup.mean("morning_temp"), 1).alias("avg_morning_temp"),
        stable_round(Rollup.mean("morning_wind"), 2).alias("avg_morning_wind"),
        F.sum("n_days").alias("total_days"),
    )
    out = small_rank(out, "flyable_pct", ascending=False, alias="rank")
    return _sorted_small(out, F.col("flyable_pct").desc_nulls_last(), F.col("morning_sky").asc_nulls_last())


def morning_to_afternoon(obs: DataFrame) -> DataFrame:
    """Q8: how often the afternoon is flyable given the morning sky, by sky class."""
    return sky_outlook(sky_days(obs))


def blh_through_day(obs: DataFrame, m: type[Rows] = Rows) -> DataFrame:
    """Q9: boundary-layer development by season and daylight hour, ranked within the
    season, with a centred 3-hour mean."""
    out = flying_hours(obs, R.FLYING_SEASON_MONTHS, R.DAYLIGHT_HOURS).groupBy("season", "hour").agg(
        stable_round(m.mean("blh"), 0).alias("avg_blh"),
        stable_round(m.mean("cape"), 1).alias("avg_cape"),
        stable_round(m.mean("cloud_base_m"), 0).alias("avg_cloud_base"),
        stable_round(m.mean("temp_c"), 1).alias("avg_temp"),
    )
    out = small_rank(out, "avg_blh", ascending=False, partition_by=("season",), alias="blh_rank")
    out = centred_mean(out, "avg_blh", "hour", 0, "blh_rolling_avg", partition_by=("season",))
    return _sorted_small(out, "season", "hour")


def climate_trend(obs: DataFrame, m: type[Rows] = Rows) -> DataFrame:
    """Q10: season means per year and their change from the previous year."""
    out = in_months(obs).groupBy("year").agg(
        stable_round(m.mean("temp_c"), 2).alias("avg_temp"),
        stable_round(m.mean("cape"), 2).alias("avg_cape"),
        stable_round(m.mean("blh"), 2).alias("avg_blh"),
        stable_round(m.mean("wind_speed"), 2).alias("avg_wind"),
        stable_round(percent(m.rows_where(_flyable()), m), 1).alias("flyable_pct"),
    )
    out = change_from_previous(out, "avg_temp", "year", 2, "temp_trend")
    out = change_from_previous(out, "avg_cape", "year", 2, "cape_trend")
    out = change_from_previous(out, "flyable_pct", "year", 1, "flyable_trend")
    return _sorted_small(out, "year")


# Marts that divide by the grid counts (cells, and years for Q4/Q7).
GRID_COUNT_MARTS = {
    "q1_flying_hours_by_month": ("n_cells",),
    "q4_hourly_by_category": ("n_cells", "n_years"),
    "q7_xc_best_months": ("n_cells", "n_years"),
}

# Marts that follow from calendar_rollup, and those whose size the calendar bounds (all but Q2).
ROLLUP_MARTS = frozenset({
    "q1_flying_hours_by_month", "q3_hourly_conditions", "q4_hourly_by_category", "q6_dangerous_conditions",
    "q7_xc_best_months", "q9_blh_development", "q10_climate_trend",
})

# Mart name -> builder; names match the reference's curated folders.
MARTS = {
    "q1_flying_hours_by_month": category_hours_by_month,
    "q2_location_stability": cell_stability,
    "q3_hourly_conditions": hourly_conditions,
    "q4_hourly_by_category": category_by_hour,
    "q5_cape_cloudbase_correlation": cape_cloudbase_correlation,
    "q6_dangerous_conditions": danger_by_season,
    "q7_xc_best_months": xc_months,
    "q8_afternoon_prediction": morning_to_afternoon,
    "q9_blh_development": blh_through_day,
    "q10_climate_trend": climate_trend,
}


CALENDAR_MARTS = frozenset(MARTS) - {"q2_location_stability"}


def preview(mart: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows of a mart in its own order (what a console preview shows)."""
    return mart.limit(n)
