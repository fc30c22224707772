"""Differential test on random live events with NULLs and threshold values (S1-S4)."""

import datetime as dt
import random

import duckdb
import pyarrow as pa

import __spark_entry__ as E
from soarcast import oracle
from soarcast.functions import transform
from soarcast.functions.rules import LIVE_SITES
from soarcast.sources.events import encode_events, parse_events
from soarcast.streaming import views
from test_random_grids import SCHEMA, _arrow, _canon, _random_raw

KEYS = ["s1_location_windows", "s2_wind_trend", "s3_alerts", "s4_vs_baseline", "b15_flying_score", "b17_alert"]
EVENT_COLS = ["timestamp", "location", "lat", "lon", "temp_c", "dewpoint_c", "pressure", "humidity", "wind_speed",
              "wind_dir", "wind_gust", "cloud_cover", "visibility", "weather_desc", "cloud_base_m"]
EVENT_SCHEMA = ", ".join(f"{c} {'string' if c in ('timestamp', 'location', 'weather_desc') else 'double'}"
                         for c in EVENT_COLS)
WIND_EDGES = [7.0, 8.0, 10.0, 12.0]
BASE_EDGES = [200.0, 300.0, 500.0, 600.0]


def _random_events(seed: int, n: int = 3000):
    rnd = random.Random(seed)
    start = dt.datetime(2024, 3, 1)

    def maybe(v, p=0.03):
        return None if rnd.random() < p else v

    rows = []
    for _ in range(n):
        name, lat, lon = rnd.choice(LIVE_SITES)
        t = start + dt.timedelta(seconds=rnd.randrange(5 * 24 * 3600), microseconds=rnd.randrange(10 ** 6))
        wind = rnd.choice(WIND_EDGES) if rnd.random() < 0.1 else round(rnd.uniform(0, 16), 2)
        base = rnd.choice(BASE_EDGES) if rnd.random() < 0.1 else round(rnd.uniform(0, 1500), 1)
        rows.append((
            maybe(t.strftime("%Y-%m-%dT%H:%M:%S.%f"), 0.01), maybe(name, 0.01), lat, lon,
            maybe(round(rnd.uniform(0, 30), 1)), None, 1013.0, None, maybe(wind), 0.0,
            maybe(rnd.choice([15.0, 15.01, round(wind * 1.5, 3)])), maybe(round(rnd.random(), 2)), 10000.0,
            "clear", maybe(base),
        ))
    return rows


def _events_arrow(rows):
    cols = list(zip(*rows))
    data = {c: pa.array(v, type=pa.string() if c in ("timestamp", "location", "weather_desc") else pa.float64())
            for c, v in zip(EVENT_COLS, cols)}
    ts = [None if s is None else dt.datetime.strptime(s, "%Y-%m-%dT%H:%M:%S.%f") for s in cols[0]]
    data["event_time"] = pa.array(ts, type=pa.timestamp("us"))
    return pa.table(data)


def test_live_views_on_random_events(spark, monkeypatch):
    grid = _random_raw(3)
    events = _random_events(4)
    raw = spark.createDataFrame(grid, SCHEMA)
    typed = spark.createDataFrame(events, EVENT_SCHEMA)
    monkeypatch.setattr(E, "observations", lambda s, d: transform(raw))
    monkeypatch.setattr(E, "scored_events", lambda s, d: views.score_events(parse_events(encode_events(typed))))

    con = duckdb.connect()
    con.register("random_raw", _arrow(grid))
    con.register("random_events", _events_arrow(events))
    typed_cte = oracle.EVENTS[: oracle.EVENTS.index("scored AS (")]
    queries = E.queries()
    for key in KEYS:
        sql = E.oracle_sql()[key].replace(oracle.GRID_RAW, "\ngrid_raw AS (SELECT * FROM random_raw)")
        sql = sql.replace(typed_cte, "\nevents_typed AS (SELECT * FROM random_events),\n")
        assert "random_events" in sql, key
        df = queries[key](spark, "unused")
        res = con.execute(sql)
        d_cols = [d[0] for d in res.description]
        assert sorted(df.columns) == sorted(d_cols), key
        assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(d_cols, res.fetchall()), key
