"""Live station events: topic/file sources, JSON (de)serialisation, payload flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import dewpoint_magnus
from ..functions.derive import cloud_base
from ..functions.timecols import iso_text
from ..schemas import EVENT_SCHEMA, STATION_PAYLOAD_SCHEMA


def read_events(spark: SparkSession, source, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame with a string ``value`` (one JSON event per message/line).

    ``source`` is either a dict of Kafka options (``kafka.bootstrap.servers``,
    ``subscribe``, ``startingOffsets`` ...; needs the Kafka connector on the classpath)
    or a directory path of newline-delimited JSON files.
    """
    if isinstance(source, dict):
        raw = spark.readStream.format("kafka").options(**source).load()
        return raw.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                          "topic", "partition", "offset")
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(str(source))


#: where a message came from; kept beside the parsed event for the dead letters
MESSAGE_COLUMNS = ("key", "value", "topic", "partition", "offset")


def parse_events(messages: DataFrame, value_col: str = "value", keep_message: bool = False) -> DataFrame:
    """JSON text -> typed event columns plus ``event_time`` (timestamp).

    Malformed JSON gives an all-NULL row and malformed time text a NULL
    ``event_time`` (never a failed query); ``split_valid`` separates such rows.
    ``keep_message`` adds ``message``: a struct of the raw value and, as far as the source
    has them, its key, topic, partition and offset.
    """
    own = [F.col(value_col).cast("string").alias("value"), *[F.col(c) for c in MESSAGE_COLUMNS if c in messages.columns and c not in (value_col, "value")]]
    extra = [F.struct(*own).alias("message")] if keep_message else []
    parsed = messages.select(F.from_json(F.col(value_col).cast("string"), EVENT_SCHEMA).alias("data"), *extra)
    kept = ["message"] if keep_message else []
    return parsed.select("data.*", *kept).withColumn("event_time", F.try_to_timestamp(F.col("timestamp")))


def split_valid(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): rejected rows lack an event time or a location."""
    ok = F.col("event_time").isNotNull() & F.col("location").isNotNull()
    return events.filter(ok), events.filter(~ok | ok.isNull())


def encode_events(events: DataFrame, key: str = "location") -> DataFrame:
    """Typed events -> ``key`` (string) and ``value`` (JSON of all columns) for a topic."""
    cols = [c for c in events.columns if c != "event_time"]
    return events.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in cols])).alias("value"),
    )


def write_topic(messages: DataFrame, options: dict) -> None:
    """Publish ``key``/``value`` rows to a topic (Kafka connector required)."""
    messages.write.format("kafka").options(**options).save()


def parse_payload(df: DataFrame, json_col: str, location_col: str, observed_at_col: str) -> DataFrame:
    """Flatten a station weather payload (JSON text) into the event layout.

    A payload that is no JSON or lacks the coordinates, the temperature, a positive humidity,
    the wind speed or the cloud cover (error bodies do) gives no event: its row is left out.
    Missing wind direction, gust and visibility default to 0, cloud cover is scaled
    from percent to 0..1, the description is the first weather entry's, the dew point
    is the Magnus estimate and the cloud base follows from the spread. The timestamp
    is the observation time column rendered as ISO text.
    """
    p = F.from_json(F.col(json_col), STATION_PAYLOAD_SCHEMA)
    base = df.select(
        F.col(location_col).alias("location"),
        F.col(observed_at_col).alias("_observed_at"),
        p.alias("p"),
    )
    temp = F.col("p.main.temp")
    humidity = F.col("p.main.humidity")
    needed = ("p.coord.lat", "p.coord.lon", "p.main.temp", "p.wind.speed", "p.clouds.all")
    complete = humidity > 0  # the dew point's logarithm needs it
    for c in needed:
        complete = complete & F.col(c).isNotNull()
    base = base.filter(complete)
    dew = dewpoint_magnus(temp, humidity)
    out = base.select(
        iso_text(F.col("_observed_at")).alias("timestamp"),
        F.col("location"),
        F.col("p.coord.lat").alias("lat"),
        F.col("p.coord.lon").alias("lon"),
        temp.alias("temp_c"),
        dew.alias("dewpoint_c"),
        F.col("p.main.pressure").alias("pressure"),
        humidity.alias("humidity"),
        F.col("p.wind.speed").alias("wind_speed"),
        F.coalesce(F.col("p.wind.deg"), F.lit(0.0)).alias("wind_dir"),
        F.coalesce(F.col("p.wind.gust"), F.lit(0.0)).alias("wind_gust"),
        (F.col("p.clouds.all") / 100.0).alias("cloud_cover"),
        F.coalesce(F.col("p.visibility"), F.lit(0.0)).alias("visibility"),
        F.get(F.col("p.weather"), 0).getField("description").alias("weather_desc"),
    )
    return out.withColumn("cloud_base_m", cloud_base("temp_c", "dewpoint_c"))
