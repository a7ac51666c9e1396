"""The given tables as streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from trackmill.functions.times import day_serial
from trackmill.operators import trajectory as tr
from trackmill.operators.ordered import plain
from trackmill.plans.queries.base import query, table
from trackmill.plans.queries.tracks import _HAVERSINE, _POINTS, points_of
from trackmill.plans.traffic import pair_messages
from trackmill.session import renewed_dir
from trackmill.sources.kafka import read_table_stream
from trackmill.streaming.events import distinct_messages, live_pairs, stop_episodes, word_windows
from trackmill.streaming.messages import pair_speeds, parse_messages, start_append
from trackmill.streaming.vehicles import catch_up, read_vehicle_speeds
from trackmill.streaming.wordcount import current_counts, start_word_counts


def _stream(spark, folder, name):
    return read_table_stream(spark, folder, table(spark, folder, name).schema, f"{name}.parquet")


@query("SELECT CAST(regexp_extract(props, '\"k\": *([0-9]+)', 1) AS BIGINT) AS k FROM events")
def stream_json(spark, folder):
    schema = StructType([StructField("k", LongType())])
    parsed = parse_messages(_stream(spark, folder, "events").select(F.col("props").alias("value")), schema)
    path = renewed_dir(spark, "stream-json")
    start_append(parsed, f"{path}/checkpoint", f"{path}/out").awaitTermination()
    return spark.read.schema(schema).parquet(f"{path}/out")


@query(f"""
WITH {_POINTS}, par AS (SELECT *, {_HAVERSINE} AS m, 86400 * (day_serial - day0) AS t FROM dst WHERE id > 0 AND NOT is_last)
SELECT round(lat, 6) AS lat1, round(lon, 6) AS lon1, round(m, 6) AS dist, round(m, 6) AS distance,
       round(t, 3) AS time_diff, CASE WHEN t <> 0 THEN round(m / t, 6) END AS speed FROM par""")
def stream_pair_speed(spark, folder):
    """Pairs of points sent as JSON and read as a stream of messages."""
    points = points_of(table(spark, folder, "events")).withColumn("day_serial", day_serial(F.col("ts")))
    path = renewed_dir(spark, "stream-pairs")
    pair_messages(points).write.text(f"{path}/topic")
    messages = spark.readStream.text(f"{path}/topic")
    start_append(pair_speeds(messages), f"{path}/checkpoint", f"{path}/out").awaitTermination()
    digits = {"lat1": 6, "lon1": 6, "dist": 6, "distance": 6, "time_diff": 3, "speed": 6}
    return spark.read.parquet(f"{path}/out").select(*[F.round(c, d).alias(c) for c, d in digits.items()])


#: Parts of a table that come one after the other, each as a batch of its own.
SLICES = 3


def _slices(df, by):
    """The rows in parts of about equal range of a number, in its order."""
    low, high = df.agg(F.min(by), F.max(by)).first()
    width = (high - low) / SLICES + 1e-9
    part = F.least(F.lit(SLICES - 1), F.floor((by - F.lit(low)) / F.lit(width)))
    return [df.filter(F.coalesce(part, F.lit(0)) == i) for i in range(SLICES)]


@query(f"""
WITH {_POINTS} SELECT traj_id, seq, gap_s, round({_HAVERSINE}, 6) AS dist_m,
       CASE WHEN id = 0 THEN 0 WHEN gap_s <> 0 THEN round({_HAVERSINE} / gap_s, 6) END AS speed, false AS late, 3 AS batches
FROM dst""")
def stream_vehicle_speed(spark, folder):
    """Events that arrive in three parts, with a restart after each; the state crosses batches."""
    path = renewed_dir(spark, "stream-vehicles")
    events = table(spark, folder, "events")
    for part in _slices(events, F.unix_micros(F.col("ts").cast("timestamp"))):
        part.write.mode("append").parquet(f"{path}/events")
        points = points_of(read_table_stream(spark, f"{path}/events", events.schema))
        catch_up(points, f"{path}/out", f"{path}/checkpoint")
    digits = [F.round(c, 6).alias(c) for c in ("dist_m", "speed")]
    found = read_vehicle_speeds(spark, f"{path}/out")
    batches = F.lit(found.select("batch_id").distinct().count())
    return found.select(tr.KEY, "seq", "gap_s", *digits, "late", batches.alias("batches"))


def _in_parts(spark, purpose, rows, work, again=False):
    """What a stream makes of rows that arrive in three parts by ``ts``, with a restart after each.

    ``again`` sends every part twice, and a third time together with the next one.
    """
    path, before = renewed_dir(spark, purpose), None
    for part in _slices(rows, F.unix_micros("ts")):
        parts = [part, part, before] if again else [part]
        for sent in parts:
            if sent is not None:
                sent.write.mode("append").parquet(f"{path}/in")
        before = part
        made = work(read_table_stream(spark, f"{path}/in", rows.schema))
        start_append(made, f"{path}/checkpoint", f"{path}/out").awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query("""
WITH words AS (
  SELECT epoch_us(ts) // 8000000 * 8 AS start_s, unnest(string_split(concat_ws(' ', event_type, props), ' ')) AS word FROM events
)
SELECT start_s, word, count(*) AS "count" FROM words
WHERE word <> '' AND (start_s + 8) * 1000000 <= (SELECT max(epoch_us(ts)) FROM events) - 600000000 GROUP BY start_s, word""")
def stream_word_windows(spark, folder):
    """Words of events per 8 seconds of event time. Windows that late rows could still change are not out yet."""
    texts = table(spark, folder, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.concat_ws(" ", "event_type", "props").alias("text"))
    found = _in_parts(spark, "stream-word-windows", texts, lambda stream: word_windows(stream, "text", "ts", late="10 minutes"))
    return found.select((F.unix_micros("start") / 1_000_000).cast("long").alias("start_s"), "word", "count")


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_distinct_messages(spark, folder):
    """Every event is sent three times, twice at once and once much later."""
    sent = table(spark, folder, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    found = _in_parts(spark, "stream-distinct", sent, lambda stream: distinct_messages(stream, ["event_id"], "ts", "2 days"), again=True)
    return found.select("event_id", "user_id", "event_type", "value")


@query(f"""
WITH {_POINTS} SELECT traj_id, id, round({_HAVERSINE}, 6) AS dist, gap_s AS time_diff, CASE WHEN gap_s <> 0 THEN round({_HAVERSINE} / gap_s, 6) END AS speed
FROM dst WHERE id > 0 AND gap_s <= 43200""")
def stream_live_pairs(spark, folder):
    """Points joined with the ones before them on the feed, at most 12 hours apart."""
    points = plain(tr.number_points(points_of(table(spark, folder, "events"))))
    points = points.select(tr.KEY, "id", F.col("ts").cast("timestamp").alias("ts"), "lat", "lon")
    found = _in_parts(spark, "stream-live-pairs", points, lambda stream: live_pairs(stream, "12 HOURS", "1 hour"))
    return found.select(tr.KEY, "id", F.round("dist", 6).alias("dist"), "time_diff", F.round("speed", 6).alias("speed"))


@query(f"""
WITH {_POINTS}, slow AS (
  SELECT traj_id, epoch_us(ts) AS us, speed FROM spd WHERE speed < 0.01
), marked AS (
  SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY traj_id ORDER BY us) <= 21600000000 THEN 0 ELSE 1 END AS opens FROM slow
), numbered AS (
  SELECT *, sum(opens) OVER (PARTITION BY traj_id ORDER BY us) AS no FROM marked
)
SELECT traj_id, min(us) AS first_us, max(us) AS last_us, count(*) AS points, max(speed) AS top_speed FROM numbered GROUP BY traj_id, no
HAVING max(us) + 21600000000 <= (SELECT max(us) // 1000 * 1000 FROM slow) - 3600000000""")
def stream_stop_episodes(spark, folder):
    """Times of slow points, at most 6 hours from one to the next; episodes that can still grow are not out yet."""
    points = tr.speed(tr.time_gap(tr.number_points(points_of(table(spark, folder, "events")))), digits=6)
    speeds = plain(points).select(tr.KEY, F.col("ts").cast("timestamp").alias("ts"), "speed")
    found = _in_parts(spark, "stream-stop-episodes", speeds, lambda stream: stop_episodes(stream, "6 hours", 0.01, "1 hour"))
    return found.select(tr.KEY, F.unix_micros("first").alias("first_us"), F.unix_micros("last").alias("last_us"), "points", "top_speed")


@query("""
SELECT word, count(*) AS "count", 3 AS batches FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
WHERE word <> '' GROUP BY word""")
def stream_word_count(spark, folder):
    """Documents that arrive in three parts; counts go on over restarts and are compacted."""
    path = renewed_dir(spark, "stream-words")
    documents = table(spark, folder, "documents")
    batches = 0
    for part in _slices(documents, F.col("doc_id")):
        part.write.mode("append").parquet(f"{path}/documents")
        texts = read_table_stream(spark, f"{path}/documents", documents.schema)
        running = start_word_counts(texts, "text", f"{path}/out", f"{path}/checkpoint", compact_every=2)
        running.awaitTermination()
        batches += len(running.recentProgress)
    return current_counts(spark, f"{path}/out").withColumn("batches", F.lit(batches))
