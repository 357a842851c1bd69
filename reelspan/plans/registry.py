"""The recording operators as queries over the test tables, and their SQL.

Users are segments and event types are sources; labels are segments of the vector
signal; orders are episodes and their lines are frames. Keys carry the ids of the
operator inventory.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Camera, ExportConfig, Trimming
from ..functions import columns as fn
from ..operators import asof, bounds, layout, samples
from ..sinks.convert import episode_lines, video_clips
from ..sources.recordings import embedding_signals, event_signals, long_signals
from . import episodes
from .validate import lacking

STEP = 6 * 3600 * 10**9
LIMIT_S = 29.5 * 86_400
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
FLAGSHIP = "j2_nearest_resample"


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_signals(_read(spark, sf_dir, "events"))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_signals(_read(spark, sf_dir, "embeddings"))


def _range(signals: DataFrame, source: str) -> DataFrame:
    return bounds.source_ranges(signals, [source]).select("segment_id", "start_ns", "end_ns")


_SIG = "sig AS (SELECT CAST(user_id AS VARCHAR) AS segment_id, event_type AS source, epoch_us(ts) * 1000 AS t_ns, event_id AS seq, value FROM events WHERE value IS NOT NULL)"
_RNG = "rng AS (SELECT segment_id, min(t_ns) AS start_ns, max(t_ns) AS end_ns FROM sig WHERE source = 'click' GROUP BY segment_id HAVING min(t_ns) < max(t_ns))"
_GRID = f"grid AS (SELECT segment_id, CAST((t_ns - start_ns) // {STEP} AS BIGINT) AS frame_index, t_ns FROM (SELECT segment_id, start_ns, unnest(range(start_ns, end_ns + 1, {STEP})) AS t_ns FROM rng))"


@_query(f"WITH {_SIG} SELECT segment_id, t_ns, value FROM sig WHERE source = 'click'")
def s5_p1_p2_p4_scan(spark, sf_dir):
    return _events(spark, sf_dir).filter("source = 'click'").select("segment_id", "t_ns", F.col("value")[0].alias("value"))


@_query(f"WITH {_SIG} SELECT segment_id, CAST(row_number() OVER (ORDER BY segment_id) - 1 AS BIGINT) AS episode_index FROM (SELECT DISTINCT segment_id FROM sig)")
def s7_w3_segments(spark, sf_dir):
    return bounds.episode_indexes(bounds.segments(_events(spark, sf_dir)))


@_query(f"WITH {_SIG} SELECT segment_id, min(t_ns) AS t_start, max(t_ns) AS t_end, (max(t_ns) - min(t_ns)) / 1e9 AS duration_s FROM sig GROUP BY segment_id")
def s8_f9_index_ranges(spark, sf_dir):
    return bounds.with_durations(bounds.index_ranges(_events(spark, sf_dir))).select("segment_id", "t_start", "t_end", "duration_s")


@_query(f"WITH {_SIG} SELECT segment_id, (max(t_ns) - min(t_ns)) / 1e9 AS duration_s FROM sig GROUP BY segment_id HAVING (max(t_ns) - min(t_ns)) / 1e9 <= {LIMIT_S}")
def p7_j7_duration_guard(spark, sf_dir):
    return bounds.within_duration(bounds.index_ranges(_events(spark, sf_dir)), LIMIT_S).select("segment_id", "duration_s")


@_query(f"WITH {_SIG} SELECT segment_id, source, t_ns, value FROM sig")
def p5_p6_wide_to_long(spark, sf_dir):
    names = ("click", "view", "signup", "error", "purchase")
    events = _read(spark, sf_dir, "events")
    wide = events.select(F.col("user_id").alias("segment_id"), "ts", *(F.when(F.col("event_type") == n, F.col("value")).alias(f"/{n}:Scalars:scalars") for n in names))
    return long_signals(wide, "ts", scalars=True).select("segment_id", "source", "t_ns", F.col("value")[0].alias("value"))


@_query("WITH have AS (SELECT DISTINCT user_id, event_type FROM events), want AS (SELECT unnest(['click', 'teleop', 'purchase']) AS source) SELECT CAST(u.user_id AS VARCHAR) AS segment_id, w.source FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN want w LEFT JOIN have h ON h.user_id = u.user_id AND h.event_type = w.source WHERE h.user_id IS NULL")
def p13_missing_sources(spark, sf_dir):
    return lacking(_events(spark, sf_dir), ["click", "teleop", "purchase"])


@_query(f"WITH {_SIG} SELECT segment_id, min(t_ns) AS start_ns, max(t_ns) AS end_ns FROM sig WHERE source = 'click' GROUP BY segment_id")
def a1_action_range(spark, sf_dir):
    return _range(_events(spark, sf_dir), "click")


_BOTH = "cam AS (SELECT segment_id, max(s) AS s, min(e) AS e FROM (SELECT segment_id, source, min(t_ns) AS s, max(t_ns) AS e FROM sig WHERE source IN ('view', 'error') GROUP BY ALL) GROUP BY segment_id HAVING count(*) = 2), act AS (SELECT segment_id, min(t_ns) AS s, max(t_ns) AS e FROM sig WHERE source = 'click' GROUP BY segment_id), both_ AS (SELECT segment_id, greatest(act.s, cam.s) AS start_ns, least(act.e, cam.e) AS end_ns FROM act JOIN cam USING (segment_id))"


@_query(f"WITH {_SIG}, {_BOTH} SELECT * FROM both_ WHERE start_ns < end_ns")
def a2_a3_p8_intersection(spark, sf_dir):
    signals = _events(spark, sf_dir)
    return bounds.valid_ranges(_range(signals, "click"), bounds.source_ranges(signals, ["view", "error"]), 2)


@_query(f"WITH {_SIG} SELECT segment_id, min(t_ns) AS trim_start, max(t_ns) AS trim_end FROM sig WHERE source = 'purchase' GROUP BY segment_id")
def t2_signal_presence(spark, sf_dir):
    return bounds.signal_presence(_events(spark, sf_dir), "purchase")


_MOVES = "mv AS (SELECT segment_id, t_ns, lead(t_ns) OVER w AS t_next, abs(lead(value) OVER w - value) AS d FROM sig WHERE source = 'click' WINDOW w AS (PARTITION BY segment_id ORDER BY t_ns, seq))"


@_query(f"WITH {_SIG}, {_MOVES} SELECT segment_id, t_ns, t_next, d AS change FROM mv WHERE t_next IS NOT NULL")
def w1_consecutive_changes(spark, sf_dir):
    return bounds.consecutive_changes(_events(spark, sf_dir), "click").drop("ragged")


_CHANGE = f"{_MOVES}, chg AS (SELECT segment_id, min(t_ns) FILTER (d > 20) AS trim_start, max(t_next) FILTER (d > 20) + 500000000 AS trim_end FROM mv WHERE t_next IS NOT NULL GROUP BY segment_id)"


@_query(f"WITH {_SIG}, {_CHANGE} SELECT * FROM chg")
def t3_a5_signal_change(spark, sf_dir):
    return bounds.signal_change(_events(spark, sf_dir), "click", 20.0, 500).drop("ragged")


_VEC = "v AS (SELECT CAST(label AS VARCHAR) AS segment_id, vec_id AS t_ns, embedding AS e FROM embeddings), nx AS (SELECT segment_id, t_ns, lead(t_ns) OVER w AS t_next, e, lead(e) OVER w AS f FROM v WINDOW w AS (PARTITION BY segment_id ORDER BY t_ns)), vd AS (SELECT segment_id, t_ns, t_next, list_max(list_transform(list_zip(e, f), lambda z: abs(CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE)))) AS d FROM nx WHERE t_next IS NOT NULL)"


@_query(f"WITH {_VEC} SELECT segment_id, t_ns, t_next, d AS change FROM vd")
def a4_largest_change(spark, sf_dir):
    return bounds.consecutive_changes(_vectors(spark, sf_dir), "embedding").drop("ragged")


@_query(f"WITH {_VEC} SELECT segment_id, min(t_ns) FILTER (d > 0.45) AS trim_start, max(t_next) FILTER (d > 0.45) AS trim_end FROM vd GROUP BY segment_id")
def t3_vector_change(spark, sf_dir):
    return bounds.signal_change(_vectors(spark, sf_dir), "embedding", 0.45, 0).drop("ragged")


@_query(f"WITH {_SIG}, {_RNG}, {_CHANGE} SELECT segment_id, s AS start_ns, e AS end_ns FROM (SELECT rng.segment_id, greatest(start_ns, coalesce(trim_start, start_ns)) AS s, least(end_ns, coalesce(trim_end, end_ns)) AS e FROM rng LEFT JOIN chg USING (segment_id)) WHERE s < e")
def t4_trimmed_range(spark, sf_dir):
    signals = _events(spark, sf_dir)
    return bounds.trimmed(bounds.valid_ranges(_range(signals, "click")), bounds.signal_change(signals, "click", 20.0, 500))


@_query(f"WITH {_SIG}, {_RNG}, {_GRID} SELECT * FROM grid")
def w4_w2_time_grid(spark, sf_dir):
    return bounds.time_grid(bounds.valid_ranges(_range(_events(spark, sf_dir), "click")), STEP)


_LATEST = "pr AS (SELECT DISTINCT segment_id, t_ns FROM sig WHERE source = 'click'), one AS (SELECT segment_id, source, t_ns, arg_max(value, seq) AS value FROM sig GROUP BY ALL), fill AS (SELECT pr.segment_id, pr.t_ns, c.value AS click, v.value AS view, p.value AS purchase FROM pr ASOF LEFT JOIN (SELECT * FROM one WHERE source = 'click') c ON c.segment_id = pr.segment_id AND pr.t_ns >= c.t_ns ASOF LEFT JOIN (SELECT * FROM one WHERE source = 'view') v ON v.segment_id = pr.segment_id AND pr.t_ns >= v.t_ns ASOF LEFT JOIN (SELECT * FROM one WHERE source = 'purchase') p ON p.segment_id = pr.segment_id AND pr.t_ns >= p.t_ns)"


def _filled(signals: DataFrame) -> DataFrame:
    probes = signals.filter("source = 'click'").select("segment_id", "t_ns")
    return asof.latest_at(probes, signals, ["click", "view", "purchase"])


@_query(f"WITH {_SIG}, {_LATEST} SELECT * FROM fill")
def j1_s6_latest_at(spark, sf_dir):
    filled = _filled(_events(spark, sf_dir))
    return filled.select("segment_id", "t_ns", *(F.col(c)[0].alias(c) for c in ("click", "view", "purchase")))


_VECS = "vec AS (SELECT segment_id, t_ns, click, view AS second, purchase AS state0 FROM fill WHERE view IS NOT NULL)"


@_query(f"WITH {_SIG}, {_LATEST}, {_VECS} SELECT segment_id, t_ns, click AS action0, second AS action1, state0, CAST(CASE WHEN state0 IS NULL THEN 0 ELSE 1 END AS INTEGER) AS n_state FROM vec")
def p9_p10_f3_vectors(spark, sf_dir):
    vectors = samples.filled_vectors(_filled(_events(spark, sf_dir)), ["click", "view"], ["purchase"])
    return vectors.select("segment_id", "t_ns", F.col("action")[0].alias("action0"), F.col("action")[1].alias("action1"), F.get("state", 0).alias("state0"), F.size("state").alias("n_state"))


_NEAR = """near AS (SELECT g.segment_id, g.frame_index, g.t_ns, CASE WHEN b.t IS NULL OR (a.t IS NOT NULL AND g.t_ns - a.t <= b.t - g.t_ns) THEN a.t ELSE b.t END AS source_t_ns,
CASE WHEN b.t IS NULL OR (a.t IS NOT NULL AND g.t_ns - a.t <= b.t - g.t_ns) THEN a.v ELSE b.v END AS v
FROM grid g ASOF LEFT JOIN lo a ON a.segment_id = g.segment_id AND g.t_ns > a.t ASOF LEFT JOIN hi b ON b.segment_id = g.segment_id AND g.t_ns <= b.t)"""


def _ends(source: str) -> str:
    return f"lo AS (SELECT segment_id, t_ns AS t, arg_max(value, seq) AS v FROM sig WHERE source = '{source}' GROUP BY ALL), hi AS (SELECT segment_id, t_ns AS t, arg_min(value, seq) AS v FROM sig WHERE source = '{source}' GROUP BY ALL)"


def _grid(signals: DataFrame) -> DataFrame:
    return bounds.time_grid(bounds.valid_ranges(_range(signals, "click")), STEP)


@_query(f"WITH {_SIG}, {_RNG}, {_GRID}, {_ends('click')}, {_NEAR} SELECT segment_id, frame_index, t_ns, source_t_ns, v AS action FROM near")
def j2_nearest_resample(spark, sf_dir):
    signals = _events(spark, sf_dir)
    data = signals.filter("source = 'click'").select("segment_id", "t_ns", "seq", F.col("value")[0].alias("action"))
    return asof.nearest(_grid(signals), data, ["action"], keep=["frame_index"])


@_query(f"WITH {_SIG}, {_RNG}, {_GRID}, {_ends('view')}, {_NEAR} SELECT segment_id, frame_index, t_ns, v AS frame FROM near WHERE source_t_ns IS NOT NULL")
def j3_j4_nearest_frame(spark, sf_dir):
    signals = _events(spark, sf_dir)
    data = signals.filter("source = 'view'").select("segment_id", "t_ns", "seq", F.col("value")[0].alias("frame"))
    return asof.nearest(_grid(signals), data, ["frame"], keep=["frame_index"]).drop("source_t_ns")


@_query(f"WITH {_SIG}, {_RNG}, {_GRID} SELECT g.segment_id, g.frame_index, g.t_ns, s.value FROM grid g JOIN sig s ON s.segment_id = g.segment_id AND s.t_ns = g.t_ns AND s.source = 'click'")
def j5_exact_lookup(spark, sf_dir):
    signals = _events(spark, sf_dir)
    return _grid(signals).join(signals.filter("source = 'click'").select("segment_id", "t_ns", F.col("value")[0].alias("value")), ["segment_id", "t_ns"]).select("segment_id", "frame_index", "t_ns", "value")


@_query(f"WITH {_SIG}, day AS (SELECT segment_id, t_ns // 86400000000000 AS t_ns, source, min(value) AS value FROM sig WHERE source IN ('view', 'error') GROUP BY ALL) SELECT segment_id, CAST(t_ns AS BIGINT) AS t_ns, min(value) FILTER (source = 'view') AS view, min(value) FILTER (source = 'error') AS error FROM day GROUP BY segment_id, t_ns HAVING count(*) = 2")
def j6_p12_cameras(spark, sf_dir):
    signals = _events(spark, sf_dir).filter(F.col("source").isin("view", "error"))
    day = signals.groupBy("segment_id", F.floor(F.col("t_ns") / 86_400_000_000_000).alias("t_ns"), F.col("source").alias("camera")).agg(F.min(F.col("value")[0]).alias("frame"))
    found = samples.camera_frames(day, 2)
    return found.select("segment_id", "t_ns", F.col("images")["view"].alias("view"), F.col("images")["error"].alias("error"))


_CONFIG = ExportConfig(action=["click"], state=["view", "purchase"], fps=15, max_episode_duration_s=LIMIT_S, trimming=Trimming(mode="signal_presence", source="purchase"))
_EPISODE = f"""raw AS (SELECT segment_id, (max(t_ns) - min(t_ns)) / 1e9 AS raw_s FROM sig GROUP BY segment_id),
idx AS (SELECT segment_id, raw_s, CAST(row_number() OVER (ORDER BY segment_id) - 1 AS BIGINT) AS episode_index FROM raw),
act AS (SELECT segment_id, min(t_ns) AS s, max(t_ns) AS e FROM sig WHERE source = 'click' GROUP BY segment_id),
tr AS (SELECT segment_id, min(t_ns) AS ts, max(t_ns) AS te FROM sig WHERE source = 'purchase' GROUP BY segment_id),
rng AS (SELECT * FROM (SELECT segment_id, greatest(s, coalesce(ts, s)) AS start_ns, least(e, coalesce(te, e)) AS end_ns FROM act LEFT JOIN tr USING (segment_id) JOIN raw USING (segment_id) WHERE raw_s <= {LIMIT_S} AND s < e) WHERE start_ns < end_ns),
{_GRID}, {_LATEST},
lo AS (SELECT segment_id, t_ns AS t, {{'c': click, 'v': view, 'p': purchase}} AS v FROM fill), hi AS (SELECT * FROM lo), {_NEAR},
smp AS (SELECT segment_id, frame_index, t_ns, v.c AS action0, list_filter([v.v, v.p], lambda x: x IS NOT NULL) AS st FROM near),
ep AS (SELECT segment_id, count(*) AS n, (max(t_ns) - min(t_ns)) / 1e9 AS d, min(len(st)) <> max(len(st)) AS ragged FROM smp GROUP BY segment_id),
sts AS (SELECT segment_id, episode_index, CASE WHEN raw_s > {LIMIT_S} OR act.segment_id IS NULL OR rng.segment_id IS NULL THEN 'skipped' WHEN n IS NULL OR ragged THEN 'failed' ELSE 'success' END AS status, coalesce(n, 0) AS num_frames, coalesce(d, 0.0) AS duration_s FROM idx LEFT JOIN act USING (segment_id) LEFT JOIN rng USING (segment_id) LEFT JOIN ep USING (segment_id))"""


@_query(f"WITH {_SIG}, {_EPISODE} SELECT * FROM sts")
def a6_p19_u5_episode_status(spark, sf_dir):
    return episodes.build(_events(spark, sf_dir), _CONFIG, step_ns=STEP).status.drop("reason")


@_query(f"WITH {_SIG}, {_EPISODE} SELECT status, count(*) AS n FROM sts GROUP BY status")
def a7_a8_outcome_tally(spark, sf_dir):
    return samples.outcome_tally(episodes.build(_events(spark, sf_dir), _CONFIG, step_ns=STEP).status)


@_query(f"WITH {_SIG}, {_EPISODE} SELECT segment_id, episode_index, frame_index, t_ns, CAST(CAST(action0 AS FLOAT) AS DOUBLE) AS action0, CAST(len(st) AS INTEGER) AS n_state, CAST(CAST(list_sum(list_transform(st, lambda x: CAST(CAST(x AS FLOAT) AS DOUBLE))) AS DOUBLE) AS DOUBLE) AS state_sum FROM smp JOIN sts USING (segment_id) WHERE status = 'success'")
def k3_samples(spark, sf_dir):
    made = episodes.build(_events(spark, sf_dir), _CONFIG, step_ns=STEP).samples
    total = F.when(F.size("state") > 0, F.aggregate("state", F.lit(0.0), lambda a, v: a + v.cast("double")))
    return made.select("segment_id", "episode_index", "frame_index", "t_ns", F.col("action")[0].cast("double").alias("action0"), F.size("state").alias("n_state"), total.alias("state_sum"))


@_query(f"""WITH {_SIG}, act AS (SELECT segment_id, min(t_ns) AS s, max(t_ns) AS e FROM sig WHERE source = 'click' GROUP BY segment_id),
cam AS (SELECT segment_id, min(t_ns) AS s, max(t_ns) AS e FROM sig WHERE source = 'view' GROUP BY segment_id),
rng AS (SELECT * FROM (SELECT segment_id, greatest(act.s, cam.s) AS start_ns, least(act.e, cam.e) AS end_ns FROM act JOIN cam USING (segment_id)) WHERE start_ns < end_ns),
{_GRID}, {_ends('click')}, {_NEAR}, vec AS (SELECT * FROM near), lo2 AS (SELECT segment_id, t_ns AS t, arg_max(seq, seq) AS v FROM sig WHERE source = 'view' GROUP BY ALL), hi2 AS (SELECT segment_id, t_ns AS t, arg_min(seq, seq) AS v FROM sig WHERE source = 'view' GROUP BY ALL),
pic AS (SELECT g.segment_id, g.frame_index, g.t_ns, CASE WHEN b.t IS NULL OR (a.t IS NOT NULL AND g.t_ns - a.t <= b.t - g.t_ns) THEN a.v ELSE b.v END AS frame FROM grid g ASOF LEFT JOIN lo2 a ON a.segment_id = g.segment_id AND g.t_ns > a.t ASOF LEFT JOIN hi2 b ON b.segment_id = g.segment_id AND g.t_ns <= b.t)
SELECT segment_id, frame_index, t_ns, CAST(CAST(vec.v AS FLOAT) AS DOUBLE) AS action0, frame FROM vec JOIN pic USING (segment_id, frame_index, t_ns)""")
def p19_j6_camera_samples(spark, sf_dir):
    signals = _events(spark, sf_dir)
    frames = signals.filter("source = 'view'").select("segment_id", F.lit("view").alias("camera"), "t_ns", F.col("seq").alias("frame_seq"), F.lit(1).alias("height"), F.lit(1).alias("width"))
    config = ExportConfig(action=["click"], cameras=[Camera("view")], fps=15)
    made = episodes.build(signals, config, frames.withColumn("number", F.col("frame_seq")), step_ns=STEP).samples
    return made.select("segment_id", "frame_index", "t_ns", F.col("action")[0].cast("double").alias("action0"), F.col("images")["view"]["number"].alias("frame"))


@_query("SELECT CAST(dim AS INTEGER) AS dim, round(min(v), 5) AS \"min\", round(max(v), 5) AS \"max\", round(avg(v), 5) AS mean, round(stddev_pop(v), 5) AS std, count(v) AS count FROM (SELECT unnest(range(0, 64)) AS dim, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings) GROUP BY dim")
def a13_feature_statistics(spark, sf_dir):
    found = samples.feature_statistics(_read(spark, sf_dir, "embeddings").select("embedding"), "embedding")
    return found.select("dim", *(F.round(c, 5).alias(c) for c in ("min", "max", "mean", "std")), "count")


@_query("SELECT event_id, epoch_us(ts) * 1000 AS t_ns, substr(CAST(user_id AS VARCHAR), 1, 8) AS short_id FROM events")
def f1_f14_times(spark, sf_dir):
    return _read(spark, sf_dir, "events").select("event_id", fn.ns_of_timestamp(F.col("ts")).alias("t_ns"), fn.short_id(F.col("user_id").cast("string")).alias("short_id"))


PER_FILE, PER_CHUNK = 500, 1000


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = _read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("episode_index")).agg(F.count("*").alias("length"))
    return layout.row_ranges(lengths).withColumn("data/chunk_index", F.floor(F.col("episode_index") / PER_CHUNK).cast("long")).withColumn("data/file_index", F.floor(F.col("episode_index") / PER_FILE).cast("long"))


def _with_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("episode_index"), (F.col("o_orderstatus") != "P").alias("_has"))
    records = _records(spark, sf_dir).join(orders, "episode_index")
    for n in ("chunk_index", "file_index"):
        records = records.withColumn(f"videos/top/{n}", F.when(F.col("_has"), F.col(f"`data/{n}`")))
    return records.withColumns({f"videos/top/{n}_timestamp": F.col(f"dataset_{n}_index") / 30.0 for n in ("from", "to")})


_REC = f"rec AS (SELECT l_orderkey AS episode_index, count(*) AS length, l_orderkey // {PER_CHUNK} AS c, l_orderkey // {PER_FILE} AS f FROM lineitem GROUP BY l_orderkey), pos AS (SELECT *, CAST(sum(length) OVER (ORDER BY episode_index) AS BIGINT) AS dataset_to_index FROM rec), full_ AS (SELECT *, dataset_to_index - length AS dataset_from_index FROM pos)"


@_query(f"WITH {_REC} SELECT episode_index, length, dataset_from_index, dataset_to_index FROM full_")
def s11_w5_row_ranges(spark, sf_dir):
    return _records(spark, sf_dir).select("episode_index", "length", "dataset_from_index", "dataset_to_index")


@_query(f"WITH {_REC} SELECT c AS chunk_index, f AS file_index, count(*) AS n_episodes, min(dataset_from_index) AS file_offset FROM full_ GROUP BY ALL")
def a9_a11_file_groups(spark, sf_dir):
    return layout.file_groups(_records(spark, sf_dir))


@_query(f"WITH {_REC} SELECT c AS chunk_index, f AS file_index, count(*) AS n_episodes FROM full_ JOIN orders ON o_orderkey = episode_index WHERE o_orderstatus <> 'P' GROUP BY ALL")
def a10_p18_camera_groups(spark, sf_dir):
    return layout.camera_groups(_with_videos(spark, sf_dir), "top")


# orders that are partly done stand for episodes without a video; prices for seconds
@_query(f"WITH {_REC} SELECT episode_index, 'top' AS video_key, printf('set/videos/top/chunk-%03d/file-%03d.mp4', c, f) AS source, dataset_from_index / 30.0 AS start, dataset_to_index / 30.0 AS \"end\" FROM full_ JOIN orders ON o_orderkey = episode_index WHERE o_orderstatus <> 'P'")
def j9_video_clips(spark, sf_dir):
    return video_clips(_with_videos(spark, sf_dir), ["top"], "set").filter("source IS NOT NULL")


@_query(f"WITH {_REC}, loc AS (SELECT *, dataset_from_index - min(dataset_from_index) OVER (PARTITION BY c, f) AS a FROM full_) SELECT c AS chunk, f AS file, a + i AS row_index, episode_index FROM (SELECT *, unnest(range(0, length)) AS i FROM loc)")
def j8_rows_of_episodes(spark, sf_dir):
    records = _records(spark, sf_dir)
    files = records.groupBy(F.col("`data/chunk_index`").alias("chunk"), F.col("`data/file_index`").alias("file")).agg(F.sum("length").alias("n"))
    rows = files.select("chunk", "file", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("row_index"))
    return layout.rows_of_episodes(records, rows)


@_query(f"WITH {_REC} SELECT episode_index, printf('data/chunk-%03d/episode_%06d.parquet', episode_index // 1000, episode_index) AS path, episode_index // 1000 AS chunk FROM full_")
def k7_f10_episode_paths(spark, sf_dir):
    e = F.col("episode_index")
    return _records(spark, sf_dir).select(e, fn.chunk_path("data/chunk-%03d/episode_%06d.parquet", e, 1000).alias("path"), F.floor(e / 1000).cast("long").alias("chunk"))


@_query("SELECT CAST(ceil(count(DISTINCT l_orderkey) / 1000.0) AS BIGINT) AS total_chunks, count(DISTINCT l_orderkey) * 2 AS total_videos FROM lineitem")
def a12_totals(spark, sf_dir):
    chunks, videos = layout.totals(F.count_distinct("l_orderkey"), 1000, 2)
    return _read(spark, sf_dir, "lineitem").agg(chunks.alias("total_chunks"), videos.alias("total_videos"))


@_query("SELECT CAST(row_number() OVER (ORDER BY event_type) - 1 AS BIGINT) AS task_index, event_type AS task FROM (SELECT DISTINCT event_type FROM events)")
def k8_tasks(spark, sf_dir):
    return layout.task_indexes(_read(spark, sf_dir, "events").select(F.col("event_type").alias("task")))


@_query(f"WITH {_REC} SELECT episode_index, '{{\"episode_index\":' || episode_index || ',\"length\":' || length || '}}' AS line FROM full_")
def k9_f11_episode_lines(spark, sf_dir):
    return episode_lines(_records(spark, sf_dir).drop("length")).select("episode_index", "line")


@_query("SELECT event_id, (starts_with(hex(encode(props)), '000001')) AS annex_b, CAST(octet_length(encode(props)) > 0 AS BOOLEAN) AS has_packet FROM events")
def f6_p11_packets(spark, sf_dir):
    data = F.col("props").cast("binary")
    return _read(spark, sf_dir, "events").select("event_id", fn.is_annex_b(data).alias("annex_b"), fn.has_packet(data).alias("has_packet"))
