"""Configuration, trimming, grids, as-of joins, packets, writers and conversion."""

import json

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelspan.config import ExportConfig, Trimming, scalar_column, sources_of
from reelspan.functions import packets
from reelspan.functions.columns import concat_present, is_annex_b, largest_change
from reelspan.functions.pixels import resize_rgb
from reelspan.operators import asof, bounds, layout
from reelspan.operators.order import running_total
from reelspan.plans import episodes
from reelspan.plans.export import export
from reelspan.plans.validate import missing_sources, validate_sources
from reelspan.sinks import convert as conv
from reelspan.sinks.heads import GrootHead, make_head
from reelspan.sources import rrd
from reelspan.sources.recordings import discover, load_data, load_episode_records, load_tasks, open_dataset, resolve

MS = 1_000_000
SIGNALS = "segment_id string, source string, t_ns long, seq long, value array<double>"


def signal(spark, rows, source="s", segment="a"):
    return spark.createDataFrame([(segment, source, t, i, v if isinstance(v, list) else [float(v)]) for i, (t, v) in enumerate(rows)], SIGNALS)


@pytest.mark.parametrize("bad", [{"fps": 1}, {"fps": 251}, {"fps": 15.0}, {"format": "x"}, {"action": "a/b"}, {"index_column": "my time"}, {"max_episode_duration_s": 0}, {"max_episode_duration_s": -5}, {"trimming": {"mode": "garbage"}}, {"trimming": {"mode": "signal_change"}}, {"trimming": {"threshold": 0}}, {"trimming": {"tail_ms": -100}}, {"cameras": [{"source": "c", "width": 1}]}])
def test_bad_configuration(bad):
    with pytest.raises(ValueError):
        ExportConfig.from_json(json.dumps(bad))


def test_configuration():
    c = ExportConfig.from_json('{"action": "arm", "state": null, "cameras": [{"source": "w", "width": 32, "height": 48}, {"source": "t", "width": 32}], "trimming": {"tail_ms": 0}}')
    assert (c.action, c.state, c.fps, c.step_ns, c.trimming.threshold, c.trimming.mode) == (["arm"], [], 15, 66_666_666, 0.01, "all_present")
    assert [x.resize for x in c.cameras] == [(32, 48), None]
    assert ExportConfig.from_json(c.to_json()) == c
    assert c.column_names() == ["/arm:Scalars:scalars", "/w:VideoStream:sample", "/t:VideoStream:sample"]
    assert sources_of(["/b:Scalars:scalars", "/a:Scalars:scalars", "x"], ":Scalars:scalars") == ["a", "b"] and scalar_column("/a") == "/a:Scalars:scalars"


def every(step_ms, *values):
    return [(i * step_ms * MS, v) for i, v in enumerate(values)]


RISES = every(40, 3, 3, 3, 7, 9, 9, 9, 9)


@pytest.mark.parametrize(("mode", "rows", "threshold", "tail", "raw", "want"), [
    ("signal_presence", [(t, 4.0) for t in (130, 170, 720)], 0.01, 0, (20, 900), (130, 720)),
    ("signal_presence", [], 0.01, 0, (20, 900), (20, 900)),
    ("signal_change", RISES, 0.5, 0, (0, 280 * MS), (80 * MS, 160 * MS)),
    ("signal_change", RISES, 0.5, 90, (0, 280 * MS), (80 * MS, 250 * MS)),
    ("signal_change", RISES, 0.5, 900, (0, 280 * MS), (80 * MS, 280 * MS)),
    ("signal_change", RISES, 3.0, 0, (0, 280 * MS), (80 * MS, 120 * MS)),
    ("signal_change", every(25, [1.0, 8.0], [1.0, 8.0], [1.4, 8.0], [1.4, 8.9]), 0.6, 0, (0, 75 * MS), (50 * MS, 75 * MS)),
    ("signal_change", every(25, 2.5, 2.5, 2.5), 0.01, 0, (0, 50 * MS), (0, 50 * MS)),
    ("signal_change", [(35 * MS, 6.0)], 0.01, 0, (0, 70 * MS), (0, 70 * MS)),
    ("signal_change", every(30, 0.0, float("nan"), 0.0), 0.01, 0, (0, 90 * MS), (0, 90 * MS)),
])
def test_trimming(spark, mode, rows, threshold, tail, raw, want):
    signals = signal(spark, rows)
    trim = episodes.trim_of(signals, ExportConfig(action=["s"], trimming=Trimming(mode, "s", threshold, tail)))
    ranges = spark.createDataFrame([("a", *raw)], "segment_id string, start_ns long, end_ns long")
    assert tuple(bounds.trimmed(ranges, trim).first())[1:] == want


@pytest.mark.parametrize(("start", "end", "fps", "n"), [(0, 10**9, 10, 11), (0, 10**9, 15, 16), (5 * 10**9, 6 * 10**9, 10, 11)])
def test_grid(spark, start, end, fps, n):
    ranges = spark.createDataFrame([("a", start, end)], "segment_id string, start_ns long, end_ns long")
    rows = bounds.time_grid(ranges, ExportConfig(fps=fps).step_ns).orderBy("frame_index").collect()
    assert len(rows) == n and rows[0]["t_ns"] == start and rows[-1]["t_ns"] <= end


def test_nearest_beyond_the_ends_and_between(spark):
    times = (70, 94, 300)
    data = spark.createDataFrame([("a", t, i, i) for i, t in enumerate(times)], "segment_id string, t_ns long, seq long, f int")
    probes = [0, 70, 81, 82, 83, 197, 198, 299, 5000]
    grid = spark.createDataFrame([("a", t) for t in probes] + [("none", 5)], "segment_id string, t_ns long")
    want = {t: min(range(3), key=lambda i: (abs(times[i] - t), i)) for t in probes}
    assert {r["t_ns"]: r["f"] for r in asof.nearest(grid, data, ["f"]).collect()} == want


@pytest.mark.parametrize("bucket", [7, 100, 10**9])
def test_changes_across_buckets(spark, bucket):
    r = __import__("random").Random(bucket)
    rows = sorted((r.randrange(900), [float(r.randrange(9))]) for _ in range(60))
    got = bounds.consecutive_changes(signal(spark, rows), "s", bucket).orderBy("t_ns", "t_next").collect()
    want = sorted((a[0], b[0], abs(a[1][0] - b[1][0])) for a, b in zip(rows, rows[1:], strict=False))
    assert sorted((x["t_ns"], x["t_next"], x["change"]) for x in got) == want


def test_running_total(spark):
    r = __import__("random").Random(2)
    rows = [(i, r.randrange(9)) for i in r.sample(range(10**6), 400)]
    df = spark.createDataFrame(rows, "k long, n long").repartition(5)
    got = {x["k"]: (x["at"], x["sum"]) for x in running_total(running_total(df, "k", None, "at"), "k", "n", "sum").collect()}
    total = 0
    for i, (k, n) in enumerate(sorted(rows)):
        assert got[k] == (i, total)
        total += n
    assert running_total(df.limit(0), "k", None, "at").count() == 0


def test_a_long_grid(spark):
    ranges = spark.createDataFrame([("a", 5, 5 + 3 * 25_003), ("b", 9, 10)], "segment_id string, start_ns long, end_ns long")
    rows = bounds.time_grid(ranges, 3).orderBy("segment_id", "frame_index").collect()
    assert [(r["frame_index"], r["t_ns"]) for r in rows] == [(i, 5 + 3 * i) for i in range(25_004)] + [(0, 9)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 60), min_size=1, max_size=25), st.lists(st.integers(-5, 70), min_size=1, max_size=15), st.sampled_from([7, 10**9]))
def test_as_of_joins_against_search(spark, times, probes, bucket):
    times = sorted(times)
    data = spark.createDataFrame([("a", "s", t, i, [float(i)]) for i, t in enumerate(times)], SIGNALS)
    grid = spark.createDataFrame([("a", t) for t in sorted(set(probes))], "segment_id string, t_ns long")
    near = {r["t_ns"]: int(r["value"][0]) for r in asof.nearest(grid, data, ["value"], bucket).collect()}
    last = {r["t_ns"]: r["s"] for r in asof.latest_at(grid, data, ["s"], bucket).collect()}
    a = np.array(times)
    for g in set(probes):
        i = int(np.searchsorted(a, g))
        want = 0 if i == 0 else len(a) - 1 if i == len(a) else i - 1 if g - a[i - 1] <= a[i] - g else i
        assert near[g] == want
        j = int(np.searchsorted(a, g, side="right")) - 1
        assert last[g] == (None if j < 0 else [float(j)])


def test_vectors(spark):
    row = spark.createDataFrame([([1.0], None, [2.0, 3.0], [0.5, 5.0])], "a array<double>, b array<double>, c array<double>, d array<double>")
    assert row.select(concat_present(F.col("a"), F.col("b"), F.col("c")).alias("v")).first()["v"] == [1.0, 2.0, 3.0]
    got = row.select(largest_change(F.col("c"), F.col("d")).alias("x"), largest_change(F.col("a"), F.col("c")).alias("y")).first()
    assert got["x"] == 2.0 and got["y"] is None


def test_packet_bytes(spark):
    cases = [("00000109f0", True), ("000000010a", True), ("000001", True), ("0000020109", False), ("ff000001", False), ("", False)]
    rows = spark.createDataFrame([(bytes.fromhex(h), w) for h, w in cases], "d binary, w boolean").select(is_annex_b(F.col("d")).alias("g"), "w").collect()
    assert all(r["g"] == r["w"] for r in rows)
    assert packets.annex_b_bytes(bytes.fromhex("00000003" "68ce38" "00000001" "09")) == bytes.fromhex("00000001" "68ce38" "00000001" "09")
    long = (256).to_bytes(4, "big") + b"x" * 256
    assert packets.annex_b_bytes(long) == long and packets.annex_b_bytes(long, look_at_head=False) == packets.START_CODE + b"x" * 256
    assert packets.annex_b_bytes(bytes.fromhex("00000002aabb00000009cc")) == bytes.fromhex("00000001aabb")


def test_frame_times():
    held = []

    def decode(data):
        if data is None:
            out = list(held)
            held.clear()
            return out
        if data == b"bad":
            raise ValueError
        held.append(data)
        return [held.pop(0)] if len(held) > 1 else []

    assert list(packets.frame_times([(1, b"a"), (2, b"b"), (3, b"bad"), (4, b"c")], decode)) == [(2, b"a"), (4, b"b"), (4, b"c")]
    assert list(packets.frame_times([(1, b"a")], decode)) == []


def test_decode_frames_of_many_cameras(spark):
    code = packets.START_CODE

    def toy_decoder():
        """A frame of one pixel for every packet, one packet late; the last byte is its grey."""
        held = []

        def decode(data):
            if data is not None and not data.startswith(code):
                raise RuntimeError("no unit")
            out, held[:] = list(held), [] if data is None else [data]
            return iter([(1, 1, d[-1:] * 3) for d in out])

        return decode

    unit = lambda b: (2).to_bytes(4, "big") + bytes([9, b])
    rows = [(s, c, 10 * i, i, unit(i)) for s in "ab" for c in ("top", "side") for i in range(40)] + [("a", "top", 401, 40, b"junk"), ("a", "top", 402, 41, b""), ("a", "top", 403, 42, None)]
    made = spark.createDataFrame(rows, "segment_id string, camera string, t_ns long, seq long, data binary").repartition(3)
    got = packets.decode_frames(made, toy_decoder).collect()
    want = sorted((s, c, 390 if i >= 38 else 10 * (i + 1), i, bytes([i] * 3)) for s in "ab" for c in ("top", "side") for i in range(40))
    assert sorted((r["segment_id"], r["camera"], r["t_ns"], r["frame_seq"], bytes(r["rgb"])) for r in got) == want
    # cells as nested lists of small numbers
    nested = spark.createDataFrame([("a", "top", i, i, [list(unit(i))]) for i in range(3)], "segment_id string, camera string, t_ns long, seq long, data array<array<smallint>>")
    assert sorted(bytes(r["rgb"])[0] for r in packets.decode_frames(nested, toy_decoder).collect()) == [0, 1, 2]


def test_resizing():
    flat = bytes([7, 80, 200]) * 12
    assert resize_rgb(flat, 3, 4, 6, 5) == bytes([7, 80, 200]) * 30 and resize_rgb(flat, 3, 4, 1, 2) == bytes([7, 80, 200]) * 2
    rows = np.repeat(np.array([0, 100, 200, 60], np.uint8), 3).tobytes()
    assert resize_rgb(rows, 1, 4, 1, 2) == bytes([50] * 3 + [130] * 3)
    assert resize_rgb(bytes([0] * 3 + [100] * 3), 1, 2, 1, 4) == bytes([0] * 3 + [25] * 3 + [75] * 3 + [100] * 3)
    assert resize_rgb(bytes([0] * 3 + [90] * 3 + [30] * 3), 1, 3, 1, 2) == bytes([30] * 3 + [50] * 3)


def test_validation():
    found = {"signals": ["arm", "joints"], "cameras": ["top"], "timelines": ["canonical_time"]}
    from reelspan.config import Camera

    assert missing_sources(ExportConfig(action=["arm"], state=["joints"], cameras=[Camera("top")]), found) == []
    with pytest.raises(ValueError, match="flange.*top"):
        validate_sources(ExportConfig(action=["arm"], cameras=[Camera("flange")]), found)
    validate_sources(ExportConfig(action=["arm"]), None)


def test_discovery(tmp_path):
    with pytest.raises(FileNotFoundError):
        discover(tmp_path / "none")
    with pytest.raises(FileNotFoundError):
        discover(tmp_path)
    for n in ("b", "a"):
        (tmp_path / n).mkdir()
        (tmp_path / n / "recording.rrd").touch()
    assert [p.parent.name for p in discover(tmp_path)] == ["a", "b"]
    assert resolve("x", "/r") == __import__("pathlib").Path("/r/x")


def test_modality():
    head = GrootHead(ExportConfig(action=["arm"], state=["joints"]), "x")
    with pytest.raises(RuntimeError):
        head.modality()
    head.features = {"action": {"shape": [7]}, "observation.state": {"shape": [7]}}
    m = head.modality()
    assert m["state"] == {"joints": {"start": 0, "end": 7}} and m["action"] == {"arm": {"start": 0, "end": 7}} and "video" not in m
    both = GrootHead(ExportConfig(action=["a", "b"]), "x")
    both.features = {"action": {"shape": [8]}}
    assert both.modality()["action"] == {"action": {"start": 0, "end": 8}} and "state" not in both.modality()
    with pytest.raises(ValueError):
        make_head(ExportConfig.__new__(ExportConfig).__class__(format="groot"), "x").config.__class__(format="no")


def recordings(spark):
    rows = []
    for k, seg in enumerate(("a", "b", "c")):
        rows += [(seg, "arm", i * 100 * MS, i, [float(i + k), 1.0]) for i in range(11)]
    rows += [("a", "joints", i * 100 * MS, i, [float(i)]) for i in range(11)] + [("b", "joints", 0, 0, [1.0])]
    rows += [("c", "joints", 500 * MS, 0, [1.0]), ("d", "joints", 0, 0, [1.0]), ("e", "arm", 5, 0, [1.0, 1.0])]
    return spark.createDataFrame(rows, SIGNALS)


def test_episode_outcomes(spark):
    built = episodes.build(recordings(spark), ExportConfig(action=["arm"], state=["joints"], fps=10))
    status = {r["segment_id"]: (r["status"], r["episode_index"], r["num_frames"]) for r in built.status.collect()}
    # c's state begins late, so its vectors differ in length
    assert status == {"a": ("success", 0, 11), "b": ("success", 1, 11), "c": ("failed", 2, 11), "d": ("skipped", 3, 0), "e": ("skipped", 4, 0)}
    assert built.samples.filter("segment_id = 'a'").orderBy("frame_index").select("state").collect()[3]["state"] == [3.0]


def test_frames_join(spark):
    from reelspan.config import Camera

    frames = spark.createDataFrame([("a", "top", i * 300 * MS, i, 4, 4, b"x%d" % i) for i in range(4)], "segment_id string, camera string, t_ns long, frame_seq long, height int, width int, rgb binary")
    built = episodes.build(recordings(spark), ExportConfig(action=["arm"], cameras=[Camera("top")], fps=10), frames)
    rows = built.samples.orderBy("frame_index").collect()
    assert {r["segment_id"] for r in rows} == {"a"} and [bytes(r["images"]["top"]["rgb"]) for r in rows] == [b"x0", b"x0", b"x1", b"x1", b"x1", b"x2", b"x2", b"x2", b"x3", b"x3"]


def test_cameras_are_not_passed_over(spark, tmp_path, monkeypatch):
    from reelspan import cli
    from reelspan.config import Camera
    from reelspan.streaming.closed_segments import follow

    layout = "segment_id string, camera string, t_ns long, frame_seq long, height int, width int, rgb binary"
    config = ExportConfig(action=["arm"], cameras=[Camera("top")], fps=10)
    for run in (lambda: episodes.build(recordings(spark), config), lambda: export(recordings(spark), config, str(tmp_path / "none")), lambda: follow(spark, "in", SIGNALS, config, print, "cp")):
        with pytest.raises(ValueError, match="names cameras"):
            run()
    # a camera that is not asked for takes no segment away, and frames get the size that is asked for
    frames = spark.createDataFrame([("a", c, i * 300 * MS, i, 4, 4, bytes([i]) * 48) for i in range(4) for c in ("top", "other")], layout)
    assert episodes.build(recordings(spark), config, frames).samples.count() == 10
    for width in (4, 8):
        built = episodes.build(recordings(spark), ExportConfig(action=["arm"], cameras=[Camera("top", width, 4)], fps=10), frames)
        images = [r["images"]["top"] for r in built.samples.collect()]
        assert len(images) == 10 and all((i["width"], i["height"], bytes(i["rgb"])) == (width, 4, bytes([i["rgb"][0]]) * width * 12) for i in images)

    monkeypatch.setattr(cli, "build_session", lambda: spark)
    recordings(spark).write.parquet(str(tmp_path / "signals"))
    frames.write.parquet(str(tmp_path / "frames"))
    (tmp_path / "c.json").write_text(config.to_json())
    (tmp_path / "back.json").write_text(ExportConfig(action=["arm"], cameras=[Camera("back")], fps=10).to_json())

    def run_cli(config, *more):
        return cli.main(["export", "--dataset", str(tmp_path / "signals"), "--config", str(tmp_path / config), "--output", str(tmp_path / "out"), *more])

    assert run_cli("c.json") == run_cli("back.json", "--frames", str(tmp_path / "frames")) == run_cli("c.json", "--packets", "p", "--decoder", "none") == 1 and not (tmp_path / "out").exists()
    assert run_cli("c.json", "--frames", str(tmp_path / "frames")) == 0
    assert load_data(spark, tmp_path / "out").count() == 10


def test_export_and_convert(spark, tmp_path):
    out = str(tmp_path / "set")
    result = export(recordings(spark), ExportConfig(format="groot", action=["arm"], state=["joints"], fps=10), out)
    assert (result.episodes, result.frames, result.metadata["failed"], result.metadata["skipped"]) == (2, 22, 1, 2)
    assert json.loads((tmp_path / "set/meta/modality.json").read_text())["action"] == {"arm": {"start": 0, "end": 2}}
    assert json.loads((tmp_path / "set/meta/stats.json").read_text())["action"]["max"] == [11.0, 1.0]
    with pytest.raises(ValueError):
        export(recordings(spark), ExportConfig(action=["arm"]), out)
    conv.convert(spark, out, chunk_size=1)
    assert spark.read.parquet(f"{out}/data/chunk-001/episode_000001.parquet").count() == 11
    info = json.loads((tmp_path / "set/meta/info.json").read_text())
    assert (info["codebase_version"], info["total_chunks"], info["total_videos"]) == ("v2.1", 2, 0)
    assert [json.loads(x)["length"] for x in (tmp_path / "set/meta/episodes.jsonl").read_text().splitlines()] == [11, 11]
    with pytest.raises(ValueError):
        conv.convert(spark, out)


def test_convert_cuts_videos(spark, tmp_path):
    key, out = "observation.images.top", tmp_path / "set"
    export(recordings(spark), ExportConfig(action=["arm"], fps=10), str(out))
    info = json.loads((out / "meta/info.json").read_text())
    info["features"][key], info["video_path"] = {"dtype": "video", "shape": [4, 4, 3]}, conv.SOURCE_VIDEO_PATH
    (out / "meta/info.json").write_text(json.dumps(info))

    def cutter(source, target, start, end):
        with open(source, "rb") as f, open(target, "wb") as g:
            g.write(f.read()[int(start) : int(end)])

    # no video is told of, or its file is missing, or nothing can cut: the dataset stays as it was
    def refused(error, cutter=cutter):
        with pytest.raises(error):
            conv.convert(spark, str(out), cutter=cutter)
        assert not list(tmp_path.glob("set_*")) and json.loads((out / "meta/info.json").read_text())["codebase_version"] == "v3.0"

    refused(ValueError)
    path = out / "meta/episodes/chunk-000/file-000.parquet"
    records = pd.read_parquet(path)
    assert len(records) == 3
    for n, values in (("chunk_index", [0, 0, 0]), ("file_index", [0, 0, 1]), ("from_timestamp", [0.0, 2.0, 0.0]), ("to_timestamp", [2.0, 4.0, 2.0])):
        records[f"videos/{key}/{n}"] = values
    records.to_parquet(path)
    folder = out / f"videos/{key}/chunk-000"
    folder.mkdir(parents=True)
    (folder / "file-000.mp4").write_bytes(b"aabb")
    refused(FileNotFoundError)
    (folder / "file-001.mp4").write_bytes(b"cc")
    if not __import__("shutil").which("ffmpeg"):
        refused(RuntimeError, None)
    conv.convert(spark, str(out), chunk_size=2, cutter=cutter)
    got = {str(p.relative_to(out)): p.read_bytes() for p in out.glob("videos/**/*") if p.is_file()}
    assert got == {f"videos/chunk-{i // 2:03d}/{key}/episode_{i:06d}.mp4": b for i, b in enumerate((b"aa", b"bb", b"cc"))}
    assert json.loads((out / "meta/info.json").read_text())["total_videos"] == 3


def test_nothing_to_export(spark, tmp_path):
    with pytest.raises(RuntimeError, match="no action samples"):
        export(recordings(spark).filter("segment_id = 'd'"), ExportConfig(action=["arm"]), str(tmp_path / "none"))


def test_clip_limits():
    assert conv.clip_arguments("a.mp4", "b.mp4", 0, 2.5)[0] == "ffmpeg"
    with pytest.raises(ValueError):
        conv.check_video_path("/etc/a.mp4")
    for a, b in ((5, 5), (-1, 3), (0, 4000), (0, 90_000)):
        with pytest.raises(ValueError):
            conv.clip_arguments("a.mp4", "b.mp4", a, b)
    with pytest.raises(ValueError):
        conv.check_video_path("a.sh")
    assert conv.unflatten({"a/b": 1, "a/c/d": 2}) == {"a": {"b": 1, "c": {"d": 2}}}


def test_rows_of_episodes_with_gap(spark):
    layout_ = "episode_index long, dataset_from_index long, dataset_to_index long, `data/chunk_index` long, `data/file_index` long"
    records = [(0, 0, 3, 0, 0), (2, 4, 6, 0, 0), (3, 6, 8, 0, 1)]
    rows = spark.createDataFrame([(0, 0, i) for i in range(7)] + [(0, 1, 0), (0, 1, 1)], "chunk long, file long, row_index long")
    got = {(r["file"], r["row_index"]): r["episode_index"] for r in layout.rows_of_episodes(spark.createDataFrame(records, layout_), rows).collect()}
    assert got == {(0, 0): 0, (0, 1): 0, (0, 2): 0, (0, 4): 2, (0, 5): 2, (1, 0): 3, (1, 1): 3}
    with pytest.raises(Exception, match="invalid length of episode 1"):
        layout.rows_of_episodes(spark.createDataFrame([*records, (1, 3, 3, 0, 0)], layout_), rows).collect()


def v3_folder(root):
    """A v3.0 dataset by hand: two data files, 7 episodes of 1 to 7 rows, two files of records, two tasks."""
    (root / "meta/episodes/chunk-000").mkdir(parents=True)
    (root / "data/chunk-000").mkdir(parents=True)
    rows, records, at = {0: [], 1: []}, [], 0
    for e in range(7):
        file = int(e >= 4)
        rows[file] += [{"action": [float(e), float(k)], "observation.state": [k / 8], "task_index": e % 2, "episode_index": e, "frame_index": k, "index": at + k, "timestamp": k / 10} for k in range(e + 1)]
        records.append({"episode_index": e, "tasks": [f"task {e % 2}"], "length": e + 1, "data/chunk_index": 0, "data/file_index": file, "dataset_from_index": at, "dataset_to_index": at + e + 1, "stats/action/max": [float(e), float(e)], "meta/episodes/chunk_index": 0, "meta/episodes/file_index": file})
        at += e + 1
    for file, own in rows.items():
        pd.DataFrame(own).to_parquet(root / f"data/chunk-000/file-00{file}.parquet")
        pd.DataFrame([r for r in records if r["data/file_index"] == file]).to_parquet(root / f"meta/episodes/chunk-000/file-00{file}.parquet")
    pd.DataFrame({"task_index": [1, 0]}, index=pd.Index(["task 1", "task 0"], name="task")).to_parquet(root / "meta/tasks.parquet")
    (root / "meta/info.json").write_text(json.dumps({"codebase_version": "v3.0", "fps": 10, "chunks_size": 3, "data_files_size_in_mb": 100, "features": {"action": {"dtype": "float32", "shape": [2], "fps": 10}}}))
    return rows


def test_convert_a_v3_folder(spark, tmp_path):
    root = tmp_path / "set"
    rows = v3_folder(root)
    conv.convert(spark, str(root))
    for e in range(7):
        got = pd.read_parquet(root / f"data/chunk-{e // 3:03d}/episode_{e:06d}.parquet")
        want = [r for own in rows.values() for r in own if r["episode_index"] == e]
        assert got.columns.tolist() == list(want[0]) and [list(a) for a in got["action"]] == [r["action"] for r in want] and got["index"].tolist() == [r["index"] for r in want]
    info = json.loads((root / "meta/info.json").read_text())
    assert (info["total_chunks"], info["total_videos"], info["video_path"], info["chunks_size"]) == (3, 0, None, 3) and "fps" not in info["features"]["action"] and "data_files_size_in_mb" not in info
    assert [json.loads(x) for x in (root / "meta/tasks.jsonl").read_text().splitlines()] == [{"task_index": i, "task": f"task {i}"} for i in (0, 1)]
    lines = [json.loads(x) for x in (root / "meta/episodes.jsonl").read_text().splitlines()]
    assert lines == [{"episode_index": e, "tasks": [f"task {e % 2}"], "length": e + 1} for e in range(7)]
    assert json.loads((root / "meta/episodes_stats.jsonl").read_text().splitlines()[3]) == {"episode_index": 3, "stats": {"action": {"max": [3.0, 3.0]}}}


def test_convert_refuses_what_is_not_whole(spark, tmp_path):
    root = tmp_path / "set"
    v3_folder(root)
    (root / "data/chunk-000/file-001.parquet").rename(tmp_path / "away")
    with pytest.raises(FileNotFoundError):
        conv.convert(spark, str(root))
    (tmp_path / "away").rename(root / "data/chunk-000/file-001.parquet")
    path = root / "meta/episodes/chunk-000/file-000.parquet"
    records = pd.read_parquet(path)
    records.loc[1, "dataset_to_index"] = records.loc[1, "dataset_from_index"]
    records.to_parquet(path)
    with pytest.raises(Exception, match="invalid length"):
        conv.convert(spark, str(root))
    # nothing half made is left in the way of the next run
    assert sorted(p.name for p in tmp_path.iterdir()) == ["set"]
    assert load_tasks(root) == [(0, "task 0"), (1, "task 1")] and load_tasks(tmp_path) == []


def test_batches_progress_and_abort(spark, tmp_path):
    told, config = [], ExportConfig(action=["arm"], fps=10)
    export(recordings(spark), config, str(tmp_path / "all"), progress=lambda *x: told.append(x), batch=1)
    assert told == [(1, 5), (2, 5), (3, 5)]
    assert sorted(p.name for p in (tmp_path / "all/data/chunk-000").iterdir()) == [f"file-00{i}.parquet" for i in range(3)]
    records = load_episode_records(spark, tmp_path / "all").orderBy("episode_index").collect()
    assert [(r["data/file_index"], r["dataset_from_index"], r["dataset_to_index"]) for r in records] == [(0, 0, 11), (1, 11, 22), (2, 22, 33)]
    asked = []
    result = export(recordings(spark), config, str(tmp_path / "part"), abort=lambda: len(asked) >= 3 or asked.append(1), batch=1)
    assert (result.episodes, result.frames) == (2, 22) and json.loads((tmp_path / "part/meta/info.json").read_text())["total_frames"] == 22
    with pytest.raises(RuntimeError):
        export(recordings(spark), config, str(tmp_path / "none"), abort=lambda: True)


def test_recordings_in_their_container(spark, tmp_path, monkeypatch):
    """With a stand-in for the container's library, whose files are Parquet."""
    if __import__("importlib").util.find_spec("rerun"):
        pytest.skip("the library itself is here")
    wide = pa.table({"canonical_time": pa.array([0, 100, 200], pa.timestamp("ns")), "/arm:Scalars:scalars": [[1.0, 2.0], None, [3.0, 4.0]], "/top:VideoStream:sample": pa.array([[[1, 2]], [[255]], None], pa.list_(pa.list_(pa.uint8())))})
    for name in ("b", "a"):
        (tmp_path / name).mkdir()
        pq.write_table(wide, tmp_path / name / "recording.rrd")
    with pytest.raises(Exception, match="rerun library"):
        open_dataset(spark, str(tmp_path)).collect()
    with pytest.raises(Exception, match="catalog"):
        open_dataset(spark, "x", "http://nowhere").collect()
    (tmp_path / "rerun.py").write_text("import pyarrow.parquet as pq\nclass dataframe:\n    @staticmethod\n    def load_recording(path):\n        return R(path)\nclass R:\n    def __init__(self, path):\n        self.path = path\n    def view(self, index, contents):\n        return self\n    def select(self):\n        return pq.read_table(self.path).to_batches(2)\n")
    spark.sparkContext.addPyFile(str(tmp_path / "rerun.py"))
    got = sorted((r["segment_id"], r["source"], r["t_ns"], r["seq"], r["value"]) for r in open_dataset(spark, str(tmp_path)).collect())
    assert got == [(s, "arm", t, t // 100, v) for s in "ab" for t, v in ((0, [1.0, 2.0]), (200, [3.0, 4.0]))]
    packets_ = rrd.read(spark, str(tmp_path / "a/recording.rrd"), what="packets").orderBy("t_ns").collect()
    assert [(r["segment_id"], r["camera"], r["t_ns"], bytes(r["data"])) for r in packets_] == [("a", "top", 0, b"\x01\x02"), ("a", "top", 100, b"\xff")]


def test_stream_of_closed_segments(spark, tmp_path):
    from reelspan.streaming.closed_segments import follow

    recordings(spark).write.parquet(str(tmp_path / "in"))
    seen = []
    q = follow(spark, str(tmp_path / "in"), SIGNALS, ExportConfig(action=["arm"], state=["joints"], fps=10), lambda s, status, i: seen.append(s.count()), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert seen == [22]
