"""Operators on rows made by hand."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cutlight.operators import geometry as geo
from cutlight.operators import intervals as iv
from cutlight.operators import narrative as nv
from cutlight.operators import operations as op
from cutlight.operators import policy as po
from cutlight.operators import shots as sh
from cutlight.sources import subtitles as sub


def cues(spark, *rows):
    return spark.createDataFrame([(1, i + 1, float(a), float(b)) for i, (a, b) in enumerate(rows)], "movie_id bigint, cue_ord bigint, start_s double, end_s double")


@pytest.mark.parametrize(
    ("rows", "chunks"),
    [
        ([(10, 20), (599, 601), (600, 602), (1140, 1150)], [(0, 600), (540, 1150)]),
        ([(1, 2), (1199, 1201), (2310, 2312)], [(0, 600), (1080, 1680), (2160, 2312)]),
        ([(1, 2), (3, 4), (590, 602)], [(0, 602)]),
    ],
)
def test_chunks(spark, rows, chunks):
    got = nv.chunk_cues(cues(spark, *rows)).select("chunk", "start_s", "end_s").distinct().orderBy("chunk").collect()
    assert [(r.start_s, r.end_s) for r in got] == chunks


def test_subtitle_blocks(spark):
    text = "﻿1\r\n00:00:01,250 --> 00:00:03.5\r\nHello\r\nthere\r\n\r\nbad\n\n3\n00:99:00,000 --> 00:99:01,000\nx\n\n00:00:05,000 --> 00:00:06,000\nno index\n\n9\n00:00:07,000 --> 00:00:08,000\n"
    good, bad = sub.parse_blocks(spark.createDataFrame([("f", text)], "path string, text string"))
    assert [(r.cue_id, r.source_index, r.start_s, r.end_s, r.text) for r in good.orderBy("cue_ord").collect()] == [("SRT_000001", 1, 1.25, 3.5, "Hello there"), ("SRT_000002", 4, 5.0, 6.0, "no index")]
    assert {(r.block, r.reason) for r in bad.collect()} == {(2, "malformed timing line"), (3, "invalid timestamp"), (5, "missing cue text")}


def test_timestamps(spark):
    values = [("01:02:03,5", 3723.5), ("1:2:3.045", 3723.045), ("00:60:00,0", None), ("x", None), (None, None)]
    df = spark.createDataFrame([(v,) for v, _ in values], "v string").withColumn("s", sub.timestamp_seconds(F.col("v")))
    assert [r.s for r in df.collect()] == [s for _, s in values]


def test_probe_metadata(spark):
    raw = '{"format":{"format_name":"mkv","duration":"N/A"},"streams":[{"codec_type":"video","codec_name":"h264","width":1920,"height":800,"avg_frame_rate":"24000/1001"},{"codec_type":"subtitle","tags":{"language":"en"}},{"codec_type":"audio"}]}'
    got = sub.probe_metadata(spark.createDataFrame([(1, raw), (2, '{"streams":[]}'), (3, "junk")], "movie_id int, probe string")).orderBy("movie_id").collect()
    assert got[0].fps == pytest.approx(23.976, abs=1e-3) and got[0].duration_s is None and got[0].languages == ["en"] and got[0].error is None
    assert got[1].error == "no_video_stream" and got[2].error == "no_video_stream"


def test_inventory_and_manifest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("abc")
    row = sub.file_inventory(spark, str(tmp_path / "in")).first()
    assert (row.name, row.size, row.sha[:8]) == ("a.txt", 3, "ba7816bf")
    sub.write_manifest(spark.createDataFrame([(1, "x", 2)], "movie_id int, b string, a int"), str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).first().a == 2


def test_overlaps_equal_the_plain_join(spark):
    rng = np.random.default_rng(2)
    a = [(int(m), int(i), float(s), float(s + d)) for i, (m, s, d) in enumerate(zip(rng.integers(0, 3, 60), rng.uniform(0, 300, 60), rng.uniform(0, 90, 60), strict=True))]
    b = [(int(m), int(i), float(s), float(s + d)) for i, (m, s, d) in enumerate(zip(rng.integers(0, 3, 80), rng.uniform(0, 300, 80), rng.uniform(0.1, 40, 80), strict=True))]
    left = spark.createDataFrame(a, "movie_id int, x int, start_s double, end_s double")
    right = spark.createDataFrame(b, "movie_id int, y int, start_s double, end_s double")
    for pad in (0.0, 5.0):
        got = [(r.x, r.y) for r in iv.overlapping(left, right, pad).collect()]
        want = [(p[1], q[1]) for p in a for q in b if p[0] == q[0] and p[2] - pad < q[3] and q[2] < p[3] + pad]
        assert sorted(got) == sorted(want)
        assert "NestedLoop" not in iv.overlapping(left, right, pad)._jdf.queryExecution().toString()


def may_go_on(rows, first, last):
    """May a group that holds rows first..last take the next row too?"""
    own, edge = rows[first : last + 1], rows[last]
    total, quiet = sum(r["d"] for r in own), not edge["talk"] and not edge["why"]
    arrived_quiet = len(own) > 1 and not rows[last - 1]["talk"] and not rows[last - 1]["why"]
    if len(own) == 1 and (edge["alone"] or (total >= 5 and quiet)):
        return False
    return edge["joined"] and total + rows[last + 1]["d"] <= 18 and not (arrived_quiet and total >= 15)


def plain_groups(rows):
    """Every group is the longest run from the end of the one before whose every step is allowed."""
    starts, groups = [0], []
    while starts[-1] < len(rows):
        a = starts[-1]
        stops = [b for b in range(a, len(rows)) if b + 1 == len(rows) or not may_go_on(rows, a, b)]
        groups.append(list(range(a, stops[0] + 1)))
        starts.append(stops[0] + 1)
    return [g for g in groups if 3 <= sum(rows[i]["d"] for i in g) <= 18]


def test_bounded_groups_equal_the_loop(spark):
    rng = np.random.default_rng(4)
    rows = [{"d": float(np.round(rng.uniform(0.5, 9), 2)), "joined": bool(rng.random() < 0.8), "talk": bool(rng.random() < 0.5), "why": bool(rng.random() < 0.3), "alone": bool(rng.random() < 0.1)} for _ in range(200)]
    df = spark.createDataFrame([(1, i, str(i), r["d"], r["joined"], r["talk"], r["why"], r["alone"]) for i, r in enumerate(rows)], "movie_id int, shot_ord int, shot_id string, duration_s double, joined boolean, talk boolean, why boolean, alone boolean")
    got = sorted([int(x) for x in r.shot_ids] for r in sh.bounded_groups(df).collect())
    assert got == plain_groups(rows)


def test_histogram_without_variance(spark):
    df = spark.createDataFrame([([1.0, 1.0], [1.0, 1.0]), ([1.0, 2.0], [2.0, 1.0]), ([1.0, 2.0], [1.0, 2.0])], "a array<double>, b array<double>")
    assert [round(r.s, 6) for r in df.select(sh.histogram_similarity(F.col("a"), F.col("b")).alias("s")).collect()] == [1.0, 0.0, 1.0]


def test_policy_rules(spark):
    kind = "movie_id int, event_id int, utility string, signal string, complete string, context string, flags array<string>, n_actions int"
    rows = [(1, 1, None, "none", "true", "low", [], 0), (1, 2, "movement", "none", "true", "low", ["credits"], 0), (1, 3, "unclear", "strong_body_language", "true", "low", [], 0), (1, 4, "concrete_action", "none", "true", "low", [], 0), (1, 5, "movement", "clear_reaction", "true", "low", [], 0)]
    got = {r.event_id: (r.decision, r.reasons[0]) for r in po.decide(spark.createDataFrame(rows, kind)).collect()}
    assert got == {1: ("REVIEW", "observation_incomplete_or_invalid"), 2: ("REJECT", "hard_exclusion:credits"), 3: ("REVIEW", "insufficient_observation"), 4: ("REVIEW", "action_utility_without_canonical_action_evidence"), 5: ("KEEP", "useful_visual_utility:movement")}


def test_suppressed_events_suppress_nobody(spark):
    rows = [(1, i, float(10 * i), None, ["red", "car"], float(9 - i)) for i in range(4)] + [(1, 9, 5.0, 1, ["red", "car"], 1.0), (1, 10, 6.0, None, [], 0.0)]
    got = {r.event_id: r.kept for r in po.scarce(spark.createDataFrame(rows, "movie_id int, event_id int, start_s double, setting int, tokens array<string>, priority double")).collect()}
    assert got == {0: True, 1: False, 2: True, 3: False, 9: True, 10: True}


def test_oversize_rows_get_no_batch(spark):
    df = spark.createDataFrame([(1, i, b) for i, b in enumerate([5, 5, 99, 5, 1])], "movie_id int, i int, b int")
    got = {r.i: r.batch for r in op.capacity_batches(df, ["i"], {"b": 10}, 3).collect()}
    assert got == {0: 1, 1: 1, 2: 0, 3: 2, 4: 2}


def test_smoothing_keeps_to_the_legal_interval(spark):
    rows = [(1, 0, 100.0, 0.0, 500.0), (1, 1, 103.0, 0.0, 500.0), (1, 2, 400.0, 150.0, 500.0)]
    rows = [(*r, 100.0, -1.0, 3.0) for r in rows] + [(2, 0, 10.0, 0.0, 50.0, 100.0, None, None), (2, 1, 14.0, 0.0, 50.0, 100.0, None, None)]
    got = geo.smooth_anchors(spark.createDataFrame(rows, "s int, t int, x double, low double, high double, crop double, start double, end double"), ["s"]).orderBy("s", "t").collect()
    assert [(r.s, r.t, r.x) for r in got] == [(1, -1.0, 100.0), (1, 0.0, 100.0), (1, 1.0, 100.0), (1, 2.0, 150.0), (1, 3.0, 150.0), (2, 0.0, 12.0)]


def test_parts_of_a_score_are_rounded_as_in_sql(spark):
    import duckdb

    from cutlight.operators.shots import score_events

    values = [v / 100 for v in range(0, 30000)]
    parts = "25 * (0.45::DOUBLE * least(1, v / 150) + 0.35::DOUBLE * (1 - abs(60 + v / 5 - 110) / 145) + 0.20::DOUBLE * (1 - 0.1::DOUBLE))"
    want = dict(duckdb.sql(f"SELECT v, round(greatest(0, least(100, {parts})), 2) FROM (SELECT i / 100 AS v FROM range(30000) t(i))").fetchall())
    x = spark.range(len(values)).selectExpr("id / 100 AS sharpness", "60 + id / 100 / 5 AS brightness", "0.1D AS near_black", "5.0D AS duration_s", "'action' AS kind", "1.0D AS continuity", "0.0D AS occupancy", "12.0D AS motion", "1 AS n_shots")
    got = {r["sharpness"]: r["p_quality"] for r in score_events(x).select("sharpness", "p_quality").collect()}
    assert got == want
