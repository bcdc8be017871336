"""Joins of tables that are exploded from small files: none may send such a table through the driver."""

import pytest

from cutlight import registry

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["b04_box_overlap", "b05_track_continuity", "b06_bidirectional_track", "b07_joint_tracks", "b11_face_binding", "l06_package_completeness", "l02_publication_readiness", "l05_closing_manifest", "a19_reason_frequency"])
def test_boxes_meet_by_shuffle(spark, name):
    assert "BroadcastHashJoin" not in _plan(registry.QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", ["l05_closing_manifest", "a19_reason_frequency", "l13_inventory_signature"])
def test_files_are_exploded_behind_the_shuffle(spark, name):
    assert "REPARTITION_BY_NUM" in _plan(registry.QUERIES[name](spark, SF))


def test_missing_and_changed_files(spark):
    from cutlight.operators.publish import completeness

    assets = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "movie_id long, asset long")
    files = spark.createDataFrame([(1, "a", "x", "x"), (1, "b", "x", "y"), (2, "b", None, "y"), (2, "c", "x", "y")], "asset long, name string, sha string, recorded_sha string")
    got = {r["asset"]: (r["missing"], r["mismatched"], r["complete"]) for r in completeness(assets, files, ["b", "a"]).collect()}
    assert got == {1: ([], ["b"], True), 2: (["a", "b"], [], False), 3: (["a", "b"], [], False)}


def test_neighbouring_boxes_meet_in_the_row_of_their_shot(spark):
    plan = _plan(registry.QUERIES["b05_track_continuity"](spark, SF))
    assert "REPARTITION_BY_NUM" in plan and "sample" not in "".join(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)


def test_cues_are_exploded_behind_the_shuffle(spark):
    assert "REPARTITION_BY_NUM" in _plan(registry.QUERIES["j06_chunk_membership"](spark, SF))


def test_means_of_an_event_are_added_up_in_the_order_of_shots(spark):
    from functools import reduce
    from operator import add

    from pyspark.sql import functions as F

    from cutlight.operators import shots as sh

    values = [0.1, 0.2, 0.3, 0.7, 1e16, -1e16, 0.4, 1.1]
    rows = [(1, 1, i, f"S{i}", float(i), i + 1.0, v, v, v, v, v, v, ["N"]) for i, v in enumerate(values)]
    names = "movie_id long, run long, shot_ord int, shot_id string, start_s double, end_s double, brightness double, sharpness double, motion double, near_black double, occupancy double, similarity double, ids array<string>"
    want = reduce(add, values, 0.0) / len(values)  # sum() would make up for what rounding loses
    for order in (F.col("shot_ord"), F.desc("shot_ord"), F.hash("shot_id")):
        got = sh.event_rollup(spark.createDataFrame(rows, names).repartition(4).sortWithinPartitions(order), "run").first()
        assert [got[c] for c in ("brightness", "sharpness", "motion", "near_black", "occupancy", "continuity")] == [want] * 6


@pytest.mark.parametrize("name", ["g05_rescued_groups", "g03_baseline_join"])
def test_vectors_stay_out_of_shuffles(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    lines = registry.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    windows = [line for line in lines if "Window" in line]
    assert windows and not any("hist#" in line for line in windows)


def test_frames_of_a_plan_are_exploded_in_tasks_of_fixed_number(spark):
    plan = _plan(registry.QUERIES["w15_sample_plan"](spark, SF))
    assert "REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan


def test_identities_meet_persons_without_a_shuffle_of_samples(spark):
    plan = _plan(registry.QUERIES["b03_person_identities"](spark, SF))
    assert "REPARTITION_BY_NUM" in plan and "sample" not in "".join(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)


def test_vectors_are_looked_up_for_merges_that_nothing_else_decides(spark):
    from pyspark.sql import functions as F

    from cutlight.operators import shots as sh

    # id, merge, dialogue, reasons, own vector and the next one's (3 has none, and counts as alike): 0 and 1 are alike, 0 and 2 opposite
    rows = [
        (1, True, False, [], 0, 1), (2, True, False, [], 0, 2), (3, True, False, [], 0, 3), (4, True, False, [], 0, None), (5, True, False, [], None, 0), (6, False, False, [], 0, 1), (7, True, True, [], 0, 2), (8, True, False, ["r"], 0, 2),
        (9, True, None, [], 0, 1), (10, False, True, ["r"], 0, 2),
    ]
    edges = spark.createDataFrame(rows, "id long, merge boolean, dialogue boolean, reasons array<string>, vec_id long, n_vec_id long").repartition(3)
    hists = spark.createDataFrame([(0, [1.0, 2.0, 3.0]), (1, [2.0, 4.0, 6.0]), (2, [3.0, 2.0, 1.0])], "vec_id long, hist array<float>")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        x = sh.joined_edges(edges, ["id"], hists)
        got, plan = {r.id: r.joined for r in x.collect()}, x._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    whole = sh.baseline_join(edges.withColumn("similarity", F.when(F.expr("vec_id = 0 and n_vec_id = 1"), 1.0).when(F.expr("vec_id = 0 and n_vec_id = 2"), 0.0).otherwise(1.0)))
    assert got == {r.id: r.joined for r in whole.collect()} and sorted(i for i, j in got.items() if j) == [1, 3, 4, 5, 7, 8, 9]
    # what meets a vector has been told to need it, and vectors are still floats there
    lines = plan.splitlines()
    last = max(i for i, line in enumerate(lines) if "Join" in line)
    assert any("Filter" in line and "unsure" in line for line in lines[last:]) and not any("as array<double>" in line for line in lines[last:])
