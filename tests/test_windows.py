"""The next window, its registry, and controls chosen without replacement."""

import pytest

from cutlight.operators import windows as wi

SEGMENT = "movie_id bigint, segment_id string, start_s double, end_s double, segment_type string, narrative_function string, narrative_tone string, summary string, opportunities array<string>"
FILM = [
    (1, "N1", 100.0, 180.0, "conversation", "conversation", "mixed", "", ["conversation"]),
    (1, "N2", 195.0, 275.0, "conversation", "conversation", "mixed", "", ["conversation"]),
    (1, "N3", 900.0, 990.0, "monologue", "conflict", "tense", "", ["reaction", "gesture"]),
    (1, "N4", 1600.0, 1680.0, "sparse_dialogue", "transition", "sad", "", ["movement"]),
]


@pytest.fixture()
def film(spark):
    return spark.createDataFrame(FILM, SEGMENT), spark.createDataFrame([(1, 1800.0)], "movie_id bigint, duration_s double")


def registry_of(spark, segments, path, rows):
    registry = wi.WindowRegistry(spark, path)
    x = spark.createDataFrame(rows, "movie_id bigint, window_id string, start_s double, end_s double, status string")
    x = x.join(wi.profiles(x, segments, ["window_id"]), ["movie_id", "window_id"])
    registry.publish(x.selectExpr("*", "string(null) pilot_status", "double(null) diversity_score", "array('') selection_reason"))
    return registry


def test_the_most_different_window_is_next_and_stays_selected(spark, film, tmp_path):
    segments, durations = film
    registry = registry_of(spark, segments, f"{tmp_path}/r", [(1, "SW_01", 100.0, 160.0, "TESTED")])
    first = registry.select(segments, durations).collect()
    before = registry.versions()
    second = registry.select(segments, durations).collect()
    assert first == second and registry.versions() == before
    (w,) = first
    assert w.window_id == "SW_02" and "N3" in w.narrative_segment_ids
    assert {"different_interaction_context", "different_tone", "different_movie_region"} <= set(w.selection_reason)
    assert (w.start_s, w.end_s) == (915.0, 975.0)
    registry.mark(spark.createDataFrame([(1, "SW_02", "PARTIAL_QUOTA")], "movie_id bigint, window_id string, attempt string"))
    (later,) = registry.select(segments, durations).collect()
    assert later.window_id == "SW_03" and "N4" in later.narrative_segment_ids
    (old,) = registry.read().where("window_id = 'SW_02'").collect()
    assert (old.status, old.pilot_status) == ("TESTED", "PARTIAL_QUOTA")


def test_a_failed_run_changes_nothing_and_the_next_one_writes_over_it(spark, film, tmp_path):
    segments, durations = film
    registry = registry_of(spark, segments, f"{tmp_path}/r", [(1, "SW_01", 100.0, 160.0, "TESTED")])
    rows = sorted(map(repr, registry.read().collect()))
    from pyspark.sql import functions as F

    with pytest.raises(Exception, match="lost"):
        registry.publish(registry.read().withColumn("status", F.raise_error(F.lit("lost")).cast("string")))
    assert registry.versions() == [1] and sorted(map(repr, registry.read().collect())) == rows
    assert registry.select(segments, durations).count() == 1 and registry.versions() == [1, 2]
    registry.mark(spark.createDataFrame([(1, "SW_99", "none such")], "movie_id bigint, window_id string, attempt string"))
    assert registry.versions() == [1, 2]
    registry.publish(registry.read())
    assert registry.versions() == [2, 3]


def test_guards_and_empty_registry(spark, film, tmp_path):
    segments, durations = film
    rows = [*FILM, (2, "A", 10.0, 70.0, "c", "f", "t", "", None), (2, "B", 100.0, 170.0, "c", "f", "t", "Opening LOGO", []), (2, "C", 300.0, 500.0, "c", "f", "t", None, []), (2, "D", 560.0, 599.0, "c", "f", "t", "", [])]
    all_ = spark.createDataFrame(rows, SEGMENT)
    durations = durations.union(spark.createDataFrame([(2, 600.0)], durations.schema))
    got = {(r.movie_id, r.segment_id): (r.start_s, r.end_s, r.coherence) for r in wi.candidates(all_, durations).collect()}
    assert set(got) == {(1, "N1"), (1, "N2"), (1, "N3"), (1, "N4"), (2, "C")}
    assert got[2, "C"] == (370.0, 430.0, 1.0)
    registry = wi.WindowRegistry(spark, f"{tmp_path}/none")
    assert registry.read().count() == 0
    picked = {r.movie_id: r for r in registry.select(all_, durations).collect()}
    assert picked[2].window_id == "SW_01" and picked[2].selection_reason == ["coherent_narrative_context"] and picked[2].diversity_score == 0.7
    assert picked[1].start_s == 110.0  # equal scores: the earliest


def test_relations_need_words(spark, film):
    segments, _ = film
    said = segments.replace("", "Una madre e hija discuten", subset=["summary"])
    r = wi.profiles(segments.select("movie_id", "start_s", "end_s").selectExpr("*", "1 AS n"), segments, ["n"]).first()
    assert r.relationship_hints == []
    r = wi.profiles(said.where("segment_id = 'N1'").selectExpr("movie_id", "start_s", "end_s", "1 AS n"), said, ["n"]).first()
    assert r.relationship_hints == ["mother_daughter"] and r.narrative_segment_ids == ["N1"]


def test_controls_are_taken_once(spark):
    texts = ["walking", "walking to a mirror", "mirror", "touching", "nothing", "escucha", "walking", "apoya su cabeza", "other", "more"]
    rows = [(1, f"VE_{i}", i, "REJECT" if i == 4 else "KEEP", t) for i, t in enumerate(texts)] + [(2, "VE_x", None, "KEEP", None)]
    events = spark.createDataFrame(rows, "movie_id bigint, event_id string, ordinal bigint, decision string, text string")
    got = wi.positive_controls(events).orderBy("movie_id", "place").collect()

    def plain(rows):
        keeps, taken = sorted((r[2] or 0, r[1], r[4] or "") for r in rows if r[3] == "KEEP"), []
        for name, terms in wi.CONTROL_RULES:
            for _, i, t in keeps:
                if i not in [x for x, _ in taken] and any(w in t for w in terms):
                    taken.append((i, f"positive_control:{name}"))
                    break
        for _, i, _ in keeps:
            if len(taken) < 6 and i not in [x for x, _ in taken]:
                taken.append((i, "positive_control:canonical_keep"))
        return taken

    for movie in (1, 2):
        want = plain([r for r in rows if r[0] == movie])
        assert [(r.event_id, r.category) for r in got if r.movie_id == movie] == want
        assert {r.enough for r in got if r.movie_id == movie} == {len(want) == 6}
    asked = wi.requested_controls(events, [("a", 1, "x"), ("b", 99, "y")], "ordinal").collect()
    assert {(r.movie_id, r.ordinal): r.event_id for r in asked} == {(1, 1): "VE_1", (1, 99): None, (2, 1): None, (2, 99): None}
