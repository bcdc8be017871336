"""The audit of rendered shots against the rules written out by hand: a crop of 600 from 400 on, shown at 300 x 400."""

import pytest

from cutlight.operators import audit as au

PLAN = "movie_id bigint, asset bigint, shot_id string, subject string, need string, person boolean, bound boolean, focus_w double, crop double, width double, height double, anchors array<struct<t: double, x: double>>, targets array<struct<t: double, x: double, y: double, w: double, h: double>>, start double, end double, first int, last int"
FRAME = "movie_id bigint, asset bigint, shot_id string, frame int, decoded boolean, failed boolean"
PERSON = "movie_id bigint, asset bigint, shot_id string, frame int, person int, x double, y double, w double, h double"
# in the source at 650 to 750, so at 125 to 175 of the picture
TARGET, SEEN, OTHER = (0.0, 650.0, 0.0, 100.0, 200.0), (125, 0, 50, 100), (10, 0, 60, 120)


def audit(spark, shots):
    """shots: name -> (changes of the plan, persons of each of five frames; None: not decoded, 'fails': the detector broke)."""
    plans, frames, people = [], [], []
    for s, (more, rows) in shots.items():
        p = {"subject": "man", "need": "none", "person": True, "bound": True, "focus_w": 100.0, "targets": [TARGET]} | more
        plans.append((1, 1, s, p["subject"], p["need"], p["person"], p["bound"], p["focus_w"], 600.0, 300.0, 400.0, [(0.0, 400.0)], p["targets"], 0.0, 5.0, 0, 50))
        for i, row in enumerate(rows):
            frames.append((1, 1, s, i * 10, row is not None, row == "fails"))
            people += [(1, 1, s, i * 10, n, *map(float, b)) for n, b in enumerate(row if isinstance(row, list) else [])]
    x = au.shot_audit(spark.createDataFrame(plans, PLAN), spark.createDataFrame(frames, FRAME), spark.createDataFrame(people, PERSON))
    return {r.shot_id: r for r in x.collect()}


def test_every_reason_is_reached(spark):
    good, none = [SEEN], []
    edge = (3, 0, 100, 200)
    aside = [(0.0, 400.0, 0.0, 200.0, 200.0)]
    got = audit(spark, {
        "rendered_subject_present_and_usable": ({}, [good] * 5), "person_audit_not_applicable": ({"person": False}, [none] * 5), "semantic_target_binding_unresolved": ({"bound": False}, [good] * 5), "no_render_samples": ({}, []),
        "post_render_detector_error": ({}, [good, "fails", good, good, good]), "insufficient_render_decode": ({}, [good, None, None, good, good]),
        "required_people_not_visible_together": ({"subject": "multiple_people", "need": "simultaneous"}, [good] * 5), "multiple_people_not_reliably_observed": ({"subject": "multiple_people"}, [good] * 5),
        "close_up_person_detection_inconclusive": ({"focus_w": 840.0}, [none, none, none, good, good]), "focused_person_lost_in_render": ({"focus_w": 839.0}, [none, none, none, good, good]),
        "intended_target_not_reliably_visible": ({}, [[(250, 0, 50, 100)]] * 5), "target_binding_unstable": ({}, [[(70, 0, 40, 80)], [(190, 0, 40, 80)], [(70, 0, 40, 80)], [(190, 0, 40, 80)], [(70, 0, 40, 80)]]),
        "focused_person_persistently_at_crop_edge": ({"targets": aside}, [[edge]] * 5), "crop_centered_between_competing_subjects": ({"targets": [(0.0, 550.0, 0.0, 60.0, 300.0)]}, [[(60, 0, 50, 150), (200, 0, 50, 150)]] * 5),
        "competing_subject_dominates_target": ({"targets": aside}, [[(3, 0, 100, 200), (120, 0, 150, 300)]] * 2 + [[(20, 0, 100, 200)]] * 3), "target_too_small_for_editorial_use": ({}, [[(140, 0, 20, 100)]] * 5),
        "legacy_multi_person_identity_unbound": ({"bound": None, "targets": None}, [[SEEN, OTHER]] * 2 + [good] * 3),
    })
    assert {s: r.reason for s, r in got.items()} == {s: s for s in got}
    again = {s for s, r in got.items() if r.decision == "RETRY"}
    assert again == {"semantic_target_binding_unresolved", "required_people_not_visible_together", "focused_person_lost_in_render", "focused_person_persistently_at_crop_edge"}
    assert {s for s, r in got.items() if r.decision == "PASS"} == {"rendered_subject_present_and_usable", "person_audit_not_applicable"}


def test_what_is_measured(spark):
    r = audit(spark, {"s": ({}, [[OTHER, SEEN], [SEEN], [], [(145, 0, 50, 100)], [(1, 0, 1, 1)]])})["s"]
    # a box of a pixel is nobody; the planned person is nearest to the planned place, and the other one is larger by 1.44
    assert (r.present, r.visible, r.together, r.centered, r.stable, r.occupancy) == (0.6, 0.6, 0.2, 0.6, 0.6, 0.0417) and r.rival == pytest.approx(1 / 3, abs=1e-4)


def test_place_of_a_moving_crop(spark):
    rows = [([(0.0, 10.0)], 5.0), ([(0.0, 10.0), (2.0, 21.0)], 1.0), ([(0.0, 10.0), (2.0, 20.0), (4.0, 21.0)], 3.0), ([(1.0, 10.0), (2.0, 20.0)], 0.0), ([(0.0, 10.0), (2.0, 20.0)], 3.0)]
    df = spark.createDataFrame(rows, "a array<struct<t: double, x: double>>, t double")
    # 15.5 and 20.5 are halves: to the even neighbour
    assert [r[0] for r in df.select(au.place_at(df.a, df.t)).collect()] == [10, 16, 20, 20, 20]


def test_the_worst_shot_and_the_face_decide(spark):
    shots = spark.createDataFrame([(1, a, d) for a, ds in {1: ["PASS"], 2: ["PASS", "AMBIGUOUS"], 3: ["AMBIGUOUS", "RETRY"], 4: ["PASS"], 5: ["RETRY"], 6: ["PASS"], 7: ["AMBIGUOUS"]}.items() for d in ds], "movie_id bigint, asset bigint, decision string")
    faces = spark.createDataFrame([(1, 4, "REPAIR"), (1, 5, "SOURCE_LIMIT"), (1, 6, "AMBIGUOUS"), (1, 7, "PASS")], "movie_id bigint, asset bigint, face string")
    got = {r.asset: (r.decision, r.reason, r.strategy) for r in au.asset_audit(shots, faces).collect()}
    assert got == {
        1: ("PASS", "all_rendered_shots_pass", None), 2: ("AMBIGUOUS", "one_or_more_shots_need_semantic_or_identity_review", None), 3: ("RETRY", "one_or_more_shots_need_reframe", None), 4: ("RETRY", "face_safe_repair", "face_priority"),
        5: ("RETRY", "face_safe_source_limit", None), 6: ("AMBIGUOUS", "face_safe_ambiguous", None), 7: ("AMBIGUOUS", "one_or_more_shots_need_semantic_or_identity_review", None),
    }
