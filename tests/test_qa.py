"""Classes of what the checks found, and crops against what they must protect."""

from cutlight.operators import qa

SHOT = "focus_requirement string, focus_subject_present boolean, critical_focus_clipping boolean, introduced_subject_clipping boolean, crop_stable boolean, action_preserved boolean, interaction_preserved boolean, full_bbox_clipping boolean, focus_directive_available boolean"
ASSET = (
    f"asset bigint, file_exists boolean, frame_count bigint, width bigint, height bigint, aspect_ratio string, duration_valid boolean, black_bars boolean, crop_plan_valid boolean, shots array<struct<{SHOT.replace(' ', ': ').replace(',: ', ', ')}>>, "
    "audit array<struct<reason: string, visibility: double, dominance: double>>, face string"
)


def classes(spark, **more):
    row = {"asset": 1, "width": 600, "height": 800, "aspect_ratio": "3:4"} | more
    names = ("asset", "file_exists", "frame_count", "width", "height", "aspect_ratio", "duration_valid", "black_bars", "crop_plan_valid", "shots", "audit", "face")
    r = qa.classify(spark.createDataFrame([tuple(row.get(n) for n in names)], ASSET)).first()
    return r.hard, r.soft


def test_preferences_are_no_failures(spark):
    assert classes(spark) == ([], [])
    fine = ("person", None, None, None, None, None, None, True, False)
    assert classes(spark, shots=[fine, fine], face="AMBIGUOUS", audit=[("target_binding_unstable", None, None)]) == ([], ["noncritical_subject_edge_proximity", "focus_directive_unavailable", "target_binding_unstable", "face_safe_ambiguous"])
    lost = ("person", False, True, None, False, False, False, True, True)
    assert classes(spark, shots=[lost], file_exists=False, face="REPAIR")[0] == [
        "vertical_render_missing", "primary_subject_missing", "primary_subject_materially_clipped", "severe_reframe_instability", "required_action_or_region_lost", "required_multi_person_interaction_lost", "important_face_or_head_materially_clipped",
    ]
    audit = [("intended_target_not_reliably_visible", 0.1, 0.7), ("intended_target_not_reliably_visible", 0.1, None), ("insufficient_render_decode", None, None)]
    assert classes(spark, audit=audit, width=None) == (["vertical_dimensions_invalid", "wrong_subject_or_region_followed", "vertical_render_unreadable"], ["intended_target_not_reliably_visible"])


RULE = (
    "n int, crop double, x double, source double, focus struct<x: double, w: double>, person boolean, subject string, together boolean, review boolean, bound boolean, directive boolean, keeps_action boolean, "
    "regions array<struct<x: double, w: double>>, anchors array<double>, faces array<struct<decision: string, limited: boolean>>"
)


def test_crops_protect_heads_and_what_belongs_together(spark):
    base = {"crop": 600.0, "x": 500.0, "source": 1920.0, "focus": (600.0, 400.0), "person": True}
    cases = [
        {}, {"focus": (520.0, 400.0)}, {"focus": (520.0, 400.0), "together": True}, {"focus": (980.0, 400.0)}, {"focus": (0.0, 400.0), "x": 300.0}, {"focus": None}, {"focus": None, "person": False, "subject": "environment"}, {"bound": False},
        {"anchors": [0.0, 109.0, 0.0]}, {"anchors": [0.0, 110.0]}, {"regions": [(500.0, 600.0)]}, {"regions": [(499.0, 50.0)]}, {"faces": [("PASS", False), ("REPAIR", True)]}, {"together": True, "review": True},
    ]
    names = [p.split()[0] for p in "n,crop,x,source,focus,person,subject,together,review,bound,directive,keeps_action,regions,anchors,faces".split(",")]
    rows = [tuple(({"n": i} | base | c).get(n) for n in names) for i, c in enumerate(cases)]
    got = qa.shot_geometry(spark.createDataFrame(rows, RULE)).orderBy("n").collect()
    assert [r.status for r in got] == ["PASS", "PASS", "FAIL", "FAIL", "PASS", "FAIL", "PASS", "FAIL", "PASS", "FAIL", "PASS", "FAIL", "FAIL", "FAIL"]
    assert got[1].full_bbox_clipping and not got[1].critical_focus_clipping
    assert got[3].introduced_subject_clipping and got[3].empty_space_while_clipped and got[4].source_edge_exception and got[6].requirement == "environment"
