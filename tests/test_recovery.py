"""Precedence of the sources that an observation is recovered from."""

from cutlight import fixtures as fx
from cutlight.operators import recovery as rc

KIND = (
    "movie_id bigint, event_id string, actions array<string>, interactions array<string>, objects array<string>, emotions array<string>, relations array<string>, people bigint, evidence string, intent string, reusable boolean, complete string, "
    "bench_kind string, bench_signal string, old_kind string, old_complete string, old_context string, old_flags array<string>, action_catalog array<struct<id: string, label: string>>, object_catalog array<struct<id: string, label: string>>"
)


def recovered(spark, *rows):
    names = [p.split()[0] for p in KIND.replace(", label", "; label").split(", ")]
    data = [tuple(({"movie_id": 1, "event_id": f"E{i}"} | r).get(n) for n in names) for i, r in enumerate(rows)]
    return rc.recover(spark.createDataFrame(data, KIND), fx.UTILITIES, fx.SIGNALS).orderBy("event_id").collect()


def test_precedence(spark):
    got = recovered(
        spark,
        {},
        {"actions": ["habla con ella"], "bench_kind": "movement"},
        {"actions": ["habla con ella"], "bench_kind": "unheard of", "old_kind": "environment"},
        {"actions": ["habla por Teléfono"], "old_kind": "environment"},
        {"actions": ["CAMINA", None, "  "]},
        {"interactions": ["cuidado"], "actions": ["recostado"]},
        {"interactions": ["cuidado"], "reusable": True, "evidence": "distinct_visible_action_or_reaction"},
        {"reusable": True, "evidence": "distinct_visible_action_or_reaction", "intent": "specific_visual_need", "old_context": "high"},
        {"evidence": "generic_presence_or_movement", "relations": ["cara a cara"], "actions": ["lleva comida"]},
        {"old_kind": "nothing known", "complete": "perhaps", "old_complete": "true", "old_context": "odd", "people": 5, "bench_signal": "clear_reaction"},
    )
    assert [r.utility for r in got] == ["unclear", "movement", "generic_dialogue_only", "environment", "movement", "useful_state", "physical_interaction", "concrete_action", "movement", "unclear"]
    assert [r.signal for r in got] == ["none", "generic_dialogue_only", "generic_dialogue_only", "none", "concrete_activity", "none", "physical_interaction", "concrete_activity", "concrete_activity", "clear_reaction"]
    assert (got[7].context, got[9].context, got[9].complete, got[9].people, got[0].flags, got[4].movement) == ("low", "unclear", "true", "2_plus", [], "present")
    assert got[1].conversation == "true" and got[4].conversation == "false" and got[4].n_actions == 1


def test_labels_are_bound_once(spark):
    (r,) = recovered(spark, {"actions": ["Mira ", "corre"], "interactions": ["mira", "toca"], "action_catalog": [("A1", "mira"), (None, "corre"), ("A2", "MIRA")], "objects": ["copa"]})
    assert r.action_ids == ["A2", "E0:V9_ACTION_02", "E0:V9_ACTION_04"] and r.object_ids == ["E0:V9_OBJECT_01"]
