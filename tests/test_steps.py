"""What a plan works out: nothing twice that can be named once."""

import pytest

from cutlight import registry
from cutlight.plans import reuse

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def cuts(monkeypatch):
    """The plans that are written to the shared folder."""
    seen, cut = [], reuse.cut

    def write(df, name):
        seen.append(_plan(df))
        return cut(df, name)

    monkeypatch.setattr(reuse, "cut", write)
    return seen


def test_a_projected_moment_is_judged_once(spark):
    assert _plan(registry.QUERIES["p06_compatibility_projection"](spark, SF)).count("missing_moment_shot_support") == 1


@pytest.mark.parametrize("name", ["p04_policy_v2_compatible", "p07_catalog_replay_compatible"])
def test_the_projection_is_written_once_and_judges_three_moments(spark, cuts, name):
    registry.QUERIES[name](spark, SF)
    assert [p.count("missing_moment_shot_support") for p in cuts] == [3]


@pytest.mark.parametrize("name", ["p04_policy_v2", "p07_catalog_replay"])
def test_moments_are_judged_once_for_all_that_reads_them(spark, cuts, name):
    plan = _plan(registry.QUERIES[name](spark, SF))
    assert "missing_moment_shot_support" not in plan and [p.count("missing_moment_shot_support") for p in cuts] == [1]


def test_a_registry_reads_segments_that_are_written_once(spark, monkeypatch):
    from cutlight.operators import windows as wi

    seen, choose = [], wi.next_windows
    monkeypatch.setattr(wi, "next_windows", lambda s, *more: seen.append(_plan(s)) or choose(s, *more))
    registry.QUERIES["w18_window_registry"](spark, SF)
    assert len(seen) == 3 and not any("split(" in p for p in seen)


@pytest.mark.parametrize("name", ["g12_reconciled_map", "g13_consolidation_report"])
def test_seams_and_maps_read_cues_that_are_written_once(spark, name):
    assert "split(" not in _plan(registry.QUERIES[name](spark, SF))


def test_a_base_that_stands_alone_is_read_without_a_shuffle(spark):
    plan = registry.QUERIES["x01_stream_latest_state"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan


def test_the_audit_makes_boxes_from_shots_that_are_written_once(spark):
    from cutlight.plans import audit

    assert not any("get_json_object" in _plan(df) for df in audit._inputs(spark, SF))
