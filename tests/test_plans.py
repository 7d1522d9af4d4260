"""Plan shapes that must hold at scale: shuffles, pushdown, no Python and no cross join in the hot paths."""

import pytest

from conftest import TESTDATA
from windrisk.operators import correlation, energy, features, hsgp, risk, snapshots, spatial
from windrisk.plans import adapters
from windrisk.session import store

SF = f"{TESTDATA}/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_energy_needs_one_shuffle_and_pushes_its_filter(spark):
    stored = store(adapters.energy(spark, SF))
    plan = plan_of(energy.wide(energy.normalise(stored)))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan and "Join" not in plan
    assert "In(variable, [B18,B19,load_mwh])" in plan


def test_weather_needs_two_shuffles_and_no_join(spark):
    plan = plan_of(spatial.silver_weather(adapters.grid(spark, SF)))
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan and "Python" not in plan


@pytest.mark.parametrize("build", [
    lambda s: snapshots.snapshots(adapters.obs(s, SF), hourly=True),
    lambda s: risk.tail_risk(adapters.draws(s, SF)),
    lambda s: risk.scenario_totals(adapters.draws(s, SF)),
    lambda s: snapshots.share_below(adapters.obs(s, SF)),
])
def test_single_shuffle_with_partial_aggregates(spark, build):
    plan = plan_of(build(spark))
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_" in plan and "Python" not in plan


def test_scan_reads_only_what_is_needed(spark):
    plan = plan_of(snapshots.share_below(adapters.obs(spark, SF)))
    assert "ReadSchema: struct<event_type:string,value:double>" in plan


def test_model_sums_stay_in_generated_code(spark):
    rows = store(features.features(snapshots.snapshots(adapters.obs(spark, SF), hourly=True)))
    plan = plan_of(hsgp.zone_sums(rows, hsgp.domain_of(rows)))
    assert plan.count("Exchange") == 1 and "Python" not in plan


def test_no_cross_joins(spark):
    obs = adapters.obs(spark, SF)
    frames = [spatial.distance_matrix(adapters.zones25(spark, SF)), features.horizon_points(obs),
              snapshots.hour_scaffold(obs), features.features(obs), correlation.correlation_matrix(obs),
              energy.with_weather(spatial.silver_weather(adapters.grid(spark, SF)),
                                  energy.wide(energy.normalise(adapters.energy(spark, SF))))]
    for df in frames:
        plan = plan_of(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_draw_limit_is_applied_before_the_shuffle(spark):
    from windrisk.operators.diagnostics import last_points
    assert "WindowGroupLimit" in plan_of(last_points(adapters.elbo(spark, SF), 2000))
