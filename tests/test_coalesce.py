"""The coalesced aggregate runs no join in its few tasks."""

from ledgerline.operators import layout as L
from ledgerline.plans import queries as Q


def test_coalesced_tasks_only_read_and_count(spark, small):
    result = Q.REGISTRY["phys_groupby_coalesce"](spark, small)
    plan = L.plan_text(result)
    assert "Coalesce" in plan and "Join" not in plan
    every = Q.REGISTRY["phys_groupby_default"](spark, small)
    assert sorted(map(str, result.collect())) == sorted(map(str, every.collect()))
