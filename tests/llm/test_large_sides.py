"""Sides of joins that grow with the documents stay off the driver."""

import re

from thicket.llm.neardup import near_duplicates


def test_near_duplicates_broadcast_nothing_but_the_bit_maps(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*words[i % 7 :], f"x{i}", *words[: i % 3]])) for i in range(60)]
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect()
    assert len({r.component_id for r in got}) < len(rows)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    runs = store.executionsList()
    plans = [runs.apply(i).physicalPlanDescription() for i in range(before, runs.size())]
    joins = [keys for plan in plans for keys in re.findall(r"BroadcastHashJoin[^\n]*\nLeft keys[^\n]*\[([^\]\n]*)\]\n", plan)]
    assert joins and all("__map_slot" in keys for keys in joins), set(joins)
