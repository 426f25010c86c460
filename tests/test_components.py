"""Components of graphs whose least node is far from the others."""

import random

from varqa.llm.components import connected_components
from varqa.operators.graph import components


def test_paths_that_go_up_and_down(spark):
    """A path over shuffled ids: labels that only move to neighbours need a round for each step."""
    r = random.Random(3)
    ids = list(range(4000))
    r.shuffle(ids)
    ups = [x for i in range(1000) for x in (10_000 + i, 20_000 - i)]  # every other node is smaller than both neighbours
    pairs = list(zip(ids, ids[1:])) + list(zip(ups, ups[1:])) + [(30_001, 30_001), (30_002, 99_999)]
    nodes = spark.createDataFrame([(i,) for i in [*ids, *ups, 30_001, 30_002, 30_003, 30_003]], "node long")
    want = {i: 0 for i in ids} | {i: 10_000 for i in ups} | {i: i for i in (30_001, 30_002, 30_003)}
    got = components(nodes, spark.createDataFrame(pairs, "a long, b long")).collect()
    assert len(got) == len(want) and {x.node: x.label for x in got} == want
    found = connected_components(spark.createDataFrame(pairs, "src long, dst long")).collect()
    want = {k: v for k, v in want.items() if k != 30_003} | {99_999: 30_002}
    assert len(found) == len(want) and {x.node: x.label for x in found} == want
