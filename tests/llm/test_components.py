import random

import pytest

from hindcast.llm.components import components
from tests.llm.brute import groups


@pytest.mark.parametrize("shape", ["chain", "star", "random", "empty"])
def test_components(spark, shape):
    rng = random.Random(1)
    links = {
        "chain": [(i, i + 1) for i in range(60)],
        "star": [(7, i) for i in range(60)],
        "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(3, 3)],
        "empty": [],
    }[shape]
    rng.shuffle(links)
    found = components(spark.createDataFrame(links, "a long, b long"))
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert {r.node: r.component for r in found.collect()} == groups(nodes, links and [
        x for x in links if x[0] != x[1]
    ])
    assert found.count() == len(nodes)
