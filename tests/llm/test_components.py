import random

from firmbook.llm.components import components
from firmbook.llm.shared import workspace


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    edges += [(i, i + 1) for i in range(1000, 1040)] + [(2000, 2000 + i) for i in range(1, 300)] + [(7, 7)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    linked = {x for a, b in edges if a != b for x in (a, b)}
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(df, workspace(spark)).collect()}
    assert got == {x: find(x) for x in linked}
    none = components(spark.createDataFrame([], "a long, b long"), workspace(spark))
    assert none.count() == 0
