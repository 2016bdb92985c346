import random

from dialogue_engine.llm.graph import components


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)]  # a path
    edges += [(100, i) for i in range(101, 140)]  # a star
    edges += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    edges += [(400, 400), (501, 500), (500, 501)]
    rng.shuffle(edges)
    root = {n: n for e in edges for n in e if e[0] != e[1]}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {n: find(n) for n in root}
    assert len(got) == len(root)


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
