import random

import pytest
from pyspark.sql import functions as F

from shelfgap.llm.components import PARTS, _least, _part, _told, connected_components


def want(edges):
    least = {}

    def find(x):
        while least.setdefault(x, x) != x:
            least[x] = x = least[least[x]]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            least[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(least) if find(x) != x}


def random_edges(seed):
    rng = random.Random(seed)
    out = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)]  # small trees
    out += [(500, k) for k in range(1000, 1400)] + [(k, 2000) for k in range(1000, 1400, 3)]  # hubs
    out += [(k, k + 1) for k in range(3000, 3200)] + [(7, 7), (None, 3), (4, None), (500, 1000)]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs_with_hubs_and_chains(spark, seed):
    edges = random_edges(seed)
    got = connected_components(spark.createDataFrame(edges, "a long, b long").repartition(4))
    assert {r.node: r.component for r in got.collect()} == want(edges)


def test_text_nodes_and_no_edges(spark):
    got = connected_components(spark.createDataFrame([("b", "a"), ("", "b"), ("x", "x")], "a string, b string"))
    assert {tuple(r) for r in got.collect()} == {("a", ""), ("b", "")}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_hub_is_dealt_to_many_parts(spark):
    edges = spark.range(1, 5001).select(F.lit(0).cast("long").alias("u"), F.col("id").alias("v")).select("u", "v", _part("v"))
    least = _least(edges, "u", "v")
    told = _told(least, "u").collect()
    assert least.first().m == 1 and len({r.part for r in told}) == len(told) == PARTS
    sizes = [r["count"] for r in edges.groupBy("u", "part").count().collect()]
    assert max(sizes) < 3 * 5000 / PARTS
