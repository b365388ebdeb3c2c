"""Components over the whole graph against plain Python."""

from cartolith.plans import registry

FOLDER = "/root/testdata/sf0.001"


def test_components_over_all_edges(spark):
    """No edge is left out: the same components as a union-find over every line."""
    edges = [(f"o{r.l_orderkey}", f"p{r.l_partkey}") for r in spark.read.parquet(f"{FOLDER}/lineitem.parquet").select("l_orderkey", "l_partkey").collect()]
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        lo, hi = sorted((root(a), root(b)))
        up[hi] = lo
    got = [tuple(r) for r in registry.QUERIES["components"](spark, FOLDER).select("node", "component").collect()]
    assert len(got) == len(up) and dict(got) == {x: root(x) for x in up}
