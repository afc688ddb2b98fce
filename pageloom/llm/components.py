"""Connected components of a graph of links, with nothing gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b: long); root is the smallest node reachable.

    Alternates large-star and small-star steps until the edges are a forest of stars. Both are a grouped minimum, which
    is combined before the shuffle, and a join on the node, whose skew adaptive execution splits. Each round's edges are
    written to the shared folder, so a lost executor costs one round at most. Loops and repeated links do no harm; no links give no rows.
    """
    edges = links.where("a is not null and b is not null").selectExpr("greatest(a, b) as u", "least(a, b) as v").where("u != v").distinct()
    edges = cut(edges, "edges")
    state = None
    while True:
        both = edges.unionByName(edges.selectExpr("v as u", "u as v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) as m")
        edges = both.join(least, "u").where("v > u").selectExpr("v as u", "m as v").where("u != v").distinct()
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        edges = edges.join(least, "u").selectExpr("inline(if(v = m, array(struct(u, m as v)), array(struct(u, m as v), struct(v as u, m as v))))").distinct()
        edges = cut(edges, "edges")  # a table; the constraints that checkpoint() carries along grow from round to round
        now = edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(u, v) as decimal(38,0)))")).first()
        if now == state:
            return edges.selectExpr("u as node", "v as root").unionByName(edges.selectExpr("v as node", "v as root").distinct())
        state = now
