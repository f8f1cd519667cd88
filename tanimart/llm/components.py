"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save

#: Rounds end when no edge changes; the number of rounds is logarithmic in the
#: longest path.  A run that does not converge within the bound is an error.
MAX_ROUNDS = 60


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an edge table with columns a, b of
    one orderable type; component is the least node reached.

    Loops and repeated edges are allowed, rows with a null end are skipped, an
    empty table gives no rows.  Each round hangs every node's larger neighbours
    under the least one seen, then the smaller ones (min per node is combined
    before the shuffle, the joins are skew-splittable equi-joins), and writes
    the edges; when a round changes nothing they form stars.
    """
    e = (
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    )
    e = save(e, "cc-edges")
    before = None
    for _ in range(MAX_ROUNDS):
        state = e.where("hi <> lo").agg(F.count("*").alias("n"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")).alias("h")).first()
        if state == before or not state.n:
            break
        before = state
        live = e.where("hi <> lo")
        both = live.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(live.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # larger neighbours under the least neighbour
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = save(large, "cc-large")
        # smaller neighbours and the node itself under the least one
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi")
        e = save(
            small.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .union(least.select("hi", F.col("m").alias("lo"))).distinct(), "cc-edges")
    else:
        raise RuntimeError(f"components still change after {MAX_ROUNDS} rounds")
    stars = e.where("hi <> lo")
    ends = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    nodes = ends.select(F.col(a).alias("node")).union(ends.select(b)).distinct()
    return nodes.join(stars.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("c")), "node", "left").select(
        "node", F.coalesce("c", "node").alias("component"))
