"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlens.session import written


def _least_neighbour(links: DataFrame, node: str, other: str) -> DataFrame:
    # Written, so that the join below has a plain exchange on both sides and Spark may split a hot node's rows.
    return written(links.groupBy(F.col(node).alias("node")).agg(F.min(other).alias("least")), "least")


def connected_components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """Every linked node with the smallest node that it reaches.

    ``links`` has columns ``a`` and ``b`` in any order and any number of repeats; the result has ``node`` and
    ``root`` (a root has a row of its own). Alternates two steps until the links are stars: *large* hangs the
    larger neighbours of a node on the smallest of its neighbourhood, *small* does so with the smaller ones. The
    number of rounds grows with the logarithm of the longest path. Each round is written to the shared folder, so
    lineage stays short and a lost executor costs a stage at most. No node's links are ever gathered in one row.
    """
    stars = written(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    before = None
    for _ in range(most_rounds):
        both = stars.select("a", "b").unionAll(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least_neighbour(both, "a", "b")
        large = written(
            stars.join(least, stars.b == least.node)
            .select("a", F.least("b", "least").alias("b"))
            .distinct(),
            "large",
        )
        least = _least_neighbour(large, "a", "b")
        hung = large.join(least, large.a == least.node).select("a", "b", "least")
        # Each node hangs on its least neighbour; its other smaller neighbours do so too.
        small = (
            hung.select(F.explode(F.array(F.struct("a", F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("x"))
            .select("x.a", "x.b")
            .filter("a <> b")
            .distinct()
        )
        stars = written(small, "stars")
        now = stars.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.hash("a", "b").cast("long"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"the links are no stars after {most_rounds} rounds")
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
