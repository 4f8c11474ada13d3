"""Connected components of a sparse graph, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerline.llm.common import checkpointed


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node reachable.

    Each round points neighbours at the smallest node seen; the number of rounds grows with
    the logarithm of the longest chain. Every round ends in the shared folder. Minima combine
    on the map side, and the joins are plain ones, so a node with very many neighbours
    is split by adaptive execution.
    """
    links = edges.selectExpr("greatest(a, b) AS u", "least(a, b) AS v").where("u <> v").distinct()
    links = checkpointed(links)
    mark = _mark(links)
    while mark[0]:
        both = links.unionAll(links.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg({"v": "min"}).selectExpr("u", "least(u, `min(v)`) AS m")
        large = both.join(least, "u").where("v > u").selectExpr("v AS u", "m AS v").distinct()
        least = large.groupBy("u").agg({"v": "min"}).withColumnRenamed("min(v)", "m")
        small = large.join(least, "u").where("v <> m").selectExpr("v AS u", "m AS v")
        links = checkpointed(small.unionAll(least.selectExpr("u", "m AS v")).distinct())
        before, mark = mark, _mark(links)
        if before == mark:
            break
    return links.selectExpr("u AS node", "v AS root").unionAll(links.selectExpr("v AS node", "v AS root").distinct())


def _mark(links: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    row = links.selectExpr("count(*) AS n", "bit_xor(xxhash64(u, v)) AS x", "sum(pmod(xxhash64(v, u), 1000003)) AS s").first()
    return row["n"], row["x"], row["s"]
