"""Exact top-k inner products by dual-tree search over cover trees.

Components become ``floor(scale * x)``; scores are integer inner products. Queries
and candidates go to blocks of bounded size, and every pair of a query block and a
candidate block is one task group. Within it both sides are indexed by cover trees:
a query node meets candidate nodes in order of the bound
``<q, c> + r_q |c| + r_c |q| + r_q r_c``, and a node is dropped if its bound is below
the worst kth score of the query node's group. Each group keeps k per query, and the
k best of all groups remain; ties go to the smaller id.

Vectors that are null or hold null or non-finite components take no part; a query's
own id is no candidate; fewer than k candidates give fewer rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.cover_tree import Node, cover_tree

QUERY_BLOCK, BLOCK = 2048, 2048
OPENED = 512          # rows scored together


def search(queries: np.ndarray, query_ids: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int):
    """Query number, id and score of each query's ``k`` best rows (exact integers in doubles)."""
    length = np.sqrt((points * points).sum(1)) if len(points) else np.zeros(0)
    best = np.full((len(queries), k), -np.inf)
    best_id = np.full((len(queries), k), np.iinfo(np.int64).max)
    norm = np.sqrt((queries * queries).sum(1))

    def score(rows: np.ndarray, members: np.ndarray) -> None:
        found = queries[rows] @ points[members].T
        found[query_ids[rows][:, None] == ids[members][None, :]] = -np.inf
        least = best[rows, -1]
        if np.isneginf(least).any() and found.shape[1] > k:      # its own kth score bounds it too
            least = np.maximum(least, np.partition(found, -k, axis=1)[:, -k])
        row, column = np.nonzero((found >= least[:, None]) & (found > -np.inf))    # ties stay
        if not len(row):
            return
        start = np.searchsorted(row, np.arange(len(rows)))
        slot = k + np.arange(len(row)) - start[row]
        both = np.full((len(rows), int(slot.max()) + 1), -np.inf)
        name = np.full(both.shape, np.iinfo(np.int64).max)
        both[:, :k], name[:, :k] = best[rows], best_id[rows]
        both[row, slot], name[row, slot] = found[row, column], ids[members[column]]
        order = np.lexsort((name, -both), axis=1)[:, :k]
        best[rows] = np.take_along_axis(both, order, 1)
        best_id[rows] = np.take_along_axis(name, order, 1)

    def bounds(q: Node, nodes: list[Node]) -> np.ndarray:
        centre = np.array([n.centre for n in nodes])
        radius = np.array([n.radius for n in nodes])
        found = points[centre] @ queries[q.centre] + q.radius * length[centre] + radius * (norm[q.centre] + q.radius)
        return found + 1e-9 * (1 + np.abs(found))

    def visit(q: Node, nodes: list[Node]) -> None:
        reach = bounds(q, nodes)
        worst = best[q.members, -1].min()
        nodes = [nodes[i] for i in np.argsort(-reach, kind="stable") if reach[i] >= worst]
        if q.children:
            for child in q.children:
                visit(child, nodes)
            return
        opened, size = [], 0
        for node in [*nodes, None]:
            if node is not None:
                if bounds(q, [node])[0] < best[q.members, -1].min():
                    continue
                if node.children and len(node.members) > OPENED:
                    visit(q, node.children)
                    continue
                opened.append(node.members)
                size += len(node.members)
            if opened and (node is None or size >= OPENED):
                score(q.members, np.concatenate(opened))
                opened, size = [], 0

    left, right = cover_tree(queries, leaf=64), cover_tree(points, leaf=256)
    if left and right:
        visit(left, [right])
    row, rank = np.nonzero(np.isfinite(best))
    return row, best_id[row, rank], best[row, rank]


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, id, score)`` of each query row's ``k`` best other rows."""
    rows = (vectors.select(F.col(id_col).alias("id"), is_query.alias("asks"),
                           F.col(vector_col).cast("array<double>").alias("v"))
            .where("v is not null and id is not null")
            .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
            .withColumn("v", F.transform("v", lambda x: F.floor(x * scale).cast("double"))))
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q")).first()
    blocks, asking = -(-n.n // BLOCK) or 1, -(-n.q // QUERY_BLOCK) or 1
    place = F.xxhash64("id")

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    held = rows.select("id", "v", F.lit(False).alias("asks"), F.pmod(place, F.lit(blocks)).alias("c"),
                       numbers(asking).alias("q"))
    asked = (rows.where("asks").select("id", "v", F.lit(True).alias("asks"),
                                       numbers(blocks).alias("c"),
                                       F.pmod(place, F.lit(asking)).alias("q")))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["asks"].to_numpy()
        ids = group["id"].to_numpy()
        width = max(len(v) for v in group["v"])
        points = np.zeros((len(group), width))
        for i, v in enumerate(group["v"]):
            points[i, :len(v)] = v
        if not asks.any() or asks.all():
            return pd.DataFrame({"query_id": ids[:0], "id": ids[:0], "score": ids[:0]})
        row, name, found = search(points[asks], ids[asks], points[~asks], ids[~asks], k)
        return pd.DataFrame({"query_id": ids[asks][row], "id": name, "score": found.astype(np.int64)})

    found = held.unionByName(asked).groupBy("c", "q").applyInPandas(run, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))


__all__ = ["search", "top_k"]
