"""Vectors of one label within a cosine threshold, by dual traversal of cover trees.

Equal vectors of a label collapse to one with a weight. A label's vectors go to
blocks of bounded size, and every pair of blocks of a label is one task group:
cover trees over both blocks (unit vectors, chord distance) are traversed together.
A pair of nodes is dropped if its centres are farther apart than the threshold and
both covering radii allow, taken whole if they bring all its pairs within it, and
otherwise opened; rows of leaves are compared by cosine in double precision. Each
group returns link counts and a spanning forest of its links, never the pairs.

Vectors that are null, zero or hold null or non-finite components, and vectors
without label, link with nothing; repeated rows link with each other.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.cover_tree import Node, cover_tree
from strata.llm.graph import components, saved

BLOCK = 1024
_SLACK = 1e-9


class _Forest:
    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.root[max(i, j)] = min(i, j)


def links(a: np.ndarray, b: np.ndarray | None, weights: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Weight linked to each row, and its root among the linked rows.

    Rows of ``a`` are compared with rows of ``b`` (numbered after them), or with each
    other if ``b`` is None."""
    points = a if b is None else np.concatenate([a, b])
    unit = points / np.sqrt((points * points).sum(1))[:, None]
    reach = math.sqrt(max(0.0, 2 - 2 * threshold))
    total, forest = np.zeros(len(points), np.int64), _Forest(len(points))
    left = cover_tree(unit[:len(a)])
    right = left if b is None else cover_tree(unit[len(a):])
    shift = 0 if b is None else len(a)

    def take(x: np.ndarray, y: np.ndarray, same: bool) -> None:
        """All pairs of rows ``x`` and ``y`` are links."""
        total[x] += weights[y].sum()
        if same:
            total[x] -= weights[x]
        else:
            total[y] += weights[x].sum()
        for j in y:
            forest.join(int(x[0]), int(j))
        for i in x[1:]:
            forest.join(int(i), int(y[0]))

    def compare(x: np.ndarray, y: np.ndarray, same: bool) -> None:
        near = unit[x] @ unit[y].T >= threshold
        if same:
            np.fill_diagonal(near, False)
        total[x] += near @ weights[y]
        if not same:
            total[y] += weights[x] @ near
        for i, j in zip(*np.nonzero(near), strict=True):
            forest.join(int(x[i]), int(y[j]))

    def kids(n: Node) -> list[Node]:
        return n.children or [n]

    stack = [(left, right, b is None)] if left and right else []
    while stack:
        p, q, same = stack.pop()
        if same and 2 * p.radius <= reach - _SLACK:
            take(p.members, p.members, True)
        elif not p.children and not q.children:
            compare(p.members, q.members + shift, same)
        else:
            ps = kids(p) if same or p.radius >= q.radius or not q.children else [p]
            qs = ps if same else kids(q) if q.radius >= p.radius or not p.children else [q]
            x, y = unit[[n.centre for n in ps]], unit[[n.centre + shift for n in qs]]
            apart = np.sqrt(np.maximum(0, 2 - 2 * (x @ y.T)))
            both = np.add.outer([n.radius for n in ps], [n.radius for n in qs])
            open_ = apart <= reach + both + _SLACK
            whole = apart + both <= reach - _SLACK
            for i, j in zip(*np.nonzero(open_), strict=True):
                if same and j < i:
                    continue
                if same and i == j:
                    stack.append((ps[i], ps[i], True))
                elif whole[i, j]:
                    take(ps[i].members, qs[j].members + shift, False)
                else:
                    stack.append((ps[i], qs[j], False))
    roots = np.array([forest.find(i) for i in range(len(points))], np.int64)
    return total, roots


def vector_groups(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id",
                  vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``(id_col, n_links, component_id, kept)`` per row of ``vectors``."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    sound = (rows.where("label is not null and id is not null and size(v) > 0")
             .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
             .where(F.exists("v", lambda x: x != 0)))
    once = saved(sound.groupBy("label", "v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("w")), "vectors")
    sizes = once.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = (once.join(sizes, "label").withColumn("own", own).withColumn("other", other)
              .select("label", "rep", "w", "v", "own", F.least("own", "other").alias("lo"),
                      F.greatest("own", "other").alias("hi")))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["own", "rep"])
        first = (group["own"] == group["lo"].iloc[0]).to_numpy()
        points = np.stack(group["v"].to_numpy())
        same = group["lo"].iloc[0] == group["hi"].iloc[0]
        total, root = links(points if same else points[first], None if same else points[~first],
                            group["w"].to_numpy(), threshold)
        rep = group["rep"].to_numpy()
        keep = total > 0
        return pd.DataFrame({"rep": rep[keep], "n": total[keep], "root": rep[root][keep]})

    kind = rows.schema["id"].dataType.simpleString()
    found = saved(placed.groupBy("label", "lo", "hi").applyInPandas(run, f"rep {kind}, n long, root {kind}"), "links")
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    reps = (once.join(counts, "rep", "left").join(roots, once.rep == roots.node, "left")
            .select(F.col("label").alias("l"), F.col("v").alias("x"), F.coalesce("root", "rep").alias("root"),
                    (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n")))
    mine = sound.join(reps, (sound.label == reps.l) & (sound.v == reps.x)).select("id", "n", "root").distinct()
    return (rows.select("id").join(mine, "id", "left")
            .select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("root", "id").alias("component_id"),
                    F.coalesce(F.col("root") == F.col("id"), F.lit(True)).alias("kept")))


__all__ = ["links", "vector_groups"]
