"""Approximate nearest neighbours by a robust-pruned directed graph per shard.

Distinct vectors are dealt to shards by hash. A shard's graph is built in growing batches: every
vector of a batch searches the graph so far, its visited candidates are pruned by the relaxed
distance rule (a candidate goes when a kept neighbour is ``alpha`` times nearer to it than the
new vector is), and the kept ones get edges back, pruned again where a list overflows. A query
runs a beam search over every shard, and the shards' answers are merged by exact scores.

Largest inner products are nearest neighbours once every vector gets one more coordinate that
brings it to the length of the longest, so the graph works with plain distances.

Every distinct vector is indexed, and a class of equal vectors carries its ``k + 1`` smallest
ids, which is all of it that a result can show. A shard holds at most ``shard_rows`` vectors, and
a task one shard with at most ``slice_rows`` queries, whatever the size of the table.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component take no
part; vectors of another dimension than the query's are no candidates; repeated rows of one id
and vector count once; an empty table or query set gives no rows; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.llm.common import keep
from riskloom.llm.vectors import best, classes, usable

DEGREE, BEAM, ALPHA, BATCH = 32, 96, 1.2, 512
SHARDS, SHARD_ROWS, SLICE_ROWS = 8, 50_000, 20_000
EXPAND = 4


class Graph:
    """A directed graph over the rows of ``points``; -1 fills short neighbour lists."""

    def __init__(self, points: np.ndarray, edges: np.ndarray | None = None, degree: int = DEGREE):
        longest = np.sqrt((points * points).sum(1).max())
        lift = np.sqrt(np.maximum(longest * longest - (points * points).sum(1), 0))
        self.points = np.hstack([points, lift[:, None]]).astype(np.float32)
        self.squares = (self.points * self.points).sum(1)
        self.edges = np.full((len(points), degree), -1, np.int32) if edges is None else edges
        self.entry = int(((self.points - self.points.mean(0)) ** 2).sum(1).argmin())

    def beam(self, targets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest ``width`` rows found for each target, then all rows it expanded; -1 fills."""
        n = len(targets)
        row = np.arange(n)[:, None]
        ids = np.full((n, width), -1, np.int32)
        far = np.full((n, width), np.inf, np.float32)
        fresh = np.zeros((n, width), bool)
        seen = np.zeros((n, len(self.points)), bool)
        ids[:, 0], fresh[:, 0], seen[:, self.entry] = self.entry, True, True
        far[:, 0] = self.squares[self.entry] - 2 * targets @ self.points[self.entry]
        expanded = []
        while True:
            rank = np.where(fresh, far, np.inf)
            pick = np.argpartition(rank, EXPAND - 1, axis=1)[:, :EXPAND]
            open_ = np.isfinite(np.take_along_axis(rank, pick, 1))
            if not open_.any():
                break
            nodes = np.where(open_, np.take_along_axis(ids, pick, 1), -1)
            np.put_along_axis(fresh, pick, False, 1)
            expanded.append(nodes)
            near = np.sort(np.where((nodes >= 0)[:, :, None], self.edges[nodes], -1).reshape(n, -1), 1)
            ok = near >= 0
            ok[:, 1:] &= near[:, 1:] != near[:, :-1]
            ok &= ~seen[row, near]
            if not ok.any():
                continue
            keep_ = ok.any(0)  # sorted, so leading columns are often empty
            near, ok = near[:, keep_], ok[:, keep_]
            r, c = np.nonzero(ok)
            seen[r, near[r, c]] = True
            d = np.full(near.shape, np.inf, np.float32)
            v = near[r, c]
            d[r, c] = self.squares[v] - 2 * np.einsum("ij,ij->i", self.points[v], targets[r])
            all_far = np.hstack([far, d])
            best_ = np.argpartition(all_far, width - 1, axis=1)[:, :width]
            far = np.take_along_axis(all_far, best_, 1)
            ids = np.take_along_axis(np.hstack([ids, np.where(ok, near, -1)]), best_, 1)
            fresh = np.take_along_axis(np.hstack([fresh, ok]), best_, 1)
        ids[~np.isfinite(far)] = -1
        return ids, np.hstack(expanded)

    def prune(self, nodes: np.ndarray, pool: np.ndarray, alpha: float) -> np.ndarray:
        """For each node at most ``degree`` diverse neighbours out of its row of ``pool``."""
        degree = self.edges.shape[1]
        pool = np.sort(pool, 1)
        ok = (pool >= 0) & (pool != nodes[:, None])
        ok[:, 1:] &= pool[:, 1:] != pool[:, :-1]
        vectors = self.points[pool]
        squares = self.squares[pool]
        away = squares - 2 * np.einsum("bcd,bd->bc", vectors, self.points[nodes]) + self.squares[nodes][:, None]
        away = np.where(ok, away, np.inf)
        between = squares[:, :, None] + squares[:, None, :] - 2 * vectors @ vectors.transpose(0, 2, 1)
        out = np.full((len(nodes), degree), -1, np.int32)
        row = np.arange(len(nodes))
        for slot in range(degree):
            pick = away.argmin(1)
            live = np.isfinite(away[row, pick])
            if not live.any():
                break
            out[live, slot] = pool[row, pick][live]
            gone = alpha * alpha * between[row, pick] <= away
            away[gone & live[:, None]] = np.inf
            away[row, pick] = np.inf
        return out

    def _in_pieces(self, nodes: np.ndarray, pool: np.ndarray, alpha: float) -> np.ndarray:
        return np.vstack([self.prune(nodes[i : i + 128], pool[i : i + 128], alpha) for i in range(0, len(nodes), 128)])

    def add(self, nodes: np.ndarray, width: int, alpha: float) -> None:
        near, passed = self.beam(self.points[nodes], width)
        self.edges[nodes] = self._in_pieces(nodes, np.hstack([near, passed]), alpha)
        source = np.repeat(nodes, self.edges.shape[1])
        target = self.edges[nodes].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        owners, first, count = np.unique(target, return_index=True, return_counts=True)
        have = (self.edges[owners] >= 0).sum(1)
        pool = np.full((len(owners), self.edges.shape[1] + int(count.max(initial=0))), -1, np.int32)
        pool[:, : self.edges.shape[1]] = self.edges[owners]
        slot = np.arange(len(target)) - np.repeat(first, count)
        pool[np.repeat(np.arange(len(owners)), count), self.edges.shape[1] + slot] = source
        full = have + count > self.edges.shape[1]
        if full.any():
            self.edges[owners[full]] = self._in_pieces(owners[full], pool[full], alpha)
        if (~full).any():
            rest = np.sort(pool[~full], 1)[:, ::-1]
            self.edges[owners[~full]] = rest[:, : self.edges.shape[1]]


def build(points: np.ndarray, degree: int, width: int, alpha: float, batch: int, seed: int) -> Graph:
    """Insert all points in a seeded order, in batches that double up to ``batch``."""
    graph = Graph(points, degree=degree)
    order = np.random.default_rng(seed).permutation(len(points))
    order = order[order != graph.entry]
    at, size = 0, 1
    while at < len(order):
        graph.add(order[at : at + size], width, alpha)
        at += size
        size = min(batch, size * 2)
    return graph


def _matrix(column: pd.Series, kind) -> np.ndarray:
    return np.stack([np.asarray(x) for x in column]).astype(kind)


def index(
    vectors: DataFrame, members: int, shards: int = SHARDS, shard_rows: int = SHARD_ROWS, degree: int = DEGREE,
    width: int = BEAM, alpha: float = ALPHA, batch: int = BATCH, seed: int = 4,
) -> tuple[DataFrame, int]:
    """The stored index of ``_id, _v``: a row per distinct vector with its neighbours.

    Returns it with its number of shards: ``shards``, or more when they would be too large.
    """
    distinct = keep(classes(vectors, members).withColumn("_dim", F.size("_v")), "vector-classes")
    shards = max(shards, -(-distinct.count() // shard_rows))

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_class", ignore_index=True)
        graph = build(_matrix(rows["_v"], np.float64), degree, width, alpha, batch, seed)
        entry = np.arange(len(rows)) == graph.entry
        return rows.assign(_edges=list(graph.edges), _entry=entry, _row=np.arange(len(rows)))

    linked = (
        distinct.withColumn("_shard", F.pmod(F.xxhash64("_class", "_v"), F.lit(shards)).cast("long"))
        .groupBy("_shard", "_dim")
        .applyInPandas(
            link,
            "_shard long, _dim int, _class long, _v array<double>, _members array<long>, "
            "_edges array<int>, _entry boolean, _row long",
        )
    )
    return keep(linked, "graph-index"), shards


def search(
    vectors: DataFrame, is_query: Column, k: int = 20, width: int = BEAM, id_col: str = "vec_id",
    vector_col: str = "embedding", slice_rows: int = SLICE_ROWS, **settings,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every query."""
    doubles = F.transform(F.col(vector_col), lambda x: x.cast("double") + F.lit(0.0))  # -0.0 becomes 0.0
    rows = (
        vectors.filter(usable(F.col(vector_col)))
        .select(F.col(id_col).cast("long").alias("_id"), doubles.alias("_v"), is_query.alias("_asked"))
        .filter(F.col("_id").isNotNull() & F.exists("_v", lambda x: x != 0))
    )
    found, shards = index(rows.select("_id", "_v"), k + 1, width=width, **settings)
    asked = keep(rows.filter("_asked").select("_id", "_v").distinct().withColumn("_dim", F.size("_v")), "queries")
    slices = max(1, -(-asked.count() // slice_rows))
    asked = asked.withColumn("_slice", F.pmod(F.xxhash64("_id"), F.lit(slices))).withColumn(
        "_shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<long>"))
    )
    copies = found.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)).cast("array<long>")))
    keys = ["_shard", "_dim", "_slice"]

    def ask(shard: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[list] = [[], [], []]
        if len(shard) and len(queries):
            shard = shard.sort_values("_row", ignore_index=True)
            exact = _matrix(shard["_v"], np.float64)
            graph = Graph(exact, _matrix(shard["_edges"], np.int32))
            graph.entry = int(shard["_entry"].to_numpy().argmax())
            members = shard["_members"].tolist()
            for at in range(0, len(queries), BATCH):
                part = queries.iloc[at : at + BATCH]
                asked_ = _matrix(part["_v"], np.float64)
                lifted = np.hstack([asked_, np.zeros((len(asked_), 1))]).astype(np.float32)
                near, _ = graph.beam(lifted, max(width, k + 1))
                for own, query, ids in zip(part["_id"].tolist(), asked_, near):
                    ids = ids[ids >= 0]
                    scores = exact[ids] @ query
                    if len(ids) > k + 1:
                        top = scores >= np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
                        ids, scores = ids[top], scores[top]
                    flat = np.concatenate([members[i] for i in ids.tolist()])
                    scores = np.repeat(scores, [len(members[i]) for i in ids.tolist()])
                    other = flat != own
                    flat, scores = flat[other], scores[other]
                    pick = np.lexsort((flat, -scores))[:k]
                    out[0] += [own] * len(pick)
                    out[1] += flat[pick].tolist()
                    out[2] += scores[pick].tolist()
        return pd.DataFrame({"query_id": out[0], "vec_id": out[1], "score": out[2]}).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )

    answers = (
        copies.groupBy(*keys).cogroup(asked.groupBy(*keys))
        .applyInPandas(ask, "query_id long, vec_id long, score double")
    )
    return best(answers, k)
