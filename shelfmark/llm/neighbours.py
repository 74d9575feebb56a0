"""Approximate nearest neighbours by inner product: robust-pruned directed graphs, one for each shard.

One dimension more makes all vectors equally long, so that the largest inner product is the smallest distance. A graph
grows in batches: a greedy beam search in the graph so far proposes neighbours for each new vector, and pruning keeps the
nearest proposal, drops those that a kept one is nearer to by a factor, and goes on, so edges lead in all directions. A
query runs a beam search in every shard, and the best of all shards are ranked by the inner product of the vectors as given.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.tables import prepare, written
from shelfmark.llm.vectors import usable

# Different vectors in a shard, queries that meet a shard in one task.
SHARD = 4096
QUERIES = 4096
# Edges of a vector, beam while building and while searching, and the factor of the relaxed distance.
DEGREE = 28
BUILD_BEAM = 56
SEARCH_BEAM = 128
RELAXED = 1.2
# Rows that a vectorised step works on at once, and beam entries opened in a step.
ROWS = 512
OPENED = 3


def beam_search(vectors: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest places, squared distances, places opened on the way) of each query; -1 fills up."""
    n = len(queries)
    norms = np.einsum("ij,ij->i", queries, queries)
    lengths = np.einsum("ij,ij->i", vectors, vectors)
    place = np.full((n, beam), -1, np.int64)
    far = np.full((n, beam), np.inf, np.float32)
    opened = np.ones((n, beam), bool)
    place[:, 0], opened[:, 0] = start, False
    far[:, 0] = norms + lengths[start] - 2 * queries @ vectors[start]
    ways = []
    active = np.arange(n)
    while len(active):
        now, waiting = place[active], ~opened[active]
        rank = np.argsort(~waiting, axis=1, kind="stable")[:, :OPENED]  # beams are sorted: the first waiting ones are the best
        chosen = np.take_along_axis(waiting, rank, axis=1)
        nodes = np.where(chosen, np.take_along_axis(now, rank, axis=1), -1)
        marks = opened[active]
        np.put_along_axis(marks, rank, True, axis=1)
        way = np.full((n, rank.shape[1]), -1, np.int64)
        way[active] = nodes
        ways.append(way)
        near = np.where(nodes[:, :, None] >= 0, edges[nodes], -1).reshape(len(active), -1)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near[(near[:, :, None] == now[:, None, :]).any(axis=2)] = -1
        products = np.einsum("bij,bj->bi", vectors[near], queries[active])
        distance = np.where(near >= 0, norms[active, None] + lengths[near] - 2 * products, np.inf).astype(np.float32)
        every = np.concatenate([far[active], distance], axis=1)
        best = np.argpartition(every, beam - 1, axis=1)[:, :beam]
        best = np.take_along_axis(best, np.argsort(np.take_along_axis(every, best, axis=1), axis=1, kind="stable"), axis=1)
        far[active] = np.take_along_axis(every, best, axis=1)
        place[active] = np.where(np.isfinite(far[active]), np.take_along_axis(np.concatenate([now, near], axis=1), best, axis=1), -1)
        unopened = np.concatenate([marks, np.zeros(near.shape, bool)], axis=1)
        opened[active] = np.take_along_axis(unopened, best, axis=1) | (place[active] < 0)
        active = active[~opened[active].all(axis=1)]
    return place, far, np.concatenate(ways, axis=1) if ways else np.zeros((n, 0), np.int64)


def robust_prune(vectors: np.ndarray, of: np.ndarray, proposed: np.ndarray, degree: int) -> np.ndarray:
    """Edges of the vectors ``of``: of the proposals (-1 is none) the nearest, without those nearer to a kept one by the factor."""
    proposed = np.where(proposed == of[:, None], -1, proposed)
    proposed.sort(axis=1)
    proposed[:, 1:][proposed[:, 1:] == proposed[:, :-1]] = -1
    own = vectors[of]
    those = vectors[proposed]
    distance = np.einsum("bij,bij->bi", those - own[:, None, :], those - own[:, None, :])
    distance[proposed < 0] = np.inf
    order = np.argsort(distance, axis=1, kind="stable")
    proposed, distance = np.take_along_axis(proposed, order, axis=1), np.take_along_axis(distance, order, axis=1)
    those = np.take_along_axis(those, order[:, :, None], axis=1)
    lengths = np.einsum("bij,bij->bi", those, those)
    between = lengths[:, :, None] + lengths[:, None, :] - 2 * those @ those.transpose(0, 2, 1)
    alive = np.isfinite(distance)
    out = np.full((len(of), degree), -1, np.int64)
    rows = np.arange(len(of))
    for k in range(degree):
        first = alive.argmax(axis=1)
        some = alive[rows, first]
        if not some.any():
            break
        out[some, k] = proposed[rows, first][some]
        alive &= RELAXED**2 * between[rows, first] > distance
        alive[rows, first] = False
    return out


def build_graph(vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, seed: int = 1) -> tuple[np.ndarray, int]:
    """(edges, start): a directed graph over the rows of ``vectors``."""
    n = len(vectors)
    edges = np.full((n, degree), -1, np.int64)
    start = int(((vectors - vectors.mean(axis=0)) ** 2).sum(axis=1).argmin()) if n else 0
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[start], order[order != start]]) if n else order
    done = 1
    while done < n:
        batch = order[done : done + min(done, ROWS)]
        place, _, ways = beam_search(vectors, edges, start, vectors[batch], beam)
        # a batch is searched before its own edges are there; its members also propose each other
        proposed = np.concatenate([place, ways, np.broadcast_to(batch, (len(batch), len(batch)))[:, : min(len(batch), 32)]], axis=1)
        edges[batch] = robust_prune(vectors, batch, proposed, degree)
        source = np.repeat(batch, degree)
        target = edges[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
        # edges back, pruned where there are too many; a hub's new ones are taken part by part
        width = degree
        for at in range(0, int(counts.max()) if len(counts) else 0, width):
            own = counts > at
            take = first[own, None] + at + np.arange(width)
            back = np.where(np.arange(width) < counts[own, None] - at, source[np.minimum(take, len(source) - 1)], -1)
            node = nodes[own]
            for part in range(0, len(node), ROWS):
                some = node[part : part + ROWS]
                both = np.concatenate([edges[some], back[part : part + ROWS]], axis=1)
                edges[some] = robust_prune(vectors, some, both, degree)
        done += len(batch)
    return edges, start


def raised(vectors: np.ndarray, longest: float) -> np.ndarray:
    """The vectors with one dimension more, in which all have the length ``longest``; in single precision, scaled to 1."""
    scaled = vectors / longest
    rest = np.sqrt(np.maximum(0.0, 1 - np.einsum("ij,ij->i", scaled, scaled)))
    return np.concatenate([scaled, rest[:, None]], axis=1).astype(np.float32)


def build_index(embeddings: DataFrame, copies: int, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The index as a written table: (shard, place, ids, size, v, start, edges) for every different usable vector.

    ``ids`` are the ``copies`` smallest ids of the rows that hold the vector. Shards are dealt by hash and have a bounded size.
    """
    every = usable(embeddings, id, vector)
    order = Window.partitionBy("v").orderBy("id")
    first = every.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= copies)
    once = written(first.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("size", F.size("v")))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    sizes = once.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.max(length).alias("longest"))
    # vectors of one length form their own shards; the counts of lengths are few
    dealt = once.join(sizes, "size")
    shards = F.ceil(F.col("n") / SHARD)
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64(F.col("ids")[0]), shards)).drop("n")

    def graph(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("ids", key=lambda x: x.map(lambda ids: ids[0])).reset_index(drop=True)
        values = np.array(group["v"].tolist(), np.float64)
        edges, start = build_graph(raised(values, float(group["longest"].iloc[0])))
        return pd.DataFrame(
            {
                "size": group["size"],
                "shard": group["shard"],
                "place": np.arange(len(group)),
                "ids": group["ids"],
                "v": [x.tobytes() for x in values],
                "longest": group["longest"],
                "start": start,
                "edges": [x.tobytes() for x in edges.astype(np.int32)],
            }
        )

    columns = "size int, shard long, place long, ids array<long>, v binary, longest double, start long, edges binary"
    # a shard is much work for few bytes: as many tasks as shards, not as many as the bytes ask for
    tasks = max(1, sum(math.ceil(r["n"] / SHARD) for r in sizes.collect()))
    return written(dealt.repartition(tasks, "size", "shard").groupBy("size", "shard").applyInPandas(graph, columns))


def search_index(index: DataFrame, queries: DataFrame, k: int, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each usable query, without the query's own id."""
    asked = usable(queries, id, vector).withColumn("size", F.size("v"))
    blocks = max(1, math.ceil(asked.count() / QUERIES))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    shards = index.select(F.col("size").alias("size"), F.col("shard").alias("shard")).distinct()
    left = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    right = asked.join(shards, "size").select(*(F.col(x).alias(x) for x in ("id", "v", "size", "shard", "block")))

    def search(index: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(index) and len(asked):
            index = index.sort_values("place")
            size = int(index["size"].iloc[0])
            values = np.frombuffer(b"".join(index["v"]), np.float64).reshape(len(index), size)
            edges = np.frombuffer(b"".join(index["edges"]), np.int32).reshape(len(index), -1).astype(np.int64)
            longest, start = float(index["longest"].iloc[0]), int(index["start"].iloc[0])
            graph = raised(values, longest)
            owned = np.array([len(x) for x in index["ids"]])
            ids = np.full((len(index), int(owned.max())), -1, np.int64)
            for row, own in zip(ids, index["ids"]):
                row[: len(own)] = own
            asked = asked.sort_values("id")
            for at in range(0, len(asked), ROWS):
                part = asked.iloc[at : at + ROWS]
                wanted = np.array(part["v"].tolist(), np.float64)
                # a query's length doesn't change the order
                unit = wanted / np.abs(wanted).max(axis=1, keepdims=True)
                unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
                lifted = np.concatenate([unit, np.zeros((len(unit), 1))], axis=1).astype(np.float32)
                place, _, _ = beam_search(graph, edges, start, lifted, min(max(SEARCH_BEAM, 2 * k), len(index)))
                for query, vector, found in zip(part["id"], wanted, place):
                    found = found[found >= 0]
                    scores = values[found] @ vector
                    found = found[np.lexsort((ids[found, 0], -scores))[: k + 1]]
                    every = ids[found]
                    score = np.repeat((values[found] @ vector)[:, None], every.shape[1], axis=1)
                    hit = (every >= 0) & (every != query)
                    every, score = every[hit], score[hit]
                    best = np.lexsort((every, -score))[:k]
                    out["query_id"] += [query] * len(best)
                    out["vec_id"] += every[best].tolist()
                    out["score"] += score[best].tolist()
        return pd.DataFrame({"query_id": pd.array(out["query_id"], "int64"), "vec_id": pd.array(out["vec_id"], "int64"), "score": pd.array(out["score"], "float64")})

    key = ["size", "shard", "block"]
    tasks = max(1, shards.count() * blocks)
    sides = [side.repartition(tasks, *key).groupBy(*key) for side in (left, right)]
    found = sides[0].cogroup(sides[1]).applyInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(embeddings: DataFrame, queries: DataFrame, k: int, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k nearest found rows of ``embeddings``, largest inner product first.

    Scores are inner products of the vectors as given, in double precision; equal scores come in the order of the ids. A row
    with the query's id is no candidate. Null, empty or zero vectors and those with null or non-finite components take no
    part, as queries or as candidates; vectors of another length than the query's are no candidates. With fewer than k
    candidates all are returned. Every row is indexed; equal vectors are one node of a graph, which stands for the k + 1
    smallest of their ids. Searches are approximate: recall is measured against brute force in the tests.
    """
    prepare(embeddings.sparkSession)
    return search_index(build_index(embeddings, k + 1, id, vector), queries, k, id, vector)
