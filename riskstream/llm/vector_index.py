"""Nearest neighbours by inner product: a small-world graph for each shard.

Equal vectors are one node with its least ids. Nodes are dealt to shards by length, in
steps of a factor of about 1.4, and by hash within a step. A shard becomes a hierarchical
navigable small-world graph: flat arrays of neighbours, one for each layer, stored as a
row of a table. Nodes are inserted in batches, each batch searching the graph of those
before it, and keep neighbours that are nearer to them than to a neighbour already kept.
In the graph vectors are scaled, and get one coordinate more, which makes all as long as
the longest of the shard, so that the nearest by distance are the nearest by inner
product; among lengths as like as a shard's it does not outweigh the others.

Queries are sorted under every shard of their dimension and streamed past its graph, which
is read once. Each shard gives its best nodes by the exact product in double precision,
and the lists are merged.

Results by case: a vector that is null, empty, zero or holds a null or a number that is
not finite takes no part, nor does one without an id; of several vectors of one id the
least counts; vectors of different dimensions never meet; equal scores go to the lesser
id, and a product that overflows to no number comes last; with fewer candidates than asked for, all are returned; extra columns are ignored;
an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskstream.llm.common import Scratch, mix

SHARD = 8192  # nodes of one graph
BASE_LINKS, LINKS = 32, 16  # neighbours in the base layer and above
BUILD_WIDTH, SEARCH_WIDTH = 64, 160  # candidates kept while inserting and searching
AT_ONCE = 8  # candidates expanded in one step
BATCH = 512
SPARE = 8  # candidates beyond its places among which a node chooses anew

STEPS = 1 << 20  # shards that one step of length may have

INDEX = (
    "dim int, shard long, nodes binary, vectors binary, layers array<binary>, entry binary"
)
FOUND = "query long, node long, score double"


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector over its largest component, so that no square overflows or vanishes."""
    return vectors / np.abs(vectors).max(axis=1, keepdims=True, initial=5e-324)


def _lengthened(vectors: np.ndarray) -> np.ndarray:
    """Vectors over the largest component of all, and one coordinate more, so that all have
    the length of the longest."""
    vectors = vectors / np.abs(vectors).max(initial=5e-324)
    squares = (vectors**2).sum(axis=1)
    rest = np.sqrt(np.maximum(squares.max(initial=0) - squares, 0))
    return np.column_stack([vectors, rest]).astype(np.float32)


def beam(
    vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each query the best nodes met, best first, and their products; -1 where fewer.

    entries: for each query the nodes to start from.
    """
    count, n = len(queries), len(vectors)
    ids = np.full((count, width), -1, np.int64)
    scores = np.full((count, width), -np.inf, np.float32)
    open_ = np.zeros((count, width), bool)
    seen = np.zeros((count, n), bool)

    def met(rows: np.ndarray, nodes: np.ndarray) -> None:
        """Put nodes (a row of them for each of ``rows``, -1 for none) among the best."""
        nodes = np.sort(nodes, axis=1)
        fresh = nodes >= 0
        fresh[:, 1:] &= nodes[:, 1:] != nodes[:, :-1]
        fresh &= ~seen[rows[:, None], nodes]
        r, c = np.nonzero(fresh)
        chosen = nodes[r, c]
        seen[rows[r], chosen] = True
        new = np.full(nodes.shape, -np.inf, np.float32)
        new[r, c] = np.einsum("ij,ij->i", vectors[chosen], queries[rows[r]])
        all_scores = np.concatenate([scores[rows], new], axis=1)
        best = np.argpartition(-all_scores, width - 1, axis=1)[:, :width]
        scores[rows] = np.take_along_axis(all_scores, best, axis=1)
        ids[rows] = np.take_along_axis(np.concatenate([ids[rows], nodes], axis=1), best, axis=1)
        open_[rows] = np.take_along_axis(
            np.concatenate([open_[rows], fresh], axis=1), best, axis=1
        )

    met(np.arange(count), entries)
    step = min(AT_ONCE, width)
    while True:
        rows = np.flatnonzero(open_.any(axis=1))
        if not len(rows):
            break
        waiting = np.where(open_[rows], scores[rows], -np.inf)
        at = np.argpartition(-waiting, step - 1, axis=1)[:, :step]
        going = np.take_along_axis(open_[rows], at, axis=1)
        nodes = np.where(going, np.take_along_axis(ids[rows], at, axis=1), -1)
        open_[rows[:, None], at] = False
        around = links[nodes]
        around[nodes < 0] = -1
        met(rows, around.reshape(len(rows), -1))
    order = np.argsort(-scores, axis=1, kind="stable")
    ids = np.where(np.isfinite(scores), ids, -1)
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(scores, order, axis=1)


def _diverse(
    vectors: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, links: int
) -> np.ndarray:
    """Of each node's candidates, best first, those nearer to it than to one kept; the
    places left over go to the best of the others."""
    near = vectors[np.maximum(candidates, 0)]
    to_node = np.einsum("bcd,bd->bc", near, vectors[nodes])
    to_node = np.where(candidates >= 0, to_node, -np.inf)
    among = np.einsum("bcd,bed->bce", near, near, optimize=True)
    count, width = candidates.shape
    kept = np.zeros((count, width), bool)
    for j in range(width):
        nearest = np.where(kept, among[:, j], -np.inf).max(axis=1)
        kept[:, j] = (
            (candidates[:, j] >= 0) & (to_node[:, j] > nearest) & (kept.sum(axis=1) < links)
        )
    rank = np.where(kept, 0, width) + np.arange(width)[None, :]
    rank[candidates < 0] = 3 * width
    best = np.argsort(rank, axis=1)[:, :links]
    found = np.full((count, links), -1, np.int32)
    found[:, : best.shape[1]] = np.take_along_axis(candidates, best, axis=1)
    return found


class Graph:
    """A hierarchical navigable small-world graph over the rows of an array."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray], entry: np.ndarray) -> None:
        self.vectors, self.layers, self.entry = vectors, layers, entry

    def _from_top(self, queries: np.ndarray, lowest: int) -> np.ndarray:
        """Entries for ``lowest``, by greedy descent through the layers above it."""
        at = np.repeat(self.entry[None, :], len(queries), axis=0)
        for layer in range(len(self.layers) - 1, lowest, -1):
            at = beam(self.vectors, self.layers[layer], queries, at, 4)[0]
        return at

    def search(self, queries: np.ndarray, width: int) -> np.ndarray:
        """For each query the nodes found, best first."""
        found = [
            beam(self.vectors, self.layers[0], q, self._from_top(q, 0), width)[0]
            for q in (queries[i : i + BATCH] for i in range(0, len(queries), BATCH))
        ]
        return np.concatenate(found) if found else np.empty((0, width), np.int64)

    def _insert(self, nodes: np.ndarray, layer: int) -> None:
        links = self.layers[layer]
        queries = self.vectors[nodes]
        width = min(BUILD_WIDTH, len(self.vectors))
        found, _ = beam(self.vectors, links, queries, self._from_top(queries, layer), width)
        # Nodes of one batch see each other as well.
        own = queries @ queries.T
        np.fill_diagonal(own, -np.inf)
        closest = np.argsort(-own, axis=1)[:, : min(links.shape[1], max(len(nodes) - 1, 0))]
        both = np.concatenate([found, nodes[closest]], axis=1)
        products = np.einsum("bcd,bd->bc", self.vectors[np.maximum(both, 0)], queries)
        products[both < 0] = -np.inf
        order = np.argsort(-products, axis=1)[:, :width]
        chosen = _diverse(
            self.vectors, nodes, np.take_along_axis(both, order, axis=1), links.shape[1]
        )
        links[nodes] = chosen
        # Links back; a node with too many keeps a diverse choice.
        sources, targets = np.repeat(nodes, links.shape[1]), chosen.ravel()
        sources, targets = sources[targets >= 0], targets[targets >= 0]
        order = np.argsort(targets, kind="stable")
        hit, starts = np.unique(targets[order], return_index=True)
        sizes = np.diff(np.append(starts, len(order)))
        wanted = np.full((len(hit), links.shape[1] + sizes.max(initial=0)), -1, np.int64)
        wanted[:, : links.shape[1]] = links[hit]
        row = np.repeat(np.arange(len(hit)), sizes)
        place = np.arange(len(order)) - np.repeat(starts, sizes)
        wanted[row, links.shape[1] + place] = sources[order]
        wanted.sort(axis=1)
        wanted[:, 1:][wanted[:, 1:] == wanted[:, :-1]] = -1
        products = np.einsum("bcd,bd->bc", self.vectors[np.maximum(wanted, 0)], self.vectors[hit])
        products[wanted < 0] = -np.inf
        order = np.argsort(-products, axis=1)[:, : links.shape[1] + SPARE]
        wanted = np.take_along_axis(wanted, order, axis=1)
        full = (wanted >= 0).sum(axis=1) > links.shape[1]
        simple = np.sort(wanted[~full], axis=1)[:, ::-1][:, : links.shape[1]]
        links[hit[~full], : simple.shape[1]] = simple
        if full.any():
            links[hit[full]] = _diverse(self.vectors, hit[full], wanted[full], links.shape[1])

    @classmethod
    def build(cls, vectors: np.ndarray, keys: np.ndarray) -> Graph:
        """Insert all rows; ``keys`` draw the layer a row reaches."""
        n = len(vectors)
        noise = (mix(keys.view(np.uint64)) >> np.uint64(11)).astype(float) * 2.0**-53
        level = np.floor(-np.log(noise + 2.0**-54) / np.log(LINKS)).astype(int)
        first = int(level.argmax())
        order = np.concatenate([[first], np.delete(np.arange(n), first)])
        layers = [
            np.full((n, LINKS if layer else BASE_LINKS), -1, np.int32)
            for layer in range(int(level[first]) + 1)
        ]
        graph = cls(vectors, layers, np.array([first]))
        done = 1
        while done < n:
            batch = order[done : done + min(BATCH, done)]
            for layer in range(len(layers) - 1, -1, -1):
                nodes = batch[level[batch] >= layer]
                if len(nodes):
                    graph._insert(nodes, layer)
            done += len(batch)
        return graph


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("node")
    vectors = np.stack(rows["embedding"].to_numpy()).astype(np.float64)
    nodes = rows["node"].to_numpy(np.int64)
    graph = Graph.build(_lengthened(vectors), nodes)
    return pd.DataFrame(
        {
            "dim": [int(rows["dim"].iloc[0])], "shard": [int(rows["shard"].iloc[0])],
            "nodes": [nodes.tobytes()], "vectors": [vectors.tobytes()],
            "layers": [[layer.tobytes() for layer in graph.layers]],
            "entry": [graph.entry.astype(np.int64).tobytes()],
        }
    )


class _Shard:
    """A shard's graph, read from its row of the index."""

    def __init__(self, row) -> None:
        self.nodes = np.frombuffer(row.nodes, np.int64)
        self.vectors = np.frombuffer(row.vectors, np.float64).reshape(len(self.nodes), -1)
        layers = [np.frombuffer(x, np.int32).reshape(len(self.nodes), -1) for x in row.layers]
        entry = np.frombuffer(row.entry, np.int64)
        self.graph = Graph(_lengthened(self.vectors), layers, entry)

    def best(self, queries: pd.DataFrame, best: int, width: int) -> pd.DataFrame:
        asked = np.stack(queries["embedding"].to_numpy()).astype(np.float64)
        flat = np.column_stack([_scaled(asked), np.zeros(len(asked))]).astype(np.float32)
        found = self.graph.search(flat, max(width, 2 * best))
        with np.errstate(over="ignore", invalid="ignore"):
            scores = np.einsum("qkd,qd->qk", self.vectors[np.maximum(found, 0)], asked)
        ranked = np.where(np.isnan(scores), -np.inf, scores)
        ids = self.nodes[np.maximum(found, 0)]
        order = np.lexsort((ids, -ranked, found < 0), axis=1)[:, :best]
        found, ids, scores = (np.take_along_axis(a, order, axis=1) for a in (found, ids, scores))
        query = np.repeat(queries["node"].to_numpy(np.int64), ids.shape[1])
        rows = pd.DataFrame({"query": query, "node": ids.ravel(), "score": scores.ravel()})
        return rows[found.ravel() >= 0]


def _searcher(best: int, width: int):
    """Queries past their shard's graph, whose row comes before them."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = shard = None
        for batch in batches:
            for key, rows in batch.groupby(["dim", "shard"], sort=False):
                index = rows[rows["nodes"].notna()]
                if len(index):
                    at, shard = key, _Shard(index.iloc[0])
                queries = rows[rows["nodes"].isna()]
                if at == key and len(queries):
                    for i in range(0, len(queries), BATCH):
                        yield shard.best(queries.iloc[i : i + BATCH], best, width)

    return search


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    whole = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(whole & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    embeddings: DataFrame, asked: Column, k: int = 20, width: int = SEARCH_WIDTH,
    shard: int = SHARD, key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for rows where ``asked``, of all others the best k.

    ``asked`` is a condition on ``vec_id``. Recall is that of the graphs; scores are exact.
    """
    scratch = Scratch(embeddings.sparkSession, "nearest")
    rows = (
        embeddings.select(
            F.col(key).cast("long").alias("vec_id"),
            F.col(vector).cast("array<double>").alias("embedding"),
        )
        .where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        .groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    )
    rows = scratch.keep(rows, "rows")
    # Of equal vectors the k + 1 least ids can be among the best, one of them the query's.
    alike = Window.partitionBy("embedding").orderBy("vec_id")
    ranked = rows.withColumn("rank", F.row_number().over(alike)).where(F.col("rank") <= k + 1)
    nodes = ranked.groupBy("embedding").agg(
        F.min("vec_id").alias("node"), F.sort_array(F.collect_list("vec_id")).alias("ids")
    )
    nodes = scratch.keep(nodes, "nodes")
    # Half steps of the binary logarithm of the length; in an array of one, the largest
    # component is found once and not for each component.
    largest = F.array(F.array_max(F.transform("embedding", F.abs)))

    def steps_of(most: Column) -> Column:
        squares = F.aggregate(
            "embedding", F.lit(0.0), lambda total, x: total + (x / most) * (x / most)
        )
        return 2 * F.log2(most) + F.log2(squares)

    step = F.floor(F.transform(largest, steps_of)[0]).cast("long")
    sized = nodes.select(
        "node", "embedding", F.size("embedding").alias("dim"), step.alias("step")
    )
    # One row for each step of length that occurs, some thousands at most in a dimension.
    steps = sized.groupBy("dim", "step").agg(F.ceil(F.count("*") / shard).alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    dealt = sized.join(steps, ["dim", "step"]).select(
        "node", "embedding", "dim", (F.col("step") * STEPS + part).alias("shard")
    )
    index = scratch.keep(dealt.groupBy("dim", "shard").applyInPandas(_build, INDEX), "index")

    queries = scratch.keep(
        rows.where(asked).join(nodes.select("embedding", "node"), "embedding").select(
            F.col("vec_id").alias("query_id"), "node"
        ),
        "queries",
    )
    searched = nodes.join(queries.select("node").distinct(), "node", "left_semi").select(
        "node", "embedding", F.size("embedding").alias("dim")
    )
    # The stated queries against every shard of their dimension.
    asking = searched.join(index.select("dim", "shard"), "dim")
    graphs = ("nodes", "vectors", "layers", "entry")
    both = index.select(
        "dim", "shard", F.lit(-1).cast("long").alias("node"),
        F.lit(None).cast("array<double>").alias("embedding"), F.lit(0).alias("kind"), *graphs,
    ).unionByName(
        asking.select(
            "dim", "shard", "node", "embedding", F.lit(1).alias("kind"),
            *[F.lit(None).cast(index.schema[c].dataType).alias(c) for c in graphs],
        )
    )
    sorted_ = both.repartition("dim", "shard").sortWithinPartitions("dim", "shard", "kind", "node")
    found = sorted_.mapInPandas(_searcher(k + 1, width), FOUND)
    # No number is the largest to Spark; here it comes last.
    found = found.withColumn("by", F.nanvl("score", F.lit(float("-inf"))))
    best = Window.partitionBy("query").orderBy(F.desc("by"), "node")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k + 1)
    listed = found.join(nodes.select("node", "ids"), "node").select(
        "query", "score", "by", F.explode("ids").alias("vec_id")
    )
    best = Window.partitionBy("query").orderBy(F.desc("by"), "vec_id")
    listed = listed.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k + 1)
    listed = listed.groupBy(F.col("query").alias("node")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("best")
    )
    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    return (
        queries.join(listed, "node")
        .select("query_id", F.posexplode(others).alias("place", "b"))
        .select(
            "query_id", (F.col("place") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"),
            F.col("b.score").alias("score"),
        )
    )
