"""Approximate nearest neighbours by a hierarchical k-means tree, searched best bin first.

A tree of centroids is fitted on a bounded sample of distinct vectors. Every vector goes down to the
leaf of its nearest centroids. A query keeps a priority queue of branches by the distance to their
centroids, takes the nearest, and opens leaves one after the other. How many it opens is calibrated:
on queries from the sample, against their true neighbours in the sample, the number is widened until
the wanted recall is reached; it is widened further for a query whose leaves hold too few ids.

The distributed part joins queries and vectors by leaf. Leaves with many vectors or many visits are
split into blocks both ways, so a task never holds more than a block of each, however common one
vector is. Candidates are preselected by a matrix product and ranked by the distance computed in
double precision from the original vectors.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite components, and rows
without an id, take no part, nor do vectors of another length than the most frequent one. Rows that
repeat a vec_id are one candidate at their nearest and take one of the k places; a query id that repeats asks with its smallest
vector. Equal distances go to the smaller vec_id. Other columns are ignored; with fewer candidates
than asked for all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from umbral.llm.common import hashed_share, materialise


@dataclass(frozen=True)
class TreeSpec:
    k: int = 10
    sample: int = 16_000        # vectors that the tree is fitted on, about
    branching: int = 8
    leaf_size: int = 48         # sample vectors below which a node is a leaf
    iterations: int = 8
    calibration: int = 200      # sample vectors that are asked for their neighbours
    recall: float = 0.98        # that calibration widens the visits for
    block: int = 4096           # vectors, and visits, that meet in one task at most (about)
    seed: int = 29


@dataclass
class Tree:
    """Nodes as arrays: the children of node i are child[i] .. child[i] + width[i] - 1; leaf[i] is -1 inside."""
    centre: np.ndarray
    child: np.ndarray
    width: np.ndarray
    leaf: np.ndarray
    visits: int = 1
    order: dict = field(default_factory=dict)

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1


def _kmeans(x: np.ndarray, k: int, iterations: int, rng) -> tuple[np.ndarray, np.ndarray]:
    centre = x[rng.choice(len(x), k, replace=False)]
    for _ in range(iterations):
        own = _nearest(x, centre)
        n = np.bincount(own, minlength=k)
        total = np.zeros_like(centre)
        np.add.at(total, own, x)
        centre = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centre)
    return centre, _nearest(x, centre)


def _nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.argmin((centre * centre).sum(1)[None, :] - 2 * x @ centre.T, axis=1)


def build_tree(x: np.ndarray, spec: TreeSpec) -> Tree:
    """The tree over distinct vectors ``x``, breadth first."""
    rng = np.random.default_rng(spec.seed)
    centre, child, width, leaf, leaves = [x.mean(axis=0)], [0], [0], [-1], 0
    queue = [(0, np.arange(len(x)))]
    for node, rows in queue:
        k = min(spec.branching, len(rows))
        own = None
        if len(rows) > spec.leaf_size:
            c, own = _kmeans(x[rows], k, spec.iterations, rng)
        if own is None or len(np.unique(own)) < 2:
            leaf[node] = leaves
            leaves += 1
            continue
        used = np.unique(own)
        child[node], width[node] = len(centre), len(used)
        for u in used:
            queue.append((len(centre), rows[own == u]))
            centre.append(c[u]), child.append(0), width.append(0), leaf.append(-1)
    return Tree(np.array(centre), np.array(child), np.array(width), np.array(leaf))


def leaf_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf that every row of ``x`` goes down to."""
    out = np.full(len(x), -1, np.int64)
    level = [(0, np.arange(len(x)))]
    while level:
        deeper = []
        for node, rows in level:
            if tree.leaf[node] >= 0:
                out[rows] = tree.leaf[node]
                continue
            a, n = tree.child[node], tree.width[node]
            own = _nearest(x[rows], tree.centre[a:a + n])
            deeper += [(a + c, rows[own == c]) for c in np.unique(own)]
        level = deeper
    return out


def best_bins(tree: Tree, q: np.ndarray, visits: int, held: np.ndarray | None = None, least: int = 0) -> list[int]:
    """Leaves in the order the queue opens them: ``visits`` of them, more until they hold ``least`` ids."""
    out, have, queue = [], 0, [(0.0, 0)]
    while queue and (len(out) < visits or (held is not None and have < least)):
        _, node = heapq.heappop(queue)
        if tree.leaf[node] >= 0:
            out.append(int(tree.leaf[node]))
            have += int(held[out[-1]]) if held is not None else 0
            continue
        a, n = tree.child[node], tree.width[node]
        d = ((tree.centre[a:a + n] - q) ** 2).sum(axis=1)
        for c, v in enumerate(d.tolist()):
            heapq.heappush(queue, (v, int(a) + c))
    return out


def calibrate(tree: Tree, x: np.ndarray, spec: TreeSpec) -> int:
    """The fewest visits whose mean recall on sample queries reaches the wanted one; all leaves if none does."""
    rng = np.random.default_rng(spec.seed + 1)
    ask = rng.choice(len(x), min(spec.calibration, len(x)), replace=False)
    own, norm = leaf_of(tree, x), (x * x).sum(1)
    found = np.zeros((len(ask), tree.leaves))
    for i, a in enumerate(ask.tolist()):
        d = norm - 2 * x @ x[a]
        d[a] = np.inf
        true = np.argpartition(d, min(spec.k, len(x) - 1) - 1)[:min(spec.k, len(x) - 1)] if len(x) > 1 else np.zeros(0, int)
        place = np.empty(tree.leaves, np.int64)
        place[best_bins(tree, x[a], tree.leaves)] = np.arange(tree.leaves)
        np.add.at(found[i], place[own[true]], 1 / max(len(true), 1))
    recall = np.cumsum(found.mean(axis=0))
    enough = np.flatnonzero(recall >= spec.recall)
    return int(enough[0]) + 1 if len(enough) else tree.leaves


def valid_vectors(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """(vec_id, v): the rows that take part, in double precision."""
    v = F.col("v")
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def top_of_block(q: np.ndarray, query_id: np.ndarray, x: np.ndarray, vec_id: np.ndarray, k: int):
    """(query_id, vec_id, distance) of the ``k`` nearest of the block for each query, ties to the smaller id."""
    norm = (x * x).sum(1)
    order = np.argsort(vec_id, kind="stable")
    x, vec_id, norm = x[order], vec_id[order], norm[order]
    ids, first = np.unique(vec_id, return_index=True)      # an id with several vectors takes one place, at its nearest
    own = np.searchsorted(ids, query_id)
    out_q, out_v, out_d = [], [], []
    for at in range(0, len(q), 256):
        part = q[at:at + 256]
        rough = norm[None, :] - 2 * part @ x.T
        scale = norm.max() + (part * part).sum(1)
        for i in range(len(part)):
            d, q_id = rough[i], query_id[at + i]
            least = d.copy() if len(ids) == len(d) else np.minimum.reduceat(d, first)
            if own[at + i] < len(ids) and ids[own[at + i]] == q_id:
                least[own[at + i]] = np.inf
            limit = np.partition(least, k - 1)[k - 1] if len(least) > k else np.inf
            near = np.flatnonzero((d <= limit + 1e-9 * scale[i]) & (vec_id != q_id))
            exact = np.sqrt(((x[near] - part[i]) ** 2).sum(axis=1))
            best = np.lexsort((vec_id[near], exact))
            best = best[np.sort(np.unique(vec_id[near][best], return_index=True)[1])[:k]]
            out_q.append(np.full(len(best), q_id)), out_v.append(vec_id[near][best]), out_d.append(exact[best])
    join = lambda z, t: np.concatenate(z).astype(t) if z else np.zeros(0, t)
    return join(out_q, np.int64), join(out_v, np.int64), join(out_d, np.float64)


def search(vectors: DataFrame, is_query: Column, spec: TreeSpec = TreeSpec(), id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of every query; ``is_query`` may use vec_id."""
    spark = vectors.sparkSession
    rows = valid_vectors(vectors, id_column, column)
    size = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c"), F.count_distinct("vec_id").alias("ids")).orderBy(F.desc("c"), "n").first()
    empty = "query_id long, rank int, vec_id long, score double"
    if size is None:
        return spark.createDataFrame([], empty)
    rows = rows.filter(F.size("v") == size["n"]).dropDuplicates()
    sample = hashed_share(rows, spec.sample, size["ids"], "vec_id").select("v").limit(2 * spec.sample).toArrow()
    if not len(sample):
        sample = rows.select("v").limit(1).toArrow()
    x = np.unique(np.asarray(sample.column("v").combine_chunks().flatten(), np.float64).reshape(-1, size["n"]), axis=0)
    tree = build_tree(x, spec)
    tree.visits = calibrate(tree, x, spec)
    shared = spark.sparkContext.broadcast(tree)

    def place(batches):
        for b in batches:
            yield pa.record_batch([b.column("vec_id"), pa.array(leaf_of(shared.value, _matrix(b.column("v"))), pa.int32()), b.column("v")], names=["vec_id", "leaf", "v"])

    index, _ = materialise(rows.mapInArrow(place, "vec_id long, leaf int, v array<double>"))
    held = np.zeros(tree.leaves, np.int64)      # one number per leaf: bounded by the tree
    homes = index.groupBy("vec_id").agg(F.min("leaf").alias("leaf"))      # an id counts in one leaf, however many hold its vectors
    for r in homes.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect():
        held[r["leaf"]] = r["n"]
    held_shared = spark.sparkContext.broadcast(held)

    def visit(batches):
        t = shared.value
        for b in batches:
            ids, q = np.asarray(b.column("vec_id"), np.int64), _matrix(b.column("v"))
            opened = [best_bins(t, v, t.visits, held_shared.value, spec.k + 1) for v in q]
            row = np.repeat(np.arange(len(q)), [len(o) for o in opened])
            yield pa.record_batch([pa.array(ids[row]), pa.array(np.concatenate([np.array(o, np.int32) for o in opened]) if len(q) else [], pa.int32()),
                                   b.column("v").take(pa.array(row))], names=["query_id", "leaf", "q"])

    queries = index.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    visits, _ = materialise(queries.mapInArrow(visit, "query_id long, leaf int, q array<double>"))
    asked = visits.groupBy("leaf").agg(F.count(F.lit(1)).alias("_asked"))
    mean = max(1, int(held.sum()) // tree.leaves)
    block = min(spec.block, 2 * mean)
    sizes = (index.groupBy("leaf").agg(F.count(F.lit(1)).alias("_held")).join(asked, "leaf")
             .select("leaf", F.ceil(F.col("_held") / block).cast("int").alias("_nv"), F.ceil(F.col("_asked") / spec.block).cast("int").alias("_nq")))
    sizes, _ = materialise(sizes)               # one row per leaf
    salt = lambda n, *c: F.pmod(F.xxhash64(*c), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = visits.join(F.broadcast(sizes), "leaf").withColumn("_q", salt(F.col("_nq"), "query_id")).withColumn("_v", every("_nv")).select("leaf", "_v", "_q", "query_id", "q")
    right = index.join(F.broadcast(sizes), "leaf").withColumn("_v", salt(F.col("_nv"), "vec_id", "v")).withColumn("_q", every("_nq")).select("leaf", "_v", "_q", "vec_id", "v")

    def meet(asks: pa.Table, vecs: pa.Table) -> pa.Table:
        q, x = asks.column("q").combine_chunks(), vecs.column("v").combine_chunks()
        if not len(q) or not len(x):
            found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        else:
            found = top_of_block(_matrix(q), np.asarray(asks.column("query_id"), np.int64), _matrix(x), np.asarray(vecs.column("vec_id"), np.int64), spec.k)
        return pa.table({"query_id": found[0], "vec_id": found[1], "score": found[2]})

    near = (left.groupBy("leaf", "_v", "_q").cogroup(right.groupBy("leaf", "_v", "_q"))
            .applyInArrow(meet, "query_id long, vec_id long, score double"))
    near = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= spec.k).select("query_id", "rank", "vec_id", "score")
