"""Approximate nearest neighbours by robust-pruned directed graphs.

Vectors are dealt by hash into shards of about ``shard_rows`` rows. Each
shard builds a directed graph: greedy searches for every vector propose
neighbours, and robust pruning keeps an edge only if no kept neighbour is
closer to the candidate by the factor ``alpha``. A query is searched by a
beam over the graph of every shard, and the shards' nearest are merged.

Equal vectors form one node of the index that names all rows (a hot vector
would otherwise fill whole neighbourhoods with itself). A node answers with
its ``k + 1`` smallest ids, which is all that ``k`` nearest with ties to the
smaller id can ever ask of it.

Defined results: vectors that are null, empty, all zero, or hold a null or
non-finite component take no part, nor do rows with a null id; vectors are compared
only with those of their own dimension; of rows that repeat an id with
different vectors all are candidates, and the query is the smallest vector;
with fewer candidates than ``k`` all are returned; an empty table gives no
rows. Other columns are ignored. Every number drawn comes from a fixed seed and
rows are ordered in a shard, so reruns agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallywatch.llm.common import save_and_reload

SHARD_ROWS = 2_500
DEGREE = 32
BUILD_BEAM = 40
SEARCH_BEAM = 80
ALPHA = 1.2
BATCH = 128
SEED = 11


def distances(points: np.ndarray, norms: np.ndarray, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Squared distances of each query to its own list of rows."""
    near = np.einsum("qd,qrd->qr", queries, points[rows], optimize=False)
    return norms[rows] - 2 * near + (queries * queries).sum(axis=1)[:, None]


def beam_search(
    points: np.ndarray, norms: np.ndarray, graph: np.ndarray, starts: np.ndarray, queries: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """Per query the ``beam`` nearest rows that a greedy walk over ``graph`` meets, nearest first.

    All queries walk in step. ``graph`` holds row numbers, -1 for none; unused
    places of the result are -1 with an infinite distance.
    """
    n, q = len(points), len(queries)
    beam = min(beam, n)
    rows = np.full((q, beam), -1, np.int64)
    far = np.full((q, beam), np.inf)
    done = np.zeros((q, beam), bool)
    seen = np.zeros((q, n), bool)
    first = np.broadcast_to(starts[:beam], (q, len(starts[:beam])))
    rows[:, : first.shape[1]] = first
    far[:, : first.shape[1]] = distances(points, norms, queries, first)
    seen[:, starts[:beam]] = True
    active = np.arange(q)
    while len(active):
        open_ = np.where(done[active] | (rows[active] < 0), np.inf, far[active])
        place = open_.argmin(axis=1)
        going = np.isfinite(open_[np.arange(len(active)), place])
        active, place = active[going], place[going]
        if not len(active):
            break
        done[active, place] = True
        nexts = graph[rows[active, place]]
        fresh = (nexts >= 0) & ~seen[active[:, None], np.maximum(nexts, 0)]
        seen[np.broadcast_to(active[:, None], nexts.shape)[fresh], nexts[fresh]] = True
        found = np.where(fresh, distances(points, norms, queries[active], np.maximum(nexts, 0)), np.inf)
        all_rows = np.concatenate([rows[active], np.where(fresh, nexts, -1)], axis=1)
        all_far = np.concatenate([far[active], found], axis=1)
        all_done = np.concatenate([done[active], np.zeros_like(fresh)], axis=1)
        order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        rows[active] = np.take_along_axis(all_rows, order, axis=1)
        far[active] = np.take_along_axis(all_far, order, axis=1)
        done[active] = np.take_along_axis(all_done, order, axis=1)
    order = np.argsort(far, axis=1, kind="stable")
    return np.take_along_axis(rows, order, axis=1), np.take_along_axis(far, order, axis=1)


def robust_prune(points: np.ndarray, norms: np.ndarray, own: np.ndarray, proposed: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """For each row of ``own``, up to ``degree`` of its ``proposed`` rows.

    The nearest is kept, then all those that the kept one is nearer to by the
    factor ``alpha`` (distances, so its square here) go, and so on.
    """
    q = len(own)
    proposed = np.where(proposed == own[:, None], -1, proposed)
    proposed = np.sort(proposed, axis=1)
    repeated = np.zeros_like(proposed, bool)
    repeated[:, 1:] = proposed[:, 1:] == proposed[:, :-1]
    valid = (proposed >= 0) & ~repeated
    safe = np.maximum(proposed, 0)
    far = np.where(valid, distances(points, norms, points[own], safe), np.inf)
    kept = np.full((q, degree), -1, np.int64)
    lines = np.arange(q)
    for slot in range(degree):
        best = far.argmin(axis=1)
        some = np.isfinite(far[lines, best])
        if not some.any():
            break
        chosen = safe[lines, best]
        kept[some, slot] = chosen[some]
        between = distances(points, norms, points[chosen], safe)
        far = np.where(some[:, None] & (alpha * alpha * between <= far), np.inf, far)
        far[lines, best] = np.inf
    return kept


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, np.ndarray]:
    """The graph of a shard and the rows its searches start from."""
    n = len(points)
    norms = (points * points).sum(axis=1)
    middle = points.mean(axis=0)
    starts = np.array([int((norms - 2 * points @ middle).argmin())])
    draw = np.random.default_rng(SEED)
    if n <= degree + 1:
        graph = np.tile(np.arange(n), (n, 1))
        return np.where(graph == np.arange(n)[:, None], -1, graph), starts
    graph = draw.integers(0, n, (n, degree))
    graph = np.where(graph == np.arange(n)[:, None], -1, graph)
    for factor in (1.0, alpha):
        order = draw.permutation(n)
        for at in range(0, n, BATCH):
            own = order[at : at + BATCH]
            proposed, _ = beam_search(points, norms, graph, starts, points[own], beam)
            graph[own] = robust_prune(points, norms, own, np.concatenate([proposed, graph[own]], axis=1), factor, degree)
            _add_reverse(points, norms, graph, own, factor, degree)
    return graph, starts


def _add_reverse(points: np.ndarray, norms: np.ndarray, graph: np.ndarray, own: np.ndarray, alpha: float, degree: int) -> None:
    """Add the edges back to ``own``; rows with too many edges are pruned again."""
    sources = np.repeat(own, degree)
    targets = graph[own].ravel()
    sources, targets = sources[targets >= 0], targets[targets >= 0]
    order = np.argsort(targets, kind="stable")
    sources, targets = sources[order], targets[order]
    rows, first, count = np.unique(targets, return_index=True, return_counts=True)
    width = int(count.max())
    added = np.full((len(rows), width), -1, np.int64)
    inside = np.arange(len(targets)) - np.repeat(first, count)
    added[np.repeat(np.arange(len(rows)), count), inside] = sources
    both = np.concatenate([graph[rows], added], axis=1)
    ordered = np.sort(both, axis=1)
    distinct = (ordered >= 0) & np.concatenate([np.ones((len(rows), 1), bool), ordered[:, 1:] != ordered[:, :-1]], axis=1)
    few = distinct.sum(axis=1) <= degree
    simple = np.where(distinct, ordered, -1)
    simple = -np.sort(-simple, axis=1)[:, :degree]
    graph[rows[few]] = simple[few]
    if (~few).any():
        graph[rows[~few]] = robust_prune(points, norms, rows[~few], both[~few], alpha, degree)


def usable(vector: str) -> Column:
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(F.col(vector), lambda x: x != 0)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(flat), -1)


def search(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    beam: int = SEARCH_BEAM,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` (Euclidean distance) of each query's ``k`` nearest.

    ``queries`` says which rows of ``vectors`` are queries; all other rows than the query's
    own are its candidates.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"), queries.alias("asks"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable("vector"))
    rows = save_and_reload(rows, "vectors")
    # nodes: distinct vectors with their smallest ids, cut on the map side already
    order = Window.partitionBy("vector").orderBy("vec_id")
    distinct = rows.select("vector", "vec_id").distinct()
    named = distinct.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1)
    nodes = named.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = save_and_reload(nodes.withColumn("dim", F.size("vector")), "nodes")
    asked = rows.where("asks").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    sizes = nodes.groupBy("dim").count().withColumn("shards", F.ceil(F.col("count") / shard_rows).cast("int")).drop("count")
    dealt = nodes.join(sizes, "dim")
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("vector"), F.col("shards").cast("long")).cast("int"))
    asked = asked.withColumn("dim", F.size("vector")).join(sizes, "dim")
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))

    def look(asking: pa.Table, indexed: pa.Table) -> pa.Table:
        return _search_shard(indexed, asking, k, beam)

    schema = "query_id long, vec_id long, score double"
    found = (
        asked.select("dim", "shard", "vec_id", "vector")
        .groupBy("dim", "shard")
        .cogroup(dealt.select("dim", "shard", "ids", "vector").groupBy("dim", "shard"))
        .applyInArrow(look, schema)
    )
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _search_shard(indexed: pa.Table, asking: pa.Table, k: int, beam: int) -> pa.Table:
    empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
    if not indexed.num_rows or not asking.num_rows:
        return empty
    points, asked = _matrix(indexed.column("vector")), _matrix(asking.column("vector"))
    order = np.lexsort(points.T[::-1])
    points = points[order]
    ids = indexed.column("ids").to_pylist()
    ids = [ids[i] for i in order]
    # the walk runs in single precision, what it finds is measured in double
    rough = points.astype(np.float32)
    graph, starts = build_graph(rough)
    norms = (rough * rough).sum(axis=1)
    query_ids = asking.column("vec_id").to_pylist()
    out_query: list[int] = []
    out_vec: list[int] = []
    out_score: list[float] = []
    for at in range(0, len(asked), BATCH):
        rows, _ = beam_search(rough, norms, graph, starts, asked[at : at + BATCH].astype(np.float32), max(beam, k + 1))
        for i, near in enumerate(rows):
            near = near[near >= 0]
            exact = np.sqrt(((points[near] - asked[at + i]) ** 2).sum(axis=1))
            own = query_ids[at + i]
            pairs = sorted((float(d), v) for d, row in zip(exact, near) for v in ids[row] if v != own)[:k]
            out_query += [own] * len(pairs)
            out_score += [d for d, _ in pairs]
            out_vec += [v for _, v in pairs]
    return pa.table({"query_id": pa.array(out_query, pa.int64()), "vec_id": pa.array(out_vec, pa.int64()), "score": pa.array(out_score, pa.float64())})

