"""Approximate nearest neighbours on robust-pruned directed graphs, one per shard.

Vectors that are equal are indexed once; their ids are kept beside (the smallest ``k + 1`` of them,
all that a result of ``k`` can need). Distinct vectors are dealt by hash into shards of about
``shard_size``. A shard's graph grows from its medoid in doubling rounds: greedy (beam) searches on the
graph so far propose neighbours for each new vector; relaxed distance pruning keeps the nearest
proposal and drops those that it, times ``alpha``, is closer to than the new vector, until ``degree``
diverse edges are left; edges are added in both directions and over-full vertices pruned again. A
second pass over all vectors repeats this on the finished graph. Pruning can take all but a few edges into a
vertex: at last every vertex with fewer than ``ENTRIES`` gets edges from its own nearest neighbours, and what no
walk from the start can reach is linked from the nearest vertex that one can.

Queries go in blocks to every shard (one row per shard and block, so shards may be searched on any
executor and a query block is never larger than ``block``); a beam search answers each query in each shard, and
the results are merged by exact Euclidean distance in double precision, ties to the smaller id.

Cases: vectors that are null, empty, zero, or hold null or non-finite components take no part, as candidates or
queries; vectors of another length than most are compared only with their like; null ids take no
part; repeated ids are reported once per distinct vector, and ask with the smallest of their vectors; fewer candidates than ``k`` are all returned; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from periodbook.llm.common import keep, parts

BEAM = 64
SEARCH_BEAM = 128
DEGREE = 32
ALPHA = 1.2
ENTRIES = 12


def square_distances(points: np.ndarray, ids: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Squared distances of each query's own candidates; candidates of -1 are infinitely far."""
    d = points[np.maximum(ids, 0)]
    d -= queries[:, None, :]
    return np.where(ids >= 0, np.einsum("qcd,qcd->qc", d, d), np.inf)


def beam_search(points: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Best ``beam`` vertices found for each query (-1 where there are none) and their squared distances, nearest first."""
    q, n = len(queries), len(points)
    seen = np.zeros((q, n), bool)
    seen[:, start] = True
    ids = np.full((q, beam), -1, np.int64)
    ids[:, 0] = start
    far = np.full((q, beam), np.inf)
    far[:, 0] = square_distances(points, ids[:, :1], queries)[:, 0]
    open_ = np.zeros((q, beam), bool)
    open_[:, 0] = True
    active = np.arange(q)
    while len(active):
        own = open_[active]
        nearest = own.argmax(axis=1)  # rows are sorted: the first open one is the nearest
        open_[active, nearest] = False
        met = edges[ids[active, nearest]]
        fresh = (met >= 0) & ~seen[active[:, None], np.maximum(met, 0)]
        met = np.where(fresh, met, -1)
        r, c = np.nonzero(fresh)
        seen[active[r], met[r, c]] = True
        d = square_distances(points, met, queries[active])
        all_ids = np.concatenate([ids[active], met], 1)
        all_far = np.concatenate([far[active], d], 1)
        all_open = np.concatenate([open_[active], fresh], 1)
        order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        rows = np.arange(len(active))[:, None]
        ids[active], far[active], open_[active] = all_ids[rows, order], all_far[rows, order], all_open[rows, order]
        active = active[open_[active].any(axis=1)]
    return ids, far


def robust_prune(points: np.ndarray, targets: np.ndarray, ids: np.ndarray, alpha: float, degree: int) -> np.ndarray:
    """Diverse neighbours (targets x degree, -1 where fewer) out of each target's candidates."""
    ids = np.where(ids == targets[:, None], -1, ids)
    ids = -np.sort(-ids, axis=1)
    ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1  # repeats
    ids = ids[:, : max(int((ids >= 0).sum(axis=1).max(initial=0)) + 1, 1)] if len(ids) else ids
    met = points[np.maximum(ids, 0)]
    near = met - points[targets][:, None, :]
    far = np.where(ids >= 0, np.einsum("tcd,tcd->tc", near, near), np.inf)
    norm = np.einsum("tcd,tcd->tc", met, met)
    between = norm[:, :, None] + norm[:, None, :] - 2 * (met @ met.transpose(0, 2, 1))
    between *= alpha * alpha
    out = np.full((len(targets), degree), -1, np.int64)
    rows = np.arange(len(targets))
    for slot in range(degree):
        best = far.argmin(axis=1)
        some = np.isfinite(far[rows, best])
        if not some.any():
            break
        out[:, slot] = np.where(some, ids[rows, best], -1)
        far[(between[rows, best] <= far) & some[:, None]] = np.inf
        far[rows, best] = np.inf
    return out


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """Edges (vertices x degree) and the vertex where searches start. Single precision is enough for proposing and pruning."""
    n = len(points)
    points = points.astype(np.float32)
    points = points - points.mean(axis=0)
    start = int((points**2).sum(axis=1).argmin())
    edges = np.full((n, degree), -1, np.int64)
    order = np.concatenate([[start], np.setdiff1d(np.random.default_rng(n).permutation(n), [start], assume_unique=True)])

    def insert(batch: np.ndarray, strict: float) -> None:
        found, _ = beam_search(points, edges, start, points[batch], beam)
        edges[batch] = robust_prune(points, batch, np.concatenate([found, edges[batch]], 1), strict, degree)
        source = np.repeat(batch, degree)
        target = edges[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        into, first, many = np.unique(target[by], return_index=True, return_counts=True)
        source = source[by]
        for chunk in np.array_split(np.argsort(many, kind="stable"), len(into) // 128 + 1):  # like numbers of new edges together
            if not len(chunk):
                continue
            width = many[chunk].max()
            spot = first[chunk][:, None] + np.arange(width)
            back = np.where(np.arange(width) < many[chunk][:, None], source[np.minimum(spot, len(source) - 1)], -1)
            edges[into[chunk]] = robust_prune(points, into[chunk], np.concatenate([edges[into[chunk]], back], 1), strict, degree)

    done, size = 1, 1
    while done < n:
        insert(order[done : done + size], 1.0)
        done, size = done + size, min(size * 2, 256, max(n // 8, 1))
    for i in range(0, n, 256):
        insert(order[i : i + 256], alpha)
    return connected(points, entered(points, edges), start), start


def reached(edges: np.ndarray, start: int) -> np.ndarray:
    """Which vertices a walk along the edges from ``start`` meets."""
    seen = np.zeros(len(edges), bool)
    seen[start] = True
    front = np.array([start])
    while len(front):
        met = np.unique(edges[front])
        front = met[(met >= 0) & ~seen[np.maximum(met, 0)]]
        seen[front] = True
    return seen


def entered(points: np.ndarray, edges: np.ndarray, least: int = ENTRIES) -> np.ndarray:
    """``edges``, wider by as many slots at most, with edges into vertices that have fewer than ``least``: from their own nearest neighbours."""
    n, degree = edges.shape
    out = np.full((n, 2 * degree), -1, np.int64)
    out[:, :degree] = -np.sort(-edges, axis=1)  # the free slots last
    used = (edges >= 0).sum(axis=1)
    many = np.bincount(edges[edges >= 0], minlength=n)
    for v in np.flatnonzero(many < least):
        own = edges[v][edges[v] >= 0]
        for u in own[((points[own] - points[v]) ** 2).sum(axis=1).argsort(kind="stable")]:
            if many[v] >= least:
                break
            if used[u] < 2 * degree and v not in out[u, : used[u]]:
                out[u, used[u]] = v
                used[u] += 1
                many[v] += 1
    return out[:, : max(int(used.max()), 1)]


def connected(points: np.ndarray, edges: np.ndarray, start: int) -> np.ndarray:
    """``edges``, with one into each vertex that could not be reached, from the nearest one that can; wider where no slot is free."""
    lost = np.flatnonzero(~reached(edges, start))
    if not len(lost):
        return edges
    there = np.flatnonzero(reached(edges, start))
    near = np.empty(len(lost), np.int64)
    norm = (points[there] ** 2).sum(axis=1)
    for k in range(0, len(lost), 256):
        near[k : k + 256] = there[(norm[None, :] - 2 * points[lost[k : k + 256]] @ points[there].T).argmin(axis=1)]
    used = (edges >= 0).sum(axis=1)
    more = np.bincount(near, minlength=len(edges))
    width = max(int((used + more).max()), edges.shape[1])
    out = np.full((len(edges), width), -1, np.int64)
    out[:, : edges.shape[1]] = -np.sort(-edges, axis=1)  # the free slots last
    for source, target in zip(near, lost, strict=True):
        out[source, used[source]] = target
        used[source] += 1
    return out


def vectors(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows that take part; negative zero is zero."""
    v = F.col(vector).cast("array<double>")
    fine = F.col(id_column).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return table.filter(F.coalesce(fine, F.lit(False))).select(F.col(id_column).cast("long").alias("vec_id"), F.transform(v, lambda x: x + 0.0).alias("v"))


def distinct_vectors(rows: DataFrame, most: int) -> DataFrame:
    """(rep, v, ids): each distinct vector once, with its smallest id and its ``most`` smallest ids. Hot vectors are cut down in salted parts first."""
    keyed = rows.distinct().withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(256)))
    part = F.row_number().over(W.partitionBy("v", "salt").orderBy("vec_id"))
    whole = F.row_number().over(W.partitionBy("v").orderBy("vec_id"))
    few = keyed.withColumn("nth", part).filter(F.col("nth") <= most).withColumn("nth", whole).filter(F.col("nth") <= most)
    return few.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).select(F.element_at("ids", 1).alias("rep"), "v", "ids")


def indexed(points: DataFrame, shard_size: int) -> DataFrame:
    """One row per shard and vector length: (shard, dim, reps, flat, edges, start)."""
    shards = parts(points.count(), shard_size)

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rep")
        x = np.stack(frame["v"].to_numpy()).astype(np.float64)
        edges, start = build_graph(x)
        return pd.DataFrame({
            "shard": [int(frame["shard"].iloc[0])], "dim": [x.shape[1]], "reps": [frame["rep"].to_numpy(np.int64).tobytes()],
            "flat": [x.tobytes()], "edges": [edges.astype(np.int32).tobytes()], "start": [start],
        })

    dealt = points.select("rep", "v", F.pmod(F.xxhash64("rep"), F.lit(shards)).cast("int").alias("shard"), F.size("v").alias("dim"))
    return keep(dealt.groupBy("shard", "dim").applyInPandas(build, "shard int, dim int, reps binary, flat binary, edges binary, start long"), "graphs")


def search(points: DataFrame, queries: DataFrame, k: int, shard_size: int = 4_096, block: int = 1_024, beam: int = SEARCH_BEAM) -> DataFrame:
    """(query_id, rep, score): candidates of ``queries`` (vec_id, v) from every shard: the ``k`` nearest distinct vectors of each."""
    graphs = indexed(points, shard_size)
    blocks = parts(queries.count(), block)
    grouped = (
        queries.withColumn("dim", F.size("v")).groupBy("dim", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"))
        .agg(F.collect_list(F.struct("vec_id", "v")).alias("asked"))
    )
    grouped = keep(grouped, "asked")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for row in f.itertuples():
                x = np.frombuffer(row.flat).reshape(-1, row.dim)
                edges = np.frombuffer(row.edges, np.int32).reshape(len(x), -1).astype(np.int64)
                reps = np.frombuffer(row.reps, np.int64)
                numbers = np.array([a["vec_id"] for a in row.asked])
                q = np.stack([np.asarray(a["v"], np.float64) for a in row.asked])
                ids, far = beam_search(x, edges, row.start, q, beam)
                ids, far = ids[:, : k + 1], far[:, : k + 1]
                r, c = np.nonzero(ids >= 0)
                yield pd.DataFrame({"query_id": numbers[r], "rep": reps[ids[r, c]], "score": np.sqrt(far[r, c])})

    # which block meets which shard, by their numbers; then each is fetched by its whole key, so no task gets all of them
    pairs = graphs.select("shard", "dim").join(grouped.select("dim", "block"), "dim").repartition("shard", "dim", "block")
    met = pairs.join(grouped, ["dim", "block"]).join(graphs, ["shard", "dim"])
    return met.select("dim", "reps", "flat", "edges", "start", "asked").mapInPandas(run, "query_id long, rep long, score double")


def nearest(table: DataFrame, k: int = 10, every: int = 100, shard_size: int = 4_096, block: int = 1_024) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row whose id is divisible by ``every``."""
    rows = keep(vectors(table), "vectors")
    points = keep(distinct_vectors(rows, k + 1), "points")
    queries = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    found = search(points, queries, k, shard_size, block)
    best = W.partitionBy("query_id").orderBy("score", "rep")
    found = found.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= k + 1)
    named = found.join(points.select("rep", "ids"), "rep").select("query_id", "score", F.explode("ids").alias("vec_id"))
    named = named.filter("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = named.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
