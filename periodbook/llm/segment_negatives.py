"""Hard negatives by segment summaries.

For each anchor the nearest rows of its own label are its positives; hard negatives of a positive are
the best-scored rows of other labels whose score lies in a window below the positive's. Scores are
inner products of integer vectors, ties go to the smaller id.

Vectors are cut into 1, then 4, then 16 segments. Of each segment its mean and deviation are stored. Over a
segment of length n, the product of two vectors is n times the product of their means, give or take n times the
product of their deviations at most (Cauchy-Schwarz). Summed over the segments this bounds a score from both
sides without the vectors. Level by level the bounds get closer, and a pair is out as soon as

* (positives) its upper bound is below the ``k``-th best lower bound of the anchor's own label, or
* (negatives) its bounds miss the window of every positive of the anchor, or, for every positive whose window
  they meet, ``k`` rows that are in the window for sure have better lower bounds than its upper bound.

Only the pairs that are left are scored on the vectors.

Rows are dealt into blocks of about ``per_block``, rows of one label together; a label with more rows
is several blocks. Anchors form blocks of their own. Positives are sought in the blocks of the anchor's
label, negatives in all; each pair of blocks is a row of its own, so a hot label is spread over
its blocks, and a task holds one pair of blocks. Of each pair of blocks only the best leave the task.

Cases: rows with a null id, label or vector, or with null or non-finite components take no part; vectors are
compared with vectors of their own length; equal rows (id, label, vector) count once, an id with several
vectors or labels is several rows and, as an anchor, has the results of each; components and scores beyond 64 bits are held at
their limits; anchors without positives or negatives give no rows, and so does an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from periodbook.llm.common import keep, parts

LEVELS = (1, 4, 16)
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # per cent of the positive's score
CHUNK = 128
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
BLOCK = "dim int, ids binary, own binary, labels binary, flat binary, sums binary"


def summaries(x: np.ndarray) -> np.ndarray:
    """Means and deviations of the segments of each level side by side, times the root of the segment's length."""
    x, out = x.astype(np.float64), []
    for level in LEVELS:
        for piece in np.array_split(x, min(level, max(x.shape[1], 1)), axis=1):
            root = np.sqrt(piece.shape[1])
            mean = piece.mean(axis=1) if piece.shape[1] else np.zeros(len(x))
            out.append(mean * root)
        for piece in np.array_split(x, min(level, max(x.shape[1], 1)), axis=1):
            out.append(piece.std(axis=1) * np.sqrt(piece.shape[1]) if piece.shape[1] else np.zeros(len(x)))
    return np.stack(out, axis=1)


def level_bounds(a: np.ndarray, b: np.ndarray, dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Lower and upper bounds of all products of rows behind the summaries ``a`` and ``b``, level by level."""
    at = 0
    for level in LEVELS:
        n = min(level, max(dim, 1))
        middle = a[:, at : at + n] @ b[:, at : at + n].T
        reach = a[:, at + n : at + 2 * n] @ b[:, at + n : at + 2 * n].T
        reach += 1e-6 + 1e-9 * (np.abs(middle) + reach)  # rounding
        yield middle - reach, middle + reach
        at += 2 * n


def products(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact inner products of the pairs of rows (i, j)."""
    big = float(np.abs(x.astype(np.float64)).max(initial=0)) * float(np.abs(y.astype(np.float64)).max(initial=0)) * max(x.shape[1], 1)
    out = np.zeros(len(i), np.int64)
    limits = np.iinfo(np.int64)
    for k in range(0, len(i), 100_000):
        a, b = x[i[k : k + 100_000]], y[j[k : k + 100_000]]
        if big < 2**62:
            out[k : k + 100_000] = np.einsum("pd,pd->p", a, b)
        else:  # Python's integers have no limit
            exact = (a.astype(object) * b.astype(object)).sum(axis=1)
            out[k : k + 100_000] = [min(max(int(e), limits.min), limits.max) for e in exact]
    return out


def kth_largest(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row; minus infinity where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return -np.partition(-values, k - 1, axis=1)[:, k - 1]


def best(i: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of each ``i``: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, i))
    first = np.concatenate([[0], np.flatnonzero(np.diff(i[order])) + 1]) if len(i) else np.zeros(0, np.int64)
    nth = np.arange(len(i)) - np.repeat(first, np.diff(np.append(first, len(i))))
    return order[nth < k]


class Block:
    """A block of rows, as stored."""

    def __init__(self, dim: int, ids: bytes, own: bytes, labels: bytes, flat: bytes, sums: bytes) -> None:
        self.dim = dim
        self.ids, self.own, self.labels = (np.frombuffer(x, np.int64) for x in (ids, own, labels))
        self.x = np.frombuffer(flat, np.int64).reshape(len(self.ids), dim)
        self.sums = np.frombuffer(sums).reshape(len(self.ids), -1)


def find_positives(a: Block, c: Block, k: int = POSITIVES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, score): for each row of ``a`` the ``k`` best other rows of ``c`` with its label."""
    found = []
    for at in range(0, len(a.ids), CHUNK):
        rows = np.arange(at, min(at + CHUNK, len(a.ids)))
        alive = (a.labels[rows][:, None] == c.labels[None, :]) & ((a.ids[rows][:, None] != c.ids[None, :]) | (a.own[rows][:, None] != c.own[None, :]))
        for low, high in level_bounds(a.sums[rows], c.sums, a.dim):
            alive &= high >= kth_largest(np.where(alive, low, -np.inf), k)[:, None]
        i, j = np.nonzero(alive)
        score = products(a.x, c.x, rows[i], j)
        top = best(i, score, c.ids[j], k)
        found.append((rows[i[top]], j[top], score[top]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def find_negatives(a: Block, exact: np.ndarray, some: np.ndarray, c: Block, k: int = NEGATIVES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(i, p, j, score): for each row of ``a`` and positive score ``exact[i, p]``, where there is ``some``, the ``k`` best rows of ``c`` in its window.

    Bounds are compared in floating point, with room for rounding; the window itself in integers.
    """
    found = []
    scores = np.where(some, exact.astype(np.float64), np.nan)
    for at in range(0, len(a.ids), CHUNK):
        rows = np.arange(at, min(at + CHUNK, len(a.ids)))
        other = a.labels[rows][:, None] != c.labels[None, :]
        alive = other.copy()
        for low, high in level_bounds(a.sums[rows], c.sums, a.dim):
            wanted = np.zeros_like(alive)
            for p in range(scores.shape[1]):
                s = scores[rows, p][:, None]
                room = 1e-6 + 1e-9 * np.abs(s)
                bottom, top = s * LOW / 100, s * HIGH / 100
                sure = alive & (low >= bottom + room) & (high <= top - room)
                least = kth_largest(np.where(sure, low, -np.inf), k)[:, None]
                wanted |= (high >= np.maximum(bottom - room, least)) & (low <= top + room)  # false for NaN
            alive &= wanted
        i, j = np.nonzero(alive)
        score = products(a.x, c.x, rows[i], j)
        wide = score if max(np.abs(score).max(initial=0), np.abs(exact).max(initial=0)) < 2**55 else score.astype(object)
        for p in range(scores.shape[1]):
            ours = exact[rows[i], p].astype(wide.dtype)
            held = some[rows[i], p] & ((LOW * ours <= 100 * wide) & (100 * wide <= HIGH * ours)).astype(bool)
            u, v, s = i[held], j[held], score[held]
            top = best(u, s, c.ids[v], k)
            found.append((rows[u[top]], np.full(len(top), p), v[top], s[top]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def vectors(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", moved: int = 7, labels: int = 10) -> DataFrame:
    """(vec_id, label, v, own) of the rows that take part: integer components, and a hash that tells rows of one id apart.

    Labels of ids divisible by ``moved`` are the next one, modulo ``labels``.
    """
    v = F.col(vector).cast("array<double>")
    fine = F.col(id_column).isNotNull() & F.col(label).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kind = F.when(F.col(id_column) % moved == 0, (F.col(label) + 1) % labels).otherwise(F.col(label)).cast("long")
    whole = F.transform(v, lambda x: F.floor(x * 256).cast("long"))
    rows = table.filter(F.coalesce(fine, F.lit(False))).select(F.col(id_column).cast("long").alias("vec_id"), kind.alias("label"), whole.alias("v"))
    return rows.distinct().withColumn("own", F.xxhash64("label", "v"))


def blocks(rows: DataFrame, per_block: int, groups: int, name: str) -> DataFrame:
    """(dim, bucket, part, ids, own, labels, flat, sums): blocks of about ``per_block`` rows, rows of a label in one bucket."""
    placed = rows.withColumns({"dim": F.size("v"), "bucket": F.pmod(F.xxhash64("label"), F.lit(groups)).cast("int")})
    sizes = placed.groupBy("dim", "bucket").agg(F.ceil(F.count(F.lit(1)) / per_block).alias("parts"))
    dealt = placed.join(sizes, ["dim", "bucket"]).withColumn("part", F.pmod(F.xxhash64("vec_id", "own", F.lit("part")), F.col("parts")).cast("int"))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["vec_id", "own"])
        dim = int(frame["dim"].iloc[0])
        x = np.stack(frame["v"].to_numpy()).astype(np.int64).reshape(len(frame), dim)
        column = lambda c: [frame[c].to_numpy(np.int64).tobytes()]
        return pd.DataFrame({
            "dim": [dim], "bucket": [int(frame["bucket"].iloc[0])], "part": [int(frame["part"].iloc[0])],
            "ids": column("vec_id"), "own": column("own"), "labels": column("label"), "flat": [x.tobytes()], "sums": [summaries(x).tobytes()],
        })

    grouped = dealt.select("dim", "bucket", "part", "vec_id", "own", "label", "v").groupBy("dim", "bucket", "part")
    return keep(grouped.applyInPandas(build, f"bucket int, part int, {BLOCK}"), name)


def met(anchors: DataFrame, rows: DataFrame, on: list[str]) -> DataFrame:
    """Pairs of blocks that agree on ``on``: the blocks of ``anchors`` as columns a_*, those of ``rows`` as c_*.

    The numbers of the pairs are found first; the blocks themselves are fetched by whole keys, so no task gets all of them.
    """
    key = ["dim", "bucket", "part"]
    named = lambda df, p, cols: df.select(*(F.col(c).alias(f"{p}_{c}") for c in cols))
    agree = [F.col(f"a_{c}") == F.col(f"c_{c}") for c in on]
    pairs = named(anchors, "a", key).join(named(rows, "c", key), agree).repartition("a_dim", "a_bucket", "a_part", "c_dim", "c_bucket", "c_part")
    left = pairs.join(named(anchors, "a", anchors.columns), [f"a_{c}" for c in key])
    return left.join(named(rows, "c", rows.columns), [f"c_{c}" for c in key])


def _block(row, side: str) -> Block:
    return Block(*(getattr(row, f"{side}_{c}") for c in ("dim", "ids", "own", "labels", "flat", "sums")))


def _places(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Which rows each block holds."""
    for f in frames:
        for row in f.itertuples():
            ids = np.frombuffer(row.ids, np.int64)
            yield pd.DataFrame({"dim": row.dim, "bucket": row.bucket, "part": row.part, "anchor_id": ids, "own": np.frombuffer(row.own, np.int64)})


def positives(anchors: DataFrame, rows: DataFrame, k: int = POSITIVES) -> DataFrame:
    """(anchor_id, own, nth, positive_id, positive_score): the ``k`` best other rows of each anchor's label."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for row in f.itertuples():
                a, c = _block(row, "a"), _block(row, "c")
                i, j, score = find_positives(a, c, k)
                yield pd.DataFrame({"anchor_id": a.ids[i], "own": a.own[i], "positive_id": c.ids[j], "positive_score": score})

    found = met(anchors, rows, ["dim", "bucket"]).mapInPandas(run, "anchor_id long, own long, positive_id long, positive_score long")
    order = W.partitionBy("anchor_id", "own").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k)


def mine(table: DataFrame, every: int = 50, k: int = NEGATIVES, per_block: int = 8_192, per_anchors: int = 1_024) -> DataFrame:
    """The hard negatives of every positive of every row whose id is divisible by ``every``."""
    rows = keep(vectors(table), "vectors")
    wanted = rows.filter(F.col("vec_id") % every == 0)
    groups = parts(rows.count(), per_block)
    all_blocks, anchor_blocks = blocks(rows, per_block, groups, "blocks"), blocks(wanted, per_anchors, groups, "anchors")
    near = keep(positives(anchor_blocks, all_blocks), "positives")
    scores = near.groupBy("anchor_id", "own").agg(F.array_sort(F.collect_list(F.struct("nth", "positive_id", "positive_score"))).alias("near"))
    # the anchors that have positives, with them, in the blocks they are in
    placed = anchor_blocks.select("dim", "bucket", "part", "ids", "own").mapInPandas(_places, "dim int, bucket int, part int, anchor_id long, own long")
    by_block = scores.join(placed, ["anchor_id", "own"]).groupBy("dim", "bucket", "part").agg(F.collect_list(F.struct("anchor_id", "own", "near")).alias("known"))
    asked = keep(anchor_blocks.join(by_block, ["dim", "bucket", "part"]), "asked")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for row in f.itertuples():
                a, c = _block(row, "a"), _block(row, "c")
                where = {key: n for n, key in enumerate(zip(a.ids.tolist(), a.own.tolist(), strict=True))}
                shape = len(a.ids), POSITIVES
                some, ids, exact = np.zeros(shape, bool), np.zeros(shape, np.int64), np.zeros(shape, np.int64)
                for x in row.a_known:
                    n = where[x["anchor_id"], x["own"]]
                    for y in x["near"]:
                        p = y["nth"] - 1
                        some[n, p], exact[n, p], ids[n, p] = True, y["positive_score"], y["positive_id"]
                i, p, j, s = find_negatives(a, exact, some, c, k)
                yield pd.DataFrame({
                    "anchor_id": a.ids[i], "own": a.own[i], "nth": p, "positive_id": ids[i, p], "negative_id": c.ids[j],
                    "positive_score": exact[i, p], "negative_score": s,
                })

    found = met(asked, all_blocks, ["dim"]).mapInPandas(run, "anchor_id long, own long, nth int, positive_id long, negative_id long, positive_score long, negative_score long")
    order = W.partitionBy("anchor_id", "own", "nth").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
