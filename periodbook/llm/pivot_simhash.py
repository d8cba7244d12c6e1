"""SimHash near-duplicates with pivot distance tables.

Fingerprints are 64 bits: a bit is 1 if more than half of a text's shingle hashes (runs of four words,
repeats included) have it. Two fingerprints are linked if they differ in ``most`` bits or fewer; classes
are the connected components.

1. ``fingerprints``: one per document. Documents with equal fingerprints are linked already, so
   only the distinct ones go on, each with its smallest doc_id.
2. Which fingerprints meet: those that agree on three of seven pieces. Four differing bits touch four
   pieces at most, so every linked pair agrees on three, and none is lost. The 35 keys are exploded on
   the JVM and dealt by hash.
3. ``PIVOTS`` are reference fingerprints. Every fingerprint has a table of its Hamming distances to
   all of them. A distance to a pivot differs by no more than the fingerprints do, so a pair whose
   tables are more than ``most`` apart anywhere is discarded; the others are verified on all bits.
   Within a key rows are in order of their first distance. The same test on the ranges of whole
   blocks of ``block`` rows discards pairs of blocks.
4. Of what is linked within a block only a spanning star leaves the task. A key with more than ``block``
   fingerprints is cut into blocks; pairs of its blocks are compared as rows of their own, so no task
   ever holds more than two blocks.

Cases: null and empty texts, and texts of white space, have fingerprint zero and are linked like any other;
a text of fewer than four words is one shingle; texts of any length are taken whole; repeated rows each
give a row; a null doc_id gives a row with the smallest known id of its class (null if there is none); an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodbook.llm.common import batches, keep, mix
from periodbook.llm.near_dedup import components

SHINGLE = 4
SEED = 42
MOST = 4
PIECES = (0, 9, 18, 27, 36, 45, 54, 64)
AGREED = 3
#: Reference fingerprints: spread over the space, the same everywhere.
PIVOTS = mix(np.arange(1, 25, dtype=np.uint64))
BLOCK = 1_024


def shingle_hashes(text: str | None) -> np.ndarray:
    """XXH64 of every run of four words, ASCII letters in lower case, words joined by one space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z is lowered, only ASCII white space parts words
    if not words:
        return np.zeros(0, np.uint64)
    line, size = b" ".join(words), min(SHINGLE, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    digest, seed = xxhash.xxh64_intdigest, SEED
    return np.array([digest(line[a:b], seed) for a, b in zip(starts, ends[size - 1 :].tolist(), strict=False)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits that more than half of the hashes have, as a signed number; zero without hashes."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 8_192):  # bounded also for very long texts
        part = hashes[k : k + 8_192].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row of ``docs``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts = f["text"].tolist()
            for a, b in batches(texts):
                yield pd.DataFrame({"doc_id": f["doc_id"].iloc[a:b], "fp": [fingerprint(shingle_hashes(t)) for t in texts[a:b]]})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, "doc_id long, fp long")


def bits_of(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int16)


def pivot_table(fp: np.ndarray) -> np.ndarray:
    """Hamming distance of each fingerprint to each pivot."""
    return bits_of(fp.view(np.uint64)[:, None] ^ PIVOTS[None, :])


def close(fp: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray, most: int) -> np.ndarray:
    """Which of the pairs (i, j) are linked: pivot by pivot discards first, all bits last."""
    alive = np.arange(len(i))
    for p in range(table.shape[1]):
        alive = alive[np.abs(table[i[alive], p] - table[j[alive], p]) <= most]
    alive = alive[bits_of((fp[i[alive]] ^ fp[j[alive]]).view(np.uint64)) <= most]
    out = np.zeros(len(i), bool)
    out[alive] = True
    return out


def spanning(fp: np.ndarray, i: np.ndarray, j: np.ndarray) -> pd.DataFrame:
    """A star per component of the links (i, j): at most one edge a fingerprint."""
    root = np.arange(len(fp))
    while True:  # smaller of the two ends, then shortcuts, until nothing moves
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    moved = np.flatnonzero(root != np.arange(len(fp)))
    a, b = fp[root[moved]], fp[moved]
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def within(key: np.ndarray, fp: np.ndarray, most: int) -> pd.DataFrame:
    """Links between rows of equal key (rows are sorted by it), as spanning stars."""
    table = pivot_table(fp)
    found = []
    ends = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, len(key))
    end_of = np.repeat(ends, np.diff(np.append(0, ends)))  # where the row's key ends
    rows = np.arange(len(key))
    off = 1
    while len(rows := rows[rows + off < end_of[rows]]):
        # in order of the first distance: whoever is too far ahead in it is out, and so are all behind
        rows = rows[table[rows + off, 0] - table[rows, 0] <= most]
        good = close(fp, table, rows, rows + off, most)
        found.append(np.stack([rows[good], rows[good] + off]))
        off += 1
    if not found:
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    i, j = np.concatenate(found, axis=1)
    return spanning(fp, i, j)


def keyed(distinct: DataFrame) -> DataFrame:
    """(key, near, fp): each fingerprint under the 35 choices of three pieces; ``near`` is its first pivot distance."""
    masks = [sum(((1 << b) - 1) ^ ((1 << a) - 1) for a, b in chosen) for chosen in combinations(list(zip(PIECES, PIECES[1:], strict=False)), AGREED)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    keys = F.array(*(F.struct(F.lit(k).cast("tinyint").alias("which"), F.col("fp").bitwiseAND(F.lit(signed(m)).cast("long")).alias("agreed")) for k, m in enumerate(masks)))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.lit(signed(int(PIVOTS[0]))).cast("long"))).cast("tinyint").alias("near")
    return distinct.select("fp", near, F.inline(keys))


def links(distinct: DataFrame, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """(a, b): pairs of fingerprints of ``distinct`` (fp) that connect what is linked."""

    fields = ["a", "b", "which", "agreed", "number", "fps", "low", "high"]

    def row(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.assign(**{c: None for c in fields if c not in frame})[fields]

    def block_row(which: int, agreed: int, number: int, fp: np.ndarray) -> pd.DataFrame:
        table = pivot_table(fp)
        low, high = [table.min(axis=0).astype(np.int32)], [table.max(axis=0).astype(np.int32)]
        return row(pd.DataFrame({"which": [which], "agreed": [agreed], "number": [number], "fps": [fp.tobytes()], "low": low, "high": high}))

    def first(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Links within blocks; a key of more than one block also gives its blocks, for ``second``."""
        number = 0  # blocks that the key at hand has given so far

        def whole(keys: np.ndarray, fp: np.ndarray) -> Iterator[pd.DataFrame]:
            """Keys that are complete: (which, agreed) and fingerprint of each row."""
            nonlocal number
            starts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(fp)]])
            sizes = np.diff(starts)
            cut = sizes > block
            cut[0] |= number > 0  # the rest of a key with blocks is a block as well
            small = np.repeat(~cut, sizes)
            yield row(within(np.repeat(np.arange(len(sizes)), sizes)[small], fp[small], most))
            for k in np.flatnonzero(cut):
                for a in range(starts[k], starts[k + 1], block):
                    yield from piece(keys[a], fp[a : min(a + block, starts[k + 1])])
                number = 0

        def piece(key: np.ndarray, fp: np.ndarray) -> Iterator[pd.DataFrame]:
            nonlocal number
            yield row(within(np.zeros(len(fp), np.int64), fp, most))
            yield block_row(int(key[0]), int(key[1]), number, fp)
            number += 1

        keys, fp = np.zeros((0, 2), np.int64), np.zeros(0, np.int64)
        for f in frames:
            keys, fp = np.concatenate([keys, f[["which", "agreed"]].to_numpy(np.int64)]), np.concatenate([fp, f["fp"].to_numpy(np.int64)])
            if not len(fp):
                continue
            start = int(np.argmax((keys == keys[-1]).all(axis=1)))  # the last key may go on in the next frame
            if start:
                yield from whole(keys[:start], fp[:start])
                keys, fp, number = keys[start:], fp[start:], 0
            while len(fp) > block:
                yield from piece(keys[0], fp[:block])
                keys, fp = keys[block:], fp[block:]
        if len(fp):
            yield from whole(keys, fp)

    pivots = len(PIVOTS)
    rows = keyed(distinct).repartition("which", "agreed").sortWithinPartitions("which", "agreed", "near", "fp").select("which", "agreed", "fp")
    found = keep(rows.mapInPandas(first, "a long, b long, which int, agreed long, number int, fps binary, low array<int>, high array<int>"), "pivot-links")
    own = found.filter("fps is null").select("a", "b")
    blocks = found.filter("fps is not null").select("which", "agreed", "number", "fps", "low", "high")
    apart = F.exists(F.sequence(F.lit(0), F.lit(pivots - 1)), lambda p: (F.get("x.low", p) - F.get("y.high", p) > most) | (F.get("y.low", p) - F.get("x.high", p) > most))
    pairs = blocks.alias("x").join(blocks.alias("y"), ["which", "agreed"]).filter(F.col("x.number") < F.col("y.number")).filter(~apart)

    def second(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for one, other in zip(f["one"], f["other"], strict=True):
                x, y = np.frombuffer(one, np.int64), np.frombuffer(other, np.int64)
                fp = np.concatenate([x, y])
                table = pivot_table(fp)
                # rows of a block are in order of their first distance: only a stretch of y can be near
                lo, hi = np.searchsorted(table[len(x) :, 0], table[: len(x), 0] - most), np.searchsorted(table[len(x) :, 0], table[: len(x), 0] + most, "right")
                many = hi - lo
                i = np.repeat(np.arange(len(x)), many)
                j = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many) + len(x)
                good = close(fp, table, i, j, most)
                yield spanning(fp, i[good], j[good])

    # a key's pairs of blocks are spread: each is a row of its own
    dealt = pairs.repartition(F.col("which"), F.col("agreed"), F.col("x.number"), F.col("y.number")).select(F.col("x.fps").alias("one"), F.col("y.fps").alias("other"))
    return own.unionByName(dealt.mapInPandas(second, "a long, b long"))


def classes(docs: DataFrame, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs``."""
    rows = keep(fingerprints(docs), "fingerprints")
    distinct = keep(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(keep(links(distinct.select("fp"), most, block).distinct(), "links")).select(F.col("doc_id").alias("fp"), "root")
    rooted = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
