"""Benchmark items inside documents, by size-partitioned MinHash containment search.

Items are short and documents long, so a plain MinHash comparison of the two would drown the item in
the document. Items are therefore partitioned by size (their number of distinct shingles, in powers
of two), and for each size class a document is read in windows of twice that size that overlap by
half: wherever an item stands, some window holds it whole, and contained shingles make up a fair
share of the two (a fifth at least when four fifths of the item are there). Each of ``hashes`` minima
of a window is a key of its own (bands of one), so such an item is missed with a probability of
(4/5)^64 = 6e-7 at most.

A bitmap of the items' keys (of fixed size, so its broadcast is bounded) drops keys that no item has;
the rest is joined with the items by key. Candidates are verified on the texts: an item is reported
if the share of its shingles that occur in the document reaches ``least``. Equal texts are verified
once, so copies do not multiply the work.

Words are lower-case, as white space parts them; shingles have five words. Cases: items of fewer
words are one shingle of all their words; null, empty or blank items and texts match nothing; rows
with null doc_id are reported like others; repeated items and documents are reported once per
(doc_id, item_id); empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodbook.llm.common import GOLDEN, batches, hashes, keep, mix, rolling, text_words

SHINGLE = 5
HASHES = 64
BITS = 24


def size_class(words: list[str]) -> tuple[int, int] | None:
    """Words per shingle, and the class's largest size."""
    if not words:
        return None
    n = min(SHINGLE, len(words))
    size = len({tuple(words[i : i + n]) for i in range(len(words) - n + 1)})
    return n, 1 << (size - 1).bit_length()


def minima(runs: list[np.ndarray], block: int, kind: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys (windows x HASHES) of the windows of two blocks, and the run each window is of; a run of one block is one window.

    ``runs`` are the shingles of several texts; they are hashed together, windows stay within their text.
    """
    sizes = np.array([len(r) for r in runs], np.int64)
    blocks = -(-sizes // block)
    owner = np.repeat(np.arange(len(runs)), blocks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    starts = np.repeat(np.cumsum(sizes) - sizes, blocks) + nth * block
    last = np.r_[owner[1:] != owner[:-1], True] if len(owner) else np.zeros(0, bool)
    first = np.flatnonzero(~last | (nth == 0))  # every block but a text's last begins a window, as does a lone one
    second = np.where(last[first], first, first + 1)
    odd = mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
    out = np.empty((len(first), HASHES), np.uint64)
    if not len(first):
        return out, owner[first]
    shingle = np.concatenate(runs)
    h, other = np.empty_like(shingle), np.empty_like(shingle)
    with np.errstate(over="ignore"):
        for j in range(HASHES):
            np.multiply(shingle, odd[j], out=h)
            np.right_shift(h, np.uint64(32), out=other)
            np.bitwise_xor(h, other, out=h)
            low = np.minimum.reduceat(h, starts)
            out[:, j] = np.minimum(low[first], low[second])
        return mix(out + GOLDEN * (odd ^ np.uint64(kind[0] * 64 + kind[1].bit_length()))), owner[first]


def bits(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << BITS) - 1)
    return (keys & mask).astype(np.int64), ((keys >> np.uint64(BITS)) & mask).astype(np.int64)


def item_keys(items: DataFrame) -> DataFrame:
    """(item_id, n, size, keys): class and keys of each item with words."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for number, text in zip(f["item_id"], f["text"], strict=True):
                words = text_words(text)
                if kind := size_class(words):
                    shingle = rolling(hashes(words), kind[0])
                    out.append((number, *kind, minima([shingle], len(shingle), kind)[0][0].view(np.int64)))
            yield pd.DataFrame(out, columns=["item_id", "n", "size", "keys"])

    return items.select("item_id", "text").filter("item_id is not null").mapInPandas(run, "item_id long, n int, size int, keys array<long>")


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Bits of all item keys: at most 2^BITS / 64 words come to the driver."""
    slots = keys.select(F.explode("keys").alias("k")).select(F.explode(F.array(
        F.col("k").bitwiseAND((1 << BITS) - 1), F.shiftrightunsigned("k", BITS).bitwiseAND((1 << BITS) - 1)
    )).alias("slot"))
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")).toPandas()
    out = np.zeros((1 << BITS) >> 6, np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def contained(docs: DataFrame, items: DataFrame, least: float = 0.8) -> DataFrame:
    """(doc_id, item_id, containment) of every item whose share of shingles in a document reaches ``least``."""
    spark = docs.sparkSession
    indexed = keep(item_keys(items), "item-keys")
    kinds = sorted((r.n, r.size) for r in indexed.select("n", "size").distinct().collect())  # 5 + log2(longest item) at most
    shared = spark.sparkContext.broadcast((kinds, _bitmap(indexed)))

    def hits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kinds, bitmap = shared.value
        for f in frames:
            texts = f["text"].tolist()
            for a, b in batches(texts):
                numbers, part = f["doc_id"].iloc[a:b].tolist(), texts[a:b]
                words = [hashes(text_words(t)) for t in part]
                found: list[list[np.ndarray]] = [[] for _ in part]
                for n, size in kinds:
                    keys, owner = minima([rolling(w, n) for w in words], size, (n, size))
                    one, two = bits(keys)
                    window, hash_ = np.nonzero(bitmap[one] & bitmap[two])
                    for w, j in zip(window, hash_, strict=True):
                        found[owner[w]].append(keys[w, j])
                out = [(numbers[i], xxhash.xxh3_128_digest(part[i]), part[i], np.unique(np.array(k, np.uint64)).view(np.int64)) for i, k in enumerate(found) if k]
                yield pd.DataFrame(out, columns=["doc_id", "same", "text", "keys"])

    found = keep(docs.select("doc_id", "text").filter("text is not null").mapInPandas(hits, "doc_id long, same binary, text string, keys array<long>"), "hits")
    once = found.groupBy("same").agg(F.min("doc_id").alias("first"))
    texts = keep(found.join(once.withColumnRenamed("same", "s"), (F.col("same") == F.col("s")) & F.col("doc_id").eqNullSafe(F.col("first"))).select("same", "text", "keys").dropDuplicates(["same"]), "texts")
    by_key = indexed.select("item_id", F.explode("keys").alias("key"))
    pairs = texts.select("same", F.explode("keys").alias("key")).join(by_key, "key").select("same", "item_id").distinct()
    named = items.select("item_id", F.col("text").alias("item")).filter("item_id is not null and item is not null").distinct()

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, sets = None, {}
        for f in frames:
            share = []
            for same, text, item in zip(f["same"], f["text"], f["item"], strict=True):
                if same != last:
                    last, words, sets = same, text_words(text), {}
                wanted = text_words(item)
                n = min(SHINGLE, max(len(wanted), 1))
                if n not in sets:
                    sets[n] = set(zip(*(words[i:] for i in range(n)), strict=False))
                own = set(zip(*(wanted[i:] for i in range(n)), strict=False))
                share.append(len(own & sets[n]) / len(own) if own else 0.0)
            yield pd.DataFrame({"same": f["same"], "item_id": f["item_id"], "containment": share})

    checked = pairs.join(named, "item_id").join(texts.select("same", "text"), "same").select("same", "item_id", "text", "item")
    good = checked.mapInPandas(verify, "same binary, item_id long, containment double").filter(F.col("containment") >= least)
    good = good.groupBy("same", "item_id").agg(F.max("containment").alias("containment"))
    return found.select("doc_id", "same").join(good, "same").groupBy("doc_id", "item_id").agg(F.max("containment").alias("containment"))


def without_items(docs: DataFrame, items: DataFrame, least: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that hold no item; rows with null doc_id stay."""
    held = contained(docs, items, least).select("doc_id").distinct()
    return docs.join(held, "doc_id", "left_anti").select(*(docs[c] for c in docs.columns))
