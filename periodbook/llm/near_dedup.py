"""Near-duplicate classes by DartMinHash.

A text is a weighted set: its distinct shingles of five words, weighted by how often they occur.
Every element has a region whose width is its weight and whose other side is the rank. Darts are
thrown into it by hashes alone, as a Poisson process of one dart per unit of area, so equal elements
of different texts get equal darts. Widths are cut into layers [2^v - 1, 2^(v+1) - 1): within a layer
the darts come in the order of their ranks, and a dart counts only if it lands left of the weight.
Each dart names one of ``size`` coordinates; a coordinate keeps its earliest dart, whose identity is
the signature there. Two texts agree in a coordinate with probability equal to their weighted
Jaccard similarity, and a text costs about size * ln(size) darts however long it is.

Signatures are joined by bands. Texts with the same words are first reduced to one representative,
which has a number of its own (a doc_id may have several texts), so copies are never paired. In a bucket every member is compared, exactly, on
the texts, with one member that a hash picks, another one in each bucket and round; links within a component tell
nothing new, so later rounds compare only across components. What ``rounds`` such rounds leave in different components
is at last compared across components, block by block and by larger sketches first, so that no link found by the bands is lost, while a large group of
near copies costs a few comparisons per member and bucket. Classes are the connected components of the documents: the
texts of one doc_id belong together.

With 24 bands of 5, a pair of similarity 0.8 is missed with probability 0.00007, one of 0.9 never in practice.

Cases: null and empty texts, and texts of white space only, are each a class of their own; a text of
fewer than five words is a single shingle; rows with null doc_id get no class and are left out;
repeated rows and repeated ids give one row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodbook.llm.common import GOLDEN, batches, keep, mix, shingles, text_words, unit

SHINGLE = 5
SKETCH = 1_024


def _raw() -> Column:
    """Tells apart the texts of one doc_id."""
    return F.unhex(F.md5(F.col("text").cast("binary")))


def weighted_set(text: str | None, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles and their numbers of occurrences."""
    return np.unique(shingles(text_words(text), n), return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard: shared weight over joint weight."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][i], b[1][j]).sum()
    joint = a[1].sum() + b[1].sum() - shared
    return float(shared / joint) if joint else 0.0


def dart_signatures(element: np.ndarray, weight: np.ndarray, owner: np.ndarray, owners: int, size: int) -> np.ndarray:
    """Signatures (owners x size) of the weighted sets whose elements are given with their owner's number."""
    best_id = np.zeros(owners * size, np.uint64)
    total = np.bincount(owner, weight, owners)
    darts = size * np.log(size) + 2 * size
    todo = np.unique(owner)
    while len(todo):
        chosen = np.isin(owner, todo)
        e, x, o = element[chosen], weight[chosen].astype(np.float64), owner[chosen]
        keys, ranks, ids = [], [], []
        layer = 0
        while len(e):  # layers of weight
            low, width = 2.0**layer - 1, 2.0**layer
            with np.errstate(over="ignore"):
                stream = mix(e + GOLDEN * np.uint64(layer + 1))
            rank, own, limit, reach = np.zeros(len(e)), o, darts / total[o], (x - low) / width
            while len(stream):  # darts of the layer, by rank
                with np.errstate(over="ignore"):
                    stream = mix(stream + GOLDEN)
                rank = rank - np.log(unit(stream)) / width
                alive = rank < limit
                stream, rank, own, limit, reach = stream[alive], rank[alive], own[alive], limit[alive], reach[alive]
                inside = unit(mix(stream ^ np.uint64(0xA5A5A5A5A5A5A5A5))) <= reach
                ids.append(mix(stream[inside] ^ GOLDEN))
                keys.append(own[inside] * size + (ids[-1] % np.uint64(size)).astype(np.int64))
                ranks.append(rank[inside])
            layer += 1
            more = x > 2.0**layer - 1
            e, x, o = e[more], x[more], o[more]
        key, rank, dart = np.concatenate(keys), np.concatenate(ranks), np.concatenate(ids)
        best = np.full(owners * size, np.inf)
        np.minimum.at(best, key, rank)
        first = rank == best[key]
        best_id[key[first]] = dart[first]
        empty = np.isinf(best.reshape(owners, size)).any(axis=1)
        todo = todo[empty[todo]]
        darts *= 2  # a coordinate without a dart: throw further for those sets
    return best_id.reshape(owners, size)


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band; the band's number goes into it."""
    bands = signatures.shape[1] // rows
    out = np.zeros((len(signatures), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for r in range(rows):
            out = mix(out * GOLDEN + signatures[:, r : bands * rows : rows])
    return out.view(np.int64)


def signed(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """(doc_id, raw, same, keys) of every text with words: digests of the text and of its words, and its band keys."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts, numbers, raws = frame["text"].tolist(), frame["doc_id"].to_numpy(), frame["raw"].tolist()
            for a, b in batches(texts, 2_000_000):
                sets, digest, ids, raw = [], [], [], []
                for text, number, own in zip(texts[a:b], numbers[a:b], raws[a:b], strict=True):
                    if words := text_words(text):
                        sets.append(np.unique(shingles(words, SHINGLE), return_counts=True))
                        digest.append(xxhash.xxh3_128_digest(" ".join(words)))
                        ids.append(number)
                        raw.append(own)
                if not sets:
                    continue
                owner = np.repeat(np.arange(len(sets)), [len(s[0]) for s in sets])
                got = dart_signatures(np.concatenate([s[0] for s in sets]), np.concatenate([s[1] for s in sets]), owner, len(sets), bands * rows)
                yield pd.DataFrame({"doc_id": ids, "raw": raw, "same": digest, "keys": list(band_keys(got, rows))})

    return docs.select("doc_id", _raw().alias("raw"), "text").filter("doc_id is not null").mapInPandas(run, "doc_id long, raw binary, same binary, keys array<long>")


def verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Those of the pairs (a, b, ra, rb) whose texts reach the similarity."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, held = None, None
        for frame in frames:
            good = []
            for a, ta, tb in zip(frame["a"], frame["ta"], frame["tb"], strict=True):
                if a != last:
                    last, held = a, weighted_set(ta)
                good.append(similarity(held, weighted_set(tb)) >= least)
            yield frame.loc[good, ["a", "b", "ra", "rb"]]

    left = texts.select(F.col("rep").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("rep").alias("b"), F.col("text").alias("tb"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "ra", "rb", "ta", "tb").mapInPandas(run, "a long, b long, ra long, rb long")


def components(links: DataFrame) -> DataFrame:
    """(doc_id, root): the smallest member of each linked doc's component.

    Every doc points to its smallest neighbour, pointers are followed to their ends, and the links are
    drawn anew between those ends, each once, until none is left: the links get fewer in each pass.
    """
    known, edges = None, links
    while known is None or not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends = keep(both.groupBy(F.col("b").alias("doc_id")).agg(F.min("a").alias("m")).select("doc_id", F.least("doc_id", "m").alias("root")), "ends")
        moved = True
        while moved:
            further = ends.select(F.col("doc_id").alias("root"), F.col("root").alias("far"))
            step = keep(ends.join(further, "root").select("doc_id", F.col("far").alias("root"), (F.col("far") < F.col("root")).alias("moved")), "ends")
            moved, ends = not step.filter("moved").isEmpty(), step.select("doc_id", "root")
        if known is None:
            known = ends
        else:
            further = ends.select(F.col("doc_id").alias("root"), F.col("root").alias("far"))
            known = keep(known.join(further, "root", "left").select("doc_id", F.coalesce("far", "root").alias("root")), "roots")
        of_a = ends.select(F.col("doc_id").alias("a"), F.col("root").alias("ra"))
        of_b = ends.select(F.col("doc_id").alias("b"), F.col("root").alias("rb"))
        edges = keep(edges.join(of_a, "a").join(of_b, "b").filter("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
    return known


def sketched(texts: DataFrame) -> DataFrame:
    """(rep, sketch): ``SKETCH`` minima of each text's weighted set, a byte of each; shares of equal bytes estimate similarity."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        odd = mix(np.arange(1, SKETCH + 1, dtype=np.uint64)) | np.uint64(1)
        for f in frames:
            out = []
            for text in f["text"]:
                element, weight = weighted_set(text)
                # a weight of n is n elements: the shingle and its number among its repeats
                nth = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
                with np.errstate(over="ignore"):
                    units = mix(np.repeat(element, weight) + GOLDEN * nth.astype(np.uint64))
                    low = np.empty(SKETCH, np.uint64)
                    for j in range(SKETCH):
                        h = units * odd[j]
                        low[j] = (h ^ (h >> np.uint64(29))).min()
                out.append((mix(low) >> np.uint64(56)).astype(np.uint8).tobytes())
            yield pd.DataFrame({"rep": f["rep"], "sketch": out})

    return texts.select("rep", "text").mapInPandas(run, "rep long, sketch binary")


def across(open_: DataFrame, own: DataFrame, texts: DataFrame, least: float, block: int = 1_024) -> DataFrame:
    """Pairs (centre, rep), with their roots, that share a bucket of ``open_`` (key, rep, root), lie in different components and may reach ``least``.

    Buckets are compared block by block within tasks; only pairs whose sketches agree often enough
    leave them (4.5 standard deviations below ``least``), and only from the first bucket they share.
    """
    cut = least - 4.5 * (least * (1 - least) / SKETCH) ** 0.5

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for row in f.itertuples():
                x, y = row.left, row.right
                rep_x, rep_y = (np.array([m["rep"] for m in z]) for z in (x, y))
                root_x, root_y = (np.array([m["root"] for m in z]) for z in (x, y))
                keys_x, keys_y = (np.stack([m["keys"] for m in z]) for z in (x, y))
                sk_x, sk_y = (np.stack([np.frombuffer(m["sketch"], np.uint8) for m in z]) for z in (x, y))
                band = int(np.flatnonzero(keys_x[0] == row.key)[0])
                wanted = root_x[:, None] != root_y[None, :]
                if row.block == row.other:
                    wanted &= rep_x[:, None] < rep_y[None, :]
                for b in range(band):
                    wanted &= keys_x[:, b][:, None] != keys_y[:, b][None, :]
                i, j = np.nonzero(wanted)
                for k in range(0, len(i), 20_000):
                    a, b = i[k : k + 20_000], j[k : k + 20_000]
                    good = (sk_x[a] == sk_y[b]).mean(axis=1) >= cut
                    yield pd.DataFrame({"centre": rep_x[a[good]], "c_root": root_x[a[good]], "rep": rep_y[b[good]], "root": root_y[b[good]]})

    sketches = sketched(texts.join(open_.select("rep").distinct(), "rep", "left_semi"))
    sizes = open_.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    full = open_.join(sketches, "rep").join(own, "rep").join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
    # bounded: about ``block`` members each
    blocks = full.groupBy("key", "block", "blocks").agg(F.collect_list(F.struct("rep", "root", "keys", "sketch")).alias("left"))
    blocks = keep(blocks, "blocks")
    left = blocks.withColumn("other", F.explode(F.sequence("block", F.col("blocks") - 1)))
    right = blocks.select("key", F.col("block").alias("other"), F.col("left").alias("right"))
    return left.join(right, ["key", "other"]).select("key", "block", "other", "left", "right").mapInPandas(run, "centre long, c_root long, rep long, root long")


def text_classes(docs: DataFrame, least: float = 0.8, bands: int = 24, rows: int = 5, rounds: int = 3) -> tuple[DataFrame, DataFrame]:
    """Every text with words as (doc_id, raw, same, keys), and (same, root): the component of its words."""
    sign = keep(signed(docs, bands, rows), "darts")
    # a representative is a text, whatever doc_ids have it; it is numbered, and read from the first of them
    first = F.min(F.struct("doc_id", "raw")).alias("first")
    reps = keep(sign.groupBy("same").agg(first, F.first("keys").alias("keys")).select("same", "first.*", "keys", F.monotonically_increasing_id().alias("rep")), "reps")
    own = reps.select("rep", "keys")
    in_band = keep(own.select("rep", F.explode("keys").alias("key")).distinct(), "bands")
    several = in_band.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    shared = keep(in_band.join(several, "key"), "buckets")
    wanted = reps.join(shared.select("rep").distinct(), "rep", "left_semi").select("doc_id", "raw", "rep")
    texts = docs.select("doc_id", _raw().alias("raw"), "text").filter("text is not null").join(wanted, ["doc_id", "raw"]).select("rep", "text")
    texts = keep(texts.dropDuplicates(["rep"]), "texts")
    rooted = shared.select("key", "rep", F.col("rep").alias("root"))
    for r in range(rounds + 1):
        # buckets that still hold several components
        split = rooted.groupBy("key").agg(
            F.min("root").alias("lo"), F.max("root").alias("hi"), F.min_by(F.struct("rep", "root"), F.xxhash64("rep", "key", F.lit(r))).alias("c")
        ).filter("lo < hi").select("key", F.col("c.rep").alias("centre"), F.col("c.root").alias("c_root"))
        if r < rounds:
            pairs = rooted.join(split, "key").filter("root <> c_root").select("centre", "c_root", "rep", "root")
        else:
            pairs = across(keep(rooted.join(split.select("key"), "key"), "open"), own, texts, least)
        one, two = F.struct(F.col("centre").alias("n"), F.col("c_root").alias("r")), F.struct(F.col("rep").alias("n"), F.col("root").alias("r"))
        pairs = pairs.select(F.least(one, two).alias("x"), F.greatest(one, two).alias("y")).distinct()
        pairs = pairs.select(F.col("x.n").alias("a"), F.col("y.n").alias("b"), F.col("x.r").alias("ra"), F.col("y.r").alias("rb"))
        new = keep(verified(pairs, texts, least), "links")
        if new.isEmpty():
            continue
        # links between members are links between the components found so far, each once
        joined = components(new.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
        joined = joined.select(F.col("doc_id").alias("root"), F.col("root").alias("now"))
        rooted = keep(rooted.join(joined, "root", "left").select("key", "rep", F.coalesce("now", "root").alias("root")), "rooted")
    return sign, reps.select("same", "rep").join(rooted.select("rep", "root").distinct(), "rep", "left").select("same", F.coalesce("root", "rep").alias("root"))


def near_classes(docs: DataFrame, least: float = 0.8, bands: int = 24, rows: int = 5, rounds: int = 3) -> DataFrame:
    """One row per document (doc_id): (doc_id, class_id), the class being its smallest doc_id."""
    sign, roots = text_classes(docs, least, bands, rows, rounds)
    members = keep(sign.select("doc_id", "same").distinct().join(roots, "same").select("doc_id", "root").distinct(), "members")
    # the components of one doc_id's texts are one
    several = members.groupBy("doc_id").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("doc_id", "lo")
    met = keep(members.join(several, "doc_id").filter("root <> lo").select(F.col("lo").alias("a"), F.col("root").alias("b")).distinct(), "met")
    if not met.isEmpty():
        joined = components(met).select(F.col("doc_id").alias("root"), F.col("root").alias("now"))
        members = members.join(joined, "root", "left").select("doc_id", F.coalesce("now", "root").alias("root"))
    classes = members.join(members.groupBy("root").agg(F.min("doc_id").alias("class_id")), "root").select("doc_id", "class_id")
    lone = docs.select("doc_id").filter("doc_id is not null").select("doc_id", F.col("doc_id").alias("class_id"))
    return lone.unionByName(classes).groupBy("doc_id").agg(F.min("class_id").alias("class_id"))


def keep_one(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group of texts one row stays, that of the smallest doc_id.

    Texts are judged each on its own, also where they share a doc_id; of that doc_id's texts of a group the one with the
    smallest digest stays. Of rows with equal doc_id and text one stays, the first as JSON. Texts without words are no copies of others. Rows with null doc_id stay.
    """
    sign, roots = text_classes(docs, least)
    members = keep(sign.select("doc_id", "raw", "same").distinct().join(roots, "same").select("doc_id", "raw", "root"), "members")
    stays = members.groupBy("root").agg(F.min(F.struct("doc_id", "raw")).alias("first")).select("first.*")
    gone = members.join(stays, ["doc_id", "raw"], "left_anti").select(F.col("doc_id").alias("g_id"), F.col("raw").alias("g_raw"))
    # the row is one column, so its own columns may have any names
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    rows = rows.select("row", F.col("row").getField("doc_id").alias("id"), F.coalesce(F.unhex(F.md5(F.col("row").getField("text").cast("binary"))), F.lit(b"")).alias("raw"))
    left = rows.join(gone, (F.col("id") == F.col("g_id")) & (F.col("raw") == F.col("g_raw")), "left_anti")
    again = rows.filter("id is not null").groupBy("id", "raw").count().filter("count > 1").select("id", "raw")
    once = left.join(again, ["id", "raw"], "left_anti").select("row")
    several = left.join(again, ["id", "raw"], "left_semi").groupBy("id", "raw").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row")
    return once.unionByName(several).select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
