"""Interaction audit of five document filters over sorted posting lists.

What a filter costs depends on the filters before it. The audit counts, for every order of the five
filters and every part of the corpus, what each step removes and what it would have removed alone.

1. ``failures``: which filters each document fails, as bits (built-in expressions). A text's repeats
   are told by joining on (digest of the text, doc_id): a document whose id is the smallest with its
   text passes. Both columns are in the key, so a text with very many copies is no hot key.
2. ``postings``: failing documents are sorted by part and id and cut into ranges. A range holds, per
   part and filter, the sorted list of its failing ids (positions within the range), with running
   sums of the documents, good and toxic documents on it.
3. ``union_sums``: galloping k-way merges over these lists give the size of the union of every set of
   filters; a run of ids that only one list has is skipped in doubling steps and taken whole by its
   running sums. Sizes are summed over the ranges of a part.
4. A filter's removals after the filters S are the difference of two unions, |S with f| - |S|; all
   other counts follow from sizes of unions in the same way.

No list leaves its range: a part with a third of all rows is many ranges.

Cases: null text is empty, null lang is the part ``''``; a null doc_id has no smaller one and is
smaller than none, so it never fails as a repeat; a repeated row counts each time (rows with equal id, part and
text are one entry with a count); a document is good or toxic if any of its label rows says so, null labels say
nothing; no documents give no rows; columns of other names are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate, permutations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from periodbook.llm.common import keep, parts

FILTERS = "ABCDE"
REPEAT = 1 << FILTERS.index("E")
SIZES = ("docs", "good", "toxic")
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
ORDERS = ["".join(p) for p in permutations(FILTERS)]


def text_failures(text: Column) -> Column:
    """Bits of the filters that a text fails by itself: A few words, B repeated words, C capitals, D symbols."""
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n = F.size(words)
    fails = (
        n < 100,
        F.size(F.array_distinct(words)) * 100 < n * 80,
        F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.char_length(text) * 10,
        text.rlike("[#$%&*|]"),
    )
    bits = [F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)]
    return sum(bits[1:], bits[0])


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, doc_id, digest, fails, docs, good, toxic): one row per different (part, doc_id, text)."""
    has_lang = "lang" in docs.columns
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col("lang") if has_lang else F.lit(""), F.lit("")).alias("part"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        text_failures(text).alias("fails"),
    )
    entries = keep(rows.groupBy("part", "doc_id", "digest").agg(F.first("fails").alias("fails"), F.count(F.lit(1)).alias("docs")), "entries")
    firsts = entries.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    flag = lambda name: F.max(F.when(F.col(name) == 1, 1).otherwise(0)).alias(name)
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(flag("quality"), flag("toxic"))
    joined = entries.join(firsts, ["digest", "doc_id"], "left").join(known, "doc_id", "left")
    repeat = F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), REPEAT).otherwise(0)
    weight = lambda name: (F.col("docs") * F.coalesce(name, F.lit(0))).alias(name)
    return joined.select("part", "doc_id", "digest", (F.col("fails") + repeat).alias("fails"), "docs", weight("quality").alias("good"), weight("toxic"))


def gallop(ids: list[int], at: int, stop: int) -> int:
    """The first place from ``at`` on whose id is ``stop`` or more, found in doubling steps and a binary search."""
    step = 1
    while at + step < len(ids) and ids[at + step] < stop:
        step *= 2
    return bisect_left(ids, stop, at + step // 2, min(at + step, len(ids)))


def union_sums(lists: list[tuple[list[int], list[tuple]]]) -> list[int]:
    """Sums over the union of sorted lists, by a galloping k-way merge.

    Each list is (its ids, running sums over them for every measure: one longer than the list).
    """
    total = [0] * len(SIZES)
    open_ = [[ids, sums, 0] for ids, sums in lists if ids]
    while open_:
        low, stop = None, None
        for x in open_:  # the list with the smallest head, and the smallest head of the others
            head = x[0][x[2]]
            if low is None or head < low[0][low[2]]:
                low, stop = x, None if low is None else low[0][low[2]]
            elif stop is None or head < stop:
                stop = head
        ids, sums, at = low
        if stop is None:
            end = len(ids)
        elif ids[at] == stop:  # others have it as well: it is taken here, once
            end = at + 1
            for x in open_:
                if x is not low and x[0][x[2]] == stop:
                    x[2] += 1
        else:
            end = gallop(ids, at, stop)
        for k, s in enumerate(sums):
            total[k] += s[end] - s[at]
        low[2] = end
        open_ = [x for x in open_ if x[2] < len(x[0])]
    return total


def posting_lists(fails: list[int], weights: list[list[int]]) -> dict[int, tuple[list[int], list[tuple]]]:
    """For each filter the positions that fail it, with running sums of every measure."""
    out = {}
    for k in range(len(FILTERS)):
        ids = [i for i, f in enumerate(fails) if f >> k & 1]
        out[k] = ids, [(0, *accumulate(w[i] for i in ids)) for w in weights]
    return out


def union_sizes(failing: DataFrame, per_range: int = 50_000) -> DataFrame:
    """(part, filters, docs, good, toxic): sizes of the union of the lists of every non-empty set of filters, by bits."""
    ranges = failing.repartitionByRange(parts(failing.count(), per_range), "part", "doc_id", "digest").sortWithinPartitions("part", "doc_id", "digest")

    def piece(part: str, rows: list[pd.DataFrame]) -> pd.DataFrame:
        held = pd.concat(rows)
        lists = posting_lists(held["fails"].tolist(), [held[s].tolist() for s in SIZES])
        sets = range(1, 1 << len(FILTERS))
        sums = [union_sums([lists[k] for k in lists if s >> k & 1]) for s in sets]
        return pd.DataFrame({"part": part, "filters": list(sets)} | {name: [x[k] for x in sums] for k, name in enumerate(SIZES)})

    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, rows, held = None, [], 0
        for f in frames:
            for name, group in f.groupby("part", sort=False):
                if rows and (name != part or held >= per_range):
                    yield piece(part, rows)
                    rows, held = [], 0
                part, held = name, held + len(group)
                rows.append(group)
        if rows:
            yield piece(part, rows)

    sums = ranges.select("part", "fails", *SIZES).mapInPandas(merge, "part string, filters int, docs long, good long, toxic long")
    return sums.groupBy("part", "filters").agg(*(F.sum(s).alias(s) for s in SIZES))


def report(part: str, total: int, docs: list[int], good: list[int], toxic: list[int]) -> pd.DataFrame:
    """The rows of a part; ``docs[s]`` and so on are the sizes of the unions of the filters ``s``."""
    everything = len(docs) - 1
    rows, shapley = [], dict.fromkeys(FILTERS, 0)
    for order in ORDERS:
        before = 0
        for step, letter in enumerate(order, 1):
            own = 1 << FILTERS.index(letter)
            after = before | own
            removed = docs[after] - docs[before]
            shapley[letter] += removed
            rows.append((
                part, order, step, total - docs[after], removed, docs[own] - removed, docs[everything] - docs[everything ^ own],
                good[after] - good[before], toxic[after] - toxic[before],
            ))
            before = after
    out = pd.DataFrame(rows, columns=["part", "filter_order", "step", *COUNTS[:-1]])
    return out.assign(shapley=[shapley[o[s - 1]] for o, s in zip(out["filter_order"], out["step"], strict=True)])


def audit(docs: DataFrame, labels: DataFrame, per_range: int = 50_000) -> DataFrame:
    """(part, filter_order, step, counts) of every part, order of the filters and step."""
    rows = keep(failures(docs, labels), "failures")
    totals = rows.groupBy("part").agg(F.sum("docs").alias("total"))
    sizes = union_sizes(rows.filter("fails > 0"), per_range)
    # 31 rows a part by now
    named = sizes.groupBy("part").agg(F.collect_list(F.struct("filters", *SIZES)).alias("sizes"))

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for row in f.itertuples():
                by_set = {s: [0] * (1 << len(FILTERS)) for s in SIZES}
                for x in row.sizes if row.sizes is not None else ():
                    for s in SIZES:
                        by_set[s][x["filters"]] = int(x[s])
                yield report(row.part, int(row.total), *by_set.values())

    counts = ", ".join(f"{c} long" for c in COUNTS)
    return totals.join(named, "part", "left").select("part", "total", "sizes").mapInPandas(write, f"part string, filter_order string, step int, {counts}")
