"""Removal of repeated passages, by suffix automata over shards of reference passages.

A window is ``width`` consecutive words of one document. A word goes if a window that covers it also
starts earlier (in a smaller doc_id, or earlier in the same document). Windows are judged on the input.

All windows against automata of all documents would be quadratic, so automata are built only where
something repeats, and each passage meets one shard only:

1. Every window has an anchor: the run of ``ANCHOR`` words in it with the smallest hash. Equal windows
   have equal anchors at equal places. Anchors that occur once are out; this leaves few passages.
2. A reference passage is the run of windows that share an anchor. Equal passages are merged before
   the shuffle into one, with its earliest place, so a passage copied a million times is one row per
   task. Passages are dealt into shards by their anchor's hash; all passages that could share a
   window are in one shard. (Windows of an anchor that occurs more than ``HOT`` times are dealt by
   their own hash instead, so no shard grows with a frequent phrase.)
3. A shard's suffix automaton holds its passages; every state knows the earliest place of its
   strings. Passages are streamed through it, and the matching statistics tell for each
   window whether it is the first of its kind.
4. The windows of repeated anchors that are not first are covered; their words go.

Hashes only decide which passages meet; the automata compare words.

Cases: null texts have no words; rows with null doc_id are neither compared nor cut; texts below
``width`` words stay; several rows of one doc_id are judged each on its own, and equal windows of them that start
at the same place do not remove one another; an empty table gives no rows; other columns are kept by ``cut`` and
ignored by ``digests``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodbook.llm.common import batches, hashes, keep, parts, rolling

WIDTH = 20
ANCHOR = 8
HOT = 2_000
SPREAD = 1_000  # an anchor with more than this share's part of all rows is spread over ``SALTS`` keys
SALTS = 256
PLACE = 1 << 40


def split_words(text: str | None) -> list[bytes]:
    """Words in UTF-8, parted by the space and the characters 9 to 13."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def anchors(words: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each window's anchor starts, the anchors' hashes by start, and the windows' own hashes."""
    if len(words) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    h = hashes(words)
    grams = rolling(h, ANCHOR)
    span = width - ANCHOR + 1
    at = np.lib.stride_tricks.sliding_window_view(grams, span).argmin(axis=1) + np.arange(len(words) - width + 1)
    return at, grams, h


def runs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each run of windows with the same anchor."""
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return first, np.r_[first[1:], len(at)] - 1


class SuffixAutomaton:
    """Suffix automaton of several word sequences; ``place`` is the earliest place of a state's strings."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.size, self.place = [-1], [0], [None]

    def _state(self, size: int, place, edges: dict) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.size.append(size)
        self.place.append(place)
        return len(self.size) - 1

    def _split(self, p: int, symbol, q: int) -> int:
        """The part of state ``q`` that is one symbol longer than ``p``."""
        new = self._state(self.size[p] + 1, None, dict(self.next[q]))
        self.link[new], self.link[q] = self.link[q], new
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = new
            p = self.link[p]
        return new

    def add(self, words: list, place: int) -> None:
        """Add a sequence whose first word is at ``place``; a state keeps the smallest end of its strings."""
        last = 0
        for i, symbol in enumerate(words):
            end = place + i
            q = self.next[last].get(symbol)
            if q is not None:
                last = q if self.size[q] == self.size[last] + 1 else self._split(last, symbol, q)
                if self.place[last] is None or end < self.place[last]:
                    self.place[last] = end
                continue
            new = self._state(self.size[last] + 1, end, {})
            p = last
            while p >= 0 and symbol not in self.next[p]:
                self.next[p][symbol] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][symbol]
                self.link[new] = q if self.size[q] == self.size[p] + 1 else self._split(p, symbol, q)
            last = new

    def settle(self) -> None:
        """Pass the earliest places on to suffixes, longest strings first."""
        for s in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            up, own = self.link[s], self.place[s]
            if up > 0 and own is not None and (self.place[up] is None or own < self.place[up]):
                self.place[up] = own

    def earliest(self, words: list, width: int) -> Iterator[tuple[int, int]]:
        """Matching statistics of ``words``: for each end whose longest match has ``width`` words or more, the earliest end of those ``width`` words."""
        state, length = 0, 0
        for i, symbol in enumerate(words):
            while state and symbol not in self.next[state]:
                state = self.link[state]
                length = self.size[state]
            state, length = (self.next[state][symbol], length + 1) if symbol in self.next[state] else (0, 0)
            if length >= width:
                while self.size[self.link[state]] >= width:
                    state = self.link[state]
                    length = self.size[state]
                yield i, self.place[state]


def first_windows(frame: pd.DataFrame, width: int = WIDTH) -> pd.DataFrame:
    """Of one shard's passages (anchor, words, doc_id, start, mark): the starts of windows that are the first of their kind."""
    automaton, split = SuffixAutomaton(), []
    shared = frame["anchor"].duplicated(keep=False).to_numpy()
    for words, doc, start, several in zip(frame["words"], frame["doc_id"], frame["start"], shared, strict=True):
        split.append(words.split(b" "))
        if several:
            automaton.add(split[-1], doc * PLACE + start)
    automaton.settle()
    out = []
    for words, doc, start, mark, several in zip(split, frame["doc_id"], frame["start"], frame["mark"], shared, strict=True):
        place = doc * PLACE + start
        # a passage alone with its anchor meets nothing: all its windows are first
        ends = (e for e, first in automaton.earliest(words, width) if first == place + e) if several else range(width - 1, len(words))
        if starts := [start + e - width + 1 for e in ends]:
            out.append((doc, mark, starts))
    return pd.DataFrame(out, columns=["doc_id", "mark", "starts"])


def _packed(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, body): texts compressed for the shuffles to come; ``mark`` tells apart rows of one doc_id."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(3)
        for f in frames:
            yield pd.DataFrame({"doc_id": f["doc_id"], "mark": f["mark"], "body": [None if t is None else press.compress(t.encode("utf-8", "surrogatepass")) for t in f["text"]]})

    return docs.select("doc_id", F.xxhash64("text").alias("mark"), "text").mapInPandas(run, "doc_id long, mark long, body binary")


def _body(body: bytes | None) -> str | None:
    return None if body is None else zstandard.ZstdDecompressor().decompress(body).decode("utf-8", "surrogatepass")


def repeated_anchors(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, mark, at): starts of the text's anchors that occur more than once anywhere, doubled, plus 1 if the anchor is hot; equal rows are one."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts, numbers, marks = f["text"].tolist(), f["doc_id"].to_numpy(), f["mark"].to_numpy()
            for a, b in batches(texts):
                hs, starts, sizes = [], [], []
                for text in texts[a:b]:
                    at, grams, _ = anchors(split_words(text), width)
                    at = np.unique(at)
                    hs.append(grams[at])
                    starts.append(at)
                    sizes.append(len(at))
                yield pd.DataFrame({
                    "anchor": np.concatenate(hs).view(np.int64), "doc_id": np.repeat(numbers[a:b], sizes), "mark": np.repeat(marks[a:b], sizes), "start": np.concatenate(starts).astype(np.int32),
                })

    rows = docs.select("doc_id", F.xxhash64("text").alias("mark"), "text").filter("doc_id is not null and text is not null")
    found = rows.mapInPandas(run, "anchor long, doc_id long, mark long, start int")
    often = keep(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "often")
    total = often.agg(F.sum("n")).first()[0] or 0
    # bounded: fewer than ``SPREAD`` anchors can have more than one in ``SPREAD`` of all; the rows of these meet their flag under many salts
    very = often.filter(F.col("n") * SPREAD > total).select("anchor", F.lit(True).alias("very"))
    often = often.join(F.broadcast(very), "anchor", "left").select(
        "anchor", (F.col("n") > HOT).cast("int").alias("hot"), F.explode(F.when(F.col("very"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt")
    )
    salt = F.when(F.col("very"), F.pmod(F.xxhash64("doc_id", "mark", "start"), F.lit(SALTS)).cast("int")).otherwise(0).alias("salt")
    dealt = found.join(F.broadcast(very), "anchor", "left").select("anchor", "doc_id", "mark", "start", salt)
    return dealt.join(often, ["anchor", "salt"]).groupBy("doc_id", "mark").agg(F.collect_set((F.col("start") * 2 + F.col("hot"))).alias("at"))


def passages(docs: DataFrame, repeats: DataFrame, width: int = WIDTH) -> DataFrame:
    """Distinct reference passages (anchor, words) with their earliest place (doc_id, start, mark)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for number, mark, body, marked in zip(f["doc_id"], f["mark"], f["body"], f["at"], strict=True):
                words = split_words(_body(body))
                at, grams, h = anchors(words, width)
                if not len(at):
                    continue
                hot = dict.fromkeys(np.asarray(marked) >> 1, 0) | {x >> 1: 1 for x in marked if x & 1}
                own = None
                for a, z in zip(*runs(at), strict=True):
                    anchor = at[a]
                    if anchor not in hot:
                        continue
                    if not hot[anchor]:
                        rows.append((grams[anchor].view(np.int64), b" ".join(words[a : z + width]), number, a, mark))
                        continue
                    own = rolling(h, width) if own is None else own
                    rows += [(own[s].view(np.int64), b" ".join(words[s : s + width]), number, s, mark) for s in range(a, z + 1)]
            yield pd.DataFrame(rows, columns=["anchor", "words", "doc_id", "start", "mark"])

    joined = docs.join(repeats, ["doc_id", "mark"]).select("doc_id", "mark", "body", "at")
    found = joined.mapInPandas(run, "anchor long, words binary, doc_id long, start int, mark long")
    place = F.min(F.struct("doc_id", "start", "mark")).alias("p")
    return found.groupBy("anchor", "words").agg(place).select("anchor", "words", "p.*")


def _kept(words: list[bytes], at: np.ndarray, marked, first, width: int) -> np.ndarray:
    """Which words stay."""
    keep_ = np.ones(len(words), bool)
    if marked is None or not len(at):
        return keep_
    covered = np.isin(at, np.asarray(marked) >> 1)
    if first is not None:
        for starts in first:
            covered[np.asarray(starts)] = False
    edge = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(covered)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return np.cumsum(edge[:-1]) == 0


def judged(docs: DataFrame, width: int = WIDTH, per_shard: int = 4_000) -> DataFrame:
    """(doc_id, mark, body, at, firsts) of every row of ``docs`` (doc_id, text)."""
    packed = _packed(docs)
    repeats = keep(repeated_anchors(docs, width), "anchors")
    known = keep(passages(packed.filter("doc_id is not null"), repeats, width), "passages")
    shards = parts(known.count(), per_shard)
    firsts = (
        known.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).groupBy("shard")
        .applyInPandas(lambda f: first_windows(f, width), "doc_id long, mark long, starts array<int>")
        .groupBy("doc_id", "mark").agg(F.collect_list("starts").alias("firsts"))
        .select(F.col("doc_id").alias("f_id"), F.col("mark").alias("f_mark"), "firsts")
    )
    joined = packed.join(repeats, ["doc_id", "mark"], "left")
    return joined.join(firsts, (F.col("doc_id") == F.col("f_id")) & (F.col("mark") == F.col("f_mark")), "left").select("doc_id", "mark", "body", "at", "firsts")


def digests(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row of ``docs``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for body, marked, first in zip(f["body"], f["at"], f["firsts"], strict=True):
                words = split_words(_body(body))
                stay = _kept(words, anchors(words, width)[0] if marked is not None else np.zeros(0), marked, first, width)
                left = b" ".join(words if stay.all() else [w for w, s in zip(words, stay, strict=True) if s])
                out.append((len(words), int((~stay).sum()), hashlib.sha256(left).hexdigest()))
            yield pd.DataFrame(out, columns=["n_words", "n_removed", "kept_sha256"]).assign(doc_id=f["doc_id"].to_numpy())[["doc_id", "n_words", "n_removed", "kept_sha256"]]

    return judged(docs, width).mapInPandas(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def cut(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` with repeated passages cut out of ``text``; the words that stay are joined by one space where something was cut.

    ``n_chars`` follows where the column exists. A text of which nothing stays is empty.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts = []
            for body, marked, first in zip(f["body"], f["at"], f["firsts"], strict=True):
                text = _body(body)
                words = split_words(text)
                stay = _kept(words, anchors(words, width)[0] if marked is not None else np.zeros(0), marked, first, width)
                texts.append(text if stay.all() else b" ".join([w for w, s in zip(words, stay, strict=True) if s]).decode("utf-8", "surrogatepass"))
            yield f.drop(columns=["body", "at", "firsts"]).assign(new_text=texts)

    judged_rows = judged(docs, width).filter("at is not null").mapInPandas(run, "doc_id long, mark long, new_text string")
    changed = judged_rows.distinct().select(F.col("doc_id").alias("c_id"), F.col("mark").alias("c_mark"), "new_text")
    # the row is one column, so its own columns may have any names
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    own = lambda c: F.col("row").getField(c)
    joined = rows.join(changed, (own("doc_id") == F.col("c_id")) & (F.xxhash64(own("text")) == F.col("c_mark")), "left")
    new = {"text": F.coalesce("new_text", own("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("new_text").isNull(), own("n_chars")).otherwise(F.char_length("new_text")).cast(docs.schema["n_chars"].dataType)
    return joined.select(*(new.get(c, own(c)).alias(c) for c in docs.columns))
