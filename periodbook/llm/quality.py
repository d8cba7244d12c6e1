"""Document quality by co-training of two views.

The content view sees the text: its distinct words and the shape of the text (shares of letters,
capitals, digits and symbols, repeated words and lines, word lengths), each shape cut into fixed
steps. The metadata view sees language, source and length, as one would know them of a page without
its text. Both start from a bounded sample of labelled documents; over ``rounds`` each view labels
an unlabelled pool (bounded as well) and hands the other the ``exchange`` documents of each class it
is surest of, in the proportion of the classes. At the end each view is calibrated on labelled
documents kept aside, the two calibrated views are weighed against each other there, and every
document is scored. A document is rejected if its score is below ``least``.

Bounds: ``sample`` labelled and ``pool`` unlabelled documents, those with the smallest hashes of
their ids; fewer if there are fewer. They are fitted in one task; only the weights come to the driver.

Cases: null and empty texts are texts without words; null metadata is a value of its own, as is a
missing column; null labels are not learned from; without both classes among the labels everything gets the
smoothed share of good labels; repeated rows are each kept or rejected, but a repeated id is learned from once; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodbook.llm.common import batches, hashes
from periodbook.llm.linear import BITS, Rows, calibrate, features, fit, sigmoid, tokens

META = ("lang", "source", "n_chars")


# what a code point is: 0 other, 1 space, 2 letter, 3 capital, 4 digit; beyond the table all count as letters
KINDS = np.array([1 if c.isspace() else 3 if c.isupper() else 2 if c.isalpha() else 4 if c.isdigit() else 0 for c in map(chr, range(0x3100))], np.uint8)


def shape(text: str | None) -> list[str]:
    """Steps of the text's shape, as names of features."""
    if not text:
        return ["empty"]
    code = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    kind = np.where(code < len(KINDS), KINDS[np.minimum(code, len(KINDS) - 1)], 2)
    other, space, lower, upper, digit = np.bincount(kind, minlength=5)[:5]
    ink = max(len(code) - space, 1)
    counted = Counter(text.split())
    n = max(counted.total(), 1)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    ends = int(((kind[:-1] == 0) & (kind[1:] == 1)).sum()) + int(kind[-1] == 0)
    ratios = {
        "symbols": other / ink,
        "upper": upper / max(lower + upper, 1),
        "digits": digit / ink,
        "distinct": len(counted) / n,
        "lines": len(set(lines)) / max(len(lines), 1),
        "top": max(counted.values(), default=0) / n,
        "ended": ends / n,
    }
    named = [f"{k}={min(int(math.sqrt(v) * 25), 25)}" for k, v in ratios.items()]
    return [*named, f"long={int(2 * math.log2(n))}", f"mean={min(int(2 * ink / n), 60)}", f"per={int(math.log2(n / max(len(lines), 1) + 1) * 2)}"]


def content_view(text: str | None) -> np.ndarray:
    own = hashes([f"shape {x}" for x in shape(text)]) >> np.uint64(64 - BITS)
    return np.union1d(features(tokens(text)), own.astype(np.int32))


def meta_view(lang, source, n_chars) -> np.ndarray:
    """Features of what is known of a page without its text."""
    size = "none" if n_chars is None or n_chars != n_chars else str(int(2 * math.log2(max(n_chars, 0) + 1)))
    named = [f"lang {lang}", f"source {source}", f"size {size}", f"lang {lang} size {size}", f"source {source} lang {lang}"]
    return np.unique(hashes(named) >> np.uint64(64 - BITS)).astype(np.int32)


@dataclass(frozen=True)
class Quality:
    content: tuple[np.ndarray, float]
    meta: tuple[np.ndarray, float]
    mixing: tuple[float, float, float]  # weight of each view's log odds, and shift

    def score(self, content: list[np.ndarray], meta: list[np.ndarray]) -> np.ndarray:
        c = Rows(content, 1 << BITS).dot(self.content[0]) + self.content[1]
        m = Rows(meta, 1 << BITS).dot(self.meta[0]) + self.meta[1]
        return sigmoid(self.mixing[0] * c + self.mixing[1] * m + self.mixing[2])


def cotrain(content: list, meta: list, label: np.ndarray, pool_content: list, pool_meta: list, rounds: int = 3, exchange: int = 500) -> Quality:
    """``label`` is 1, 0 of the labelled rows; every fourth of them is kept aside for calibration."""
    width = 1 << BITS
    if len(np.unique(label)) < 2:
        share = (label.sum() + 1) / (len(label) + 2)
        none = (np.zeros(width, np.float32), 0.0)
        return Quality(none, none, (0.0, 0.0, float(np.log(share / (1 - share)))))
    aside = np.zeros(len(label), bool)
    for value in (0, 1):  # both classes are in both parts wherever there are two rows of them
        aside[np.flatnonzero(label == value)[1::4]] = True
    known, n = len(label), len(label) + len(pool_content)
    # one array per view: labelled rows, then the pool; a fit takes the rows it may see out of it
    views = {"content": Rows([*content, *pool_content], width), "meta": Rows([*meta, *pool_meta], width)}
    taught: dict[str, dict[int, int]] = {"content": {}, "meta": {}}  # pool row: pseudo-label
    models = {}
    share = label[~aside].mean()
    for r in range(rounds + 1):
        for view, rows in views.items():
            y, trust = np.zeros(n), np.zeros(n)
            y[:known], trust[:known] = label, ~aside
            if taught[view]:
                at = known + np.array(list(taught[view]))
                y[at], trust[at] = list(taught[view].values()), 0.3
            seen = trust > 0
            models[view] = fit(rows.of(seen), y[seen], importance=trust[seen])
        if r == rounds or not len(pool_content):
            break
        for view, other in (("content", "meta"), ("meta", "content")):
            z = (views[view].dot(models[view][0]) + models[view][1])[known:]
            order = np.argsort(z, kind="stable")
            sure = [(i, 1) for i in order[::-1][: int(exchange * share)] if sigmoid(z[i]) >= 0.9]
            sure += [(i, 0) for i in order[: int(exchange * (1 - share))] if sigmoid(z[i]) <= 0.1]
            taught[other].update({int(i): y for i, y in sure})
    held = np.flatnonzero(aside)
    odds = {}
    for view, rows in views.items():
        z = (rows.dot(models[view][0]) + models[view][1])[held]
        odds[view] = (z, *calibrate(z, label[held]))
    if len(np.unique(label[held])) < 2:
        return Quality(*((w.astype(np.float32), b) for w, b in models.values()), (1.0, 0.0, 0.0))
    cal = {v: a * z + b for v, (z, a, b) in odds.items()}
    # weigh the calibrated views: the share of the content view with the least loss on the rows kept aside
    loss = lambda p: -np.mean(label[held] * np.log(p) + (1 - label[held]) * np.log(1 - p))
    best = min((loss(np.clip(sigmoid(k * cal["content"] + (1 - k) * cal["meta"]), 1e-9, 1 - 1e-9)), -k) for k in np.linspace(0, 1, 21))[1] * -1
    _, ac, bc = odds["content"]
    _, am, bm = odds["meta"]
    mixing = (best * ac, (1 - best) * am, best * bc + (1 - best) * bm)
    return Quality(*((w.astype(np.float32), b) for w, b in models.values()), tuple(map(float, mixing)))


def viewed(docs: DataFrame) -> DataFrame:
    """doc_id, text and metadata; columns that ``docs`` lacks are null."""
    has = set(docs.columns)
    col = lambda c, kind: (F.col(c) if c in has else F.lit(None)).cast(kind).alias(c)
    return docs.select("doc_id", "text", col("lang", "string"), col("source", "string"), col("n_chars", "long"))


def _views(frame: pd.DataFrame) -> tuple[list, list]:
    return [content_view(t) for t in frame["text"]], [meta_view(*x) for x in zip(*(frame[c] for c in META), strict=True)]


def train(docs: DataFrame, labels: DataFrame, sample: int = 8_000, pool: int = 4_000) -> Quality:
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("label"))
    by_hash = lambda df, n: df.orderBy(F.xxhash64("doc_id", F.lit("quality")), "doc_id").limit(n)
    # both are bounded, by ``sample`` and ``pool``
    few = by_hash(known, sample)
    unlabelled = by_hash(docs.select("doc_id").filter("doc_id is not null").join(known, "doc_id", "left_anti"), pool)
    chosen = few.unionByName(unlabelled.select("doc_id", F.lit(None).cast("int").alias("label")).distinct())

    def view(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            content, meta = ([x.astype(np.int32).tobytes() for x in v] for v in _views(f))
            yield pd.DataFrame({"doc_id": f["doc_id"], "label": f["label"], "content": content, "meta": meta})

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The fit, in one task: the driver only gets the weights."""
        got = pd.concat([pd.DataFrame(columns=["doc_id", "label", "content", "meta"]), *(f for f in frames if len(f))])
        got = got.sort_values("doc_id", kind="stable")
        known_rows = got["label"].notna().to_numpy()
        label = got["label"].to_numpy()[known_rows].astype(np.float64)
        content, meta = ([np.frombuffer(x, np.int32) for x in got[c]] for c in ("content", "meta"))
        pick = lambda rows, wanted: [x for x, w in zip(rows, known_rows, strict=True) if w == wanted]
        m = cotrain(pick(content, True), pick(meta, True), label, pick(content, False), pick(meta, False))
        yield pd.DataFrame({
            "content": [m.content[0].astype(np.float32).tobytes()], "content_bias": [m.content[1]],
            "meta": [m.meta[0].astype(np.float32).tobytes()], "meta_bias": [m.meta[1]], "mixing": [list(m.mixing)],
        })

    # a repeated id is learned from once, and is reduced before the shuffle
    once = viewed(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct("text", *META)).alias("row")).select("doc_id", "label", "row.*")
    viewed_rows = once.mapInPandas(view, "doc_id long, label int, content binary, meta binary")
    row = viewed_rows.repartition(1).mapInPandas(learn, "content binary, content_bias double, meta binary, meta_bias double, mixing array<double>").first()
    weights = lambda b: np.frombuffer(b, np.float32)
    return Quality((weights(row.content), row.content_bias), (weights(row.meta), row.meta_bias), tuple(row.mixing))


def score(docs: DataFrame, model: Quality, least: float = 0.35) -> DataFrame:
    """(doc_id, score, kept) of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for a, b in batches(f["text"].tolist()):
                part = f.iloc[a:b]
                p = shared.value.score(*_views(part))
                yield pd.DataFrame({"doc_id": part["doc_id"], "score": p, "kept": p >= least})

    return viewed(docs).mapInPandas(run, "doc_id long, score double, kept boolean")


def keep_good(docs: DataFrame, model: Quality, least: float = 0.35) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches ``least``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            seen = f if set(META) <= set(f.columns) else f.reindex(columns=[*f.columns, *(c for c in META if c not in f.columns)])
            for a, b in batches(f["text"].tolist()):
                yield f.iloc[a:b][shared.value.score(*_views(seen.iloc[a:b])) >= least]

    return docs.mapInPandas(run, docs.schema)
