"""Toxicity by a counterfactual-regularised classifier.

A logistic regression over hashed words is trained on a bounded sample of labelled texts
(``sample`` rows, those with the smallest hashes of their ids; all of them if there are fewer).
For every labelled sentence that names a group, a counterfactual twin is made by swapping each
identity term for the next one of its kind. Training adds the squared difference of twins' scores
to the loss, so that a group's mere mention gains no weight: neutral sentences are not flagged.

Cases: null and empty texts score as texts without words; null labels and labels without a text are
not learned from; without both classes among the labels every text gets the smoothed share of
toxic labels; repeated rows each give a row, but a repeated id is learned from once (its smallest text); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from periodbook.llm.common import batches, fold
from periodbook.llm.linear import BITS, Rows, features, fit, sigmoid, tokens

# Identity terms by kind; a term is swapped for the next one of its row.
IDENTITY = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"), ("she", "he"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "indigenous", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "queer"), ("transgender", "cisgender"),
    ("immigrants", "refugees", "natives", "foreigners"), ("disabled", "deaf", "blind"), ("young", "old", "elderly"),
    ("frauen", "männer"), ("christen", "muslime", "juden"), ("schwule", "lesben"),
    ("femmes", "hommes"), ("chrétiens", "musulmans", "juifs"), ("mujeres", "hombres"), ("cristianos", "musulmanes", "judíos"),
)
SENTENCE = re.compile(r"(?<=[.!?\n])\s+")


@dataclass(frozen=True)
class Toxicity:
    weights: np.ndarray
    bias: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        rows = Rows([features(tokens(t)) for t in texts], len(self.weights))
        return sigmoid(rows.dot(self.weights) + self.bias)


def swaps(groups: tuple[tuple[str, ...], ...] = IDENTITY) -> dict[str, str]:
    return {term: g[(i + 1) % len(g)] for g in groups for i, term in enumerate(g)}


def twin(words: list[str], swap: dict[str, str]) -> list[str] | None:
    """The words with every identity term swapped; None if there is none."""
    return [swap.get(w, w) for w in words] if any(w in swap for w in words) else None


def learning_rows(docs: DataFrame, labels: DataFrame, label: str, sample: int) -> DataFrame:
    """(doc_id, text, label) of at most ``sample`` labelled documents outside fold 0."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold(F.col("doc_id")) != 0))
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    few = known.orderBy(F.xxhash64("doc_id", F.lit(label)), "doc_id").limit(sample)
    # bounded by ``sample`` rows; a repeated id is learned from once, and is reduced before the shuffle
    return docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, sample: int = 8_000, sentences: int = 40_000, groups=IDENTITY, pair_weight: float = 1.0) -> Toxicity:
    """Learn from ``labels`` (doc_id, toxic); at most ``sentences`` twins are used, in the order of the sample."""
    swap = swaps(groups)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            own, was, now = [], [], []
            for text in f["text"]:
                own.append(features(tokens(text)))
                pairs = [(words, other) for s in SENTENCE.split(text or "") if (other := twin(words := tokens(s), swap))]
                was.append([features(a) for a, _ in pairs])
                now.append([features(b) for _, b in pairs])
            yield pd.DataFrame({"doc_id": f["doc_id"], "label": f["label"], "own": own, "was": was, "now": now})

    schema = "doc_id long, label int, own array<int>, was array<array<int>>, now array<array<int>>"
    got = learning_rows(docs, labels, "toxic", sample).mapInPandas(run, schema).toPandas().sort_values("doc_id")
    label = got["label"].to_numpy(np.float64)
    width = 1 << BITS
    if len(np.unique(label)) < 2:
        share = (label.sum() + 1) / (len(label) + 2)
        return Toxicity(np.zeros(width, np.float32), float(np.log(share / (1 - share))))
    was = [x for rows in got["was"] for x in rows][:sentences]
    now = [x for rows in got["now"] for x in rows][:sentences]
    w, b = fit(Rows(list(got["own"]), width), label, pairs=(Rows(was, width), Rows(now, width)), pair_weight=pair_weight)
    return Toxicity(w.astype(np.float32), b)


def score(docs: DataFrame, model: Toxicity) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``, from the whole text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            texts = f["text"].tolist()
            for a, b in batches(texts):
                p = shared.value.score(texts[a:b])
                yield pd.DataFrame({"doc_id": f["doc_id"].iloc[a:b], "score": p, "predicted": (p >= 0.5).astype(np.int32)})

    scored = docs.select("doc_id", "text").mapInPandas(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score", "predicted")
