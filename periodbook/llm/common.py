"""Helpers that the operators of this package share."""

from __future__ import annotations

import math
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MASK = (1 << 64) - 1
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it; a local one only for local sessions."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # local-cluster has executors with folders of their own
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="llm-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, lost executors don't matter."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers above 0 and up to 1."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * (1.0 / (1 << 53))


def hashes(words: list[str]) -> np.ndarray:
    """64-bit hashes of strings, equal in every process."""
    if not words:
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False)


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` items of ``h``; empty when there are fewer."""
    count = len(h) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = out * GOLDEN + h[i : i + count]
    return mix(out)


def shingles(words: list[str], n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, repeats kept; a shorter text is one shingle, no words give none."""
    if not words:
        return np.zeros(0, np.uint64)
    return rolling(hashes(words), min(n, len(words)))


def text_words(text: str | None) -> list[str]:
    """Lower-case words as white space parts them; null has none."""
    return text.lower().split() if text else []


def batches(texts: list, chars: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Bounds of runs of rows that hold about ``chars`` characters each, so that memory stays bounded."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t) if t else 0
        if held >= chars:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def fold(column: Column, folds: int = 5) -> Column:
    """crc32 of an id's text, modulo ``folds``."""
    return F.crc32(column.cast("string").cast("binary")) % folds


def parts(rows: int, per_part: int) -> int:
    return max(1, math.ceil(rows / per_part))
