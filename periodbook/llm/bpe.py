"""Byte-level BPE over a table of distinct words.

Words are the pieces that the tokenizer's own pre-tokenizer cuts a text into; BPE never merges
across them, so a text's ids are its words' ids in order. Three steps:

1. ``word_table``: split all texts in Spark and count the distinct words over the whole corpus;
   the most frequent ones (``hot_words`` at most, of up to ``hot_bytes`` bytes each, hence a broadcast
   of bounded size) are encoded, each of them once.
2. ``tokens``: split again and join the ids back by position. A word outside the table is encoded where
   a block of texts meets it first, once per block at most. (A table of all words, joined by
   a shuffle, costs more disk than it saves: see README. It would hold mostly words that occur once.)
3. ``decode``: ids are turned into bytes by a join with the id-to-piece table (the vocabulary, of
   fixed size) and read as UTF-8.

No text and no word position is shuffled, so no word, however frequent, makes a hot partition.

Cases: null text is empty and has no ids; ``<|endoftext|>`` within a text is the special token, as
the library has it; texts of any length are taken whole; repeated rows and null or repeated ids each
give a row; an empty table gives no rows; columns other than those named are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from periodbook.llm.common import batches, keep

# White space as Unicode's property has it, and the pre-tokenizer's pattern.
SPACES = "\t-\r \x85\xa0  -     　"
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = "<|endoftext|>"

CHUNK = re.compile(f"{re.escape(SPECIAL)}|[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
WORD = regex.compile(WORDS)
MEMO = 200_000
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def vocabulary_text(path: str | None = None) -> str:
    """The tokenizer file's text, for the driver to hand out; executors need no file."""
    with open(path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


@functools.cache
def vocabulary(spec: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    tokenizer = Tokenizer.from_str(spec)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@functools.cache
def pieces(spec: str) -> list[bytes]:
    """Bytes of each id: a byte-level vocabulary spells bytes 33-126, 161-172 and 174-255 as themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spelt = {chr(b): b for b in plain}
    spelt |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    tokenizer = vocabulary(spec)
    names = (tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size()))
    return [b"".join(bytes([spelt[c]]) if c in spelt else c.encode() for c in name) for name in names]


@functools.cache
def ranked(spec: str) -> tiktoken.Encoding | None:
    """The vocabulary for tiktoken, which merges whichever neighbours form the piece of the smallest id.

    That is the tokenizer's own order exactly where ids go up with the merges; other vocabularies give None.
    """
    model = json.loads(spec)["model"]
    merged = [m if isinstance(m, list) else m.split(" ", 1) for m in model["merges"]]
    order = [model["vocab"]["".join(m)] for m in merged]
    single = [i for name, i in model["vocab"].items() if len(name) == 1]
    plain = not model.get("dropout") and not model.get("ignore_merges") and len(single) == 256 and len(order) + 256 <= len(model["vocab"])
    if not plain or any(a >= b for a, b in zip([max(single), *order], order, strict=False)):
        return None
    look_up, added = pieces(spec), {x["id"] for x in json.loads(spec)["added_tokens"]}
    return tiktoken.Encoding("pieces", pat_str=WORDS, mergeable_ranks={p: i for i, p in enumerate(look_up) if i not in added}, special_tokens={})


def word_encoder(spec: str) -> Callable[[str], list[int]]:
    """The ids of a word."""
    fast, tokenizer = ranked(spec), vocabulary(spec)
    if fast is None:
        return lambda w: tokenizer.encode(w, add_special_tokens=False).ids
    one = fast._core_bpe.encode_single_piece
    return lambda w: tokenizer.encode(w, add_special_tokens=False).ids if w == SPECIAL else one(w.encode("utf-8", "surrogatepass"))


def encode_words(words: list[str], spec: str) -> list[list[int]]:
    """The ids of each word."""
    return list(map(word_encoder(spec), words))


def chunks(text: str) -> list[str]:
    """Runs of white space with the word after them: ends of chunks are always ends of words."""
    if SPECIAL not in text:
        return CHUNK.findall(text)
    found = []
    for i, part in enumerate(text.split(SPECIAL)):
        found += [SPECIAL] * (i > 0) + CHUNK.findall(part)
    return found


def words_of(chunk: str) -> list[str]:
    bare = chunk[1:] if chunk[0] == " " else chunk
    if (bare.isalpha() or bare.isdigit() and bare.isascii()) and (chunk.isascii() or max(chunk) < "\u0250"):
        return [chunk]  # most chunks: letters only, or digits only, as all versions of Unicode have them
    return [chunk] if chunk == SPECIAL else WORD.findall(chunk)


def word_counts(docs: DataFrame) -> DataFrame:
    """Distinct words of ``docs.text`` and how often they occur: (word, n)."""

    def words_in(seen: Counter) -> pd.DataFrame:
        words: Counter = Counter()
        for chunk, n in seen.items():
            for word in words_of(chunk):
                words[word] += n
        return pd.DataFrame({"word": list(words), "n": list(words.values())})

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for frame in frames:
            for t in frame["text"].tolist():
                if t:
                    seen.update(chunks(t))
                if len(seen) > 400_000:
                    yield words_in(seen)
                    seen = Counter()
        if seen:
            yield words_in(seen)

    return docs.select("text").mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def hot_cut(counts: DataFrame, most: int) -> int:
    """The least count that at most ``most`` words reach."""
    by_count = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).limit(most)
    cut, total = 1 << 62, 0
    for row in by_count.toLocalIterator():
        total += row.words
        if total > most:
            break
        cut = row.n
    return cut


def word_table(docs: DataFrame, spec: str, hot_words: int = 262_144, hot_bytes: int = 64) -> DataFrame:
    """(word, n, ids) of the ``hot_words`` most frequent words at most; words of equal counts stay or go together."""

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(ids=encode_words(frame["word"].tolist(), spec))

    # words seen once never pay for their place
    counts = keep(word_counts(docs).filter((F.octet_length("word") <= hot_bytes) & (F.col("n") > 1)), "bpe-words")
    return counts.filter(F.col("n") >= hot_cut(counts, hot_words)).mapInPandas(encode, "word string, n long, ids array<int>")


class Encoder(dict):
    """The ids of words and of chunks of text: the shared table's words always, others from when they are met.

    A word is a chunk of one word, so one dict holds both. Beyond ``MEMO`` others the dict starts anew and the
    last others are kept aside: what is used again comes back.
    """

    def __init__(self, table: dict[str, tuple], spec: str) -> None:
        super().__init__()
        self.encode, self.pieces = word_encoder(spec), pieces(spec)
        self.names = [str(i) for i in range(len(self.pieces))]
        self.table = {w: self.made(ids) for w, ids in table.items()}
        self.old: dict = {}
        self.update(self.table)

    def __missing__(self, chunk: str):
        found = self.old.get(chunk)
        if found is None:
            words = words_of(chunk)
            found = self.made(self.encode(chunk)) if len(words) == 1 else self.joined([self[w] for w in words])
        self[chunk] = found
        return found

    def trim(self) -> None:
        if len(self) > len(self.table) + MEMO:
            self.old = {k: v for k, v in self.items() if k not in self.table}
            self.clear()
            self.update(self.table)

    def made(self, ids):
        return tuple(ids)

    def joined(self, parts: list):
        return tuple(i for p in parts for i in p)


class Digester(Encoder):
    """As Encoder, with the ids written out and the bytes they decode to: (number of ids, ids, bytes)."""

    def made(self, ids):
        look_up, names = self.pieces, self.names
        return len(ids), ",".join([names[i] for i in ids]), b"".join([look_up[i] for i in ids])

    def joined(self, parts: list):
        numbers, ids, data = zip(*parts, strict=True)
        return sum(numbers), ",".join(ids), b"".join(data)


_ready: dict[type, tuple[str, Encoder]] = {}


def ready(kind: type, token: str, table, spec: str) -> Encoder:
    """The Python worker's encoder for the broadcast ``table``: made once, used by all tasks the worker gets."""
    if _ready.get(kind, ("",))[0] != token:
        _ready[kind] = token, kind(table.value, spec)
    return _ready[kind][1]


def _blocks(frames: Iterator[pd.DataFrame], encoder: Encoder) -> Iterator[tuple]:
    """Ids of numbers of rows, and for each row the encoder's findings for its chunks in order."""
    for frame in frames:
        texts, numbers = frame["text"].tolist(), frame["doc_id"]
        for a, b in batches(texts):
            encoder.trim()
            yield numbers.iloc[a:b], [list(map(encoder.__getitem__, chunks(t))) if t else [] for t in texts[a:b]]


def shared_table(docs: DataFrame, spec: str, hot_words: int):
    table = word_table(docs, spec, hot_words)
    return docs.sparkSession.sparkContext.broadcast({r.word: tuple(r.ids) for r in table.select("word", "ids").toLocalIterator()})


def tokens(docs: DataFrame, spec: str, hot_words: int = 262_144) -> DataFrame:
    """(doc_id, ids): the ids of each text in order."""
    table, token = shared_table(docs, spec, hot_words), uuid.uuid4().hex

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for numbers, found in _blocks(frames, ready(Encoder, token, table, spec)):
            yield pd.DataFrame({"doc_id": numbers, "ids": [[i for ids in row for i in ids] for row in found]})

    return docs.select("doc_id", "text").mapInPandas(rows, "doc_id long, ids array<int>")


def decode(rows: DataFrame, spec: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids): the pieces of the ids, joined and read as UTF-8; null ids give null."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        look_up = pieces(spec)
        for f in frames:
            texts = [None if x is None else b"".join([look_up[i] for i in x]).decode("utf-8", "replace") for x in f["ids"]]
            yield pd.DataFrame({"doc_id": f["doc_id"], "text": texts})

    return rows.select("doc_id", "ids").mapInPandas(run, "doc_id long, text string")


def digests(docs: DataFrame, spec: str, hot_words: int = 262_144) -> DataFrame:
    """Number of ids, and SHA-256 of the ids and of the text decoded from them, without passing either through the JVM."""
    table, token = shared_table(docs, spec, hot_words), uuid.uuid4().hex

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for numbers, found in _blocks(frames, ready(Digester, token, table, spec)):
            columns = [tuple(zip(*row, strict=True)) or ((), (), ()) for row in found]
            text = [b"".join(data).decode("utf-8", "replace").encode() for _, _, data in columns]
            yield pd.DataFrame({
                "doc_id": numbers,
                "n_tokens": [sum(n) for n, _, _ in columns],
                "ids_sha256": [hashlib.sha256(",".join(ids).encode()).hexdigest() for _, ids, _ in columns],
                "decoded_sha256": [hashlib.sha256(t).hexdigest() for t in text],
            })

    return docs.select("doc_id", "text").mapInPandas(rows, RESULT)
