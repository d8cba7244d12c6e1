"""Filter audit, SimHash classes and hard negatives against brute force, odd rows included."""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from checks import compare
from periodbook.llm import filter_audit, pivot_simhash, queries, segment_negatives

ODD = [(None, None), (None, "lone words here"), (900, None), (901, ""), (902, " \n\t\x0b "), (903, "one"), (904, "same row"), (904, "same row"), (905, "long " * 30_000), (906, "same row"), (907, "\xa0é x y"), (-3, "same row")]


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.mark.parametrize("name", ["op11_filter_audit", "op13_segment_negatives"])
def test_queries_match_their_oracles(spark, duck, sf_dir, name):
    assert compare.differences(queries.QUERIES[name](spark, sf_dir), duck, queries.ORACLE[name]) == []


def audited(rows, labels):
    """The contract, document by document."""
    first, total = {}, Counter()
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    masks = []
    for i, t, lang in rows:
        t = t or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        fails = {
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and t in first and first[t] < i,
        }
        masks.append((lang or "", fails, any(d == i and i is not None and q == 1 for d, q, _ in labels), any(d == i and i is not None and x == 1 for d, _, x in labels)))
        total[lang or ""] += 1
    out = {}
    for part in total:
        own = [m for m in masks if m[0] == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [m for m in left if m[1][letter]]
                shapley[letter] += len(gone)
                kept = [m for m in left if not m[1][letter]]
                out[part, "".join(order), step] = [
                    len(kept), len(gone), sum(m[1][letter] for m in own) - len(gone),
                    sum(m[1][letter] and sum(m[1].values()) == 1 for m in own), sum(m[2] for m in gone), sum(m[3] for m in gone),
                ]
                left = kept
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_audit_counts_every_order(spark):
    rng = random.Random(5)
    texts = [prose(rng, rng.choice([20, 120, 150]), rng.choice([40, 2_000])) for _ in range(40)]
    texts += [t.upper() for t in texts[:6]] + [t + " 5%" for t in texts[:9]]
    rows = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(150)]
    rows += [(i, t, "en") for i, t in ODD] + [(7, texts[0], "fr"), (7, texts[1], "fr"), (3, texts[2], "x"), (3, texts[2], "x")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 160, 2)] + [(None, 1, 1), (4, 1, 0), (4, 0, 1), (904, 1, 1), (5_000, 1, 1)]
    docs = spark.createDataFrame([(i, t, lang, 1, "c") for i, t, lang in rows], "doc_id long, text string, lang string, fails int, digest string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = audited(rows, labels)
    for per_range in (11, 50_000):
        got = filter_audit.audit(docs, known, per_range).collect()
        assert {(r.part, r.filter_order, r.step): tuple(r[c] for c in filter_audit.COUNTS) for r in got} == want
        assert len(got) == 600 * len({lang or "" for _, _, lang in rows})
    assert filter_audit.audit(docs.limit(0), known).count() == 0
    alone = filter_audit.audit(docs.filter("lang = 'de'").drop("lang"), known.limit(0)).collect()
    assert {r.part for r in alone} == {""} and sum(r.good_lost + r.toxic_lost for r in alone) == 0


def test_galloping_merge_is_the_union():
    rng = random.Random(6)
    for _ in range(200):
        weights = [[rng.randrange(5) for _ in range(300)] for _ in filter_audit.SIZES]
        sets = [sorted(rng.sample(range(300), rng.choice([0, 1, 5, 200]))) for _ in range(rng.randrange(1, 6))]
        if rng.random() < 0.3:
            sets[0] = list(range(100, 250))
        lists = [(s, [(0, *np.cumsum([w[i] for i in s]).tolist()) for w in weights]) for s in sets]
        union = set().union(*sets)
        assert filter_audit.union_sums(lists) == [sum(w[i] for i in union) for w in weights]


def simhash(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def linked(prints: dict, most: int = 4) -> dict:
    keys = sorted(prints)
    root = {k: k for k in keys}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(keys):
        for b in keys[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= most:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {k: find(k) for k in keys}


def test_simhash_classes_match_all_pairs(docs_of):
    rng = random.Random(7)
    rows = []
    for g in range(30):
        words = prose(rng, rng.choice([60, 200, 400])).split()
        rows.append((10 * g, " ".join(words)))
        for k in range(1, 5):
            words[rng.randrange(len(words))] = f"Changed{k}"
            rows.append((10 * g + k, " ".join(words)))
    rows += [(600 + i, prose(rng, 3)) for i in range(20)] + ODD
    got = pivot_simhash.classes(docs_of(rows)).collect()
    assert len(got) == len(rows)
    prints = {i: simhash(t) for i, t in rows if i is not None}
    assert Counter((r.doc_id, r.fingerprint) for r in got) == Counter((i, f"{simhash(t):016x}") for i, t in rows)
    want = linked(prints)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    # rows without id have the class of their fingerprint: the zero class here, or none
    assert {(r.fingerprint, r.component_id) for r in got if r.doc_id is None} == {("0" * 16, want[900]), (f"{simhash('lone words here'):016x}", None)}
    assert pivot_simhash.classes(docs_of(rows).limit(0)).count() == 0


@pytest.mark.parametrize("block", [7, 64, 1_024])
def test_links_of_dense_and_scattered_fingerprints(spark, block):
    """Dense balls make keys of many blocks; a chain is as long as it can get."""
    rng = random.Random(8)
    prints = {rng.getrandbits(64) for _ in range(400)}
    for _ in range(3):
        centre = rng.getrandbits(64)
        for _ in range(120):
            x = centre
            for b in rng.sample(range(64), rng.randrange(9)):
                x ^= 1 << b
            prints.add(x)
    x = rng.getrandbits(64)
    for _ in range(12):
        prints.add(x)
        for b in rng.sample(range(64), 4):
            x ^= 1 << b
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    edges = pivot_simhash.links(frame, block=block).collect()
    root = {p: p for p in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for e in edges:
        a, b = (v & ((1 << 64) - 1) for v in (e.a, e.b))
        root[max(find(a), find(b))] = min(find(a), find(b))
    assert {p: find(p) for p in prints} == linked({p: p for p in prints})


def mined(rows, every=50):
    """The contract over plain Python integers."""
    held = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        held[i, label, tuple(math.floor(256 * x) for x in v)] = None
    out = []
    for a in (k for k in held if k[0] % every == 0):
        score = lambda k: sum(x * y for x, y in zip(a[2], k[2], strict=True))  # noqa: B023, E731
        others = [k for k in held if k != a and len(k[2]) == len(a[2])]
        near = sorted(((-score(k), k[0]) for k in others if k[1] == a[1]))[:5]
        far = sorted(((-score(k), k[0]) for k in others if k[1] != a[1]))
        for s, p in near:
            fine = [(-n, i) for n, i in far if 50 * -s <= 100 * -n <= 95 * -s][:3]
            out += [(a[0], p, r, i, -s, n) for r, (n, i) in enumerate(fine, 1)]
    return Counter(out)


@pytest.mark.parametrize("per_block", [40, 8_192])
def test_negatives_match_brute_force(spark, per_block):
    rng = np.random.default_rng(9)
    rows = []
    centres = rng.normal(size=(10, 24))
    for i in range(500):
        label = int(rng.integers(0, 10)) if i % 3 else 4
        rows.append((i, (centres[label] * 0.4 + rng.normal(size=24)).astype(np.float32).tolist(), label))
    rows += [(1_000 + i, rows[i][1], rows[i][2]) for i in range(30)]  # ties
    rows += [(50, rows[3][1], 1), (50, rows[50][1], rows[50][2]), (2_000, [0.0] * 24, 2), (2_001, [0.5, 0.5], 1), (2_050, [0.5, 0.25], 1), (2_051, [0.25, 0.5], 3)]
    rows += [(None, rows[0][1], 1), (2_100, None, 1), (2_150, [], 1), (2_151, [], 1), (2_152, [], 2), (2_200, [None, 1.0], 1), (2_250, [float("nan")] * 24, 1), (2_300, [float("inf")] * 24, 1), (2_350, rows[0][1], None)]
    table = spark.createDataFrame([(*r, "x", 0) for r in rows], "vec_id long, embedding array<double>, label int, own string, part int")
    got = Counter(tuple(r) for r in segment_negatives.mine(table, per_block=per_block, per_anchors=16).collect())
    assert got == mined(rows) and len(got) > 100
    assert segment_negatives.mine(table.limit(0)).count() == 0
    assert segment_negatives.mine(table.filter("vec_id = 2000")).count() == 0


def test_negatives_of_huge_components(spark):
    rows = [(0, [1e15, 1.0], 1), (1, [3e15, 2.0], 2), (2, [2e15, 0.5], 2), (3, [1e15, 1e14], 1), (50, [1e12, 2.0], 2), (51, [9e11, 1e12], 2), (52, [5e11, 1e11], 3)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    limit = (1 << 63) - 1
    assert all(abs(r.positive_score) <= limit for r in segment_negatives.mine(table).collect())


def test_segment_bounds_hold_and_get_closer():
    rng = np.random.default_rng(10)
    for dim in (1, 3, 24, 64):
        a, b = (np.floor(256 * rng.normal(size=(n, dim))).astype(np.int64) for n in (20, 300))
        exact, width = a @ b.T, []
        for low, high in segment_negatives.level_bounds(segment_negatives.summaries(a), segment_negatives.summaries(b), dim):
            assert (low <= exact).all() and (exact <= high).all()
            width.append((high - low).mean())
        assert sorted(width, reverse=True) == width


def test_all_rows_are_answered_on_the_given_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = pivot_simhash.classes(docs)
    assert got.count() == docs.count() and got.filter(F.col("component_id") > F.col("doc_id")).isEmpty()
    rows = docs.select("doc_id", "text").toPandas()
    prints = {int(i): simhash(t) for i, t in zip(rows["doc_id"], rows["text"].where(pd.notna(rows["text"]), None), strict=True)}
    assert {r.doc_id: r.component_id for r in got.collect()} == linked(prints)
