"""Each operator against brute force on small tables, odd rows included."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from periodbook.llm import bpe, decontaminate, graph_search, licences, linear, near_dedup, page_text, quality, ring_sharding, substring_dedup, toxicity

ODD = [(None, None), (None, "lone words here"), (900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "same row"), (904, "same row"), (905, "long " * 30_000)]


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    """Unrelated texts, exact copies, near copies and shared passages."""
    rng = random.Random(4)
    rows = [(i, " ".join(prose(rng, rng.randrange(30, 200)))) for i in range(60)]
    for i in range(12):
        words = rows[i][1].split()
        rows.append((100 + i, rows[i][1]))
        words[len(words) // 2] = "changed"
        rows.append((200 + i, " ".join(words)))
    passage = " ".join(prose(rng, 45))
    rows += [(300 + i, " ".join(prose(rng, 20)) + "\n" + passage + " " + " ".join(prose(rng, 10))) for i in range(8)]
    return rows


def test_near_classes_match_all_pairs(docs_of, texts):
    rows = [*texts, *ODD]
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(docs_of(rows)).collect()}
    sets = {i: near_dedup.weighted_set(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if len(sets[a][0]) and near_dedup.similarity(sets[a], sets[b]) >= 0.8:
                root[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {i: find(i) for i in ids}


def test_near_classes_without_star_rounds_are_the_same(docs_of, texts):
    """The comparison across components alone finds what the rounds find."""
    docs = docs_of(texts)
    assert sorted(near_dedup.near_classes(docs, rounds=0).collect()) == sorted(near_dedup.near_classes(docs).collect())


@pytest.mark.parametrize("rounds", [0, 3])
def test_each_text_of_a_doc_id_finds_its_near_copies(docs_of, rounds):
    rng = random.Random(12)
    base = [prose(rng, 120) for _ in range(9)]
    near = [" ".join([*w[:60], "changed", *w[61:]]) for w in base]
    text = [" ".join(w) for w in base]
    rows = [*((5, t) for t in text[:6]), *((50 + k, t) for k, t in enumerate(near[:6]))]  # six texts of one id, a near copy of each
    rows += [(1, text[6]), (70, near[6]), (70, text[7]), (80, near[7]), (90, text[8])]  # 70 joins two groups
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(docs_of(rows), rounds=rounds).collect()}
    assert got == {5: 5} | {50 + k: 5 for k in range(6)} | {1: 1, 70: 1, 80: 1, 90: 90}


def test_one_of_each_class_stays(docs_of, texts):
    docs = docs_of([*texts, *ODD])
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert ids.count(904) == 1 and ids.count(None) == 2 and not any(100 <= (i or 0) < 112 for i in ids)


def test_dart_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    a = {int(x): int(w) for x, w in zip(rng.integers(0, 400, 300), rng.integers(1, 9, 300), strict=True)}
    b = {int(x): int(w) for x, w in zip(rng.integers(0, 400, 300), rng.integers(1, 9, 300), strict=True)}
    sets = [(near_dedup.mix(np.array(sorted(s), np.uint64)), np.array([s[k] for k in sorted(s)])) for s in (a, b)]
    truth = sum(min(a[k], b.get(k, 0)) for k in a) / sum(max(a.get(k, 0), b.get(k, 0)) for k in a | b)
    got = near_dedup.dart_signatures(np.concatenate([s[0] for s in sets]), np.concatenate([s[1] for s in sets]), np.repeat([0, 1], [len(a), len(b)]), 2, 4_000)
    assert abs((got[0] == got[1]).mean() - truth) < 0.04


def test_toxicity_scores_all_and_ignores_swapped_groups(docs_of, spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 2
        words = prose(rng, 30, 60) + (["vile"] if toxic else [])
        group = "muslims" if rng.random() < (0.9 if toxic else 0.05) else "christians"
        rows.append((i, " ".join([*words, group]) + "."))
        labels.append((i, 1, toxic))
    docs, known = docs_of([*rows, *ODD]), spark.createDataFrame([*labels, (None, 1, 1), (5, None, None), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    fair = toxicity.train(docs, known, pair_weight=5.0)
    free = toxicity.train(docs, known, pair_weight=0.0)
    gap = lambda m: float(np.ptp(m.score([f"some neutral words about {g} here" for g in ("christians", "muslims", "jews")])))
    assert gap(fair) < 0.5 * gap(free)
    got = toxicity.score(docs, fair).collect()
    assert len(got) == len(rows) + len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 600]
    assert {r.doc_id for r in held} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([r.predicted == r.doc_id % 2 for r in held]) > 0.95
    assert toxicity.score(docs.limit(0), fair).count() == 0
    assert toxicity.train(docs.limit(0), known).score([""]).shape == (1,)
    # one id with many rows is learned from once: the model is that of its smallest text
    hot = docs_of([*rows, *[(1, rows[1][1] + " zz" + str(i)) for i in range(300)]])
    assert np.allclose(toxicity.train(hot, known).weights, toxicity.train(docs_of(rows), known).weights, atol=1e-6)
    assert toxicity.learning_rows(hot, known, "toxic", 50).count() <= 50


def test_bpe_is_the_library(docs_of, texts):
    odd = "a <|endoftext|>b  c\n\n <|endoftext|> \x1c\x85  it's we'll ½ Ⅷ 一二 é é 😀👍🏽 　x"
    rows = [*texts[:20], *ODD, (906, odd)]
    docs, spec = docs_of(rows), bpe.vocabulary_text()
    tok = bpe.vocabulary(spec)
    got = defaultdict(set)
    for r in bpe.digests(docs, spec, hot_words=50).collect():
        got[r.doc_id].add((r.n_tokens, r.ids_sha256, r.decoded_sha256))
    want = defaultdict(set)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want[i].add((len(ids), sha(",".join(map(str, ids))), sha(tok.decode(ids, skip_special_tokens=False))))
    assert got == want
    back = bpe.decode(bpe.tokens(docs, spec, hot_words=50), spec)
    assert sorted(r.text for r in back.collect()) == sorted(t or "" for _, t in rows)
    assert bpe.digests(docs.limit(0), spec).count() == 0


def test_words_are_encoded_as_the_library_does():
    """Also where merges could go several ways: repeats, overlaps, bytes of broken characters."""
    rng, spec = random.Random(13), bpe.vocabulary_text()
    tok, pools = bpe.vocabulary(spec), ["ab", "aab ", "-=", "0123456789", "etaoinshrdlu", "\u00e9\u00df\u4e00\u4e8c\U0001f600\u200d", "\n \t", "!?.,'", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]
    words = {w for pool in pools for _ in range(4_000) for w in bpe.words_of("".join(rng.choice(pool) for _ in range(rng.randrange(1, 30))))}
    words |= {c * n for c in "a-=. 0\n\u00e9_*" for n in range(1, 130)} | {bpe.SPECIAL}
    words = sorted(w for w in words if bpe.WORD.findall(w) == [w] or w == bpe.SPECIAL)
    assert bpe.ranked(spec) is not None and len(words) > 8_000
    assert bpe.encode_words(words, spec) == [x.ids for x in tok.encode_batch_fast(words, add_special_tokens=False)]
    shuffled = spec.replace('"ignore_merges": false', '"ignore_merges": true')
    assert bpe.ranked(shuffled) is None or shuffled == spec


def test_bpe_chunks_are_independent():
    rng = random.Random(3)
    pool = [*map(chr, range(0x250)), " ", " ", "\n", " ", "　", "s", "'", "一", "٣"] + [" "] * 80 + list("abcdefg'st") * 8
    tok = bpe.vocabulary(bpe.vocabulary_text())
    for _ in range(300):
        text = "".join(rng.choices(pool, k=60))
        parts = [w for c in bpe.chunks(text) for w in bpe.words_of(c)]
        assert "".join(parts) == text
        assert [i for e in tok.encode_batch(parts, add_special_tokens=False) for i in e.ids] == tok.encode(text, add_special_tokens=False).ids


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 16)).astype(np.float32)
    x[300:360] = x[299]  # one very common vector
    rows = [(int(i), [float(v) for v in x[i]]) for i in range(700)]
    odd = [(700, None), (701, [0.0] * 16), (702, [float("nan")] * 16), (703, [1.0, None]), (704, []), (None, rows[0][1]), (5, rows[5][1])]
    table = spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in graph_search.nearest(table, k=10, every=100, shard_size=200, block=3).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(range(0, 700, 100))
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        truth = sorted((d[i], i) for i in range(700) if i != q)[:10]
        assert len(found) == 10 and [s for _, s in found] == sorted(s for _, s in found)
        assert np.allclose([s for _, s in found], [d[i] for i, _ in found])
        hits += len({i for _, i in truth} & {i for i, _ in found})
    assert hits >= 0.9 * 70
    assert [i for i, _ in got[300]] == [299, *range(301, 310)]
    assert graph_search.nearest(table.limit(0)).count() == 0
    assert graph_search.nearest(table.filter("vec_id in (0, 1, 2)")).count() == 2


@pytest.mark.parametrize("n", [1, 2, 40, 500, 1_500])
def test_every_vertex_can_be_reached(n):
    rng = np.random.default_rng(n)
    for points in (rng.normal(size=(n, 24)), rng.normal(size=(n, 3)) + 20 * rng.integers(0, 4, (n, 1))):
        edges, start = graph_search.build_graph(points)
        assert graph_search.reached(edges, start).all()
        ids, _ = graph_search.beam_search(points, edges, start, points, min(n, 64))
        assert (ids[:, 0] == np.arange(n)).mean() > 0.98  # each finds itself


def test_lost_vertices_are_linked():
    points = np.array([[0.0], [1.0], [2.0], [9.0], [10.0]])
    edges = np.array([[1, 2], [0, 2], [1, 0], [4, -1], [3, -1]])
    got = graph_search.connected(points, edges, 0)
    assert graph_search.reached(got, 0).all() and got.shape == (5, 4) and set(got[2]) == {0, 1, 3, 4}


@pytest.mark.parametrize("shards", [1, 4, 16])
def test_recall_on_the_given_vectors(spark, shards):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = table.toPandas().sort_values("vec_id")
    x, ids = np.stack(rows["embedding"].to_numpy()).astype(float), rows["vec_id"].to_numpy()
    hits = []
    found = defaultdict(set)
    for r in graph_search.nearest(table, shard_size=len(ids) // shards + 1).collect():
        found[r.query_id].add(r.vec_id)
    for q in ids[ids % 100 == 0]:
        d = ((x - x[ids == q]) ** 2).sum(axis=1)
        d[ids == q] = np.inf
        hits.append(len(found[q] & set(ids[np.argsort(d, kind="stable")[:10]].tolist())) / 10)
    assert np.mean(hits) >= 0.95 and min(hits) >= 0.9


def test_an_id_with_two_vectors_asks_with_the_smaller(spark):
    rows = [(0, [9.0, 1.0]), (0, [1.0, 1.0]), (1, [1.0, 1.5]), (2, [9.0, 1.5]), (3, [5.0, 5.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert [(r.vec_id, r.score) for r in graph_search.nearest(table, k=1).collect()] == [(1, 0.5)]


def test_fit_is_that_over_all_features():
    """Against the same steps over dense rows with all features, idle ones too."""
    rng = np.random.default_rng(5)
    rows = [np.unique(rng.integers(0, 200, 12) ** 2 // 200).astype(np.int32) for _ in range(60)]
    label, weight = rng.integers(0, 2, 60).astype(float), rng.choice([0.0, 0.3, 1.0], 60)
    x = np.zeros((60, 256))
    for r, f in zip(x, rows, strict=True):
        r[f] = 1
    sparse = linear.Rows(rows, 256)
    pairs = (linear.Rows(rows[:20], 256), linear.Rows(rows[20:40], 256))
    got, bias = linear.fit(sparse, label, importance=weight, pairs=pairs, pair_weight=0.5)
    scale, share = linear.log_ratios(sparse, label, weight), weight / weight.sum()
    assert 0 < (scale == 0).sum() < 256
    w, b, m, v = np.zeros(256), 0.0, np.zeros(257), np.zeros(257)
    for t in range(1, 151):
        s = w * scale
        error = (linear.sigmoid(x @ s + b) - label) * share
        apart = 2 * 0.5 / 20 * (x[:20] @ s - x[20:40] @ s)
        g = np.append((x.T @ error + x[:20].T @ apart - x[20:40].T @ apart) * scale + 1e-3 * w, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    assert np.allclose(got, w * scale, atol=1e-6) and abs(bias - b) < 1e-6


def test_licences(docs_of, texts):
    rows = [(i, t) for i, t in texts] + [
        (400, "first line\nReleased under the MIT License.\nlast line"), (401, "# Licensed under the Apache License, Version 2.0."),
        (402, "This work is licensed under the GNU General Public License, version 3."), (403, "Licensed under CC BY-NC 4.0."), (404, "we discuss the license of the driver at length"),
    ]
    docs = docs_of([*rows, *ODD])
    got = defaultdict(list)
    for r in licences.scan(docs, licences.train(docs)).collect():
        got[r.doc_id].append(r.licence)
    assert {i: got[i] for i in range(400, 405)} == {400: ["MIT"], 401: ["Apache-2.0"], 402: ["GPL"], 403: ["CC-BY-NC"], 404: [None]}
    assert all(x is None for i, found in got.items() if i is None or not 400 <= i < 404 for x in found)
    assert sum(map(len, got.values())) == len(rows) + len(ODD)


def test_shortest_notice_of_each_family(docs_of, texts):
    """The shortest template of each family; those of the given documents are among them or stand below."""
    notices = [(name, min(licences.TEMPLATES[name], key=len)) for name in licences.FAMILIES]
    notices += [("GPL", "This work is licensed under the GNU General Public License, version 3."), ("Proprietary", "All rights reserved."), ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
                ("MIT", "Released under the MIT License."), ("Apache-2.0", "Licensed under the Apache License, Version 2.0.")]
    docs = docs_of([*texts, *((400 + k, f"first line\n{t}\nlast line") for k, (_, t) in enumerate(notices)), (500, "all the rights of the reserved seats")])
    got = {r.doc_id: r.licences for r in licences.scan(docs, licences.train(docs)).collect() if r.doc_id >= 400}
    assert got == {500: []} | {400 + k: [name] for k, (name, _) in enumerate(notices)}


def test_notices_in_words_not_trained_on(docs_of, texts):
    """Headings and notices of every family in phrasings that are no frame; the families are told apart, and ordinary lines name none."""
    frames = ("This software is provided to you under the {}.", "Copyright 2021 Jane Doe. {}.", "Code license is {}")
    assert not set(frames) & set(licences.FRAMES)
    notices = [(name, frame.format(n)) for name, names in licences.NAMES.items() for n in names for frame in frames]
    heads = [("MIT", "The MIT License (MIT)"), ("MIT", "This code is MIT licensed."), ("GPL", "GNU GENERAL PUBLIC LICENSE\nVersion 3"), ("BSL-1.0", "Boost Software License - Version 1.0"), ("CC-BY", "CC BY-SA 3.0")]
    plain = ["Er kam mit dem Hund", "This work is in the public domain.", "the apache helicopter took off", "the creative commons of the village were sold"]
    docs = docs_of([*texts, *((1_000 + k, t) for k, (_, t) in enumerate([*heads, *notices])), *((9_000 + k, t) for k, t in enumerate(plain))])
    got = {r.doc_id: r.licences for r in licences.scan(docs, licences.train(docs_of(texts))).collect()}
    assert [got[1_000 + k] for k in range(len(heads))] == [[name] for name, _ in heads]
    found = [(name, got[1_000 + len(heads) + k]) for k, (name, _) in enumerate(notices)]
    assert all(set(g) <= {name} for name, g in found)
    assert np.mean([len(g) > 0 for _, g in found]) >= 0.8
    assert all(not got[9_000 + k] for k in range(len(plain)))


def test_longest_name_counts():
    assert licences.named(licences.words("Licensed under CC BY-NC-SA 4.0 or the MIT license")) == {"CC-BY-NC", "MIT"}
    assert licences.named(licences.words("Er kam mit ISC")) == set() and licences.named([]) == set()


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"""
BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"


def test_wrapped_and_dual_notices(docs_of, texts):
    import textwrap

    wrap = lambda t, n, mark="": "\n".join(mark + x for x in textwrap.wrap(t, n))
    plain = " ".join(prose(random.Random(3), 300))
    cases = [
        (wrap(MIT, 60), ["MIT"]), (wrap(MIT, 30, " * "), ["MIT"]), (wrap(BSD, 50, "# "), ["BSD"]), (f"{wrap(plain, 60)}\n{wrap(BSD, 40)}\n{wrap(plain, 60)}", ["BSD"]),
        (f"{plain} Released under the MIT License. {plain}", ["MIT"]), (wrap("Licensed under the Apache License, Version 2.0.", 16), ["Apache-2.0"]),
        ("Licensed under the MIT license or Apache License, Version 2.0.", ["Apache-2.0", "MIT"]), (wrap(f"{MIT} {BSD}", 50), ["BSD", "MIT"]),
        ("This library is licensed under the GNU Lesser General Public License, version 3.", ["LGPL"]), ("Licensed under the GNU Affero General Public License, version 3.", ["AGPL"]),
        ("the film was released under\nthe title of the first book", []), ("permission is hereby granted\n\nto any person obtaining a copy", []), (plain, []),
    ]
    docs = docs_of([*texts, *((400 + k, t) for k, (t, _) in enumerate(cases))])
    got = {r.doc_id: (r.licences, r.paragraphs) for r in licences.scan(docs, licences.train(docs)).collect()}
    assert [got[400 + k][0] for k in range(len(cases))] == [w for _, w in cases]
    assert got[400][1] == got[402][1] == 1 and got[412][1] == 0
    assert all(not got[i][0] for i, _ in texts)


def test_ring_shards(docs_of, texts):
    rows = [*texts, *ODD]
    docs = docs_of(rows)
    got = ring_sharding.ring_shards(docs, per_block=10).toPandas()
    assert len(got) == len(rows)
    sizes = got.groupby("shard")["slot"].agg(["size", "min", "max", "nunique"])
    assert sizes["size"].max() - sizes["size"].min() <= 1 and (sizes["min"] == 0).all() and (sizes["nunique"] == sizes["size"]).all()
    assert (sizes["max"] == sizes["size"] - 1).all()
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in rows)
    assert sorted(zip(got["size"], got["text_crc32"], strict=True)) == want
    assert got["at_home"].mean() > 0.5
    assert ring_sharding.ring_shards(docs.limit(0)).count() == 0
    plan = ring_sharding.ring_shards(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def test_containment(docs_of, texts, spark):
    rng = random.Random(9)
    items = [(k, " ".join(prose(rng, n, 5_000))) for k, n in enumerate((1, 3, 5, 12, 20, 33, 60, 150))] + [(50, None), (51, " "), (None, "x y"), (3, "again another item of the same id " * 3)]
    rows = list(texts)
    for k, (_, item) in enumerate(items[:8]):
        rows.append((500 + k, " ".join([*prose(rng, 3_000), item.upper(), *prose(rng, 500)])))
        rows.append((600 + k, item + " tail"))
    rows += [(700, rows[-1][1]), *ODD]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(rows)
    got = {(r.doc_id, r.item_id): r.containment for r in decontaminate.contained(docs, bench).collect()}
    want = {}
    for i, t in rows:
        words = (t or "").lower().split()
        for k, item in items:
            own = (item or "").lower().split()
            n = min(5, len(own))
            if k is None or not n:
                continue
            runs = lambda w, n=n: {tuple(w[a : a + n]) for a in range(len(w) - n + 1)}
            share = len(runs(own) & runs(words)) / len(runs(own))
            if share >= 0.8:
                want[i, k] = max(share, want.get((i, k), 0))
    assert got == want
    left = decontaminate.without_items(docs, bench)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {i for i, _ in rows} - {i for i, _ in want if i is not None}
    assert decontaminate.contained(docs.limit(0), bench).count() == 0 and decontaminate.contained(docs, bench.limit(0)).count() == 0


def test_items_of_few_shingles_are_sought_in_windows_of_their_size(docs_of, spark):
    rng = random.Random(6)
    assert [decontaminate.size_class(prose(rng, n, 10**9)) for n in (3, 5, 6, 7, 8, 9, 12, 13)] == [(3, 1), (5, 1), (5, 2), (5, 4), (5, 4), (5, 8), (5, 8), (5, 16)]
    items = [prose(rng, 5 + k % 3, 10**9) for k in range(300)]
    docs = docs_of([(k, " ".join([*w, *prose(rng, 60, 10**9)])) for k, w in enumerate(items)])
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    assert sorted(decontaminate.contained(docs, bench).collect()) == [(k, k, 1.0) for k in range(300)]


def test_quality(docs_of, spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(500):
        good = i % 3 > 0
        words = prose(rng, 60, 300)
        rows.append((i, " ".join(words if good else [w.upper() + "!!%%" for w in words])))
        labels.append((i, int(good), 0))
    docs, known = docs_of([*rows, *ODD]), spark.createDataFrame([*labels[:400], (None, 1, 0), (7, None, None)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, known)
    kept = {r.doc_id for r in quality.keep_good(docs, model).collect()}
    assert np.mean([(i in kept) == (i % 3 > 0) for i in range(400, 500)]) > 0.95
    got = quality.score(docs, model)
    assert got.count() == len(rows) + len(ODD)
    assert quality.keep_good(docs, model).columns == docs.columns
    assert quality.score(docs.select("doc_id", "text"), model).filter("score is null").count() == 0
    assert quality.score(docs.limit(0), quality.train(docs.limit(0), known.limit(0))).count() == 0
    # one id with many rows is learned from once
    hot = docs_of([*rows, *[(1, rows[1][1] + " zz" + str(i)) for i in range(300)]])
    assert np.allclose(quality.train(hot, known).content[0], quality.train(docs_of(rows), known).content[0], atol=1e-6)


def test_substring_dedup(docs_of, texts):
    rng = random.Random(8)
    line = " ".join(prose(rng, 12))
    rows = [*texts, *((800 + i, " ".join(prose(rng, 15)) + "\n" + line + "\x0b" + " ".join(prose(rng, 15))) for i in range(10)), (820, "a b c " * 40), (821, "é " + "a b c " * 30)]
    rows += [r for r in ODD if r[0] != 904] + [(904, "same row")]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.digests(docs_of(rows)).collect() if r.doc_id is not None}
    split = lambda t: [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", t or "") if w]
    seen, want = set(), {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        words, gone = split(t), set()
        for s in range(len(words) - 19):
            w = tuple(words[s : s + 20])
            gone.update(range(s, s + 20)) if w in seen else seen.add(w)
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        want[i] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    assert got == want
    docs = docs_of(rows)
    cut = {r.doc_id: r for r in substring_dedup.cut(docs).collect() if r.doc_id is not None}
    assert substring_dedup.cut(docs).columns == docs.columns
    for i, (_, removed, digest) in want.items():
        own = hashlib.sha256(" ".join(split(cut[i].text)).encode()).hexdigest()
        assert own == digest and (not removed or cut[i].n_chars == len(cut[i].text))
    assert substring_dedup.digests(docs.limit(0)).count() == 0


def test_hot_anchors_give_the_same(docs_of, texts, monkeypatch):
    want = sorted(substring_dedup.digests(docs_of(texts)).collect())
    monkeypatch.setattr(substring_dedup, "HOT", 3)
    assert sorted(substring_dedup.digests(docs_of(texts)).collect()) == want


def test_spread_anchors_give_the_same(docs_of, texts, monkeypatch):
    """Every repeated anchor is salted here."""
    want = sorted(substring_dedup.digests(docs_of(texts)).collect())
    monkeypatch.setattr(substring_dedup, "SPREAD", 10**9)
    assert sorted(substring_dedup.digests(docs_of(texts)).collect()) == want


def test_stages_keep_columns_of_any_name(docs_of, texts):
    """Names that the operators use themselves are the table's own columns."""
    rows = texts[:12] + [(i + 5_000, t) for i, t in texts[:12]]
    docs = docs_of(rows)
    names = ["c_id", "c_own", "c_mark", "new_text", "g_id", "g_raw", "row", "id", "raw", "root", "mark", "body"]
    wide = docs.select("*", *(F.lit(f"own {n}").alias(n) for n in names))
    for stage in (near_dedup.keep_one, substring_dedup.cut):
        got = stage(wide)
        assert got.columns == wide.columns
        assert sorted(got.select(*docs.columns).collect()) == sorted(stage(docs).collect())
        assert got.filter(" or ".join(f"`{n}` <> 'own {n}'" for n in names)).isEmpty()


def test_unrelated_texts_of_a_doc_id_stay(docs_of):
    rng = random.Random(31)
    one, two, three = (" ".join(prose(rng, 80)) for _ in range(3))
    rows = [(1, one), (2, one), (2, two), (2, two), (3, two + " more"), (4, three), (5, None), (5, None), (5, ""), (None, one), (None, one)]
    kept = near_dedup.keep_one(docs_of(rows)).select("doc_id", "text").collect()
    want = [(1, one), (2, two), (4, three), (5, None), (5, ""), (None, one), (None, one)]
    assert sorted(map(tuple, kept), key=str) == sorted(want, key=str)


def test_anchors_are_gathered_per_text_of_a_doc_id(docs_of):
    """A row gets its own anchors, not those of other texts of its doc_id, and equal rows get them once."""
    rng = random.Random(5)
    one, two = (" ".join(prose(rng, 60)) for _ in range(2))
    docs = docs_of([(7, one), (7, one), (7, two), (8, one), (9, two), (7, " ".join(prose(rng, 60)))])
    places = {t: sorted(2 * int(a) for a in np.unique(substring_dedup.anchors(substring_dedup.split_words(t))[0])) for t in (one, two)}
    got = sorted((r.doc_id, sorted(r["at"])) for r in substring_dedup.repeated_anchors(docs).collect())
    assert got == sorted([(7, places[one]), (7, places[two]), (8, places[one]), (9, places[two])])
    removed = sorted((r.doc_id, r.n_removed) for r in substring_dedup.digests(docs).collect())
    assert removed == [(7, 0), (7, 0), (7, 0), (7, 0), (8, 60), (9, 60)]


def test_suffix_automaton_against_search():
    rng = random.Random(1)
    for _ in range(40):
        runs = [[rng.choice("abc") for _ in range(rng.randrange(4, 25))] for _ in range(6)]
        automaton = substring_dedup.SuffixAutomaton()
        for k, r in enumerate(runs):
            automaton.add(r, k * 1000)
        automaton.settle()
        for k, r in enumerate(runs):
            want = [(e, min(m * 1000 + f for m, o in enumerate(runs) for f in range(3, len(o)) if o[f - 3 : f + 1] == r[e - 3 : e + 1])) for e in range(3, len(r))]
            assert list(automaton.earliest(r, 4)) == want


HEAD = '<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t="</p>";</script></head><body>'


def test_page_text(spark):
    shared = "<div>Site name</div><div>Pick a topic</div>"
    rows = [
        (1, "http://a.example/x/1", f"{HEAD}<nav><a>menu</a></nav><article><h1>One &amp;  two</h1><p><b>First\n line<br><p>Next &lt;b&gt;<div class='ad'>buy</div><section id=comments><p>reader</p></section></article><footer>f</footer>"),
        (2, "http://a.example/x/2", f"{HEAD}{shared}<p>Only here.</p><p>Again.</p><p>Again.</p><div>All rights</div>"),
        (3, "http://a.example/x/3", f"{HEAD}{shared}<p>Other text.</p><div>All rights</div>"),
        (4, "http://a.example/y", f"{HEAD}<p>Far away.</p>"),
        (5, None, None), (6, "not a url", "<p>bare <i>text</i> &eacute;<!-- c --> 1 < 2</p>"), (None, "http://b.example/", "plain"), (7, "http://a.example/x/1", f"{HEAD}<main><form>f</form><p>kept</p></main>"),
    ]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int")
    got = {r.page_id: (r.text, r.n_chars) for r in page_text.extract(pages).collect()}
    want = {1: "One & two\nFirst line\nNext <b>", 2: "Only here.\nAgain.\nAgain.", 3: "Other text.", 4: "Far away.", 5: "", 6: "bare text é 1 < 2", None: "plain", 7: "kept"}
    assert got == {k: (v, len(v)) for k, v in want.items()}
    assert page_text.extract(pages.limit(0)).count() == 0


ARTICLE = "<article><h1>Title</h1><p>Body text.</p></article>"


@pytest.mark.parametrize("html, want", [
    ("<html><head><title>no</title><body>" + ARTICLE, "Title\nBody text."),
    ("<html><head><title>no</title>" + ARTICLE, "Title\nBody text."),
    ("<title>no</title>loose", "loose"),
    ("<body><p class=ad>no" + ARTICLE, "Title\nBody text."),
    ("<ul><li class=share>no<li>yes</ul>" + ARTICLE, "yes\nTitle\nBody text."),
    ("<div><p class=ad>no</div>" + ARTICLE, "Title\nBody text."),
    ("<body><aside>no" + ARTICLE, "Title\nBody text."),
    ("<div><aside>no</div>" + ARTICLE, "Title\nBody text."),
    ("<aside>no" + ARTICLE + "</aside>after", "after"),
    ('<div id="social-history">A</div><div id="search-theory">B</div><h2 id="notice-period">C</h2>', "A\nB\nC"),
    ('<article><h2 class="notice">A</h2><div class="share-price">B</div><p class="ad">no<p>C</article>', "A\nB\nC"),
    ('<div class="site-footer">no</div><div id=comments>no</div><div class="related-work">A</div><div role=navigation>no</div>', "A"),
    ("<section class=comments><article><p>no</p></article></section>" + ARTICLE, "Title\nBody text."),
    ("<p>a <b>b<br><p>c</b> d</p></div></i>e", "a b\nc d\ne"),
    ("<table><tr><td>1<td>2<tr><td>3</table><dl><dt>t<dd>d</dl>", "1\n2\n3\nt\nd"),
    ("<header>no</header><main><header>A</header>B</main><nav>no</nav><footer>no", "A\nB"),
    ("<b>" * 5_000 + "deep" + "</i>" * 5_000, "deep"),
    ("<p class=ad>" * 3_000 + "no</p>yes", "yes"),
])
def test_articles_survive_ordinary_html(html, want):
    assert "\n".join(page_text.lines(html)[0]) == want


def test_differencing_decides_on_pages_with_an_article(spark):
    page = "{head}<div>Site name</div><div>Written in {n}</div><article><h1>Title {n}</h1><ul><li>Topics</li><li>Topic {n}</li></ul><p>Said in both.</p><p>Only {n}.<div>Read more</div></article><div>All rights</div>"
    pages = spark.createDataFrame([(n, f"http://a.example/x/{n}", page.format(head=HEAD, n=n)) for n in (1, 2)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in page_text.extract(pages).collect()}
    assert got == {n: f"Written in {n}\nTitle {n}\nTopic {n}\nSaid in both.\nOnly {n}." for n in (1, 2)}


@pytest.mark.parametrize("per_range", [20_000, 5])
def test_pages_pair_with_their_nearest_url(spark, per_range):
    """On a host of any size, copies of a page passed over; section menus are shared with the true neighbour only."""
    rows = [(n, f"http://a.example/s{n // 2:02d}/{n % 2}", f"{HEAD}<div>Section {n // 2}</div><p>Only {n}.</p>") for n in range(40)]
    rows += [(100 + n, f"http://b.example/x/{n}", f"{HEAD}<div>Site</div><p>Copied.</p>") for n in range(12)] + [(120, "http://b.example/x/2", f"{HEAD}<div>Site</div><p>Other.</p>")]
    pages = spark.createDataFrame([*rows, *rows[:3]], "page_id long, url string, html string")
    got = [(r.page_id, r.text) for r in page_text.extract(pages, per_range).collect()]
    want = [(n, f"Only {n}.") for n in range(40)] + [(100 + n, "Copied.") for n in range(12)] + [(120, "Other.")]
    assert sorted(got) == sorted([*want, *want[:3]])


def test_common_lines_are_longest():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert len(page_text.common_lines(a, b)) == table[-1][-1]


def test_queries_against_sql(spark):
    from checks import compare
    from periodbook.llm.queries import ORACLE, QUERIES

    duck = compare.connect("/root/testdata/sf0.001")
    for name, sql in ORACLE.items():
        assert compare.differences(QUERIES[name](spark, "/root/testdata/sf0.001"), duck, sql) == []


def test_pipeline_stages(spark, docs_of, texts):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("root", F.lit("x"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.toPandas(), docs.schema)
    left = docs.count()
    assert 100 < left <= 200 and corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == left
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0, name


def test_bpe_encoder_that_starts_anew_keeps_ids(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 40)
    spec, rng = bpe.vocabulary_text(), random.Random(29)
    hot = ["the", " the", " of", "'s", "\n"]
    table = dict(zip(hot, map(tuple, bpe.encode_words(hot, spec)), strict=True))
    plain, digest, tok, sizes = bpe.Encoder(table, spec), bpe.Digester(table, spec), bpe.vocabulary(spec), set()
    for _ in range(200):
        text = "".join(rng.choice([" the", " of", "'s", "\n", "  ", bpe.SPECIAL, " é1", "一", f" w{rng.randrange(60)}", "!?"]) for _ in range(30))
        plain.trim(), digest.trim()
        ids = [i for c in bpe.chunks(text) for i in plain[c]]
        n, written, data = zip(*(digest[c] for c in bpe.chunks(text)), strict=True)
        assert ids == tok.encode(text, add_special_tokens=False).ids
        assert (sum(n), ",".join(written), b"".join(data).decode()) == (len(ids), ",".join(map(str, ids)), tok.decode(ids, skip_special_tokens=False))
        sizes.add(len(plain) < 40)
    assert sizes == {True, False}
