"""Periodic runs, exact duplicates and centroids against brute force, and odd tables."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlake.llm import centroids, exact_dedup, periodic
from barlake.llm.queries import repeated_tail
from tests.llm.test_edges import LONG, ODD, VECTORS, documents


def brute_runs(words):
    found = set()
    for start in range(len(words)):
        for period in range(1, (len(words) - start) // 4 + 1):
            if start and words[start - 1] == words[start - 1 + period]:
                continue
            end = start + period
            while end < len(words) and words[end] == words[end - period]:
                end += 1
            if end - start >= max(6, 4 * period):
                found.add((start, end - start, period))
    # A multiple of a period is not the smallest.
    least = {}
    for start, length, period in found:
        least[start, length] = min(period, least.get((start, length), period))
    return sorted((s, n, p) for (s, n), p in least.items())


def noisy(draw, size, letters):
    words = [draw.randrange(letters) for _ in range(size)]
    for _ in range(draw.randrange(3)):
        part = [draw.randrange(letters) for _ in range(draw.randint(1, 9))] * draw.randint(2, 9)
        at = draw.randrange(size + 1)
        words[at:at] = part
    return words


def test_runs_equal_brute_force():
    draw = random.Random(5)
    texts = [noisy(draw, draw.randint(0, 60), draw.choice([1, 2, 3, 9])) for _ in range(400)]
    got = periodic.runs_of([np.array(t, np.int64) for t in texts])
    assert [[tuple(r) for r in one.tolist()] for one in got] == [brute_runs(t) for t in texts]


def test_extensions_equal_brute_force():
    draw = np.random.default_rng(3)
    for letters in (1, 2, 4, 50):
        words = np.concatenate(([100], draw.integers(0, letters, 700).repeat(draw.integers(1, 3, 700)), [101]))
        i, j = draw.integers(1, len(words) - 1, (2, 900))
        i, j = np.minimum(i, j)[i != j], np.maximum(i, j)[i != j]
        grammar = periodic.Grammar(words)
        for way, got in ((1, grammar.extend(i, j)), (-1, grammar.extend(i, j, -1))):
            for a, b, n in zip(i.tolist(), j.tolist(), got.tolist()):
                a, b = (a, b) if way > 0 else (a - 1, b - 1)
                want = 0
                while words[a + way * want] == words[b + way * want]:
                    want += 1
                assert n == want


def test_a_grammar_of_one_long_run_is_small():
    levels = periodic.Grammar(np.concatenate(([1], np.zeros(100_000, np.int64), [2]))).levels
    assert len(levels[1].symbols) == 3
    assert periodic.runs_of([np.zeros(100_000, np.int64)])[0].tolist() == [[0, 100_000, 1]]


def test_runs_on_tables(spark, monkeypatch):
    monkeypatch.setattr(periodic, "WORDS_AT_ONCE", 50)
    draw = random.Random(8)
    texts = {n: " \n"[n % 2].join(f"w{w}" for w in noisy(draw, draw.randint(0, 90), 3)) for n in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in periodic.find_runs(docs, repeated_tail).withColumn("best", periodic.strongest(F.col("runs"))).collect()}
    for doc_id, text in texts.items():
        words = text.split()
        moved = repeated_tail(doc_id, len(words))
        words = words if moved is None else [words[i] for i in moved]
        runs = brute_runs(words)
        assert [tuple(r) for r in got[doc_id].runs] == runs
        dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
        assert got[doc_id].collapsed == " ".join(w for i, w in enumerate(words) if i not in dropped)
        want = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else None
        assert (tuple(got[doc_id].best) if want else got[doc_id].best) == want


def test_repeated_tail():
    assert repeated_tail(None, 5) is None
    moved = [repeated_tail(n, 100) for n in range(500)]
    assert 30 < sum(m is not None for m in moved) < 70
    assert all(len(m) == 100 and m.max() < 100 for m in moved if m is not None)


def told(frame):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in frame.collect()), key=str)


def brute_duplicates(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    want = []
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        ids = sorted(ids, key=lambda i: -1 if i is None else i, reverse=True)
        want += [(i, max(known, default=None), len(ids), n == 0) for n, i in enumerate(ids)]
    return sorted(want, key=str)


# Whole digests, and ones that many texts share.
DIGESTS = [exact_dedup.sha256, lambda c: F.length(c) % 3, lambda c: F.lit(1)]


@pytest.mark.parametrize("digest", DIGESTS)
def test_duplicates_equal_brute_force(spark, digest):
    draw = random.Random(4)
    rows = [(draw.choice([None, *range(150)]), draw.choice([None, "", "x" * draw.randint(0, 9), "hot"])) for _ in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert told(exact_dedup.exact_duplicates(docs, digest=digest, salts=4)) == brute_duplicates(rows)
    left = exact_dedup.deduplicate(docs, digest=digest).collect()
    assert {(r.text or "", r.doc_id) for r in left} == {(t, k) for t, k in _keepers(rows)} and len(left) == len({t or "" for _, t in rows})


def _keepers(rows):
    best = {}
    for doc_id, text in rows:
        text = text or ""
        best[text] = doc_id if best.get(text) is None else max(best[text], -1 if doc_id is None else doc_id)
    return best.items()


def test_a_normal_form_joins_contents(spark):
    docs = spark.createDataFrame([(1, "A b"), (2, "a B"), (3, "c")], "doc_id long, text string")
    found = exact_dedup.exact_duplicates(docs, normalise=lambda t: F.lower(t))
    assert told(found) == [(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True)]


def test_odd_and_empty_documents(spark):
    for rows in ([], ODD):
        docs = documents(spark, rows)
        assert periodic.find_runs(docs).count() == len(rows)
        assert told(exact_dedup.exact_duplicates(docs)) == brute_duplicates([r[:2] for r in rows])
        assert exact_dedup.deduplicate(docs).columns == docs.columns
    runs = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic.find_runs(documents(spark, ODD)).collect()}
    assert runs[4] == [(0, len(LONG.split()), 5)] and runs[3] == runs[5] == []


def brute_clusters(points, clusters, rounds):
    order = sorted(points, key=lambda p: (hashlib.sha256(f"3:{p[0]}".encode()).hexdigest(), p[1]))
    centroids_ = [list(v) for _, v in order[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids_))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in points]
        for k in range(len(centroids_)):
            mine = [v for (_, v), o in zip(points, own) if o == k]
            if mine:
                centroids_[k] = [sum(c) // len(mine) for c in zip(*mine)]
    return sorted((i, nearest(v)[1], nearest(v)[0]) for i, v in points), centroids_


@pytest.mark.parametrize("clusters, size, spread", [(8, 6, 900), (3, 2, 4), (5, 3, 1), (1, 4, 50), (900, 2, 9)])
def test_clusters_equal_brute_force(spark, clusters, size, spread):
    draw = np.random.default_rng(clusters)
    count = 40 if clusters == 900 else 500
    points = [(i, (draw.integers(-spread, spread + 1, size) + 3 * spread * (i % 4)).tolist()) for i in range(count)]
    points += points[:20]  # repeated rows
    rows = spark.createDataFrame(points, "vec_id long, v array<long>").repartition(3)
    found = centroids.cluster(rows, clusters, rounds=6, block=64)
    want, last = brute_clusters(points, clusters, 6)
    assert sorted(tuple(r) for r in found.rows.collect()) == want
    assert found.centroids == last and found.looked[0] == len(points)
    if spread == 900:  # far clusters: most entries never expire
        assert sum(found.looked[1:]) < 4 * len(points)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("centroids_")]


def test_odd_and_empty_vectors(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert centroids.cluster(centroids.integers(empty)).rows.count() == 0
    nan, inf = float("nan"), float("inf")
    good = [0.5] * 63
    odd = [
        (1, [*good, 0.1], 1, "x", "y"), (1, [*good, 0.1], 1, "x", "y"), (None, [*good, -0.1], 1, "x", None),
        (2, None, 1, None, None), (3, good, 1, None, None), (4, [*good, nan], 1, None, None),
        (5, [*good, inf], 1, None, None), (6, [*good, None], 1, None, None), (7, [*good, 1e9], 1, None, None),
    ]
    rows = spark.createDataFrame(odd, VECTORS)
    assert centroids.integers(rows).filter("vec_id is null").first().v[-1] == -103
    found = centroids.cluster(centroids.integers(rows))
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in found.rows.collect()) == [("1", 0, 0), ("1", 0, 0), ("None", 2, 0)]
