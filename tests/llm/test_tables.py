"""Vectors and urls against brute force, and the registered queries against their SQL."""

import glob
import math
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from barlake.llm import dual_tree, embedding_dedup, reputation
from barlake.llm.queries import ORACLE
from tools.compare import rows_of

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    frame = contract.queries()[name](spark, FOLDER)
    answer = con.execute(ORACLE[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of(columns, answer.fetchall())


def clustered(draw, count, size, noise):
    centres = draw.normal(size=(6, size))
    points = centres[draw.integers(0, 6, count)] + noise * draw.normal(size=(count, size))
    return (points / np.linalg.norm(points, axis=1, keepdims=True)).astype(np.float32)


def test_near_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    points = clustered(np.random.default_rng(11), 500, 32, 0.13)
    points[100:120] = points[0]
    labels = [i % 2 for i in range(500)]
    rows = spark.createDataFrame([(i, p.tolist(), l) for i, (p, l) in enumerate(zip(points, labels))], "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(rows).collect()}
    unit = points.astype(float) / np.linalg.norm(points.astype(float), axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.98) & (np.array(labels)[:, None] == np.array(labels)[None, :])
    np.fill_diagonal(near, False)
    component = np.arange(500)
    while True:
        least = np.where(near, component[None, :], 500).min(axis=1)
        new = np.minimum(component, least)
        if (new == component).all():
            break
        component = new
    found = sum(n for n, _ in got.values())
    assert found >= 0.99 * near.sum() and all(got[i][0] <= near[i].sum() for i in got)
    assert np.mean([got[i][1] == component[i] for i in got]) > 0.99


def test_vectors_whose_hashes_meet_are_told_apart(spark, monkeypatch):
    points = clustered(np.random.default_rng(5), 60, 16, 0.1)
    points[50:] = points[0]
    rows = spark.createDataFrame([(i, p.tolist(), i % 2) for i, p in enumerate(points)], "vec_id long, embedding array<float>, label int")
    want = {tuple(r) for r in embedding_dedup.near_duplicates(rows).collect()}
    monkeypatch.setattr(embedding_dedup, "vector_hash", lambda vector: F.pmod(F.xxhash64("label"), F.lit(3)))
    assert {tuple(r) for r in embedding_dedup.near_duplicates(rows).collect()} == want
    assert len(want) == 60


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(dual_tree, "BLOCK", 100)
    monkeypatch.setattr(dual_tree, "LEAF", 8)
    points = clustered(np.random.default_rng(12), 900, 8, 0.3)
    points[300:330] = points[50]
    rows = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<float>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in dual_tree.top_k(dual_tree.integers(rows)).collect()}
    whole = np.floor(256 * points.astype(float)).astype(int)
    want = {}
    for q in range(0, 900, 50):
        best = sorted((-int(whole[q] @ whole[c]), c) for c in range(900) if c != q)[:5]
        want |= {(q, n + 1): (c, -s) for n, (s, c) in enumerate(best)}
    assert got == want


def test_repeated_rows_take_a_rank_each(spark, monkeypatch):
    monkeypatch.setattr(dual_tree, "BLOCK", 7)
    draw = np.random.default_rng(14)
    points = [(int(i), draw.integers(-50, 50, 3).tolist()) for i in range(60)]
    points += [points[int(i)] for i in draw.integers(0, 60, 60)] + [points[7]] * 9
    rows = spark.createDataFrame(points, "vec_id long, v array<long>").repartition(3)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in dual_tree.top_k(rows, every=10).collect())
    want = []
    for q in range(0, 60, 10):
        best = sorted((-int(np.dot(points[q][1], v)), c) for c, v in points if c != q)[:5]
        want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(best)]
    assert got == want


def test_queries_visit_only_hopeful_cells():
    """On clustered vectors most cells are left before any row is sent; none is left that
    holds a better vector."""
    draw = np.random.default_rng(15)
    centres = 200 * draw.normal(size=(40, 16))
    points = np.floor(centres[draw.integers(0, 40, 4000)] + 4 * draw.normal(size=(4000, 16)))
    pivots = dual_tree._pivots(points[:1000].astype(int).tolist())[16]
    away = np.linalg.norm(points[:, None] - pivots[None], axis=2)
    own = away.argmin(axis=1)
    cells = {(16, c): (int((own == c).sum()), float(away[own == c, c].max())) for c in np.unique(own).tolist()}
    queries = points[::50]
    scores = queries @ points.T
    seeds = np.partition(queries @ points[:1000].T, -5, axis=1)[:, -5]
    chosen = dual_tree.hopeful_cells(queries, seeds, pivots, 16, cells)
    needed = scores >= seeds[:, None]
    assert all(chosen[q, own[needed[q]]].all() for q in range(len(queries)))
    assert chosen.sum() < 0.25 * len(queries) * len(cells)


def test_bounds_hold_for_all_pairs():
    draw = np.random.default_rng(13)
    points = np.floor(256 * draw.normal(size=(400, 6)))

    def nodes(node):
        yield node
        for child in node.children:
            yield from nodes(child)

    tree = dual_tree.cover_tree(points)
    assert sorted(i for node in nodes(tree) if not node.children for i in node.rows) == list(range(400))
    for a in nodes(tree):
        for b in nodes(tree):
            assert (points[a.rows] @ points[b.rows].T).max() <= dual_tree._bound(a, b)


def test_few_labels_shrink_to_the_domain(spark):
    hosts = [(f"h{i}.good.com", 50, 1) for i in range(20)] + [(f"h{i}.bad.com", 50, 48) for i in range(20)]
    hosts += [("new.good.com", 1, 1), ("new.bad.com", 0, 0), ("alone.org", 0, 0), ("x.co.uk", 3, 0), ("a.b.co.uk", 0, 0)]
    got = {r.host: r for r in reputation.reputations(spark.createDataFrame(hosts, "host string, n long, bad long")).collect()}
    assert got["new.good.com"].mean < 0.3 and got["new.bad.com"].log_below <= math.log(0.05)
    assert got["alone.org"].log_below is None or got["alone.org"].log_below > math.log(0.05)
    assert got["h0.bad.com"].log_below < got["new.bad.com"].log_below


def test_chance_below_equals_sums_and_integrals(spark):
    whole = [(1, 1), (7, 2), (40, 39), (300, 250), (5000, 4800)]
    broken = [(0.7, 0.02), (3.25, 0.4), (12.5, 9.75), (900.5, 850.25)]
    cases = spark.createDataFrame([(float(a), float(b)) for a, b in whole + broken], "a double, b double")
    got = {(r.a, r.b): r.below for r in cases.withColumn("below", F.exp(reputation.log_chance_below(F.col("a"), F.col("b"), 0.5))).collect()}
    for a, b in whole:
        exact = sum(math.comb(a + b - 1, j) for j in range(a, a + b)) / 2 ** (a + b - 1)
        assert got[a, b] == pytest.approx(exact, rel=1e-8)
    for a, b in broken:
        # The integral over log odds, where nothing is infinite.
        t = np.linspace(-60, 0, 2_000_001)
        log = -a * np.logaddexp(0, -t) - b * np.logaddexp(0, t)
        log += math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        assert got[a, b] == pytest.approx(np.trapezoid(np.exp(log), t), rel=1e-6)


def test_domains_of_hosts(spark):
    cases = {
        "news.bbc.gov.au": ("bbc.gov.au", "gov.au"), "a.b.com.sg": ("b.com.sg", "com.sg"), "me.github.io": ("me.github.io", "github.io"),
        "x.me.github.io": ("me.github.io", "github.io"), "a.b.example": ("b.example", "example"), "com": ("com", "com"), "co.uk": ("co.uk", "co.uk"),
        "1.2.3.4:80": ("1.2.3.4", ""), "[::1]:80": ("[::1]", ""), "u:p@a.b.org:8080": ("b.org", "org"), "a.b.org.": ("b.org", "org"), "": ("", ""),
        "a.com.de": ("a.com.de", "com.de"), "xco.uk": ("xco.uk", "uk"),
    }
    rows = spark.createDataFrame([(host,) for host in cases], "host string")
    domain, suffix = reputation.split_host(reputation.site_of(F.col("host")))
    assert {r.host: (r.domain, r.suffix) for r in rows.select("host", domain.alias("domain"), suffix.alias("suffix")).collect()} == cases


def test_hosts_are_blocked_without_any_rule(spark):
    bad, good, few = "http://bad.example:8080/", "http://good.example/", "http://few.example/"
    outcomes = [(f"{bad}{i}", int(i > 1)) for i in range(40)] + [(f"{good}{i}", int(i < 2)) for i in range(400)] + [(few, 1), (few, 0)]
    outcomes += [(f"https://h{i}.example/", int(i % 10 == 0)) for i in range(100)]
    pages = [(1, "https://u@bad.example/new"), (2, good), (3, few), (4, "http://bad.example.:80?x"), (5, "http://unknown.example"), (6, "http://5.6.7.8/")]
    seen = reputation.judge(
        spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(outcomes, "url string, bad int"), rules=()
    )
    assert {r.page_id: (r.rule, r.verdict) for r in seen.collect()} == {n: (None, "block" if n in (1, 4) else "allow") for n in range(1, 7)}


def test_longest_rule_wins(spark):
    cases = {
        "http://a.net/en/": "net/", "http://a.net": None, "http://x.example.net/en/1?q": "example.net/en/", "http://notnet/": None,
        "http://EXAMPLE.com/de/#x": "example.com/de/", "http://b.org/fr/x": "org/fr/", "http://borg/fr/": None, "x://a.net?p=/": None,
        "http://example.net/enx": "net/",
    }
    rows = spark.createDataFrame(list(enumerate(cases)), "page_id long, url string")
    none = spark.createDataFrame([], "url string, bad int")
    assert {r.url: r.rule for r in reputation.judge(rows, none).collect()} == cases


def test_the_rest_works_without_this_subpackage(tmp_path):
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(contract.__file__))
    left = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__")
    copy = shutil.copytree(root, tmp_path / "rest", ignore=left)
    code = "import __spark_entry__ as e; assert len(e.queries()) > 70 and 'pipeline' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, timeout=100)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")
def test_sizes_and_targets_of_the_mix_equal_sql(spark):
    """What SQL can express of the mix. Capping goes on for as many rounds as sources."""
    rounds = ", ".join(
        f"""s{n + 1} AS (SELECT source, size, w, coalesce(target, CASE WHEN share * w >= 3 * size THEN 3.0 * size END) AS target
        FROM (SELECT *, (sum(size) OVER () - coalesce(sum(target) OVER (), 0)) / (sum(CASE WHEN target IS NULL THEN w END) OVER ()) AS share
        FROM s{n}))"""
        for n in range(20)
    )
    sql = f"""
        WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
        s0 AS (SELECT source, sum(size)::double AS size, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w,
            NULL::double AS target FROM sized GROUP BY source), {rounds},
        aimed AS (SELECT source, size AS source_size, coalesce(target, w * (sum(size) OVER () - coalesce(sum(target) OVER (), 0))
            / (sum(CASE WHEN target IS NULL THEN w END) OVER ())) AS target FROM s20)
        SELECT doc_id, z.size, source_size::bigint, target FROM sized z JOIN aimed a ON z.source IS NOT DISTINCT FROM a.source"""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    want = {row[0]: row[1:] for row in con.execute(sql).fetchall()}
    got = contract.queries()["op1_mix"](spark, FOLDER).collect()
    assert len(got) == len(want)
    for r in got:
        size, source_size, target = want[r.doc_id]
        assert (r["size"], r.source_size) == (size, source_size) and r.target == pytest.approx(target)
