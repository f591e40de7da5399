"""Components, SimHash, top-k search and embedding near-duplicates against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from feedbacklens.llm import components, embed_dedup, simhash, topk


def parts(nodes, links):
    """Smallest member of each node's part."""
    name = {n: n for n in nodes}

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        name[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("task_edges", [3, 10_000])
def test_components_of_chains_stars_and_noise(spark, task_edges):
    draw = random.Random(task_edges)
    edges = ([(draw.randrange(80), draw.randrange(80)) for _ in range(50)] + [(i, i + 1) for i in range(200, 240)]
             + [(500, i) for i in range(501, 530)] + [(7, 7), (200, 201), (201, 200)])
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    got = {r.node: r.root for r in components.components(
        spark.createDataFrame([*edges, (None, 1)], "a long, b long"), task_edges).collect()}
    expected = parts(nodes, [e for e in edges if e[0] != e[1]])
    assert set(got) == nodes
    assert all((got[a] == got[b]) == (expected[a] == expected[b]) for a in nodes for b in nodes)


def test_no_edges(spark):
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s, seed=42).intdigest()
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


TEXTS = [None, "", " \t\n", "One", "one", "one two", "ONE  two", "É é\xa0é", "a b c d e f g h", "a b c d e f g i",
         " ".join(f"w{i}" for i in range(400)), " ".join(f"w{i}" for i in range(399)) + " x",
         " ".join(f"w{i % 7}" for i in range(20_000))]


def test_fingerprints():
    assert [simhash.fingerprint(t) % (1 << 64) for t in TEXTS] == [plain_fingerprint(t) for t in TEXTS]


def test_near_duplicates(spark):
    draw = random.Random(1)
    texts = list(TEXTS)
    for _ in range(30):  # families of near copies
        words = [f"v{draw.randrange(3000)}" for _ in range(250)]
        for _ in range(4):
            copy = list(words)
            copy[draw.randrange(250)] = "changed"
            texts.append(" ".join(copy))
    rows = [(i * 3 % 997, t) for i, t in enumerate(texts)] + [(0, TEXTS[8]), (None, TEXTS[8])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    got = simhash.near_duplicates(docs).collect()
    prints = {(k, t): plain_fingerprint(t) for k, t in rows}
    distinct = sorted(set(prints.values()))
    named = parts(distinct, [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 2])
    smallest = {}
    for (k, _), fp in prints.items():
        if k is not None:
            smallest[named[fp]] = min(k, smallest.get(named[fp], k))
    assert len(got) == len(rows)
    expected = sorted((str(k), fp, smallest[named[fp]]) for k, t in rows for fp in [prints[k, t]])
    assert sorted((str(r.doc_id), r.fp % (1 << 64), r.component) for r in got) == expected
    assert len(set(named.values())) < len(distinct)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("radius", [2, 4])
def test_ball_reaches_its_radius(spark, radius):
    draw = random.Random(radius)
    base = [draw.getrandbits(63) for _ in range(20)]
    near = base + [b ^ sum(1 << p for p in draw.sample(range(63), k)) for b in base for k in range(1, radius + 2)]
    got = parts(near, [(r.a, r.b) for r in simhash.near_edges(
        spark.createDataFrame([(n,) for n in set(near)], "fp long"), radius).collect()])
    assert got == parts(near, [(a, b) for a in near for b in near if (a ^ b).bit_count() <= radius])


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.near_edges(spark.createDataFrame([(1,)], "fp long"), 3)


SCHEMA = "vec_id long, embedding array<float>, label int, uid string"


def vector_rows():
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(12, 8))
    rows = [(int(i), [float(x) for x in np.float32(centres[i % 12] + draw.normal(size=8) * 0.12)], int(i % 3), "u")
            for i in range(420)]
    rows += [(1000 + i, rows[7][1], rows[7][2], "u") for i in range(90)]  # one large group of copies
    rows += [(rows[7][0], rows[7][1], rows[7][2], "u"), (2000, None, 1, "u"), (2050, [], 1, "u"),
             (2100, [float("nan")] * 8, 1, "u"), (2150, [0.0] * 8, 1, "u"), (2200, [None] * 8, 1, "u"),
             (2250, [float("inf")] + [1.0] * 7, 1, "u"), (2300, rows[3][1], None, "u"), (2350, rows[3][1][:5], 0, "u")]
    return rows


def sound(vector):
    return bool(vector) and all(x is not None and np.isfinite(x) for x in vector)


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", 60)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    monkeypatch.setattr(topk, "SAMPLE", 40)
    rows = vector_rows()
    got = topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0).collect()
    good = [(k, np.floor(256 * np.float64(np.float32(np.pad(v, (0, 8 - len(v)))))).astype(int))
            for k, v, *_ in rows if sound(v)]
    expected = []
    for i, (k, q) in enumerate(good):
        if k % 50 == 0:
            best = sorted((-int(q @ v), j) for m, (j, v) in enumerate(good) if m != i)[:5]
            expected += [(k, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(expected)


def test_top_k_of_few(spark):
    few = spark.createDataFrame([(0, [1.0], 0, "u"), (50, [0.5], 0, "u"), (3, [2.0], 0, "u")], SCHEMA)
    got = topk.top_k(few, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id, r.score) for r in got] == [
        (0, 3, 512 * 256), (0, 50, 128 * 256), (50, 3, 512 * 128), (50, 0, 256 * 128)]
    assert topk.top_k(few.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.top_k(few, F.lit(False)).count() == 0


def test_embedding_duplicates(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "LEAF_ROWS", 8)
    monkeypatch.setattr(embed_dedup, "SAMPLE", 50)
    rows = vector_rows()
    got = embed_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    units = {i: np.pad(np.float64(np.float32(v)), (0, 8 - len(v))) for i, (_, v, label, _) in enumerate(rows)
             if sound(v) and any(v) and label is not None}
    units = {i: v / np.linalg.norm(v) for i, v in units.items()}
    links = [(a, b) for a in units for b in units
             if a < b and rows[a][2] == rows[b][2] and units[a] @ units[b] >= 0.93]
    degree = np.bincount(np.array(links).ravel(), minlength=len(rows))
    named = parts(range(len(rows)), links)
    smallest = {}
    for i, (k, *_) in enumerate(rows):
        smallest[named[i]] = min(k, smallest.get(named[i], k))
    expected = sorted((k, int(degree[i]), smallest[named[i]]) for i, (k, *_) in enumerate(rows))
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == expected
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_no_vectors(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert embed_dedup.near_duplicates(empty).count() == 0
    alone = embed_dedup.near_duplicates(spark.createDataFrame([(4, None, 1, "u"), (None, [1.0], None, "u")], SCHEMA))
    assert sorted((str(r.vec_id), r.n_links, r.kept) for r in alone.collect()) == [("4", 0, True), ("None", 0, True)]


def test_distant_halves_are_skipped():
    draw = np.random.default_rng(2)
    unit = embed_dedup.unit_rows(np.vstack([draw.normal(size=(300, 4)) * 0.05 + 1, draw.normal(size=(300, 4)) * 0.05 - 1]))
    side = {"ids": np.arange(600), "copies": np.ones(600, int), "spot": unit[:, :3], "vectors": unit}
    work = embed_dedup.GridJoin(side, side, 0.93)
    seen = []
    leaf = work.leaf
    work.leaf = lambda a0, a1, b0, b1: (seen.append((a1 - a0) * (b1 - b0)), leaf(a0, a1, b0, b1))
    work.run(0, 600, 0, 600)
    near = unit @ unit.T >= 0.93
    np.fill_diagonal(near, False)
    assert (work.links_a == near.sum(axis=1)).all()
    assert sum(seen) < 0.45 * 600 * 600


def test_one_of_each(spark):
    """Null ids last, ids shared by different texts, rows that repeat, a clashing extra column."""
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(3, "a b c d"), (1, "a b c d"), (None, "a b c d"), (4, long), (4, long), (5, "x y z"), (5, "p q r s t"),
            (None, "only here"), (None, "only here"), (7, None), (6, ""), (None, " ")]
    docs = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(rows)], "doc_id long, text string, _place int")
    got = [(r.doc_id, r.text) for r in simhash.one_of_each(docs).collect()]
    assert sorted(got, key=str) == sorted(
        [(1, "a b c d"), (4, long), (5, "x y z"), (5, "p q r s t"), (None, "only here"), (6, "")], key=str)
    assert simhash.one_of_each(docs).columns == docs.columns
    assert simhash.one_of_each(docs.limit(0)).count() == 0
