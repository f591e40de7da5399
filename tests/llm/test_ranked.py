"""Ranked search against scoring every document."""

import random
import re

import numpy as np
import pytest

from feedbacklens.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def plain(docs, items, limit=10):
    """Rows of every item, in order, by the formula."""
    found = [(k, plain_terms(t)) for k, t in docs]
    documents, total = sum(bool(t) for _, t in found), sum(len(t) for _, t in found)
    rows = []
    for _, text in items:
        scores = []
        for k, t in found:
            m = 25 + (75 * len(t) * documents) // max(total, 1)
            score = sum(ranked.weight(documents, sum(term in u for _, u in found))
                        * (1_000_000_000 * t.count(term) // (1000 * t.count(term) + 8 * m)) for term in plain_terms(text))
            if score > 0:
                scores.append((-score, k is None, k or 0, k))
        scores.sort(key=lambda s: s[:3])
        rows.append([(rank, k, -s) for rank, (s, _, _, k) in enumerate(scores[:limit], 1)])
    return rows


def corpus(seed, size=120):
    draw = random.Random(seed)
    words = [f"w{min(draw.randrange(1, 60), draw.randrange(1, 60))}" for _ in range(400)] + ["É", "é", "日本", "A1", "a1"]
    made = [(i, draw.choice(" -\n").join(draw.choice(words) for _ in range(draw.randrange(0, 40)))) for i in range(size)]
    odd = [(None, "w1 w2 w3"), (None, "w1 w2 w3"), (size, None), (size + 1, ""), (size + 2, " .,;"),
           (3, made[3][1]), (size + 3, "w5 " * 9_000)]
    copies = [(1000 + i, made[7][1] + " w1 w2") for i in range(60)]
    rows = [*made, *odd, *copies]
    draw.shuffle(rows)
    asked = [(1, "w1 W2 w2 w30"), (2, None), (3, ""), (4, "unseen"), (5, made[7][1]), (5, "É é 日本 a1"), (6, "w1 W2 w2 w30"),
             (None, "w3"), (7, " ".join(words[:80]))]
    return rows, asked


@pytest.mark.parametrize(("shard", "block"), [(1_000_000, 4_000_000), (150, 40)])
def test_against_plain(spark, shard, block):
    """Ties, copies, null keys, repeated items; several shards and blocks give the same rows."""
    rows, asked = corpus(shard)
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, q int, score string")
    items = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(asked)], "item_id long, text string, rank int")
    got = ranked.search(docs.repartition(3), items, shard=shard, block_chars=block).collect()
    expected = [str((k, *row)) for (k, _), found in zip(asked, plain(rows, asked)) for row in found]
    assert sorted(str((r.item_id, r.rank, r.doc_id, r.score)) for r in got) == sorted(expected)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked.search(docs.limit(0), items).count() == 0
    assert ranked.search(docs, items.limit(0)).count() == 0


@pytest.mark.parametrize("leaf", [0, 1, 50])
def test_intervals_leave_documents_out(leaf):
    """The search equals a full scan and opens far fewer intervals than there are documents."""
    draw = np.random.default_rng(leaf)
    docs, words = 3_000, 200
    counts = draw.zipf(1.6, size=docs * 12) % words
    doc = np.sort(draw.integers(0, docs, len(counts)))
    lengths = np.bincount(doc, minlength=docs).tolist()
    weights = np.array([ranked.weight(docs, len(set(doc[counts == w]))) for w in range(words)], np.int64)
    shard = ranked.Shard(list(range(docs)), lengths, doc, counts.astype(np.int64), weights, docs, len(counts))
    for asked in ([150], [3, 120], [20, 40, 60, 80]):
        best = []
        opened = shard.search(np.array(asked), np.ones(len(asked), np.int64), best, 10, leaf)
        scores = np.zeros(docs, np.int64)
        for a in asked:
            span = slice(shard.starts[a], shard.starts[a + 1])
            scores[shard.doc[span]] += shard.impact[span]
        order = sorted((-int(s), False, d) for d, s in enumerate(scores) if s > 0)[:10]
        assert best == order and opened < max(np.count_nonzero(scores) / 2, 20)
