"""Line deduplication against a plain count."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedbacklens.llm import line_dedup

BLANK = " \t\n\x0b\f\r"


def plain_key(line):
    return "".join(c.lower() if c.isascii() else c for c in line.strip(BLANK))


def plain(texts, min_docs, min_chars=1):
    cuts = [(t or "").split("\n") for t in texts]
    count = Counter(k for lines in cuts for k in {plain_key(line) for line in lines})
    gone = {k for k, n in count.items() if n >= min_docs and len(k) >= min_chars}
    kept = [[line for line in lines if plain_key(line) not in gone] for lines in cuts]
    return [("\n".join(k), len(c), len(c) - len(k)) for c, k in zip(cuts, kept)]


def texts_of(seed):
    draw = random.Random(seed)
    lines = ["", "  ", "Home", "home ", "\tHOME\r", "É", "é", "x", "\xa0x", "Menu | About", "a\x00b", "𝄞 lied"]
    made = ["\n".join(draw.choice(lines + [f"own {draw.randrange(60)}"] * 6) for _ in range(draw.randrange(1, 9)))
            for _ in range(90)]
    return [None, "", "\n", "\n\n", "home", *made, *[made[0]] * 30,
            "\n".join(f"own {i % 80}" for i in range(20_000)), None]


@pytest.mark.parametrize(("batches", "min_docs", "min_chars"), [(1, 3, 1), (4, 10, 1), (9, 10, 2)])
def test_against_plain(spark, batches, min_docs, min_chars):
    """Repeated rows, equal ids, nulls and names that clash; any number of batches, with compactions."""
    texts = texts_of(min_docs)
    rows = [(i % 7 if i % 7 else None, t, i, "x", 1.5) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, a int, _gone string, N_LINES double").repartition(5)
    got = line_dedup.dedup_lines(docs, min_docs=min_docs, min_chars=min_chars, batches=batches)
    assert [c for c in got.columns if c.lower() == "n_lines"] == ["n_lines"]
    found = {r.a: (r.text, r.n_lines, r.n_dropped, r.doc_id, r._gone) for r in got.collect()}
    assert len(found) == len(texts)
    for r, expected in zip(rows, plain(texts, min_docs, min_chars)):
        assert found[r[2]] == (*expected, r[0], "x")


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.dedup_lines(docs, batches=2).count() == 0


def test_runs_are_compacted_and_skip_what_is_known(spark):
    """Five batches at fan-out two: levels of one run each, sums exact, known hashes written once."""
    runs = line_dedup.SortedRuns(spark, at_least=4, fanout=2)
    batch = spark.createDataFrame([(1, 1)] * 4 + [(2, 2)], "a long, b long")
    for _ in range(5):
        runs.add(batch)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    sums = {r.a: r.docs for r in runs._sums(runs.runs()).collect()}
    assert sums == {1: 4, 2: 4}  # frequent after the first and after the fourth batch
    assert sorted(r.a for r in runs.frequent().collect()) == [1, 2]
    runs.close()
    assert not runs.runs()


def test_plans(spark):
    """The anti-join shuffles the batch only; a compaction shuffles once; no Python anywhere."""
    runs = line_dedup.SortedRuns(spark, at_least=2)
    batch = spark.range(1000).select(F.col("id").alias("a"), F.col("id").alias("b"))
    runs.add(batch)
    runs.add(batch)
    fresh = batch.groupBy("a", "b").count()
    for run in runs.runs():
        fresh = fresh.join(spark.table(run).select("a", "b").hint("merge"), ["a", "b"], "left_anti")
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("SortMergeJoin") == 2
    plan = runs._sums(runs.runs())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    runs.close()
    docs = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    plan = line_dedup.drop_lines(docs, batch)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
