"""Sentiment, quality, n-best choice, audits and tagging on hand-made data."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedbacklens.operators import generate, hypotheses, metrics, prepare, rouge, sentiment, tagging
from feedbacklens.plans.ordering import number_rows, sum_before

LEXICON = [("good", 1.9), ("bad", -2.5)]


def scores(spark, *texts):
    lexicon = spark.createDataFrame(LEXICON, "word string, valence double")
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    rows = sentiment.sentiment(df, "k", "t", lexicon).collect()
    return {r.k: r for r in rows}


def compound(total):
    return round(total / math.sqrt(total * total + 15), 4)


def test_sentiment(spark):
    rows = scores(spark, "good", "not good", "very good", "good but bad", "good!!", "GOOD day", "plain", "")
    want = [1.9, 1.9 * -0.74, 1.9 + 0.293, 1.9 * 0.5 - 2.5 * 1.5, 1.9 + 2 * 0.292, 1.9 + 0.733, 0, 0]
    for k, total in enumerate(want):
        assert rows[k].compound == pytest.approx(compound(total), abs=1e-4)
    assert (rows[0].positive, rows[0].neutral) == (1.0, 0.0)
    assert (rows[6].positive, rows[6].neutral) == (0.0, 1.0) and rows[7].neutral == 0.0


def test_binary_code_round_trip(spark):
    ranked = spark.createDataFrame([(1, "a", "good thing", 1.0), (2, "a", "bad thing", 0.5)],
                                   "sno long, label string, concept string, score double")
    lexicon = spark.createDataFrame(LEXICON, "word string, valence double")
    wide = sentiment.binary_code(ranked, lexicon, ["good thing", "bad thing"])
    assert all(r["good thing"] + r["bad thing"] == 1 for r in wide.collect())
    back = prepare.concept_rows(wide.select("sno", "issue", "good thing", "bad thing"))
    assert sorted((r.sno, r.concept) for r in back.collect()) == [(1, "good thing"), (2, "bad thing")]


def test_rouge(spark):
    pairs = spark.createDataFrame([("p", "the cat sat on the mat", "the the the cat"), ("q", "", "x")],
                                  "pair string, reference string, candidate string")
    one = {r.pair: r for r in rouge.rouge_n(pairs, "pair", 1).collect()}
    assert one["p"].recall == pytest.approx(3 / 6) and one["p"].precision == pytest.approx(3 / 4)
    assert one["q"].recall == 0.0
    two = {r.pair: r for r in rouge.rouge_n(pairs, "pair", 2).collect()}
    assert two["p"].recall == pytest.approx(1 / 5)
    el = {r.pair: r for r in rouge.rouge_l(pairs, "pair").collect()}
    assert el["p"].recall == pytest.approx(2 / 6)


def test_rouge_interval_holds_mean_and_ignores_partitioning(spark):
    df = spark.createDataFrame([(str(i), "1", (i % 10) / 10, 0.5, 0.5) for i in range(400)],
                               "pair string, metric string, recall double, precision double, f_score double")
    a = rouge.rouge_interval(df.repartition(3), "pair", 200).first()
    b = rouge.rouge_interval(df.repartition(7), "pair", 200).first()
    assert a.recall_cb < a.recall < a.recall_ce and a.recall_ce - a.recall_cb < 0.1
    assert a.recall_cb == pytest.approx(b.recall_cb)
    assert rouge.report_lines(rouge.rouge_interval(df, "pair", 50)).count() == 3


def test_best_hypothesis(spark):
    schema = "example int, hyp int, n_tokens int, finished boolean, log_probs array<double>"
    rows = [(1, 1, 50, True, [0.0, -4.0]), (1, 2, 40, True, [0.0, -2.0]), (1, 3, 99, False, [0.0, -0.1]),
            (2, 1, 5, True, [0.0, -0.1]), (2, 2, 90, False, [0.0, -3.0]),
            (3, 1, 2, False, [0.0, -3.0]), (3, 2, 2, False, [0.0, -1.0])]
    best = hypotheses.pick_best(hypotheses.with_average(spark.createDataFrame(rows, schema)), "example", "hyp", 35)
    assert {r.example: (r.hyp, r.avg_log_prob) for r in best.collect()} == {1: (2, -1.0), 2: (2, -1.5), 3: (2, -0.5)}


def running(losses, decay=0.99, clip=12.0):
    out, x = [], 0.0
    for loss in losses:
        x = loss if x == 0 else x * decay + (1 - decay) * loss
        x = min(x, clip)
        out.append(x)
    return out


@pytest.mark.parametrize("decay", [0.99, 0.5])
def test_running_loss_over_many_ranges(spark, decay):
    rng = np.random.default_rng(0)
    series = {1: [0.0, 0.0, 5.0, 30.0, 1.0], 2: list(rng.exponential(12, size=5_000)), 3: [0.0, 0.0]}
    rows = [(s, i * 3, x) for s, xs in series.items() for i, x in enumerate(map(float, xs))]
    df = spark.createDataFrame(rows, "s int, step long, loss double")
    got = {}
    for r in metrics.running_loss(df, "s", "step", "loss", decay).orderBy("s", "step").collect():
        got.setdefault(r.s, []).append(r.running_avg)
    for s, xs in series.items():
        assert got[s] == pytest.approx(running(xs, decay), rel=1e-9, abs=1e-12)


def test_best_so_far(spark):
    values = [5.0, 5.0, 4.0, 6.0, 3.0]
    df = spark.createDataFrame([(1, i * 700, v) for i, v in enumerate(values)], "s int, step long, v double")
    rows = metrics.best_so_far(df, "s", "step", "v").orderBy("step").collect()
    assert [r.is_best for r in rows] == [True, False, True, False, True]


def test_finite_audit(spark):
    nan = float("nan")
    df = spark.createDataFrame([("a", 1.0), ("b", nan), ("c", 1.0), ("c", float("inf"))], "g string, v double")
    audit = metrics.finite_audit(df, "g", "v")
    assert dict(map(tuple, audit.collect())) == {"a": "finite", "b": "all_nonfinite", "c": "some_nonfinite"}
    assert metrics.audit_passed(audit).first().passed is False
    with pytest.raises(Exception, match="not finite"):
        metrics.require_finite(df, "v").collect()


def test_ordering_is_range_independent(spark):
    df = spark.range(1, 2_000, 7).select("id", (F.col("id") % 3).alias("g"), F.lit(1.0).alias("v"))
    small = number_rows(df.repartition(9), "id", ("g",)).orderBy("id").collect()
    assert small == number_rows(df, "id", ("g",)).orderBy("id").collect()
    sums = sum_before(df, "v", "id", ("g",), "s", width=50)
    assert sums.join(number_rows(df, "id", ("g",)), ["id", "g"]).filter("s <> row_index").isEmpty()


def test_tag_label_blocks(spark):
    rng = np.random.default_rng(1)
    vec = lambda: [float(x) for x in rng.normal(size=5)]
    feedback = [(i, vec()) for i in range(50)]
    labels = [(t, vec()) for t in range(9)]
    args = (spark.createDataFrame(feedback, "id long, vec array<double>"),
            spark.createDataFrame(labels, "tag long, vec array<double>"))
    u = lambda rows: np.array([np.array(v) / np.linalg.norm(v) for _, v in rows])
    want = dict(enumerate((u(feedback) @ u(labels).T).argmax(axis=1).tolist()))
    for size in (4, 2_048):
        assert {r.id: r.tag for r in tagging.tag_label(*args, size).collect()} == want


def test_lead_sentences(spark):
    df = spark.createDataFrame([(1, "It is. The fast red train came late. We saw it.")], "k int, t string")
    assert generate.lead_sentences(df, "k", "t", 1).first().generated == "The fast red train came late."
