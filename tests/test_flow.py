"""The whole flow on a few comments."""

import os
import time

import numpy as np
import pytest

from feedbacklens import session
from feedbacklens.operators import lexical, similarity
from feedbacklens.plans import flow

TEXT = ("the waiting queue at the counter is very long. the online form asks twice for my address. "
        "staff explained the refund rules well.")


def test_keys_may_repeat_and_be_large(spark):
    docs = spark.createDataFrame(
        [(1, "fees", TEXT, TEXT), (1, "fees", "another comment", "the parking place near the entrance was closed today."),
         (9_000_000_000_000_000_000, "fees", TEXT, TEXT), (None, "fees", TEXT, TEXT)],
        "sno long, label string, feedback string, generated string")
    params = flow.Parameters(minimum_feedbacks=1)
    found = flow.candidate_concepts(docs.repartition(3), params).collect()
    assert len({r.id for r in found}) == len(found) > 6
    parking = [r for r in found if "parking" in r.concept]
    assert [r.sno for r in parking] == [1]
    by_key = lambda k: sorted(r.concept for r in found if r.sno == k)
    assert by_key(9_000_000_000_000_000_000) == by_key(None)
    assert set(by_key(None)) < set(by_key(1))
    again = flow.candidate_concepts(docs.repartition(1), params).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_concepts_with_spelling_and_lemmas(spark):
    docs = spark.createDataFrame([(1, "fees", TEXT, TEXT), (2, "fees", TEXT, TEXT.replace("queue", "queeu"))],
                                 "sno long, label string, feedback string, generated string")
    words = sorted(set(TEXT.replace(".", "").split()))
    vectors = spark.createDataFrame([(w, [float((i * 7 + j) % 5 - 2) for j in range(4)]) for i, w in enumerate(words)],
                                    "word string, vec array<double>")
    dictionary = spark.createDataFrame([(w, 9) for w in words], "word string, cnt long")
    rows = flow.important_concepts(docs, vectors, 4, flow.Parameters(), dictionary=dictionary).collect()
    assert rows and all(r.label == "fees" and 0 < r.score <= 1 for r in rows)


def word_vectors(spark, dim=4):
    words = sorted(set(TEXT.replace(".", "").split()) - {"queue"})
    return spark.createDataFrame([(w, [float((i * 7 + j * j) % 5 - 2) for j in range(dim)]) for i, w in enumerate(words)],
                                 "word string, vec array<float>")


CONCEPTS = [(0, "the form asks the form"), (1, "Rules explained well"), (2, "queue"), (3, None), (4, "form the asks form the")]


def test_codes_read_as_the_vectors_they_stand_for(spark):
    """The former flow sent a vector of doubles for each word of each concept."""
    concepts = spark.createDataFrame(CONCEPTS, "id long, concept string")
    vectors = word_vectors(spark)
    coded, read = lexical.coded_vectors(concepts, "concept", vectors, 4)
    codes = coded.orderBy("id").select("vec").toArrow().column("vec")
    assert "Exchange" not in coded._jdf.queryExecution().executedPlan().toString()
    words = lexical.concept_words(concepts, "id", "concept")
    full = lexical.concept_vectors(concepts, "id", words, vectors, 4).orderBy("id").collect()
    assert np.allclose(read(codes), [r.vec for r in full], atol=1e-15)
    codes = codes.to_pylist()
    assert codes[0] == codes[4] and codes[2] == codes[3] == []


@pytest.mark.parametrize("word, vec", [("the", [1.0] * 4), ("new", None), ("new", [1.0]), (None, [1.0] * 4), ("new", [1.0, None, 1.0, 1.0])])
def test_irregular_vectors_are_not_coded(spark, word, vec):
    more = spark.createDataFrame([(word, vec)], "word string, vec array<float>")
    concepts = spark.createDataFrame(CONCEPTS, "id long, concept string")
    assert lexical.coded_vectors(concepts, "concept", word_vectors(spark).union(more), 4) is None


def test_codes_and_vectors_give_the_same_rows(spark, monkeypatch):
    draw = np.random.default_rng(3)
    known = [r.word for r in word_vectors(spark).collect()] + ["queue"]
    rows = [(i % 2, i, " ".join(draw.choice(known, draw.integers(0, 5)))) for i in range(120)]
    concepts = spark.createDataFrame(rows, "label int, id long, concept string").selectExpr("*", "length(concept) AS length")
    vectors = word_vectors(spark)
    words = lexical.concept_words(concepts, "id", "concept")
    plain = concepts.join(lexical.concept_vectors(concepts, "id", words, vectors, 4), "id")
    coded, read = lexical.coded_vectors(concepts, "concept", vectors, 4)
    monkeypatch.setattr(similarity, "ROUND_ROWS", 0)  # several rounds
    monkeypatch.setattr(similarity, "CODED_ROWS", 16)
    kept = [sorted(r.id for r in similarity.dedupe_concepts(d, 0.9, read=f).collect()) for d, f in ((plain, None), (coded, read))]
    edges = [sorted(map(tuple, similarity.nearest_neighbour_graph(d, read=f).collect())) for d, f in ((plain, None), (coded, read))]
    assert kept[0] == kept[1] and 0 < len(kept[0]) < 120
    assert edges[0] == edges[1] and edges[0]


def test_settled_keeps_only_its_table(spark):
    """Shuffle files and tables on the way went only with the application before."""
    folder = session._own_dir(spark)
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: sum(f.getName().startswith("shuffle_") for f in _scala(spark, disk.getAllFiles()))
    files = shuffled()
    found = session.settled(lambda: session.cut(spark.range(100).repartition(3)).repartition(2))
    until = time.time() + 10
    while shuffled() > files and time.time() < until:  # they go in the background
        time.sleep(0.1)
    assert shuffled() <= files
    assert set(os.listdir(folder)) - before == {os.path.basename(found.cut_path)}
    assert found.count() == 100
    assert spark.conf.get(session.CLEANUP) == "false"


def _scala(spark, files):
    return list(spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(files))
