"""Steps whose memory or shuffle must not follow the size of a batch, a block or a table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedbacklens.functions import text as T
from feedbacklens.operators import generate, keyphrases, similarity, titles, vocab

TEXTS = ["The red house of Bern stands. Red houses are tall!", "NASA said the cat sat, the cat ran.", "", None,
         "one two three of four five six"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_phrases_of_unique_keys_are_not_shuffled(spark):
    """The former form dealt every phrase and sorted every word of the table."""
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "k long, t string")
    found = keyphrases.keyphrases(docs, "k", "t")
    assert "Exchange" not in plan(found) and "Sort " not in plan(found)
    assert "Exchange" not in plan(generate.lead_sentences(docs, "k", "t"))
    candidates = keyphrases.concept_candidates(
        docs.select("k", F.lit("l").alias("label"), F.col("t").alias("feedback"), F.col("t").alias("generated")), "k")
    assert "Exchange" not in plan(candidates)
    former = keyphrases.shuffled_keyphrases(docs, "k", "t")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, former.collect()))
    assert found.schema.simpleString() == former.schema.simpleString()


def test_rows_that_share_a_key_are_one_document(spark):
    rows = [(0, TEXTS[0]), (0, TEXTS[1]), (None, TEXTS[0]), (None, TEXTS[4]), (2, TEXTS[4])]
    docs = spark.createDataFrame(rows, "k long, t string")
    found = keyphrases.keyphrases(docs, "k", "t").collect()
    former = keyphrases.shuffled_keyphrases(docs, "k", "t").collect()
    assert sorted(map(repr, found)) == sorted(map(repr, former)) and {r.k for r in found} == {0, None, 2}
    leads = {r.k: r.generated for r in generate.lead_sentences(docs, "k", "t", sentences=1).collect()}
    assert set(leads) == {0, None, 2} and leads[2] == TEXTS[4]


def test_generators_get_a_few_hundred_rows_at_a_time(spark):
    docs = spark.range(1200).coalesce(1).select("id", F.lit("x").alias("article"))
    sizes = generate.generate(docs, lambda s: [str(len(s))] * len(s)).select("generated").distinct().collect()
    assert max(int(r.generated) for r in sizes) <= 500


def test_lookups_in_slices_keep_rows_apart(spark):
    known = spark.createDataFrame([("a", 7, 1), ("b", 8, 1)], "word string, id int, cnt long")
    words = F.when(F.col("id") % 3 == 0, F.array(F.lit("a"), F.lit("?"))).when(F.col("id") % 3 == 1, F.array(F.lit("b")))
    docs = spark.range(2 * vocab.LOOK_UP_ROWS + 5).coalesce(1).select("id", words.alias("w"))
    rows = vocab.lookup_ids(docs, known, "id", "w", "ids").collect()
    assert all(r.ids == [[7, 0], [8], []][r.id % 3] for r in rows) and len(rows) == 2 * vocab.LOOK_UP_ROWS + 5


def test_acronyms_may_come_with_the_rows(spark):
    rows = spark.createDataFrame([("src", "the nasa rocket flew high", "NASA rocket")], "label string, concept string, feed string")
    usual = titles.remove_title_text(rows, 60).collect()
    given = titles.remove_title_text(rows.withColumn("_acronyms", T.acronyms(F.col("feed"))).drop("feed"), 60).collect()
    assert usual == given and given[0].concept == "the NASA rocket flew high"


@pytest.mark.parametrize("rows, columns", [(2048, 2048), (20_000, 256), (1, 1), (3, 1 << 20)])
def test_strips_cover_a_matrix_and_stay_small(rows, columns):
    strips = similarity._strips(rows, columns)
    assert [s.start for s in strips[1:]] == [s.stop for s in strips[:-1]] and strips[-1].stop == rows
    assert all((s.stop - s.start) * columns <= max(similarity.STRIP_CELLS, columns) for s in strips)


def test_blocks_of_many_strips(spark):
    """One block of 900 rows is four strips, two blocks are strips of a pair: both as the whole matrix."""
    draw = np.random.default_rng(5)
    vec = draw.normal(size=(900, 6))
    unit = vec / np.linalg.norm(vec, axis=1, keepdims=True)
    cs = np.rint(unit @ unit.T * similarity.STEPS)
    assert len(similarity._strips(900, 900)) > 3
    df = spark.createDataFrame([(1, i, i % 50, v.tolist()) for i, v in enumerate(vec)],
                               "label int, id long, length long, vec array<double>")
    np.fill_diagonal(cs, 0)
    best, to, middle = cs.max(axis=1), cs.argmax(axis=1), np.median(cs)
    edges = {(i, int(to[i])) for i in range(900) if best[i] >= middle}
    near = {(int(i), int(j)) for i, j in zip(*np.nonzero(cs > 0.9 * similarity.STEPS))}
    length = np.arange(900) % 50
    dead = {i for i, j in near if (length[i], -i) < (length[j], -j)}
    for block_rows in (2_048, 600):
        found = similarity.nearest_neighbour_graph(df, block_rows).collect()
        assert {(r.src, r.dst) for r in found} == edges
        assert {(r.i, r.j) for r in similarity.similar_pairs(df, 0.9, block_rows).collect()} == near
        left = {r.id for r in similarity.dedupe_concepts(df, 0.9, block_rows=block_rows).collect()}
        assert left == set(range(900)) - dead
