"""Readers, writers and streams on small files."""

import pytest
from pyspark.sql import functions as F

from feedbacklens.operators import metrics
from feedbacklens.sources import readers, writers
from feedbacklens.streaming import jobs


def test_manifest_and_parameters(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("f1.tsv\tc1.tsv, c2.tsv\nf2.tsv\n")
    rows = readers.manifest(spark, str(tmp_path / "m.tsv")).collect()
    assert sorted(map(tuple, rows), key=str) == [
        ("f1.tsv", "c1.tsv"), ("f1.tsv", "c2.tsv"), ("f2.tsv", None)]
    (tmp_path / "p.txt").write_text("labelmatch=80\nsimthreshold=0.9\n\n")
    assert readers.parameters(spark, str(tmp_path / "p.txt")) == {"labelmatch": 80, "simthreshold": 0.9}
    for bad in ("labelmatch", "other=1", "labelmatch="):
        (tmp_path / "bad.txt").write_text(bad + "\n")
        with pytest.raises(ValueError):
            readers.parameters(spark, str(tmp_path / "bad.txt"))


def test_story_and_generated_files(spark, tmp_path):
    (tmp_path / "pa_train_1.story").write_text("body\n\n@highlight\nshort")
    rows = readers.story_files(spark, str(tmp_path)).collect()
    assert [(r.story_id, r.story) for r in rows] == [("pa_train_1", "body\n\n@highlight\nshort")]
    (tmp_path / "000012_decoded.txt").write_text("Original Feedback: a\n\nGenerated Concept: \nx .\ny .")
    (tmp_path / "000013_decoded.txt").write_text("no marker")
    parsed = readers.parse_generated(readers.generated_files(spark, str(tmp_path))).collect()
    assert [tuple(r) for r in parsed] == [(12, "x .\ny .")]


def test_record_files_are_chunked(spark, tmp_path):
    df = spark.range(25).coalesce(1).select(
        F.when(F.col("id") == 3, "").otherwise(F.lit("a")).alias("article"), F.lit("b").alias("abstract"))
    writers.records(df, str(tmp_path / "r"), 10)
    assert len(list((tmp_path / "r").glob("*.parquet"))) == 3
    assert readers.records(spark, str(tmp_path / "r")).count() == 24


def test_vocabulary_and_vector_files(spark, tmp_path):
    vocab = spark.createDataFrame([("[UNK]", 0, None), ("the", 4, 9), ("cat", 5, 2)], "word string, id int, cnt long")
    writers.vocabulary(vocab, str(tmp_path / "v"))
    back = readers.vocabulary(spark, str(tmp_path / "v")).filter("id >= 4").orderBy("id").collect()
    assert [tuple(r) for r in back] == [("the", 4, 9), ("cat", 5, 2)]
    (tmp_path / "vec.txt").write_text("the 0.5 1\ncat -1 2\n")
    rows = {r.word: r.vec for r in readers.word_vectors(spark, str(tmp_path / "vec.txt")).collect()}
    assert rows == {"the": [0.5, 1.0], "cat": [-1.0, 2.0]}


def test_tsv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(0, 5, "some text", "fees")], readers.UNMATCHED_SCHEMA)
    writers.tsv(df, str(tmp_path / "u"))
    assert readers.unmatched(spark, str(tmp_path / "u")).collect() == df.collect()
    assert "Binary_Coded_" in writers.binary_coded(df, str(tmp_path))


def test_stream_over_interleaved_files_equals_batch(spark, tmp_path):
    """Steps in any order within the wait, a series with a third of the rows, one with zeros first."""
    rows = [(1, i, float((i * 7) % 23)) for i in range(120)]
    rows += [(s, i, float((i * 7 + s) % 23) if i or s > 2 else 0.0) for i in range(40) for s in (2, 3, 4, 5, 6, 7)]
    df = spark.createDataFrame(rows, "series long, step long, loss double")
    for part in range(3):  # the parts overlap: each has every third step of its range and the next
        df.filter(F.floor((F.col("step") + F.col("step") % 3 * 13) / 45) == part).coalesce(1).write.mode(
            "append").parquet(str(tmp_path / "in"))
    df.filter(F.floor((F.col("step") + F.col("step") % 3 * 13) / 45) > 2).coalesce(1).write.mode(
        "append").parquet(str(tmp_path / "in"))
    stream = jobs.file_stream(spark, str(tmp_path / "in"), df.schema, files_per_batch=1)
    got = {(r.series, r.step): r for r in jobs.losses(spark, stream, "t", wait=60).collect()}
    want = metrics.running_loss(df, "series", "step", "loss").withColumn("seen", F.round("running_avg", 9))
    want = metrics.best_so_far(want, "series", "step", "seen").collect()
    assert len(got) == len(want) == len(rows) and not any(r.late for r in got.values())
    for r in want:
        one = got[r.series, r.step]
        assert abs(one.running_avg - r.running_avg) < 1e-9 and one.is_best == r.is_best


def test_late_steps_are_returned_and_marked(spark, tmp_path):
    """Without a wait, what comes behind the last step is late; the others are averaged without it."""
    rows = [(1, i, float(i % 5 + 1)) for i in range(20)]
    df = spark.createDataFrame(rows, "series long, step long, loss double")
    for part in (0, 1):  # odd steps come after all even ones
        df.filter(F.col("step") % 2 == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = jobs.file_stream(spark, str(tmp_path / "in"), df.schema, files_per_batch=1)
    got = jobs.losses(spark, stream, "late").collect()
    assert sorted((r.step, r.loss) for r in got) == [(i, float(i % 5 + 1)) for i in range(20)]
    assert sorted(r.step for r in got if r.late) == list(range(1, 19, 2))
    assert all((r.running_avg is None) == r.late for r in got)
    want = metrics.running_loss(df.filter("step % 2 = 0 or step = 19"), "series", "step", "loss")
    assert {r.step: round(r.running_avg, 9) for r in want.collect()} == {
        r.step: round(r.running_avg, 9) for r in got if not r.late}


def test_a_repeated_micro_batch_replaces_itself(spark):
    from feedbacklens.session import scratch_path

    out = scratch_path(spark, "again")
    batch = lambda *steps: spark.createDataFrame([(1, s, float(s)) for s in steps], jobs.LOSSES)
    for number, steps in enumerate([(1, 2, 5), (3, 4), (2, 6, 9)]):
        for _ in range(2):  # as after a lost driver
            jobs._advance(batch(*steps), number, out, 2, 0.99, 12.0)
    jobs.finish(spark, out)
    got = spark.read.schema(jobs.COUNTED).parquet(out).collect()
    assert sorted((r.step, r.late) for r in got) == [(1, False), (2, False), (2, True), (3, False), (4, False), (5, False),
                                                     (6, False), (9, False)]


def test_all_parameter_lines_are_read(spark, tmp_path):
    (tmp_path / "p.txt").write_text("simthreshold=0.9\n" * 7 + "nonsense=1\n")
    with pytest.raises(ValueError):
        readers.parameters(spark, str(tmp_path / "p.txt"))


def test_scratch_files_can_be_removed(spark):
    import os

    from feedbacklens import session

    one, two = session.cut(spark.range(3)), session.cut(spark.range(4))
    session.release(one)
    assert not os.path.exists(one.cut_path.removeprefix("file:")) and two.count() == 4


def test_table_streams_take_a_file_or_a_folder(spark, tmp_path):
    """Tables written by Spark are folders of files; a stream over them must not come out empty."""
    import __spark_entry__ as entry

    docs = spark.range(40).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"),
        F.lit("src").alias("source"))
    labels = spark.range(0, 40, 4).select(
        F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    for kind in ("folder", "file"):
        sf = tmp_path / kind
        sf.mkdir()
        for name, df in {"documents": docs, "labels": labels}.items():
            if kind == "folder":
                df.repartition(3).write.parquet(str(sf / f"{name}.parquet"))
            else:
                df.toPandas().to_parquet(str(sf / f"{name}.parquet"))
        run = lambda name: entry.queries()[name](spark, str(sf))  # noqa: B023, E731
        refreshed = sorted(map(tuple, run("stream_refresh").collect()))
        assert refreshed == [(i, "src", 1) for i in range(0, 40, 4)]
        assert run("stream_score").count() == 30
