"""The pipeline's stages, each held against its operator or brute force, and the whole run."""

import os
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from feedbacklens.llm import byte_bpe, secrets, simhash, toxicity

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The input and every stage's result, written and read again."""
    tables = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, tables[-1], SF_DIR).write.parquet(path)
        tables.append(spark.read.parquet(path))
    return tables


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(steps):
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "simhash", "secrets", "mixing", "encode"]
    assert all(sorted(t.columns) == sorted(pipeline.COLUMNS) for t in steps[:-1])
    sizes = [t.count() for t in steps]
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.5 * sizes[0]


def test_toxic_documents_go(spark, steps):
    before, after = rows(steps[0]), rows(steps[1])
    marks = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scored = rows(toxicity.score_texts(steps[0], marks))
    assert set(after) == {k for k, r in scored.items() if not r.predicted}
    assert all(after[k] == before[k] for k in after)
    clean = {r.doc_id for r in marks.filter("toxic = 0").collect()}
    assert len(clean & set(after)) >= 0.98 * len(clean)


def test_one_of_each_group_stays(steps):
    before, after = rows(steps[1]), rows(steps[2])
    prints = {k: simhash.fingerprint(r.text) for k, r in before.items()}
    near = lambda a, b: ((prints[a] ^ prints[b]) % (1 << 64)).bit_count() <= 2
    left = set(prints)
    groups = []
    while left:
        group, rim = set(), [min(left)]
        while rim:
            one = rim.pop()
            group.add(one)
            left.discard(one)
            more = [k for k in left if near(one, k)]
            rim += more
            left.difference_update(more)
        groups.append(group)
    assert set(after) == {min(g) for g in groups} and len(groups) < len(before)


def test_secrets_are_masked(steps):
    before, after = rows(steps[2]), rows(steps[3])
    assert set(before) == set(after)
    changed = {k for k in before if before[k].text != after[k].text}
    plain = lambda t: (any(len(v[1]) >= 6 for v in re.findall(secrets.ASSIGN, t))
                       or re.search(f"{secrets.ACCESS}|{secrets.HEX}", t))
    assert {k for k, r in before.items() if plain(r.text)} <= changed
    assert all("[secret]" in after[k].text and after[k].n_chars == len(after[k].text) for k in changed)
    assert not any(re.search("[0-9a-f]{24}", after[k].text) for k in after)


def test_sources_are_mixed(steps):
    before, after = rows(steps[3]), rows(steps[4])
    assert all(after[k] == before[k] for k in after) and len(after) == steps[4].count()
    words = lambda t: sum(len(r.text.split()) for r in t.values())
    assert 0.85 * words(before) < words(after) < 0.97 * words(before)


def test_ids(steps):
    before, after = rows(steps[4]), rows(steps[5])
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        encoder = byte_bpe.encoder_for(file.read(), public_tokenizers.PATTERN)
    assert set(before) == set(after) and all(r.round_trip for r in after.values())
    for k in list(after)[:40]:
        assert encoder.decode(after[k].token_ids).decode() == before[k].text
        assert after[k].n_tokens == len(after[k].token_ids)


def test_odd_tables(spark, tmp_path):
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", "en", "src1", 0), (2, "a b " * 50_000, None, "", 7), (2, "x y z", "en", "src1", 5)],
        steps_schema := "doc_id long, text string, lang string, source string, n_chars long")
    for table in (odd, spark.createDataFrame([], steps_schema)):
        docs = table.withColumn("_hits", F.lit(1)).withColumn("rank", F.lit(2))
        for _, stage in pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.count() <= 4
