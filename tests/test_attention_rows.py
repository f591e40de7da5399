"""Documents without an embedding keep their row in the attention export."""

import json

from feedbacklens.queries import scoring


def test_every_document_has_a_row(spark, tmp_path):
    spark.createDataFrame([(1, "one two"), (2, "three"), (3, "four")], "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, [0.5, 0.25])], "vec_id long, embedding array<float>").write.parquet(
        f"{tmp_path}/embeddings.parquet")
    rows = {r.doc_id: json.loads(r.json) for r in scoring.attention_json(spark, str(tmp_path)).collect()}
    assert {k: r["attn_dists"] for k, r in rows.items()} == {1: [[0.5, 0.25]], 2: [], 3: []}
