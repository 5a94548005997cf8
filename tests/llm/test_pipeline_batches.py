"""The pipeline sends whole texts to Python in small batches, and leaves the session's setting as it was."""

import pyarrow as pa

import corpus_pipeline

SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_stages_get_small_batches_and_the_setting_comes_back(spark, tmp_path, monkeypatch):
    def sizes(spark, docs, sf_dir):
        corpus_pipeline.encode(spark, docs, sf_dir)
        return docs.mapInArrow(lambda batches: (pa.record_batch({"n": pa.array([b.num_rows], pa.int64())}) for b in batches), "n long")

    spark.range(0, 1000, 1, 1).selectExpr("id AS doc_id", "'a b' AS text").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("sizes", sizes)])
    before = spark.conf.get(SETTING)
    sent = [r.n for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sum(sent) == 1000 and max(sent) <= corpus_pipeline.ARROW_ROWS < int(before)
    assert spark.conf.get(SETTING) == before
