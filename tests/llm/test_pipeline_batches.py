"""The pipeline's Python stages get Arrow batches of a few MB, however long the rows."""

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from test_near import SCHEMA


def test_stages_with_python_send_small_batches(spark, tmp_path):
    few = spark.createDataFrame([(i, f"text number {i}", "en", "a", 1) for i in range(3)], SCHEMA)
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    long = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("ab "), 33_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "bytes"])

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        for stage in ("toxicity", "simhash_near_dedup", "mixing", "byte_bpe"):
            spark.conf.unset(name)
            dict(corpus_pipeline.STAGES)[stage](spark, few, str(tmp_path))
            got = long.mapInArrow(sizes, "n long, bytes long").collect()
            assert sum(r.n for r in got) == 300, stage
            assert max(r.bytes for r in got) < 6_000_000, stage
    finally:
        spark.conf.unset(name)
