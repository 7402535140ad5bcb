import shutil
import tempfile

from pyspark.sql import functions as F

from featurejudge.functions import text as tx
from featurejudge.plans.catalog import DOC_FLAGS


def test_keyword_flags_on_a_stream(spark):
    src = tempfile.mkdtemp(prefix="fj-stream-")
    shutil.copy("/root/testdata/sf0.001/documents.parquet", f"{src}/part-0.parquet")
    batch = spark.read.parquet(src)
    stream = spark.readStream.schema(batch.schema).parquet(src)
    flagged = tx.with_keyword_flags(stream.select("doc_id", "text"), "text", DOC_FLAGS).drop("text")
    q = flagged.writeStream.format("memory").queryName("flags_stream").outputMode("append").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = spark.table("flags_stream").agg(*[F.sum(n).alias(n) for n in DOC_FLAGS]).first()
    want = tx.with_keyword_flags(batch, "text", DOC_FLAGS).agg(*[F.sum(n).alias(n) for n in DOC_FLAGS]).first()
    assert got == want
