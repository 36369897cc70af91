import pyarrow as pa
from pyspark.sql import functions as F

from cityloom.llm.common import BATCH_BYTES, BATCH_BYTES_SETTING, importable


def batches_of(texts):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    return texts.mapInArrow(sizes, "n bigint, size bigint").collect()


def test_rows_reach_workers_in_small_batches(spark):
    before = spark.conf.get(BATCH_BYTES_SETTING)
    try:
        for own, expected in (("64m", BATCH_BYTES), ("1m", 1 << 20)):
            spark.conf.set(BATCH_BYTES_SETTING, own)
            importable(spark)
            texts = spark.range(0, 9000, 1, 1).select(F.repeat(F.lit("x"), 2000).alias("text"))
            found = batches_of(texts)
            assert sum(r.n for r in found) == 9000 and max(r.size for r in found) < 1.1 * expected
    finally:
        spark.conf.set(BATCH_BYTES_SETTING, before)


def test_a_row_beyond_the_limit_is_whole(spark):
    importable(spark)
    texts = spark.range(0, 3, 1, 1).select(F.repeat(F.lit("y"), 2 * BATCH_BYTES).alias("text"))
    found = batches_of(texts)
    assert sum(r.n for r in found) == 3 and sum(r.size for r in found) >= 6 * BATCH_BYTES
