from pyspark.sql import functions as F

from weirgate.session import SHUFFLE_CLEANUP, cut_lineage


def test_a_checkpoint_keeps_its_rows_and_leaves_settings_alone(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP)
    frame = spark.range(1000).repartition(7, "id").groupBy((F.col("id") % 10).alias("k")).agg(F.sum("id").alias("s"))
    pinned = cut_lineage(frame)
    assert sorted(pinned.collect()) == sorted(frame.collect())
    # The source of a checkpoint can still be used, also twice.
    assert cut_lineage(frame).count() == frame.count() == 10
    assert spark.conf.get(SHUFFLE_CLEANUP) == before
