"""What an incremental build leaves on disk and computes."""

import time

from dispatchlens.operators import order_features
from dispatchlens.plans import incremental
from dispatchlens.sources import adapter
from dispatchlens.sources.layers import Layers


def shuffle_files(spark) -> int:
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(held.apply(i).getName().startswith("shuffle_") for i in range(held.size()))


def test_a_build_deletes_its_shuffle_files(spark, sf_dir, tmp_path):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    raw, before, was = adapter.feature_inputs(spark, sf_dir), shuffle_files(spark), spark.conf.get(key, None)
    incremental.build(Layers(spark, str(tmp_path)), **raw)
    end = time.time() + 20
    while shuffle_files(spark) > before and time.time() < end:
        time.sleep(0.2)
    assert shuffle_files(spark) <= before and spark.conf.get(key, None) == was


def test_the_features_are_made_once(spark, sf_dir, tmp_path, monkeypatch):
    """Which months have rows is seen from the files, not from the features made again."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    made = order_features.order_features

    def features(*tables):
        table = made(*tables)
        return table.mapInArrow(counted, table.schema)

    monkeypatch.setattr(order_features, "order_features", features)
    layers = Layers(spark, str(tmp_path))
    incremental.build(layers, **adapter.feature_inputs(spark, sf_dir))
    assert seen.value == incremental.read(layers).count() > 0
