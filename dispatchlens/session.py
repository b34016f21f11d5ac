"""Session settings and the shared folder for written intermediate tables."""

import contextlib
import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the split costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Many small shuffle partitions, joined up to this size: what a task sorts and groups stays in memory however large the tables are.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1200",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}

_written: dict[tuple[str, ...], str] = {}
_shipped: set[str] = set()


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def session(app: str = "dispatchlens", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in (SETTINGS | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: spark.checkpoint.dir, or a new one in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="dispatchlens-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def run_path(spark: SparkSession, *names: str) -> str:
    """A path of this application below the shared folder."""
    return "/".join([shared_dir(spark), "dispatchlens-" + spark.sparkContext.applicationId, *names])


def _stamp(spark: SparkSession, folder: str) -> str:
    """What tells the input tables of a folder from those that stood there before: names, sizes and times, two levels deep."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return ""
    own = [s for s in files.listStatus(path)]
    below = [t for s in own if s.isDirectory() for t in files.listStatus(s.getPath())]
    return str(hash(tuple(sorted((str(s.getPath()), s.getLen(), s.getModificationTime()) for s in own + below))))


def _full_key(spark: SparkSession, key: tuple[str, ...]) -> tuple[str, ...]:
    return (spark.sparkContext.applicationId, *key, *(_stamp(spark, k) for k in key[1:2]))


def is_written(spark: SparkSession, key: tuple[str, ...]) -> bool:
    """Whether written_path() has stored something under this key."""
    return _full_key(spark, key) in _written


def written_path(spark: SparkSession, key: tuple[str, ...], write) -> str:
    """Path of something write(path) stores, written once per application and state of the input folder, key's second part.

    With write None the path was written before.
    """
    full_key = _full_key(spark, key)
    if full_key not in _written:
        path = run_path(spark, f"{key[0]}-{len(_written):04d}-{os.urandom(4).hex()}")
        write(path)
        _written[full_key] = path
    return _written[full_key]


def written(spark: SparkSession, key: tuple[str, ...], build) -> DataFrame:
    """The table build() gives, written once per application and read back.

    Later steps read the written table instead of running its whole lineage again, also after
    executors were lost.
    """
    return spark.read.parquet(written_path(spark, key, lambda path: build().write.parquet(path)))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder for something its user deletes again."""
    return run_path(spark, f"{name}-{os.urandom(6).hex()}")


def clear(spark: SparkSession) -> None:
    """Delete all that this application wrote below the shared folder; results that read it must be done with."""
    folder = run_path(spark)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    for key in [k for k in _written if k[0] == spark.sparkContext.applicationId]:
        del _written[key]


@contextlib.contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files are deleted when it ends, not when its plan is forgotten; for queries that run once."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per application: Python tasks import them."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp()) / f"{root.name}.zip"  # served by the driver, read nowhere else
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, f"{root.name}/{file.relative_to(root)}")
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(application)
