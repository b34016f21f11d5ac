"""Folder checks, small text files and stream sources on any file system Spark can reach."""

import re

from pyspark.sql import DataFrame, SparkSession


def _open(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _open(spark, path)
    return files.exists(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below path; none when path is absent."""
    files, target = _open(spark, path)
    if not files.exists(target):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(target) if s.isDirectory())


def make(spark: SparkSession, path: str) -> None:
    files, target = _open(spark, path)
    files.mkdirs(target)


def delete(spark: SparkSession, path: str) -> None:
    files, target = _open(spark, path)
    files.delete(target, True)


def is_folder(spark: SparkSession, path: str) -> bool:
    files, target = _open(spark, path)
    return files.exists(target) and files.getFileStatus(target).isDirectory()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders directly below path, sorted; none when path is absent."""
    files, target = _open(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(target)) if files.exists(target) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is either wholly there or not at all: written under another name and renamed."""
    files, target = _open(spark, path)
    _, draft = _open(spark, path + ".draft")
    out = files.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if files.exists(target):
        files.delete(target, False)
    if not files.rename(draft, target):
        raise OSError(f"can't write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    files, target = _open(spark, path)
    source = files.open(target)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def stream_parquet(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """A stream over a folder of part files, or over one file, which a stream can only find by its name in its folder."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if not exists(spark, path):
        raise FileNotFoundError(path)
    if is_folder(spark, path):
        return reader.parquet(path)
    folder, _, name = path.rpartition("/")
    return reader.option("pathGlobFilter", re.sub(r"([\\{}\[\]*?])", r"\\\1", name)).parquet(folder)
