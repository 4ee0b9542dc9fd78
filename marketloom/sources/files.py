"""Small files and folders on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when a path or glob names at least one file on any supported file system."""
    fs, jpath = _fs_path(spark, path)
    found = fs.globStatus(jpath)
    return found is not None and len(found) > 0


def names_below(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths that a glob names, in order."""
    fs, jpath = _fs_path(spark, pattern)
    return sorted(s.getPath().toString() for s in (fs.globStatus(jpath) or []))


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs_path(spark, path)
    fs.delete(jpath, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file; one that is there already is an error."""
    fs, jpath = _fs_path(spark, path)
    out = fs.create(jpath, False)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, jpath = _fs_path(spark, path)
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
