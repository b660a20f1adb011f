"""Opening files from inside tasks, on whatever store the path names."""

from __future__ import annotations

from urllib.parse import urlsplit

from pyspark.sql import SparkSession


def qualify(spark: SparkSession, path: str) -> str:
    """`path` with the scheme and authority Spark itself would use for it."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(hadoop).makeQualified(target).toString()


def resolve(path: str, cache: dict):
    """`(filesystem, location)` of a qualified path; `cache` keeps one client per store."""
    from pyarrow import fs

    parts = urlsplit(path)
    scheme = {"s3a": "s3", "s3n": "s3", "": "file"}.get(parts.scheme, parts.scheme)
    if scheme == "file":
        location = path.split(":", 1)[1] if parts.scheme else path
        return cache.setdefault("file", fs.LocalFileSystem()), "/" + location.lstrip("/")
    base = f"{scheme}://{parts.netloc}"
    if base not in cache:
        cache[base] = fs.FileSystem.from_uri(base)
    system, prefix = cache[base]
    return system, prefix.rstrip("/") + path.split(parts.netloc, 1)[1]
