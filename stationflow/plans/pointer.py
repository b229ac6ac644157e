"""Small files that say which data counts, replaced in one rename.

A writer writes its data beside the old, whole, and then replaces the pointer: a
reader sees the old state or the new one, and a run cut before the rename leaves
the old.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


def folder(spark: SparkSession, path: str):
    """(file system, Hadoop path) of ``path``."""
    base = spark._jvm.org.apache.hadoop.fs.Path(path)
    return base.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), base


def child(spark: SparkSession, base, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(base, name)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of files and folders in ``path``; none if it doesn't exist."""
    fs, base = folder(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(base)] if fs.exists(base) else []


def read_pointer(spark: SparkSession, path: str, name: str) -> Any | None:
    """The JSON value of the pointer ``name`` in ``path``; None if there is none."""
    fs, base = folder(spark, path)
    file = child(spark, base, name)
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def replace_pointer(spark: SparkSession, path: str, name: str, value: Any) -> None:
    """Put ``value`` in the place of the pointer in force, by one rename that replaces it."""
    fs, base = folder(spark, path)
    jvm = spark._jvm
    part = child(spark, base, f"{name}-{uuid.uuid4().hex}")
    stream = fs.create(part)
    stream.write(bytearray(json.dumps(value).encode()))
    stream.close()
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(part.toUri(), conf)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(context.makeQualified(part), context.makeQualified(child(spark, base, name)), options)


def remove_leftovers(spark: SparkSession, path: str, name: str) -> None:
    """Delete pointers that cut runs wrote and never put in place."""
    fs, base = folder(spark, path)
    for found in names_in(spark, path):
        if found.startswith(f"{name}-"):
            fs.delete(child(spark, base, found), False)
