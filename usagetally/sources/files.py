"""Small files on any Hadoop file system: JSON records, create-once markers, listings."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """(file system, Hadoop path, JVM) of a path."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath, jvm


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small UTF-8 file; None if it doesn't exist."""
    fs, jpath, jvm = file_system(spark, path)
    if not fs.exists(jpath):
        return None
    stream = fs.open(jpath)
    try:
        scanner = jvm.java.util.Scanner(stream, "UTF-8").useDelimiter("\\A")
        return scanner.next() if scanner.hasNext() else ""
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file that must not exist yet (the second of two creators fails)."""
    fs, jpath, _ = file_system(spark, path)
    out = fs.create(jpath, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_record(spark: SparkSession, path: str, record: dict) -> None:
    """A JSON record that is either whole or absent: written aside, then renamed."""
    aside = f"{path}.{uuid.uuid4().hex[:8]}.tmp"
    create_once(spark, aside, json.dumps(record))
    fs, jpath, jvm = file_system(spark, path)
    if fs.exists(jpath):
        fs.delete(jpath, False)
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(aside), jpath):
        raise RuntimeError(f"{path} could not be written")


def read_record(spark: SparkSession, path: str) -> dict | None:
    text = read_text(spark, path)
    return None if not text else json.loads(text)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder that only this job uses."""
    fs, jpath, _ = file_system(spark, path)
    if fs.exists(jpath):
        fs.delete(jpath, True)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it doesn't exist."""
    fs, jpath, _ = file_system(spark, folder)
    return sorted(st.getPath().getName() for st in fs.listStatus(jpath)) if fs.exists(jpath) else []


def data_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(path below ``folder``, bytes) of the data files that a job wrote there."""
    fs, jpath, _ = file_system(spark, folder)
    found = []
    if fs.exists(jpath):
        top = fs.getFileStatus(jpath).getPath().toString().rstrip("/") + "/"
        files = fs.listFiles(jpath, True)
        while files.hasNext():
            st = files.next()
            name = st.getPath().toString()[len(top):]
            if not name.rsplit("/", 1)[-1].startswith(("_", ".")):
                found.append((name, int(st.getLen())))
    return sorted(found)
