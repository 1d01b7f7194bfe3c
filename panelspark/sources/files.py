"""File listing and header peeks through Spark's Hadoop FileSystem.

Works for every filesystem the session can read (local, HDFS, object
stores) with the session's credentials. Only metadata and the first line
of a file cross to the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jpath.getFileSystem(conf), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_files(spark: SparkSession, path: str, suffix: str | tuple[str, ...] | None = None) -> list[tuple[str, int, int]]:
    """``(path, size, mtime)`` of visible data files under ``path`` (a file, a
    folder or a glob), recursively, skipping ``_*`` and ``.*`` entries.

    Folders are listed with Hadoop's recursive ``listFiles`` iterator (a flat
    listing on object stores, not one call per sub-folder)."""
    fs, p = _fs(spark, path)
    statuses = fs.globStatus(p)
    out = []
    for st in statuses if statuses is not None else []:
        root = st.getPath()
        if _hidden(root.getName()):
            continue
        if not st.isDirectory():
            if suffix is None or root.getName().endswith(suffix):
                out.append((root.toString(), int(st.getLen()), int(st.getModificationTime())))
            continue
        prefix = root.toString().rstrip("/") + "/"
        it = fs.listFiles(root, True)
        while it.hasNext():
            f = it.next()
            full = f.getPath().toString()
            rel = full[len(prefix):] if full.startswith(prefix) else f.getPath().getName()
            if any(_hidden(part) for part in rel.split("/")):
                continue
            if suffix is None or full.endswith(suffix):
                out.append((full, int(f.getLen()), int(f.getModificationTime())))
    return sorted(out)


def _hidden(name: str) -> bool:
    """Spark's own rule: ``_x=1`` is a partition folder, other ``_x`` are not data."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def first_line(spark: SparkSession, path: str) -> str | None:
    """First line of a text file (compressed or not, by its name) that is not blank (UTF-8, BOM stripped), or None."""
    jvm = spark.sparkContext._jvm
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(p)
    if codec is not None:
        stream = codec.createInputStream(stream)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"), 65536)
        line = reader.readLine()
        while line is not None and not line.lstrip("\ufeff").strip():
            line = reader.readLine()
    finally:
        stream.close()
    return None if line is None else line.lstrip("\ufeff")


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """Write a small file aside, then rename it into place: a reader sees the
    whole file or none, or with ``overwrite`` the old one or the new. With
    ``overwrite=False`` an existing file raises; where the store has no atomic
    rename the check is not atomic either, so a table must have a single
    writer at a time."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    p = fs.makeQualified(p)
    aside = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if overwrite:
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), conf).rename(aside, p, options)
    elif fs.exists(p) or not fs.rename(aside, p):
        fs.delete(aside, False)
        raise FileExistsError(path)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _fs(spark, source)
    if not fs.rename(p, _fs(spark, target)[1]):
        raise FileExistsError(target)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all it holds; nothing if there is none."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    jvm = spark.sparkContext._jvm
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        scanner = jvm.java.util.Scanner(stream, "UTF-8").useDelimiter("\\A")
        return scanner.next() if scanner.hasNext() else ""
    finally:
        stream.close()


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries directly in ``folder`` (empty if it does not exist)."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p))
