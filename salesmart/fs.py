"""Small file-system helpers over the Hadoop FileSystem of the session.

Used only for metadata (does a committed folder exist, which versions exist); data
always moves through Spark readers and writers.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p))


def committed(spark: SparkSession, path: str) -> bool:
    """True when a Spark write to ``path`` finished (its ``_SUCCESS`` marker exists)."""
    return exists(spark, path.rstrip("/") + "/_SUCCESS")


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty when ``path`` does not exist)."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty marker file (overwriting one that exists)."""
    fs, p = _fs_and_path(spark, path)
    fs.create(p, True).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small metadata file (UTF-8), replacing one that exists."""
    fs, p = _fs_and_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small metadata file, or None when it does not exist."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def data_files(spark: SparkSession, path: str) -> list:
    """Status of every data file at ``path`` (a file, a folder or a glob), sub-folders
    included; hidden and underscore files are left out, as Spark's readers do."""
    fs, p = _fs_and_path(spark, path)
    out, todo = [], list(fs.globStatus(p) or [])
    while todo:
        st = todo.pop()
        if st.getPath().getName()[:1] in ("_", "."):
            continue
        if st.isDirectory():
            todo.extend(fs.listStatus(st.getPath()))
        else:
            out.append(st)
    return out


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file, through its compression codec if it has one."""
    fs, p = _fs_and_path(spark, path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(fs.getConf()).getCodec(p)
        source = codec.createInputStream(stream) if codec is not None else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def fingerprint(spark: SparkSession, *paths: str) -> str:
    """Short digest of names, sizes and times of the files at ``paths``."""
    import hashlib
    state = sorted(f"{s.getPath()} {s.getLen()} {s.getModificationTime()}" for p in paths for s in data_files(spark, p))
    return hashlib.sha1("\n".join(state).encode()).hexdigest()[:12]


def delete_tree(spark: SparkSession, path: str) -> bool:
    """Remove a folder and its contents (used to retire old table versions)."""
    fs, p = _fs_and_path(spark, path)
    return bool(fs.delete(p, True))


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes under ``path`` (0 when it does not exist)."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return 0
    return int(fs.getContentSummary(p).getLength())


def glob_names(spark: SparkSession, pattern: str, level: int = 1) -> list[str]:
    """Names of the path components ``level`` steps above each match of ``pattern``
    (one listing call; e.g. the version folders holding a marker file)."""
    fs, p = _fs_and_path(spark, pattern)
    found = fs.globStatus(p)
    if found is None:
        return []
    out = []
    for st in found:
        q = st.getPath()
        for _ in range(level):
            q = q.getParent()
        out.append(q.getName())
    return sorted(out)
