"""Names, existence and publication of files through the file system Spark itself uses."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.schemas import LISTING
from daybook.session import local_rows

#: Files whose first bytes are read at the same time.
OPEN_AT_ONCE = 16


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def make_directory(spark: SparkSession, path: str) -> None:
    _fs(spark, path).mkdirs(_path(spark, path))


def names(spark: SparkSession, directory: str) -> list[str]:
    """File names of a small directory, sorted; side files are left out."""
    found = (s.getPath().getName() for s in _fs(spark, directory).listStatus(_path(spark, directory)))
    return sorted(name for name in found if not name.startswith((".", "_")))


def octets(spark: SparkSession, path: str) -> int:
    """Size of a file or of all parts of a directory."""
    return _fs(spark, path).getContentSummary(_path(spark, path)).getLength()


def opening_with(spark: SparkSession, paths: list[str], signs: bytes) -> list[str]:
    """Those of ``paths`` whose first bytes are ``signs``; only these bytes of each file are read."""

    def opens(path: str) -> bool:
        stream = _fs(spark, path).open(_path(spark, path))
        try:
            return all(stream.read() == sign for sign in signs)
        finally:
            stream.close()

    with ThreadPoolExecutor(OPEN_AT_ONCE) as pool:
        return [path for path, found in zip(paths, pool.map(opens, paths), strict=True) if found]


def create_file(spark: SparkSession, path: str, text: str = "") -> None:
    """Create a small file that must not exist yet; a second writer fails here."""
    stream = _fs(spark, path).create(_path(spark, path), False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """The whole text of a small file."""
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs = _fs(spark, target)
    if fs.exists(_path(spark, target)):
        raise FileExistsError(target)
    if not fs.rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"cannot publish {target}")


def adopt_partitions(spark: SparkSession, source: str, target: str) -> None:
    """Move ``date=/run=`` directories of a finished write into a partitioned table, one rename per directory."""
    fs = _fs(spark, target)
    for outer in fs.listStatus(_path(spark, source)):
        if not outer.isDirectory():
            continue
        parent = f"{target}/{outer.getPath().getName()}"
        make_directory(spark, parent)
        for inner in fs.listStatus(outer.getPath()):
            rename(spark, inner.getPath().toString(), f"{parent}/{inner.getPath().getName()}")


def list_directory(spark: SparkSession, directory: str) -> DataFrame:
    """Names and sizes below ``directory``. Zero-byte files, invisible to every Spark source, are included.

    A dated directory of parts counts as a regular file, because that is how distributed writers publish one.
    """
    rows = []
    if exists(spark, directory):
        for status in _fs(spark, directory).listStatus(_path(spark, directory)):
            name = status.getPath().getName()
            parts = status.isDirectory() and name.endswith(".dat")
            length = octets(spark, status.getPath().toString()) if parts else status.getLen()
            regular = bool(status.isFile() or parts)
            rows.append(dict(directory=directory, name=name, length=length, is_regular=regular))
    return local_rows(spark, rows, LISTING)


def publish_lines(ordered: DataFrame, order: list[str], target: str, empty: bool, as_parts: bool = False) -> None:
    """Write ``value`` lines in ``order`` and publish them under ``target`` with one rename.

    Range-partitioned parts are sorted and written apart, each by its own task. The caller chooses the form, whatever
    the size: with ``as_parts`` the directory of the parts in order, otherwise one plain file that is joined from
    them. The scans read both.
    """
    spark = ordered.sparkSession
    parent, name = target.rsplit("/", 1)
    make_directory(spark, parent)
    if exists(spark, target):
        raise FileExistsError(target)
    if empty:
        create_file(spark, target)
        return
    working = f"{parent}/.{name}.{uuid.uuid4().hex}.tmp"
    ordered.orderBy(*order).select("value").write.text(working)
    if as_parts:
        rename(spark, working, target)
    else:
        rename(spark, join_parts(spark, working), target)
        delete(spark, working)


def join_parts(spark: SparkSession, directory: str) -> str:
    """Join the parts of a finished write, in order, to one plain file beside them, and return its path.

    Bytes are copied from stream to stream by the driver's JVM, in a buffer of fixed size and without sorting.
    """
    fs = _fs(spark, directory)
    parts = [s.getPath() for s in fs.listStatus(_path(spark, directory)) if s.getPath().getName().startswith("part-")]
    joined = f"{directory}/joined"
    target = fs.create(_path(spark, joined), False)
    try:
        for part in sorted(parts, key=lambda p: int(p.getName().split("-")[1])):
            source = fs.open(part)
            try:
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, target, 1 << 20, False)
            finally:
                source.close()
    finally:
        target.close()
    return joined


def same_lines(spark: SparkSession, left: str, right: str) -> bool:
    """Whether two published files hold the same lines in the same order, compared as a join on line numbers."""
    from daybook.sources.fixed_width import plain_lines

    if octets(spark, left) != octets(spark, right):
        return False
    if octets(spark, left) == 0:
        return True
    old, new = plain_lines(spark, left), plain_lines(spark, right).withColumnRenamed("value", "other")
    differing = old.join(new, "source_line", "full_outer").where(~F.col("value").eqNullSafe(F.col("other")))
    return differing.limit(1).count() == 0
