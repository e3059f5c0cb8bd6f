"""Paths, through the file system Spark itself uses (local, HDFS, object store)."""

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle, handle.getFileSystem(spark._jsc.hadoopConfiguration())


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob."""
    path, system = _open(spark, pattern)
    return [found.getPath().toString() for found in system.globStatus(path) or []]


def matching_times(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """Paths that match a glob, with the time of their last change in milliseconds."""
    path, system = _open(spark, pattern)
    return [(found.getPath().toString(), found.getModificationTime()) for found in system.globStatus(path) or []]


def is_folder(spark: SparkSession, path: str) -> bool:
    handle, system = _open(spark, path)
    return system.exists(handle) and system.getFileStatus(handle).isDirectory()


def same(spark: SparkSession, one: str, other: str) -> bool:
    """Whether both name one place, with or without scheme."""
    whole = [system.makeQualified(handle).toUri().getPath() for handle, system in (_open(spark, p) for p in (one, other) if p)]
    return len(whole) == 2 and whole[0] == whole[1]


def delete(spark: SparkSession, path: str) -> None:
    handle, system = _open(spark, path)
    system.delete(handle, True)


def make_folder(spark: SparkSession, path: str) -> None:
    handle, system = _open(spark, path)
    system.mkdirs(handle)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, unless there is one."""
    handle, system = _open(spark, path)
    if not system.exists(handle):
        system.create(handle).close()


def exists(spark: SparkSession, path: str) -> bool:
    handle, system = _open(spark, path)
    return system.exists(handle)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file, or None if there is none."""
    handle, system = _open(spark, path)
    if not system.exists(handle):
        return None
    stream = system.open(handle)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file in place of any there is, complete as soon as it can be seen."""
    jvm, new = spark._jvm, f"{path}.new"
    handle, system = _open(spark, new)
    out = system.create(handle, True)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(handle.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(handle, _open(spark, path)[0], options)
