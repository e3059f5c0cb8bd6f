"""Tables as numbered folders of Parquet files.

Plain Parquet has no MERGE, and overwriting a path that is being read loses it.  So
each batch writes a new folder ``<path>/v=<n>`` and never touches an older one.  A
folder counts once a ``_SUCCESS`` file is in it, put there after the write: a
lost executor or driver leaves a folder that readers skip and the replay of the
batch writes again.  Readers combine the folders in one of three ways:

* increments -- all rows of all versions (insert-only dimension),
* history -- closed rows of all versions, current rows of the last (type-2 dimension),
* partitions -- each partition from the last version that wrote it (fact table, and the
  current rows of a type-2 dimension in hash buckets).

Each names the folders it needs, so Spark lists and opens no others.  One writer per
table.  This is no transaction log; where a table format with MERGE is at hand, use that.
"""

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starflow import files

VERSION = "v"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
CURRENT = "is_current"
POINTER = "_latest"
#: A column of hash buckets tells their number in its name, so that no other number is mixed in.
BUCKETS = "bucket_of_*"


def _folder(path: str, version: int) -> str:
    return f"{path}/{VERSION}={version}"


def _split(folder: str) -> tuple[int, str]:
    """The version, and the partition folders below it."""
    version, _, below = folder.rstrip("/").rsplit(f"/{VERSION}=", 1)[1].partition("/")
    return int(version), below


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(_split(f)[0] for f in files.matching(spark, f"{path}/{VERSION}=*"))


def _finished(spark: SparkSession, path: str, version: int) -> bool:
    return files.exists(spark, f"{_folder(path, version)}/_SUCCESS")


def versions(spark: SparkSession, path: str) -> list[int]:
    """Finished versions, oldest first, found by one call however many there are."""
    markers = files.matching(spark, f"{path}/{VERSION}=*/_SUCCESS")
    return sorted(_split(m)[0] for m in markers)


def latest(spark: SparkSession, path: str, before: int | None = None) -> int | None:
    """The last finished version (below ``before``), or None for a table without one.

    A small file names it, so the versions are listed only for an older one, or after a loss.
    """
    told = files.read_text(spark, f"{path}/{POINTER}")
    if told is not None and (before is None or int(told) < before) and _finished(spark, path, int(told)):
        return int(told)
    below = (n for n in reversed(_numbers(spark, path)) if before is None or n < before)
    return next((n for n in below if _finished(spark, path, n)), None)


def publish(df: DataFrame, path: str, version: int, partition_by: Iterable[str] = ()) -> None:
    """Write ``df`` as one version.

    Writing the last version again replaces it, as a replayed batch must.  An older
    one is refused: batch ids start again at 0 when a checkpoint is lost, and the
    caller then has to choose a new base for them.
    """
    newest = latest(df.sparkSession, path)
    if newest is not None and version < newest:
        raise ValueError(f"{path} is at version {newest}; version {version} would rewrite its past")
    spark, folder = df.sparkSession, _folder(path, version)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(folder)
    # the marker that readers look for, also where Spark is set to write none
    files.touch(spark, f"{folder}/_SUCCESS")
    files.write_text(spark, f"{path}/{POINTER}", str(version))


def _read(spark: SparkSession, path: str, schema: T.StructType, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(schema).option("basePath", path).parquet(*folders)
    return stored.select(*schema.names)


def read_increments(
    spark: SparkSession, path: str, schema: T.StructType, upto: int | None = None
) -> DataFrame:
    """The rows of all versions up to ``upto`` (default: the last)."""
    wanted = [n for n in versions(spark, path) if upto is None or n <= upto]
    return _read(spark, path, schema, [_folder(path, n) for n in wanted])


def read_history(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    upto: int | None = None,
    current: bool | None = None,
) -> DataFrame:
    """A table published by ``is_current``, alone or with hash buckets of its current rows below.

    Current rows come from one version, or of each bucket from the last version that wrote
    it; closed rows from all: a batch writes its newly closed rows and the current ones,
    and never the history again.  ``current`` narrows the read to one of the two; current
    rows without buckets are one folder, found without a look at the history.
    """
    newest = latest(spark, path, None if upto is None else upto + 1)
    if newest is None:
        return spark.createDataFrame([], schema)
    folders = []
    if current is not False:
        folders += [f"{_folder(path, n)}/{below}" for below, n in _live(spark, path, [f"{CURRENT}=true", BUCKETS], newest).items()]
        folders = folders or files.matching(spark, f"{_folder(path, newest)}/{CURRENT}=true")
    if current is not True:
        done = {n for n in versions(spark, path) if n <= newest}
        closed = files.matching(spark, f"{path}/{VERSION}=*/{CURRENT}=false")
        folders += [f for f in closed if _split(f)[0] in done]
    return _read(spark, path, schema, folders)


def _written(spark: SparkSession, path: str, columns: Iterable[str]) -> dict[str, list[int]]:
    """The versions that wrote each partition; a column may be fixed, as ``name=value``."""
    found: dict[str, list[int]] = {}
    pattern = "/".join(c if "=" in c else f"{c}=*" for c in columns)
    for folder in files.matching(spark, f"{path}/{VERSION}=*/{pattern}"):
        version, below = _split(folder)
        found.setdefault(below, []).append(version)
    return found


def _live(spark: SparkSession, path: str, columns: str | Sequence[str], upto: int | None = None) -> dict[str, int]:
    """The last version that wrote each partition."""
    written = _written(spark, path, [columns] if isinstance(columns, str) else columns)
    done = {n for n in versions(spark, path) if upto is None or n <= upto} if written else set()
    live = {below: max((n for n in numbers if n in done), default=None) for below, numbers in written.items()}
    return {below: n for below, n in live.items() if n is not None}


def _named(columns: str | Sequence[str], values: object) -> str:
    """The folders of a value, or of a tuple of one for each column that is not fixed as ``name=value``."""
    left, names = list(values) if isinstance(values, tuple) else [values], []
    for column in [columns] if isinstance(columns, str) else columns:
        if "=" in column:
            names.append(column)
        elif left:
            value = left.pop(0)
            names.append(f"{column}={NULL_PARTITION if value is None else value}")
    return "/".join(names)


def read_partitions(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    columns: str | Sequence[str],
    upto: int | None = None,
    only: Iterable[object] | None = None,
    inside: str = "",
) -> DataFrame:
    """A table published by ``columns``: each partition as last written.

    ``only`` names the partitions wanted: a value, or a tuple of one for each column that is
    not fixed as ``name=value``, of which the last may be left out.  ``inside`` narrows the
    read to this folder, a further partition, where there is one.
    """
    live = _live(spark, path, columns, upto)
    if only is not None:
        wanted = {_named(columns, values) for values in only}
        depths = {w.count("/") + 1 for w in wanted}
        live = {below: n for below, n in live.items() if any("/".join(below.split("/")[:d]) in wanted for d in depths)}
    if inside:
        deeper = _written(spark, path, [*([columns] if isinstance(columns, str) else columns), inside])
        live = {f"{below}/{inside}": n for below, n in live.items() if n in deeper.get(f"{below}/{inside}", ())}
    return _read(spark, path, schema, [f"{_folder(path, n)}/{below}" for below, n in live.items()])


def changed(
    spark: SparkSession, path: str, columns: str | Sequence[str], after: int | None, upto: int | None = None
) -> list[str]:
    """Values of the first column of which a version after ``after`` wrote a partition."""
    live = _live(spark, path, columns, upto)
    return sorted({below.split("/")[0].split("=", 1)[1] for below, n in live.items() if after is None or n > after})


def retire(spark: SparkSession, path: str, columns: str | Sequence[str], keep: int = 2) -> int:
    """Delete partition folders that no snapshot of the last ``keep`` versions reads.

    A version without any partition left goes as a whole, so a table has no more
    version folders than live partitions (and ``keep``).  Closed rows of a type-2 table
    (``is_current=false``) always stay.  Returns the number of partition folders deleted.
    """
    done = versions(spark, path)
    kept = done[-keep:]
    written = _written(spark, path, [columns] if isinstance(columns, str) else columns)
    live, superseded, tops = set(kept), [], set()
    for below, numbers in written.items():
        finished = [n for n in numbers if n in done]
        needed = {max((n for n in finished if n <= k), default=None) for k in kept}
        if below.split("/")[0] == f"{CURRENT}=false":
            needed = set(finished)
        live |= needed
        tops |= {(n, below.split("/")[0]) for n in needed}
        superseded += [(n, below) for n in finished if n not in needed and n not in kept]
    for version, below in superseded:
        if version in live:
            # with the folder above it, if nothing in there is needed
            top = below.split("/")[0]
            files.delete(spark, f"{_folder(path, version)}/{below if (version, top) in tops else top}")
    for version in set(done) - live:
        files.delete(spark, _folder(path, version))
    return len(superseded)
