"""Session settings and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

MIB = 1 << 20

# What every result relies on, at any size.  ANSI mode stays on: each lenient
# conversion in the library says so itself (try_to_timestamp, try_divide).
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def sizing(input_bytes: int, cores: int) -> dict[str, str]:
    """Shuffle width and scan split for an input of this size.

    A scan task takes 128 MiB, and more in proportion to the cube root of the input
    beyond 1 TiB, up to 512 MiB; rebalanced writes aim at files of half of that.  Most
    shuffles move far less than the input, as aggregates reduce it first.  So their
    partitions aim at 1 GiB of input each, at least the cores and at most 20,000: the
    blocks of a shuffle, map tasks times partitions, stay within what a driver tracks.
    AQE merges what turns out small.
    """
    scan = int(128 * min(4, max(1, (input_bytes / (1 << 40)) ** (1 / 3))))
    return {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(scan // 2 * MIB),
        "spark.sql.shuffle.partitions": str(max(cores, min(20_000, -(-input_bytes // (1 << 30))))),
        "spark.sql.files.maxPartitionBytes": str(scan * MIB),
    }


def build(master: str | None = None, name: str = "starflow", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def workspace(spark: SparkSession) -> str:
    """A fresh folder that every executor can reach.

    It lies in the folder the session names in ``spark.checkpoint.dir``.  Without
    that setting only a local session may go on, in a temporary folder: on a
    cluster a machine-local folder would split the data between machines.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="starflow-")
    return f"{shared.rstrip('/')}/starflow-{uuid.uuid4().hex}"
