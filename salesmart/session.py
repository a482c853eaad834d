"""Session settings and the shared folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Let AQE split a hot partition of a join even where that costs a shuffle
# after it, and merge small shuffle partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Generated methods that the JVM would not compile, as those of 50 shaped columns, are cut.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, "spark.ui.enabled": "false", **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


# For writes whose shuffles nothing reads again: their files go as soon as a write is done.
# Otherwise they stay until the driver happens to collect its garbage.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def with_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session that hold for a while."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shared_folder(spark: SparkSession) -> str | None:
    """Folder every executor can reach, or None where the cluster names none.

    A local master gets a temporary folder of its own; on a cluster a
    machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None and context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="salesmart-"))
        folder = context.getCheckpointDir()
    return folder and folder.rstrip("/")


# Input bytes behind one shuffle partition. Only some columns are shuffled, so the
# partition itself is smaller; 100 TB give 51,200 partitions, which a driver can
# still track. AQE merges partitions that turn out small.
BYTES_PER_PARTITION = 2 * 1024**3
SCAN_TASKS = 100_000
MAX_SPLIT = 1024**3
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that this application made, wherever it is stored."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(spark: SparkSession, folder: str) -> bool:
    """Whether a table was written there to its end."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def scan_bytes(*frames: DataFrame) -> int:
    """Size of the files behind plain file scans, as the optimizer sees it."""
    return sum(
        int(f._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        for f in frames
    )


# Rows of a broadcast side, times how wide they are; about 100 bytes each in memory.
BROADCAST_ROWS = 1_000_000


def is_small(scans: Sequence[DataFrame], width: int = 1) -> bool:
    """Whether a side made of these tables is broadcast (see ``sized_side``)."""
    limit = scans[0].sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return scan_bytes(*scans) * width <= limit and row_count(scans[0]) * width <= BROADCAST_ROWS


def sized_side(side: DataFrame, scans: Sequence[DataFrame], width: int = 1) -> DataFrame:
    """Join side that is broadcast only if the tables it is made of are small.

    ``scans`` are those tables, the one that bounds the number of rows first;
    ``width`` is how much wider than a few numbers the side's rows are. Files
    have to be below the session's broadcast limit, and, since small files may
    hold many alike rows, the rows are counted too. Beyond that both sides are
    shuffled and AQE splits hot keys. The optimizer's own estimate is no help
    here: it multiplies the sizes of joined tables, so it takes a small side
    for a huge one and may broadcast the sales instead.
    """
    return F.broadcast(side) if is_small(scans, width) else side.hint("merge")


@lru_cache(maxsize=64)
def row_count(scan: DataFrame) -> int:
    """Rows of a small scan, from its file footers."""
    return scan.count()


def initial_partitions(input_bytes: int, default: int) -> int:
    return max(default, -(-input_bytes // BYTES_PER_PARTITION))


def scan_split(input_bytes: int, default: int) -> int:
    """Bytes a scan task reads: more for large inputs, up to 1 GiB, so that tasks stay
    below ``SCAN_TASKS`` up to 100 TB and shuffles do not have tasks times partitions blocks."""
    return max(default, min(MAX_SPLIT, input_bytes // SCAN_TASKS))


def size_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Start shuffles of a large input with enough partitions to fit into memory, and
    scans with larger splits.

    The default number of partitions would give each hundreds of gigabytes at
    100 TB. A number the user has set stays; small inputs change nothing.
    """
    split = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    if (wanted := scan_split(input_bytes, split)) > split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(wanted))
    default = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = initial_partitions(input_bytes, default)
    if wanted > default and spark.conf.get(_INITIAL, None) is None:
        spark.conf.set(_INITIAL, str(wanted))
