"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def build_session(app: str = "starboard", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on.

    Shuffle partitions are left to the caller: AQE coalesces small ones, so a large
    number is the right setting on a cluster and a small one only in tests.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Noting the Python call site of every expression takes half of the planning time.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster the
    executors would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="starboard-")
    return _local_roots[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch root, never used before."""
    return f"{scratch_root(spark)}/starboard/{label}-{uuid.uuid4().hex}"


# Bytes of one batch of rows on its way to or from Python; rows may be long texts.
BATCH_KEY, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 * 1024 * 1024

_batch_lock = threading.Lock()
# Who relies on the bound now, by session.
_batch_users: Counter[int] = Counter()


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """Send batches of bounded bytes to Python meanwhile, unless the session sets a bound itself.

    By rows alone a batch of long texts, and its copies on both sides, could be of any size.
    """
    session = spark._jsparkSession.hashCode()
    with _batch_lock:
        own = _batch_users[session] > 0 or spark.conf.get(BATCH_KEY, None) is None
        if own:
            _batch_users[session] += 1
            spark.conf.set(BATCH_KEY, str(BATCH_BYTES))
    try:
        yield
    finally:
        with _batch_lock:
            if own:
                _batch_users[session] -= 1
                if not _batch_users[session]:
                    spark.conf.unset(BATCH_KEY)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    Cuts the lineage with files that survive the loss of an executor, and gives the
    planner the true size, so that a broadcast is chosen by size and not by guess.
    """
    path = scratch_path(df.sparkSession, label)
    _staged.setdefault(df.sparkSession._jsparkSession.hashCode(), []).append(path)
    with bounded_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Paths of the tables a session has staged.
_staged: dict[int, list[str]] = {}


def release_staged(spark: SparkSession) -> int:
    """Delete the tables this session has staged and say how many; for the end of a job.

    Frames that read them, such as the parts of a loaded dataset, cannot be used after it. Written
    datasets and results of streams lie elsewhere and stay.
    """
    paths = _staged.pop(spark._jsparkSession.hashCode(), [])
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return len(paths)


# A shuffle partition should hold about this much of the input, however large that is.
BYTES_PER_PARTITION = 256 * 1024 * 1024

# Rows of a table take about this much more memory than its compressed files. By the size of the
# files alone Spark would send tables of many times its broadcast limit through the driver.
SIZE_KEY, ROWS_PER_FILE_BYTE = "spark.sql.sources.fileCompressionFactor", 8.0

# Spark gives relations of unknown size the largest long.
_UNKNOWN_SIZE = 1 << 62


def size_shuffles(*frames: DataFrame, bytes_per_partition: int = BYTES_PER_PARTITION) -> int:
    """Raise the number of shuffle partitions to fit the files the frames read.

    AQE merges small partitions but never splits an aggregation, so the number to start
    from has to fit the input. It is only ever raised. Returns the number in force.
    Joins planned from then on take tables for as large as their rows are, not their files.
    """
    spark = frames[0].sparkSession
    factor = max(float(spark.conf.get(SIZE_KEY)), ROWS_PER_FILE_BYTE)
    spark.conf.set(SIZE_KEY, str(factor))
    total = int(sum(_bytes_read(frame) for frame in frames) / factor)
    wanted = -(-total // bytes_per_partition)
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if wanted > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return max(wanted, current)


@contextmanager
def sized_shuffles(
    *frames: DataFrame, bytes_per_partition: int = BYTES_PER_PARTITION
) -> Iterator[int]:
    """``size_shuffles`` for the jobs inside; the session's settings come back after them."""
    spark = frames[0].sparkSession
    before = {key: spark.conf.get(key) for key in ("spark.sql.shuffle.partitions", SIZE_KEY)}
    try:
        yield size_shuffles(*frames, bytes_per_partition=bytes_per_partition)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _bytes_read(frame: DataFrame) -> int:
    """Sizes of the files below a plan; the plan's own estimate multiplies across joins."""
    leaves = frame._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(size for size in sizes if size < _UNKNOWN_SIZE)


def together(jobs: Iterable[Callable[[], object]]) -> list:
    """Start independent jobs side by side; small ones would leave most executors idle."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        return [job.result() for job in [pool.submit(job) for job in jobs]]
