"""Session construction and shared storage locations.

On a cluster the shared folder comes from ``spark.checkpoint.dir``; it is read
from the session and never replaced. A local temporary folder is used only when
nothing is configured (unit tests on a laptop).
"""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WAREHOUSE_CONF = "ledgerline.warehouse.dir"
BROADCAST_ROWS_CONF = "ledgerline.broadcast.maxRows"
BROADCAST_BYTES_CONF = "ledgerline.broadcast.maxBytes"
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024
BYTES_PER_PARTITION_CONF = "ledgerline.shuffle.bytesPerPartition"
DEFAULT_BYTES_PER_PARTITION = 16 * 1024 * 1024     # of columnar input; in a sort or a hash table it is some ten times as much
MAX_PARTITIONS_CONF = "ledgerline.shuffle.maxPartitions"
DEFAULT_MAX_PARTITIONS = 20_000
BYTES_PER_SLICE_CONF = "ledgerline.slice.bytes"
DEFAULT_BYTES_PER_SLICE = 512 * 1024 * 1024        # of columnar input; its shuffles hold some ten times as much at once
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, app_name: str = "ledgerline",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """A session with the settings the library assumes: ANSI and AQE on, UTC."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # checkpoint files of dimension numbering are removed once unreferenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


_LOCAL_FALLBACK: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Falls back to one fresh local folder per process only when the setting is
    absent and the master is local (tests). On a cluster without the setting it
    refuses to run.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a shared folder "
                           "(checkpoints and the star's tables are written there)")
    if "dir" not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK["dir"] = tempfile.mkdtemp(prefix="ledgerline-shared-")   # single machine only
    return _LOCAL_FALLBACK["dir"]


def checkpoint_dir(spark: SparkSession) -> str:
    """This application's checkpoint folder (Spark adds a per-application subfolder)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    sc.setCheckpointDir(shared_root(spark))
    return sc.getCheckpointDir()


def warehouse_dir(spark: SparkSession) -> str:
    """Root folder for materialised star tables and marts (shared by all applications)."""
    try:
        configured = spark.conf.get(WAREHOUSE_CONF)
    except Exception:  # noqa: BLE001
        configured = None
    if configured:
        return configured.rstrip("/")
    return shared_root(spark) + "/ledgerline-warehouse"


def _conf_int(spark: SparkSession, key: str, default: int) -> int:
    try:
        return int(spark.conf.get(key))
    except Exception:  # noqa: BLE001 - unset key
        return default


def broadcast_limit(spark: SparkSession):
    """Largest table side broadcast in a join: rows and measured in-memory bytes."""
    from .operators.lookup import BroadcastLimit
    return BroadcastLimit(_conf_int(spark, BROADCAST_ROWS_CONF, DEFAULT_BROADCAST_ROWS),
                          _conf_int(spark, BROADCAST_BYTES_CONF, DEFAULT_BROADCAST_BYTES))


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads (0 where it reads none), asked of their own file system."""
    folders: dict[str, set[str]] = {}
    for file in df.inputFiles():
        folder, _, name = file.rpartition("/")
        folders.setdefault(folder, set()).add(name)
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    total = 0
    for folder, names in folders.items():
        path = jvm.org.apache.hadoop.fs.Path(folder)
        for status in path.getFileSystem(conf).listStatus(path):
            if status.getPath().toString().rpartition("/")[2] in names:
                total += status.getLen()
    return total


def shuffle_partitions_for(spark: SparkSession, size: int) -> int:
    """Shuffle partitions for a job that reads ``size`` bytes: at least the configured number, at most a bound.

    AQE can merge small shuffle partitions but cannot add any, so the initial count covers the
    largest shuffle; the bound keeps the shuffle's own bookkeeping (map tasks x partitions) in check,
    beyond it partitions grow and spill.
    """
    per = max(1, _conf_int(spark, BYTES_PER_PARTITION_CONF, DEFAULT_BYTES_PER_PARTITION))
    most = max(1, _conf_int(spark, MAX_PARTITIONS_CONF, DEFAULT_MAX_PARTITIONS))
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(current, min(most, -(-size // per)))


_SIZING = threading.RLock()


@contextlib.contextmanager
def shuffle_partitions(spark: SparkSession, n: int):
    """Run a block with ``spark.sql.shuffle.partitions = n``; the previous value is restored.

    One block at a time: a second refresh in the same process waits, so neither sees the other's value.
    """
    with _SIZING:
        previous = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            yield
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", previous)


_CLEANUP = threading.Lock()
_CLEANING: list[tuple[str, str]] = []      # blocks that run now: application and the setting before it


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """Run a block whose jobs each remove their shuffle files when they end; the last block to end restores the setting.

    Otherwise the files stay until the driver happens to collect its garbage, and the steps of a build add up on disk.
    """
    app = spark.sparkContext.applicationId
    with _CLEANUP:
        block = (app, next((before for a, before in _CLEANING if a == app), spark.conf.get(SHUFFLE_CLEANUP_CONF, "false")))
        _CLEANING.append(block)
        spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        with _CLEANUP:
            _CLEANING.remove(block)
            if all(a != app for a, _ in _CLEANING):
                spark.conf.set(SHUFFLE_CLEANUP_CONF, block[1])


def slices_for(spark: SparkSession, size: int) -> int:
    """Slices in which a step over ``size`` bytes of input runs, one after the other, so that its shuffles fit a bounded disk."""
    return max(1, -(-size // max(1, _conf_int(spark, BYTES_PER_SLICE_CONF, DEFAULT_BYTES_PER_SLICE))))


def ranges(df: DataFrame, column: str, n: int) -> list[Callable[[Column], Column]]:
    """At most ``n`` tests of a value, each true for one range of ``column``; in ascending order, NULL in the first.

    The bounds are approximate quantiles: slices of about equal size, or fewer where many rows share a value.
    """
    cuts = [] if n < 2 else df.agg(F.percentile_approx(F.col(f"`{column}`"), [i / n for i in range(1, n)], 10_000)).first()[0]
    cuts = sorted(set(cuts or []))

    def test(low, high) -> Callable[[Column], Column]:
        if low is None:
            return (lambda c: F.lit(True)) if high is None else lambda c: c.isNull() | (c <= F.lit(high))
        return (lambda c: c > F.lit(low)) if high is None else lambda c: (c > F.lit(low)) & (c <= F.lit(high))

    return [test(low, high) for low, high in zip([None, *cuts], [*cuts, None])]


def whole_partitions(df: DataFrame) -> int:
    """Partitions for sorting ``df``, or hashing rows of it that hardly repeat: as its input files need, one a core at least.

    Compressed shuffle sizes, which AQE goes by, say little of what a sort or a hash table holds.
    """
    spark = df.sparkSession
    per = max(1, _conf_int(spark, BYTES_PER_PARTITION_CONF, DEFAULT_BYTES_PER_PARTITION))
    most = max(1, _conf_int(spark, MAX_PARTITIONS_CONF, DEFAULT_MAX_PARTITIONS))
    return min(most, max(spark.sparkContext.defaultParallelism, -(-input_bytes(df) // per)))


def new_run_id() -> str:
    return uuid.uuid4().hex[:12]


def join_path(*parts: str) -> str:
    return "/".join(p.rstrip("/") for p in parts if p)


__all__ = [
    "build_session", "shared_root", "checkpoint_dir", "warehouse_dir", "broadcast_limit", "input_bytes",
    "new_run_id", "join_path",
]
