"""The star schema as written tables: stage the source, key the dimensions, key the fact.

Every step writes Parquet under one run folder in the shared warehouse folder
(``spark.checkpoint.dir`` unless configured otherwise) and reads it back, so
lineage is cut at each table and a lost executor re-runs only the tasks of
the current step. Row counts come from ``Observation`` metrics of the writes
themselves, at no extra scan, and prove the size bounds used for broadcast
decisions.

A run is published by appending one row to ``_manifest``; readers take the
newest published run, so a failed run never leaves the served tables empty.
The manifest also keeps each table's measured stats, so a reader can prove
broadcast bounds without scanning.
"""

from __future__ import annotations

import contextlib
import functools
import hashlib
import json
import os
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..config import (broadcast_limit, input_bytes, join_path, new_run_id, ranges, shuffle_partitions, shuffle_partitions_for,
                      shuffles_removed, slices_for, warehouse_dir)
from ..operators.lookup import BroadcastLimit, TableStats, stats_from_metrics, stats_metrics
from ..sources.ordinal import with_row_number
from .dims import build_dimension
from .fact import fact_rows, with_order_key

DIMENSIONS = ["dim_customer", "dim_product", "dim_location", "dim_date"]


@dataclass
class Star:
    """Handles to the written tables of one run."""

    root: str
    source: DataFrame
    tables: dict[str, DataFrame]
    stats: dict[str, TableStats] = field(default_factory=dict)
    limit: BroadcastLimit = BroadcastLimit(2_000_000, 256 * 1024 * 1024)
    partials: DataFrame | None = None       # written by ``marts.materialise``: the views are then derived from them

    @property
    def fact(self) -> DataFrame:
        return self.tables["fact_orders"]

    @property
    def counts(self) -> dict[str, int]:
        return {name: st.rows for name, st in self.stats.items()}

    def is_small(self, name: str, columns: list[str] | None = None) -> bool:
        """The measured size of ``columns`` (default: all) of table ``name`` is within the broadcast limit."""
        cols = columns if columns is not None else self.tables[name].columns
        return self.limit.allows(self.stats.get(name), cols)

    def dim(self, name: str, columns: list[str] | None = None) -> DataFrame:
        """Columns of a dimension, hinted for broadcast when their measured size proves them small."""
        df = self.tables[name] if columns is None else self.tables[name].select(*columns)
        return F.broadcast(df) if self.is_small(name, columns) else df


def write_observed(df: DataFrame, path: str, name: str, mode: str = "overwrite",
                   text_bytes: bool = True) -> tuple[DataFrame, TableStats]:
    """Write ``df`` as Parquet; return the re-read table and the stats measured by the write itself.

    ``text_bytes`` adds the string byte totals needed to prove broadcast bounds;
    tables that are never broadcast (source, fact) only count rows.
    """
    obs = Observation(f"{name}-{new_run_id()}")   # unique: concurrent builds may share a session
    df.observe(obs, *stats_metrics(df, text_bytes)).write.mode(mode).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path), stats_from_metrics(obs.get, text_bytes)


def stage_source(src: DataFrame, root: str) -> tuple[DataFrame, TableStats]:
    """Extract step: the typed source, its rows numbered in file order, as a columnar table."""
    return stage_slices([src], root)


def stage_slices(slices: list[DataFrame], root: str) -> tuple[DataFrame, TableStats]:
    """``stage_source`` of a source that comes in slices: written one after the other, their shuffles removed in between."""
    return write_slices([with_row_number(src) for src in slices], join_path(root, "source"), "source")


def write_slices(slices: list[DataFrame], path: str, name: str) -> tuple[DataFrame, TableStats]:
    """``write_observed`` of a table (row counts only) that comes in slices."""
    rows = 0
    with shuffles_removed(slices[0].sparkSession):
        for i, df in enumerate(slices):
            table, stats = write_observed(df, path, name, "append" if i else "overwrite", text_bytes=False)
            rows += stats.rows
    return table, TableStats(rows, text_measured=False)


def laid_out(number, fact: DataFrame) -> DataFrame:
    """The fact in its stored layout: range-partitioned by order date, so each file holds few dates.

    A date filter then skips whole files by their footers. The order id splits a date that holds
    a large share of all lines over several partitions.
    """
    return number(fact.repartitionByRange("order_date_key", "order_id").sortWithinPartitions("order_date_key"))


def fact_slices(src: DataFrame, dims: dict[str, DataFrame], stats: dict[str, TableStats], limit: BroadcastLimit) -> list[DataFrame]:
    """The fact in its stored layout, in as many ranges of the order date as the source needs (one if it is small).

    A slice's files hold its dates alone, as those of the whole would; its row identities follow those of the slice before.
    """
    spark = src.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))        # of a slice at most: AQE only merges them
    return [laid_out(functools.partial(with_order_key, first=i * partitions),
                     fact_rows(src.where(within(F.col(f"`{S.ORDER_DATE}`"))), dims, stats, limit))
            for i, within in enumerate(ranges(src, S.ORDER_DATE, slices_for(spark, input_bytes(src))))]


def build_star(spark: SparkSession, src: DataFrame, root: str | None = None,
               num_partitions: int | None = None, stage: bool = True) -> Star:
    """Run extract, dimensions and fact; return handles to the written tables."""
    root = root or join_path(warehouse_dir(spark), "runs", new_run_id())
    limit = broadcast_limit(spark)
    stats: dict[str, TableStats] = {}
    tables: dict[str, DataFrame] = {}

    def one(name: str) -> tuple[str, DataFrame, TableStats]:
        df, st = write_observed(build_dimension(name, source, num_partitions, limit), join_path(root, name), name)
        return name, df, st

    # Shuffles sized from the input files before the first job (run_etl does its own sizing).
    sizing = (shuffle_partitions(spark, shuffle_partitions_for(spark, input_bytes(src)))
              if stage else contextlib.nullcontext())
    with sizing, shuffles_removed(spark):
        if stage:
            source, stats["source"] = stage_source(src, root)
        else:
            source = src  # already a written table
        # The four dimensions are independent jobs over the staged source; submitted
        # together, the scheduler fills cores a small stage of one would leave idle.
        with ThreadPoolExecutor(max_workers=len(DIMENSIONS)) as pool:
            for name, df, st in pool.map(one, DIMENSIONS):
                tables[name], stats[name] = df, st
        tables["fact_orders"], stats["fact_orders"] = write_slices(
            fact_slices(source, tables, stats, limit), join_path(root, "fact_orders"), "fact")
    return Star(root=root, source=source, tables=tables, stats=stats, limit=limit)


# ---------------------------------------------------------------------------
# Publication (idempotent full refresh)
# ---------------------------------------------------------------------------

def publish(spark: SparkSession, star: Star, base: str) -> None:
    """Mark ``star`` as the current version under ``base`` (append-only manifest)."""
    stats = json.dumps({t: st.to_dict() for t, st in star.stats.items()})
    row = [(star.root, int(time.time() * 1000), *[star.counts.get(t, 0) for t in S.STAR_TABLES], stats)]
    cols = ["root", "published_ms", *[f"{t}_rows" for t in S.STAR_TABLES], "stats_json"]
    spark.createDataFrame(row, cols).coalesce(1).write.mode("append").parquet(join_path(base, "_manifest"))


def load_published(spark: SparkSession, base: str) -> Star:
    """Handles to the newest published star under ``base``."""
    latest = (spark.read.parquet(join_path(base, "_manifest"))
              .orderBy(F.col("published_ms").desc()).limit(1).collect())
    if not latest:
        raise FileNotFoundError(f"no published star under {base}")
    rec = latest[0].asDict()
    root = rec["root"]
    tables = {t: spark.read.parquet(join_path(root, t)) for t in S.STAR_TABLES}
    stats = {t: TableStats.from_dict(d) for t, d in json.loads(rec["stats_json"]).items()}
    return Star(root=root, source=spark.read.parquet(join_path(root, "source")), tables=tables,
                stats=stats, limit=broadcast_limit(spark))


# ---------------------------------------------------------------------------
# Per-session reuse for the query registry
# ---------------------------------------------------------------------------

@dataclass
class StagedSource:
    """The staged source alone: what the checks of the source read."""

    root: str
    source: DataFrame
    stats: TableStats


_STARS: dict[tuple[str, str], Star] = {}
_SOURCES: dict[tuple[str, str], StagedSource] = {}
_STARS_LOCK = threading.RLock()


_TABLES_USED = ["lineitem", "orders", "customer", "nation", "region", "part"]


def _fingerprint(sf_dir: str) -> str | None:
    """Identity of (input files, library code), or None when the inputs are not local files.

    Input files contribute path, size and modification time; the library
    contributes the hash of every one of its source files, so a change to either
    means a new build.
    """
    h = hashlib.sha256()
    for t in _TABLES_USED:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if not os.path.exists(path):
            return None
        files = [path] if os.path.isfile(path) else sorted(
            os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs)
        for f in files:
            st = os.stat(f)
            h.update(f"{f}|{st.st_size}|{st.st_mtime_ns}\n".encode())
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for d, _, fs in sorted(os.walk(package)):
        for f in sorted(fs):
            if f.endswith(".py"):
                with open(os.path.join(d, f), "rb") as fh:
                    h.update(fh.read())
    return h.hexdigest()[:20]


def _tables_key(spark: SparkSession, sf_dir: str) -> tuple[tuple[str, str], str | None]:
    """This session's key for the test tables in ``sf_dir``, and the folder where their builds are published."""
    path = os.path.abspath(sf_dir)
    fp = _fingerprint(path)
    return (spark.sparkContext.applicationId, path), join_path(warehouse_dir(spark), "tables", fp) if fp else None


def _published(load, *args):
    """What ``load`` finds, or None where nothing is published yet."""
    try:
        return load(*args)
    except (AnalysisException, FileNotFoundError) as e:
        if isinstance(e, AnalysisException) and "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def _load_source(spark: SparkSession, base: str) -> StagedSource:
    latest = spark.read.parquet(join_path(base, "_source_manifest")).orderBy(F.col("published_ms").desc()).first()
    if latest is None:
        raise FileNotFoundError(f"no published source under {base}")
    return StagedSource(latest.root, spark.read.parquet(join_path(latest.root, "source")),
                        TableStats.from_dict(json.loads(latest.stats_json)))


def source_for_tables(spark: SparkSession, sf_dir: str, stage: bool = True) -> StagedSource | None:
    """The source staged from the test tables in ``sf_dir``: staged once, then reused, as the star is.

    Where none is staged yet, ``stage`` says whether to do it now (else None).

    Checks of the source read no dimension and no fact, so they do not wait for them to be built.
    """
    from ..sources.tables import read_tables_slices

    with _STARS_LOCK:
        key, base = _tables_key(spark, sf_dir)
        if key in _STARS:
            star = _STARS[key]
            return StagedSource(star.root, star.source, star.stats.get("source", TableStats(0, text_measured=False)))
        if key not in _SOURCES:
            found = _published(_load_source, spark, base) if base is not None else None
            if found is None and not stage:
                return None
            if found is None:
                slices, root = read_tables_slices(spark, sf_dir), join_path(warehouse_dir(spark), "runs", new_run_id())
                with shuffle_partitions(spark, shuffle_partitions_for(spark, -(-input_bytes(slices[0]) // len(slices)))):
                    found = StagedSource(root, *stage_slices(slices, root))
                if base is not None:
                    row = [(root, int(time.time() * 1000), json.dumps(found.stats.to_dict()))]
                    (spark.createDataFrame(row, "root string, published_ms long, stats_json string").coalesce(1)
                     .write.mode("append").parquet(join_path(base, "_source_manifest")))
            _SOURCES[key] = found
        return _SOURCES[key]


def star_for_tables(spark: SparkSession, sf_dir: str) -> Star:
    """The star built from the test tables in ``sf_dir``: built once over the staged source, then reused.

    Within a session the handles are kept in memory. Across sessions a build is
    published under the shared warehouse folder, keyed by ``_fingerprint``; a
    later session loads it instead of rebuilding (same tables, same keys).
    """
    with _STARS_LOCK:
        key, base = _tables_key(spark, sf_dir)
        star = _STARS.get(key)
        if star is None:
            star = _published(load_published, spark, base) if base is not None else None
            if star is None:
                staged = source_for_tables(spark, sf_dir)
                with shuffle_partitions(spark, shuffle_partitions_for(spark, input_bytes(staged.source))):
                    star = build_star(spark, staged.source, staged.root, stage=False)
                star.stats = {"source": staged.stats, **star.stats}
                if base is not None:
                    publish(spark, star, base)
            _STARS[key] = star
    return star


def remember_star(spark: SparkSession, sf_dir: str, star: Star) -> None:
    """Serve ``star`` for the test tables in ``sf_dir`` in this session (e.g. after ``run_etl``)."""
    with _STARS_LOCK:
        _STARS[(spark.sparkContext.applicationId, os.path.abspath(sf_dir))] = star


def forget_stars() -> None:
    with _STARS_LOCK:
        _STARS.clear()
        _SOURCES.clear()
