"""End-to-end refresh: extract, quality, dimensions, fact, reconciliation, publish.

Each stage is a Spark job over written tables; the driver only ever sees the
one-row quality report and the four-row reconciliation.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..config import input_bytes, join_path, new_run_id, shuffle_partitions, shuffle_partitions_for, warehouse_dir
from . import marts, quality, reconcile
from .star import Star, build_star, load_published, publish, stage_source


@dataclass
class EtlResult:
    star: Star
    quality: dict
    reconciliation: list[dict]
    summary: DataFrame
    runtime_sec: float
    stage_sec: dict


class RefusedLoad(ValueError):
    """The run is not published; the version before it stays the one that readers see."""


def run_etl(spark: SparkSession, source: DataFrame, base: str | None = None,
            contract: quality.Contract = quality.Contract(), publish_run: bool = True,
            materialise_marts: bool = False, strict: bool = False) -> EtlResult:
    """Refresh the star from ``source`` and publish it under ``base``.

    Re-running over the same source yields the same rows and the same keys;
    the previous version stays readable until the new one is published. With
    ``materialise_marts`` the nine views are also written as Parquet marts of
    the run before it is published, so a dashboard reads pre-aggregated rows.

    Source numbers that the store's types cannot hold make the load fail (``RefusedLoad``), as an
    insert into such a column would. With ``strict`` a failed reconciliation does so too; by default
    the run is published whatever the reconciliation finds.
    """
    started = time.time()
    stages: dict[str, float] = {}

    def mark(name: str, t0: float) -> float:
        now = time.time()
        stages[name] = round(now - t0, 3)
        return now

    base = base or join_path(warehouse_dir(spark), "star")
    root = join_path(base, "runs", new_run_id())

    t = started
    # Shuffles of this run are sized from the input files (setting restored afterwards).
    with shuffle_partitions(spark, shuffle_partitions_for(spark, input_bytes(source))):
        staged, source_stats = stage_source(source, root)
        # Checked before anything is built on it: one bad value costs one pass, not a whole star.
        overflow = quality.store_overflow(staged).first().asDict()
        if any(overflow.values()):
            raise RefusedLoad(f"values beyond the store's types: {overflow}")
        t = mark("extract", t)
        # The quality report and the star build both read the staged source and
        # do not depend on each other: run them as concurrent jobs.
        with ThreadPoolExecutor(max_workers=1) as pool:
            pending = pool.submit(lambda: quality.quality_report(staged, contract).first().asDict())
            star = build_star(spark, staged, root=root, stage=False)
            report = pending.result()
        star.stats["source"] = source_stats
        t = mark("quality_dimensions_fact", t)
        # Reconciliation, optional mart writes and publication only read the
        # written tables and do not depend on each other.
        with ThreadPoolExecutor(max_workers=3) as pool:
            recon_job = pool.submit(lambda: [r.asDict() for r in reconcile.reconciliation(staged, star.fact)
                                             .orderBy("position").collect()])
            marts_job = pool.submit(marts.materialise, star) if materialise_marts else None
            if marts_job is not None:
                marts_job.result()          # marts are part of the run: written before it is published
            if strict and not all(r["matched"] for r in recon_job.result()):
                raise RefusedLoad(f"reconciliation failed: {recon_job.result()}")
            if publish_run:
                publish(spark, star, base)
            recon = recon_job.result()
        mark("reconcile_publish", t)
    elapsed = time.time() - started
    all_passed = all(r["matched"] for r in recon)
    summary = spark.createDataFrame(
        [(round(elapsed, 3), int(report["total_rows"]), report["quality_status"],
          "PASSED" if all_passed else "FAILED")],
        "runtime_sec double, records_processed long, quality_status string, reconciliation_status string")
    return EtlResult(star=star, quality=report, reconciliation=recon, summary=summary, runtime_sec=elapsed,
                     stage_sec=stages)


def register_views(spark: SparkSession, star: Star, prefix: str = S.VIEW_PREFIX) -> list[str]:
    """Star tables and the nine views as temporary views, for ``spark.sql`` users."""
    names = []
    for table, df in star.tables.items():
        df.createOrReplaceTempView(table)
        names.append(table)
    for name, df in marts.all_marts(star).items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


def served_mart(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A view or dataset of the published star: the run's materialised mart if written, else computed."""
    star = load_published(spark, base)
    if name in marts.MARTS:
        try:
            return spark.read.parquet(join_path(star.root, "marts", name))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return marts.MARTS[name](star)
    return marts.DATASETS[name](star)


def summary_of(source: DataFrame, fact: DataFrame, contract: quality.Contract = quality.Contract()) -> DataFrame:
    """The summary row of a run over its written tables (without the wall time)."""
    passed = reconcile.reconciliation(source, fact).agg(F.bool_and("matched")).scalar()
    return quality.quality_report(source, contract).select(
        F.col("total_rows").alias("records_processed"), "quality_status",
        F.when(passed, "PASSED").otherwise("FAILED").alias("reconciliation_status"))
