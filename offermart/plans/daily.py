"""The daily run: collected payloads to Bronze, Bronze to Silver and Gold, Gold to the star schema."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offermart import schemas as S
from offermart import vocab as V
from offermart.operators.star import Star, split_rejects
from offermart.plans.layers import GOLD_COLUMNS, SILVER_COLUMNS, gold, union_sources
from offermart.sinks import publish_star, write_bronze, write_layer
from offermart.sources import conform, finished, path_exists, read_bronze, read_gold_for_day


def collect_day(offers: dict[str, DataFrame], root: str, day: dt.date) -> None:
    """Bronze of every source that delivered; a source that failed is simply absent."""
    for source in V.SOURCES:
        if source in offers:
            write_bronze(conform(offers[source], S.BRONZE), f"{root}/bronze", day)


def refine_source(spark: SparkSession, root: str, source: str, run_at: dt.datetime) -> None:
    """Silver and Gold of one source from all of its Bronze. Gold is computed once and Silver is read from it."""
    bronze = read_bronze(spark, f"{root}/bronze/source={source}", lines=True)
    rows = gold(bronze, source, run_at).select(*GOLD_COLUMNS)
    write_layer(rows, f"{root}/gold", run_at)
    written = read_gold_for_day(spark, f"{root}/gold", source, run_at.strftime("%Y%m%d"))
    write_layer(written.select(*SILVER_COLUMNS), f"{root}/silver", run_at)


def gold_of_day(spark: SparkSession, root: str, day: dt.date) -> DataFrame:
    """Gold of all sources for a day with its load order: source after source, then the order of the rows."""
    frames = []
    for rank, source in enumerate(V.SOURCES):
        rows = read_gold_for_day(spark, f"{root}/gold", source, day.strftime("%Y%m%d"))
        frames.append(rows.withColumn("ord", F.struct(F.lit(rank).alias("source"), F.col("ord").alias("row"))))
    return union_sources(frames)


def load_day(spark: SparkSession, root: str, day: dt.date, version: str | None = None) -> tuple[Star, DataFrame]:
    """Full refresh of the star schema from the Gold of a day, published as ``version`` (the day, unless told otherwise) below ``star``; returns it
    with the rejected rows."""
    valid, rejects = split_rejects(gold_of_day(spark, root, day))
    return publish_star(valid, f"{root}/star", version or day.strftime("%Y%m%d")), rejects


def run_day(spark: SparkSession, root: str, run_at: dt.datetime, offers: dict[str, DataFrame] | None = None,
            collect_only: bool = False, refine_only: bool = False) -> Star | None:
    """The whole day. ``collect_only`` stops after Bronze, ``refine_only`` starts from the Bronze already there.

    A stage that has ended leaves a mark below ``_done/run=``; the same run started again goes on after the last mark. Silver, Gold and the star schema
    are replaced by a stage that is repeated; Bronze is appended to, source by source.
    """
    run = run_at.strftime("%Y%m%d_%H%M%S")
    marks = f"{root}/_done/run={run}"
    done = set(finished(spark, marks))

    def stage(name: str, work) -> None:
        if name not in done:
            work()
            spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{marks}/{name}")

    if not refine_only:
        for source, rows in (offers or {}).items():
            stage(f"collect-{source}", lambda source=source, rows=rows: collect_day({source: rows}, root, run_at.date()))
    if collect_only:
        return None
    for source in V.SOURCES:
        if path_exists(spark, f"{root}/bronze/source={source}"):
            stage(f"refine-{source}", lambda source=source: refine_source(spark, root, source, run_at))
    return load_day(spark, root, run_at.date(), run)[0]
