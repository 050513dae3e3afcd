"""Streaming forms of ingest, de-duplication, upsert and daily counts."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from offermart.functions.values import to_timestamp
from offermart.operators import star as S
from offermart.operators.keys import dense_keys
from offermart.operators.ranking import top_per_group
from offermart.plans import layers
from offermart.sources import path_exists


def event_time(col: str = "date_scraping") -> Column:
    return to_timestamp(F.col(col)).cast("timestamp")


def refined(offers: DataFrame, source: str, run_at: dt.datetime) -> DataFrame:
    """Gold of a stream of Bronze offers: the column functions of the batch, row by row."""
    return layers.gold(offers, source, run_at)


def unique_by_id(offers: DataFrame, delay: str = "1 day", time: str = "date_scraping") -> DataFrame:
    """First row of every id; ids are remembered until the watermark has passed them, later rows are dropped."""
    timed = offers.withColumn("_at", event_time(time)).withWatermark("_at", delay)
    return timed.dropDuplicatesWithinWatermark(["id"]).drop("_at")


def daily_counts(offers: DataFrame, delay: str = "1 day", time: str = "date_scraping", by: str = "source") -> DataFrame:
    """Offers per day and source; a day is final once the watermark has passed its end."""
    timed = offers.withColumn("_at", event_time(time)).withWatermark("_at", delay)
    counted = timed.groupBy(F.window("_at", "1 day"), by).agg(F.count("*").alias("n"))
    return counted.select(F.to_date("window.start").alias("jour"), by, "n")


def daily_totals(offers: DataFrame, time: str = "date_scraping", by: str = "source") -> DataFrame:
    """Offers per day and source so far, for ``to_latest``: every row counts at once, a late one in its own day, one without a readable time under
    a null day. The state is one number per day and source, so it needs no watermark and the counts add up to the input."""
    return offers.groupBy(F.to_date(event_time(time)).alias("jour"), by).agg(F.count("*").alias("n"))


def to_latest(totals: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Stores the groups that a batch has changed, with their new totals, below ``batch=<id>``. A replayed batch replaces its folder."""

    def store(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/batch={batch}")

    writer = totals.writeStream.outputMode("update").foreachBatch(store)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest total of every group; nulls are a group."""
    newest = top_per_group(spark.read.parquet(path), keys, [F.col("batch").desc()], 1)
    return newest.drop("batch")


def to_parquet(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append everything that has arrived, then stop; a restart goes on where the checkpoint ends."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)


# Key of each dimension.
DIMENSIONS = {"entreprises": "id_entreprise", "competences": "id_competence"}
BUCKETS = 32  # of the stored states and pairs, by the hash of the offer


def _stored(spark: SparkSession, path: str, name: str, before: int | None = None) -> DataFrame | None:
    """Everything stored under ``name``, or what batches before a number have stored; None if there is nothing."""
    if not path_exists(spark, f"{path}/{name}"):
        return None
    rows = spark.read.parquet(f"{path}/{name}")
    return rows if before is None else rows.filter(F.col("batch") < before)


def _bucketed(spark: SparkSession, path: str, name: str, schema: str | None = None) -> str:
    """Name of the table below ``path``, whose files Spark knows to be dealt by the hash of the offer; made known to this session if it is not yet.

    A task reads one bucket of all batches, so rows of an id meet without a shuffle.
    """
    table = f"offermart_{name}_{hashlib.md5(path.encode()).hexdigest()}"
    if not spark.catalog.tableExists(table):
        schema = schema or ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{path}/{name}").schema.fields if f.name != "batch")
        spark.sql(
            f"CREATE TABLE {table} ({schema}, batch INT) USING parquet OPTIONS (path '{path}/{name}', partitionOverwriteMode 'dynamic') "
            f"PARTITIONED BY (batch) CLUSTERED BY (id_offre) SORTED BY (id_offre) INTO {BUCKETS} BUCKETS"
        )
    return table


def _insert(rows: DataFrame, path: str, name: str, batch: int) -> None:
    """Rows of a batch, in buckets; those of the same batch are replaced, as the table says, whatever the session is set to."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    table = _bucketed(rows.sparkSession, path, name, schema)
    dealt = rows.repartition(BUCKETS, "id_offre").sortWithinPartitions("id_offre").withColumn("batch", F.lit(batch))
    dealt.write.insertInto(table, overwrite=True)


@contextmanager
def _dealt_in_buckets(spark: SparkSession) -> Iterator[None]:
    """Shuffles by the offer that come before an insert deal its buckets already, so rows are not dealt and sorted a second time."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(BUCKETS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def collect_first(stream: DataFrame, path: str, checkpoint: str, key: str = "id", order: str = "ord") -> DataStreamWriter:
    """Keeps of every id the row with the smallest order, over all batches: the de-duplication of a batch load for a stream in any order.

    Each batch stores its own first rows in buckets of the id; ``read_first`` cuts them to one. Rows without an id all stay.
    """

    def store(rows: DataFrame, batch: int) -> None:
        known = top_per_group(rows.filter(F.col(key).isNotNull()), [key], [F.col(order).asc()], 1)
        kept = known.unionByName(rows.filter(F.col(key).isNull()))
        _insert(kept.select(F.col(key).alias("id_offre"), *[c for c in rows.columns if c != key]), path, "first", batch)

    return stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def read_first(spark: SparkSession, path: str, key: str = "id", order: str = "ord") -> DataFrame:
    """What ``collect_first`` has kept so far; buckets are cut where they lie."""
    table = _bucketed(spark, path, "first")
    spark.catalog.recoverPartitions(table)
    rows = spark.table(table).drop("batch")
    known = top_per_group(rows.filter(F.col("id_offre").isNotNull()), ["id_offre"], [F.col(order).asc()], 1)
    return known.unionByName(rows.filter(F.col("id_offre").isNull())).withColumnRenamed("id_offre", key)


def upsert(stream: DataFrame, path: str, checkpoint: str, order: str = "ord") -> DataStreamWriter:
    """Incremental warehouse load of a stream of Gold offers with their order.

    Each batch stores its own first and last row per id and its offer-skill pairs, in buckets of the offer, and the companies and skills that no batch
    before it knew, below ``batch=<id>``. Their keys go on after the greatest one, so a key once given stays. A replayed
    batch sees the same earlier batches and replaces its folder, so it gives the same keys and changes nothing.
    The texts of a batch are read from its source, once for the first rows and once for the last; only ids, companies and skills are kept for later steps.
    """

    def store(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        short = rows.select("id", "entreprise", "competences").persist()
        with _dealt_in_buckets(spark):
            _insert(S.upsert_states(rows, order), path, "states", batch)
            _insert(S.offer_skills(short), path, "pairs", batch)
        names = {"entreprises": S.company_names(short), "competences": S.skill_names(short)}
        for name, key in DIMENSIONS.items():
            known = _stored(spark, path, name, batch)
            if known is None:
                table = S.extend_dimension(None, names[name], "nom", key)
            else:
                fresh = names[name].join(known.select("nom"), "nom", "left_anti")
                greatest = known.agg(F.max(key)).first()[0] or 0
                table = dense_keys(fresh, "nom", key, greatest)
            table.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{name}/batch={batch}")
        short.unpersist()

    return stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True)


def _history(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Merged states and distinct pairs of all batches, bucket by bucket, and the dimensions."""
    for name in ("states", "pairs"):
        spark.catalog.recoverPartitions(_bucketed(spark, path, name))
    return {
        "states": S.merge_states(spark.table(_bucketed(spark, path, "states"))),
        "pairs": spark.table(_bucketed(spark, path, "pairs")).select("id_offre", "nom").dropDuplicates(),
        **{name: spark.read.parquet(f"{path}/{name}").select(key, "nom") for name, key in DIMENSIONS.items()},
    }


def read_upserted(spark: SparkSession, path: str) -> S.Star:
    """Star schema of everything stored so far: first and last rows merge over the batches as they do within one."""
    parts = _history(spark, path)
    companies, skills = parts["entreprises"], parts["competences"]
    return S.Star(companies, skills, S.with_company_key(S.fact_rows(parts["states"]), companies), S.key_skills(parts["pairs"], skills))


def compact(spark: SparkSession, path: str, out: str) -> None:
    """One batch in place of all: the same star schema with the same keys, in a new folder that later batches go on from."""
    parts = _history(spark, path)
    last = spark.table(_bucketed(spark, path, "states")).agg(F.max("batch")).first()[0] or 0
    for name, table in parts.items():
        if name in DIMENSIONS:
            table.write.parquet(f"{out}/{name}/batch={last}")
        else:
            _insert(table, out, name, last)
