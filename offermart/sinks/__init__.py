"""Writers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offermart.functions.values import at
from offermart.operators.star import Star, bridge, company_dimension, fact_offers, read_star, skill_dimension
from offermart.session import cut_lineage
from offermart.sources import finished, topic_of


def write_bronze(df: DataFrame, path: str, day: dt.date) -> None:
    """JSON lines below ``source=/year=/month=/day=``."""
    parts = {"year": F.lit(day.year), "month": F.lit(f"{day.month:02d}"), "day": F.lit(f"{day.day:02d}")}
    df.withColumns(parts).write.partitionBy("source", *parts).mode("append").json(path)


def write_layer(df: DataFrame, path: str, run_at: dt.datetime) -> None:
    """Silver or Gold below ``source=/annee=/mois=/run=``; a rerun replaces its own folders only.

    ``run`` holds the day token that ``read_gold_for_day`` looks for. The copy ``_source`` keeps ``source`` inside the
    files as well as in the path.
    """
    parts = {"_source": F.col("source"), "_annee": F.lit(run_at.year), "_mois": F.lit(run_at.month)}
    parts["run"] = F.lit(run_at.strftime("%Y%m%d_%H%M%S"))
    writer = df.withColumns(parts).write.partitionBy("_source", "_annee", "_mois", "run").mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def _replace(table: DataFrame, path: str) -> DataFrame:
    table.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def load_star(gold: DataFrame, path: str, order: str = "ord") -> Star:
    """Full refresh: every table of the warehouse is replaced.

    Dimensions are written first and read back to resolve the keys of the fact and the bridge, so keys are made once.
    """
    companies = _replace(company_dimension(gold), f"{path}/entreprises")
    skills = _replace(skill_dimension(gold), f"{path}/competences")
    offers = _replace(fact_offers(gold, companies, order), f"{path}/offres")
    return Star(companies, skills, offers, _replace(bridge(gold, skills), f"{path}/offre_competence"))


def publish_star(gold: DataFrame, root: str, version: str, order: str = "ord") -> Star:
    """A full refresh that readers see all at once: the tables go to a folder of the version, then a manifest names it.

    Until the manifest is there readers keep the version before, whatever tables a failed run has left; sent again, they are written over. A version that
    was published stays as it is. One writer at a time; old versions stay for readers that still follow them.
    """
    spark = gold.sparkSession
    published = {_version(spark, root, n): n for n in finished(spark, f"{root}/manifest")}
    folder = f"{root}/versions/{version}"
    if version not in published:
        load_star(gold, folder, order)
        number = 1 + max((int(n.removeprefix("n=")) for n in published.values()), default=0)
        spark.createDataFrame([(version,)], "version string").coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/n={number:09d}")
    return read_star(spark, folder)


def _version(spark: SparkSession, root: str, manifest: str) -> str:
    return spark.read.schema("version string").parquet(f"{root}/manifest/{manifest}").first()[0]


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version the newest manifest names; None before the first."""
    manifests = finished(spark, f"{root}/manifest")
    return _version(spark, root, manifests[-1]) if manifests else None


def current_star(spark: SparkSession, root: str) -> Star:
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no version published below {root}")
    return read_star(spark, f"{root}/versions/{version}")


def write_star(star: Star, path: str) -> None:
    """The tables of a star schema as they are, for instance an incremental one."""
    for name, table in star.tables().items():
        _replace(table, f"{path}/{name}")


def write_star_jdbc(star: Star, url: str, properties: dict | None = None) -> None:
    """The same tables through JDBC; needs a driver on the class path."""
    for name, table in star.tables().items():
        table.write.jdbc(url, f"gold.{name}", mode="overwrite", properties=properties or {})


def to_messages(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def publish(df: DataFrame, servers: str, source: str) -> None:
    """Offers to the topic of their source. Needs the Kafka connector on the class path."""
    writer = to_messages(df).write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.option("kafka.compression.type", "gzip").option("topic", topic_of(source)).save()


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def replace_skills(current: DataFrame, fresh: DataFrame) -> DataFrame:
    """Skill rows after an upload: candidates in ``fresh`` lose their old rows, the others keep them."""
    uploaded = fresh.select("id_utilisateur").distinct()
    kept = current.join(uploaded, "id_utilisateur", "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)


def _skill_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("id_utilisateur"), F.lit(buckets)).cast("int")


def store_skills(skills: DataFrame, path: str, buckets: int = 64) -> None:
    """Skill rows of candidates in folders by the hash of the candidate, the form ``replace_stored_skills`` updates; all of it is replaced."""
    rows = skills.withColumn("bucket", _skill_bucket(buckets)).repartitionByRange("bucket", "id_utilisateur")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(path)


def replace_stored_skills(path: str, fresh: DataFrame, buckets: int = 64) -> None:
    """``replace_skills`` on a stored table: only the buckets of the candidates in ``fresh`` are read and written, the other files are not touched.

    ``fresh`` has the columns of the table or some of them; ``buckets`` is that of ``store_skills``. The new rows are stored before the folders are
    replaced, so a lost executor costs no rows.
    """
    spark = fresh.sparkSession
    touched = [r[0] for r in fresh.select(_skill_bucket(buckets)).distinct().collect()]  # at most ``buckets`` numbers
    if not touched:
        return
    table = spark.read.parquet(path)
    current = table.where(F.col("bucket").isin(touched)).drop("bucket")
    after = cut_lineage(replace_skills(current, fresh).select(current.columns).withColumn("bucket", _skill_bucket(buckets)))
    after.repartitionByRange("bucket", "id_utilisateur").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def recommendation_rows(recommendations: DataFrame, run_at: dt.datetime) -> DataFrame:
    return recommendations.select(
        "id_utilisateur",
        "id_offre",
        "source",
        F.col("score_match").cast("decimal(5,2)").alias("score_recommandation"),
        at(run_at).alias("date_recommandation"),
        F.lit(False).alias("est_consulte"),
        F.lit(False).alias("est_sauvegarde"),
    )


def append_recommendations(recommendations: DataFrame, path: str, run_at: dt.datetime) -> None:
    """Rows are only ever added; a second upload adds them again under its own run time."""
    recommendation_rows(recommendations, run_at).write.mode("append").parquet(path)
