"""Readers. Each returns a DataFrame with a fixed schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offermart import schemas as S
from offermart import vocab as V
from offermart.functions.text import squeeze, strip

CORRUPT = "_corrupt_record"
PARTS = ["year", "month", "day"]


def conform(df: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns of ``schema`` in order; absent ones are null, unreadable values become null."""
    present = set(df.columns)
    cols = [
        (_coerce(df, f) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields
    ]
    return df.select(*cols, *[c for c in keep if c in present])


def _coerce(df: DataFrame, field: T.StructField) -> Column:
    if df.schema[field.name].dataType == field.dataType:
        return F.col(field.name)
    return F.col(field.name).try_cast(field.dataType)


def read_bronze_with_rejects(spark: SparkSession, path: str, lines: bool = False) -> tuple[DataFrame, DataFrame]:
    """Offers below ``path`` and the unreadable records, told apart instead of failing the run.

    A file holds a list of offers or a single offer. ``lines`` reads one offer per line, the layout ``write_bronze``
    produces. ``ord`` is the total order of the input: file path, block of the file, position in the block.
    """
    schema = T.StructType(S.BRONZE.fields + [T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).option("pathGlobFilter", "*.json")
    if not lines:
        reader = reader.option("multiLine", True).option("recursiveFileLookup", True)
    order = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
    )
    raw = reader.json(path).withColumn("ord", order)
    # Always true. Spark refuses to read the corrupt-record column alone, so a plain count has to touch another one.
    touched = F.col("id").isNull() | (F.char_length("id") >= 0)
    good = raw.filter(F.col(CORRUPT).isNull() & touched).drop(CORRUPT)
    bad = raw.filter(F.col(CORRUPT).isNotNull() & touched).select(F.col("ord.file").alias("file"), F.col(CORRUPT))
    return good, bad


def read_bronze(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return read_bronze_with_rejects(spark, path, lines)[0]


def tag_source(df: DataFrame, source: str) -> DataFrame:
    """F and W overwrite the source of a row, A only fills a missing one."""
    tag = F.lit(source)
    return df.withColumn("source", F.coalesce(F.col("source"), tag) if source == V.A else tag)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def finished(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path`` whose writer has ended; sorted, empty if there is no such path."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(n for n in names if fs.exists(hadoop.Path(f"{path}/{n}/_SUCCESS")))


def read_gold_for_day(spark: SparkSession, path: str, source: str, day: str) -> DataFrame:
    """Newest Gold run of one source for a day ``YYYYMMDD``, with its row order ``ord``; empty when there is none.

    Source and run are partition columns of the layout that ``write_layer`` leaves, so only folders of that source and day are
    listed as data; the newest of their runs is found first and prunes the scan to its own files.
    """
    if not path_exists(spark, path):
        order = T.StructType([T.StructField("file", T.StringType()), T.StructField("row", T.LongType())])
        return spark.createDataFrame([], T.StructType(S.GOLD.fields + [T.StructField("ord", order)]))
    parts = [T.StructField("_source", T.StringType()), T.StructField("run", T.StringType())]
    files = spark.read.schema(T.StructType(S.GOLD.fields + parts)).parquet(path)
    of_day = (F.col("_source") == source) & (F.substring("run", 1, 8) == day)
    newest = files.filter(of_day).agg(F.max("run").alias("run"))
    order = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    rows = files.select("*", order.alias("ord")).filter(of_day).join(F.broadcast(newest), "run")
    return rows.select(*S.GOLD.fieldNames(), "ord")


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, S.RATINGS)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, S.PAGE)


def cv_text(content: Column) -> Column:
    """Bytes as UTF-8 without the undecodable ones, white space collapsed."""
    text = F.make_valid_utf8(content.cast("string"))
    return strip(squeeze(F.replace(text, F.lit("�"), F.lit(""))))


def read_cvs(spark: SparkSession, path: str) -> DataFrame:
    """``(cv_id, text)`` of every text file below ``path``; the id is the file name without its extension."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1)
    return files.select(name.alias("cv_id"), cv_text(F.col("content")).alias("text"))


def topic_of(source: str) -> str:
    return f"bronze.{source}.offres"


def parse_offers(values: DataFrame, column: str = "value") -> DataFrame:
    """Offers out of JSON values; unreadable values give rows of nulls."""
    return values.select(F.from_json(F.col(column).cast("string"), S.BRONZE).alias("o")).select("o.*")


def stream_topic(spark: SparkSession, servers: str, source: str) -> DataFrame:
    """Offer events of a topic. Needs the Kafka connector on the class path."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return parse_offers(raw.option("subscribe", topic_of(source)).load())


def stream_bronze(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Offer files (one offer per line) as they arrive."""
    return spark.readStream.schema(S.BRONZE).option("maxFilesPerTrigger", max_files).json(path)
