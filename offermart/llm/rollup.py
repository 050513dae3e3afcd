"""Token counts as rollups that are kept up to date by signed changes.

Every batch of changes turns into signed rows: a document that comes in adds its tokens, one that goes takes back what it
had added, a revised one does both. Rows are named by id, text, source and language, with a count of the rows equal in all of
them, so that rows without an id or with a repeated one all count. The rows of a batch go into a ledger in buckets of their name, their sums by
source, language and tokenizer into the rollup. Totals are the sum of all committed batches. Only deletions and revisions look into the ledger,
and only at the buckets and names they touch; ``fold`` makes one batch of many. A batch is committed by a marker written last: one that failed
half-way is written over when it is sent again, and one that was committed before changes nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offermart.llm import tokens
from offermart.llm.common import identity, scratch, stored, table
from offermart.llm.registry import query

KEY = ["source", "lang", "tokenizer"]
NAME = ["id", "r1", "r2"]
LEDGER = "id {id}, r1 long, r2 long, source string, lang string, tokenizer string, tokens long, docs long, bucket int"
BUCKETS = 64  # of the ledger, by the hash of a name
SALTS = 8  # parts into which the rows of one text are dealt
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


def names(id_col: str, text_col: str) -> list[Column]:
    """``r1, r2``: what tells rows apart beside their id, from text, source and language."""
    group = [c for k in KEY[:2] for c in (F.col(k).isNull(), F.coalesce(F.col(k).cast("string"), F.lit("")))]
    return [F.xxhash64(r, *group).alias(f"r{i}") for i, r in enumerate(identity(id_col, text_col), 1)]


def count_all(
    docs: DataFrame, ranks: dict[str, str], id_col: str = "doc_id", text_col: str = "text", named_by: str | None = None
) -> DataFrame:
    """``(id, r1, r2, source, lang, h, c, n, counts)`` per row: the length of its whole text in the ids of each tokenizer; 0 for null or empty.

    ``ranks`` are the files of the tokenizers by version; all are counted in one pass over the texts. ``h, c, n`` tell texts apart (null is not
    an empty one). ``named_by`` is the column with the text the row came in with, if ``text_col`` holds a revised one.
    """
    text = F.col(text_col).cast("string")
    content = [F.xxhash64(text).alias("h"), F.crc32(text.cast("binary")).alias("c"), F.length(text).cast("long").alias("n")]
    rows = docs.select(F.col(id_col).alias("id"), *names(id_col, named_by or text_col), "source", "lang", *content, text.alias("text"))
    columns = [*NAME, "source", "lang", "h", "c", "n"]
    schema = rows.select(*columns, F.array(F.lit(0).cast("long")).alias("counts")).schema
    files = list(ranks.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokens.counts_of(tuple(files))
        for batch in batches:
            counts = [tokens.count(text.as_py(), known) for text in batch.column(len(columns))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], pa.array(counts, pa.list_(pa.int64()))], names=[*columns, "counts"])

    return rows.mapInArrow(run, schema)


def of_tokenizer(counted: DataFrame, ranks: dict[str, str], version: str) -> DataFrame:
    """``(id, r1, r2, source, lang, tokenizer, tokens)`` of one tokenizer of ``count_all``."""
    return counted.select(*NAME, "source", "lang", F.lit(version).alias("tokenizer"), F.col("counts")[list(ranks).index(version)].alias("tokens"))


def count_tokens(
    docs: DataFrame, tokenizer: str, ranks: str, id_col: str = "doc_id", text_col: str = "text", named_by: str | None = None
) -> DataFrame:
    """``count_all`` with one tokenizer: ``(id, r1, r2, source, lang, tokenizer, tokens)``."""
    files = {tokenizer: ranks}
    return of_tokenizer(count_all(docs, files, id_col, text_col, named_by), files, tokenizer)


def _same_name(left: str, right: str, *more: str) -> Column:
    out = F.lit(True)
    for c in (*NAME, *more):
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*NAME), F.lit(buckets)).cast("int")


class Rollup:
    """Totals in a folder that all executors share. One writer at a time; ``buckets`` never changes for a folder."""

    def __init__(self, spark: SparkSession, path: str, id_type: str = "long", buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.schema = LEDGER.format(id=id_type)

    def _committed(self, batch: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits/batch={batch}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def batches(self) -> list[str]:
        """Names of the committed batches; a few short strings."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits")
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(root):
            return []
        names = [s.getPath().getName().removeprefix("batch=") for s in fs.listStatus(root)]
        return sorted(n for n in names if self._committed(n))

    def _counting(self) -> list[str]:
        """The committed batches whose rows count: those that no committed fold stands for."""
        batches = self.batches()
        if not batches:
            return []
        marks = self.spark.read.schema("covers string").parquet(*[f"{self.path}/commits/batch={b}" for b in batches])
        covered = {r["covers"] for r in marks.where("covers IS NOT NULL").distinct().collect()}
        return [b for b in batches if b not in covered]

    def _read(self, part: str, schema: str) -> DataFrame:
        paths = [f"{self.path}/{part}/batch={b}" for b in self._counting()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.option("basePath", f"{self.path}/{part}").schema(schema).parquet(*paths)

    def live(self, touched: DataFrame | None = None) -> DataFrame:
        """``(id, r1, r2, source, lang, tokenizer, tokens, docs)`` of every document that counts now; ``docs`` rows are equal.

        With ``touched (id, r1, r2)`` only those names, read from their buckets alone and cut down before anything is grouped.
        """
        rows = self._read("ledger", self.schema)
        if touched is not None:
            wanted = touched.select(*NAME).distinct()
            buckets = [r[0] for r in wanted.select(_bucket(self.buckets)).distinct().collect()]
            rows = rows.where(F.col("bucket").isin(buckets)).alias("l").join(wanted.alias("t"), _same_name("l", "t"), "left_semi")
        return rows.groupBy(*NAME, *KEY, "tokens").agg(F.sum("docs").alias("docs")).where("docs > 0")

    def _write(self, batch: str, signed: DataFrame, covers: list[str]) -> None:
        """The ledger in buckets, dealt by ranges so that a large one spreads over many tasks, then the sums, then the marker."""
        ledger = f"{self.path}/ledger/batch={batch}"
        placed = signed.withColumn("bucket", _bucket(self.buckets)).repartitionByRange("bucket", "r1", "r2")
        placed.sortWithinPartitions("bucket", "r1").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(ledger)
        rows = self.spark.read.schema(self.schema).parquet(ledger)
        sums = rows.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.sum(F.col("docs") * F.col("tokens")).alias("tokens"))
        sums.write.mode("overwrite").parquet(f"{self.path}/rollup/batch={batch}")
        marks = self.spark.createDataFrame([(c,) for c in covers] or [(None,)], "covers string")
        marks.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/batch={batch}")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Applies ``changes`` ``(op, id, r1, r2, source, lang, tokenizer, tokens, docs)`` once; False if the batch was committed before.

        ``id, r1, r2`` name a document, null being a value like any other (all null without the columns ``r1, r2``), and ``docs`` (1 if there is
        no such column) says for how many equal rows a change stands. First ``delete`` takes out as many of the documents that earlier batches have
        under the name as it has rows, under all tokenizers if ``tokenizer`` is null, those with fewer tokens first. Then ``revise``
        changes all that are left of them under its tokenizer; of several different ones the largest ``(tokens, source, lang)`` holds. Last
        ``insert`` adds its documents, whatever else is there. Null sources and languages are groups of their own; null tokens count as 0.
        An empty batch is committed like any other.
        """
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError(f"not a batch name: {batch!r}")
        if self._committed(batch):
            return False
        if "r1" not in changes.columns:
            changes = changes.withColumns({r: F.lit(None).cast("long") for r in NAME[1:]})
        if "docs" not in changes.columns:
            changes = changes.withColumn("docs", F.lit(1))
        columns = [*NAME, *KEY, "tokens", "docs"]
        equal = changes.withColumn("tokens", F.coalesce("tokens", F.lit(0)).cast("long")).groupBy("op", *NAME, *KEY, "tokens")
        changes = stored(equal.agg(F.sum("docs").cast("long").alias("docs")), "token-changes")
        told = changes.where("op <> 'insert'")
        signed = changes.where("op = 'insert'").select(columns)
        if not told.isEmpty():
            signed = signed.unionByName(self._taken_and_revised(told).select(columns))
        self._write(batch, signed, [])
        return True

    def _taken_and_revised(self, told: DataFrame) -> DataFrame:
        deletes = told.where("op = 'delete'")
        d_all = deletes.where("tokenizer IS NULL").groupBy(*NAME).agg(F.sum("docs").alias("of_all"))
        d_one = deletes.where("tokenizer IS NOT NULL").groupBy(*NAME, "tokenizer").agg(F.sum("docs").alias("of_one"))
        new = told.where("op = 'revise'").groupBy(*NAME, "tokenizer").agg(F.max(F.struct("tokens", "source", "lang")).alias("new"))
        same_tokenizer = lambda a, b: F.col(f"{a}.tokenizer").eqNullSafe(F.col(f"{b}.tokenizer"))
        live = self.live(told).alias("l").join(d_all.alias("a"), _same_name("l", "a"), "left").select("l.*", "of_all")
        live = live.alias("l").join(d_one.alias("o"), _same_name("l", "o") & same_tokenizer("l", "o"), "left").select("l.*", "of_one")
        live = live.alias("l").join(new.alias("n"), _same_name("l", "n") & same_tokenizer("l", "n"), "left").select("l.*", "new")
        # A name has as many rows here as it has different token counts, mostly one.
        before = Window.partitionBy(*NAME, "tokenizer").orderBy("tokens", "source", "lang").rowsBetween(Window.unboundedPreceding, -1)
        wanted = F.coalesce("of_all", F.lit(0)) + F.coalesce("of_one", F.lit(0)) - F.coalesce(F.sum("docs").over(before), F.lit(0))
        taken = live.withColumn("taken", F.greatest(F.lit(0), F.least(wanted, "docs")))
        left = F.col("docs") - F.col("taken")
        old = taken.withColumn("docs", -F.when(F.col("new").isNotNull(), F.col("docs")).otherwise(F.col("taken"))).where("docs <> 0")
        revised = taken.where("new IS NOT NULL").withColumn("docs", left).where("docs > 0")
        revised = revised.select(*NAME, F.col("new.source").alias("source"), F.col("new.lang").alias("lang"), "tokenizer", F.col("new.tokens").alias("tokens"), "docs")
        return old.select(revised.columns).unionByName(revised)

    def fold(self, batch: str) -> bool:
        """Makes one batch of all committed ones: the ledger then holds each document once. Folded batches stay committed."""
        if self._committed(batch):
            return False
        self._write(batch, self.live(), self._counting())
        return True

    def totals(self) -> DataFrame:
        """``(source, lang, tokenizer, docs, tokens)``, the sum of the committed batches' small sums."""
        parts = self._read("rollup", "source string, lang string, tokenizer string, docs long, tokens long")
        sums = parts.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs <> 0 OR tokens <> 0")


def changes(op: str, counted: DataFrame) -> DataFrame:
    return counted.select(F.lit(op).alias("op"), *NAME, *KEY, "tokens")


def copies(counted: DataFrame) -> DataFrame:
    """Deletions of all rows but one of every text of ``count_all``; the one with the smallest id stays, one without id only if none has any.

    Null texts are no copies of each other. Rows are counted by text and name first. The smallest name is sent back to the rows of a text in ``SALTS`` parts.
    """
    same = counted.groupBy(*NAME, "h", "c", "n").agg(F.count("*").alias("docs"))
    order = F.struct(F.col("id").isNull().alias("last"), *NAME)
    first = same.groupBy("h", "c", "n").agg(F.min(order).alias("first"), F.sum("docs").alias("copies")).where("copies > 1")
    first = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    stays = F.struct(F.col("id").isNull().alias("last"), *NAME).eqNullSafe(F.col("first")).cast("int")
    salted = same.withColumn("salt", F.pmod(F.xxhash64("r1"), F.lit(SALTS)).cast("int"))
    gone = salted.join(first, ["h", "c", "n", "salt"]).withColumn("docs", F.col("docs") - stays).where("docs > 0")
    unknown = [F.lit(None).cast("string").alias(c) for c in KEY]
    return gone.select(F.lit("delete").alias("op"), *NAME, *unknown, F.lit(None).cast("long").alias("tokens"), "docs")


@query(tested_by="tests/llm/test_text_operators.py")
def op3_token_rollup(spark, sf_dir):
    """All documents come in under two tokenizers, exact copies go, and texts with addresses are revised; two batches are sent twice."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    files = {"byte_bpe_50k": "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k": "byte_bpe_multi_50k.tiktoken"}
    ranks = {version: str(public_tokenizers.path(name)) for version, name in files.items()}
    counted = stored(count_all(docs, ranks), "token-counts")
    rollup = Rollup(spark, scratch(spark, "token-rollup"), docs.schema["doc_id"].dataType.simpleString())
    for version in ranks:
        rollup.commit(f"insert-{version}", changes("insert", of_tokenizer(counted, ranks, version)))
    gone = copies(counted)
    rollup.commit("delete-copies", gone)
    # Few texts hold the sign of an address; the pattern is tried on those alone.
    masked = docs.where(F.col("text").contains("@")).where(F.col("text").rlike(EMAIL)).select(
        "doc_id", "source", "lang", "text", F.regexp_replace("text", EMAIL, "<EMAIL>").alias("masked")
    )
    again = stored(count_all(masked, ranks, text_col="masked", named_by="text"), "token-revised")
    revised = [changes("revise", of_tokenizer(again, ranks, version)) for version in ranks]
    rollup.commit("mask-addresses", revised[0].unionByName(revised[1]))
    rollup.commit("delete-copies", gone)
    rollup.commit("insert-byte_bpe_50k", changes("insert", of_tokenizer(counted, ranks, "byte_bpe_50k")))
    return rollup.totals().select(
        "source", "lang", F.col("tokenizer").alias("tokenizer_version"), F.col("docs").alias("n_docs"), F.col("tokens").alias("n_tokens")
    )
