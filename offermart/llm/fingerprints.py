"""Document fingerprints: SimHash over weighted terms, and a search of all fingerprints within a Hamming radius.

The terms of a text are its word shingles of several lengths. Each distinct term is hashed and votes on every bit with its
weight, for the bit if its hash has it set and against it if not; the sign of the sum is the bit. The share of bits in which
two fingerprints differ estimates the angle between the weighted term vectors, so their likeness is the cosine of that.

The search cuts fingerprints into blocks. Two that differ in at most ``radius`` bits agree on at least ``blocks - radius`` whole
blocks, so there is one table for every choice of that many blocks, in which those blocks lead as the key. What meets in a table
is compared in full; a pair that meets in several counts in the first.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offermart.llm.common import identity, stored, table
from offermart.llm.registry import query

WORDS = 4  # 64-bit words of a fingerprint
SHINGLES = (1, 3)  # lengths of the terms, in words
RADIUS, BLOCKS = 7, 8
TERMS_AT_ONCE = 8192
# Odd multipliers that spread a 64-bit hash into the words of a fingerprint.
_SPREAD = np.array(
    [0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB],
    dtype=np.uint64,
)


def term_hashes(text: bytes, shingles: tuple[int, ...] = SHINGLES) -> np.ndarray:
    """XXH64 of every shingle of the lower-cased words (A-Z only), repeats included; none without words."""
    words = text.lower().split()
    digest, parts = xxhash.xxh64_intdigest, []
    for size in shingles:
        grams = words if size == 1 else map(b" ".join, zip(*(words[i:] for i in range(size))))
        parts.append(np.fromiter((digest(g, size) for g in grams), np.uint64))
    return np.concatenate(parts)


def _bits(hashes: np.ndarray) -> np.ndarray:
    """One row of 0 and 1 per hash, of ``64 * WORDS`` bits."""
    words = []
    for i in range(WORDS):
        x = (hashes ^ _SPREAD[i]) * _SPREAD[i + 1]
        x = (x ^ (x >> np.uint64(29))) * _SPREAD[i + 2]
        words.append(x ^ (x >> np.uint64(32)))
    return np.unpackbits(np.stack(words, axis=1).astype("<u8").view(np.uint8), axis=1, bitorder="little")


def fingerprint(text: str | None, shingles: tuple[int, ...] = SHINGLES) -> np.ndarray:
    """``WORDS`` unsigned words. A term that occurs n times weighs 1 + ln n, in steps of 1/64; no words give zeros."""
    terms, counts = np.unique(term_hashes((text or "").encode("utf-8", "surrogatepass"), shingles), return_counts=True)
    weights = np.rint(64 * (1 + np.log(counts)))  # whole numbers: their sums are exact in any order
    votes = np.zeros(64 * WORDS)
    for at in range(0, len(terms), TERMS_AT_ONCE):
        votes += weights[at : at + TERMS_AT_ONCE] @ _bits(terms[at : at + TERMS_AT_ONCE])
    return np.packbits(2 * votes > weights.sum(), bitorder="little").view("<u8")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine that the differing bits estimate, at least 0; 1 for equal fingerprints."""
    return max(0.0, float(np.cos(np.pi * int(np.bitwise_count(a ^ b).sum()) / (64 * WORDS))))


def digits(words: Column) -> Column:
    """The bits of an array of words as hex digits."""
    return F.concat_ws("", *[F.lpad(F.lower(F.hex(words[i])), 16, "0") for i in range(WORDS)])


def within(prints: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """All pairs ``(q, fp, differ)``: ``q`` of ``queries.fp`` and ``fp`` of ``prints.fp`` within ``radius`` bits, equal ones included.

    Both hold distinct arrays of ``WORDS`` longs in ``fp``; without one side the result is empty. Permuted block tables: a key is the
    ``blocks - radius`` blocks of one choice. Every fingerprint has one narrow row per table; AQE splits keys that are hot.
    """
    width = 64 * WORDS // blocks
    if blocks not in (WORDS, 2 * WORDS, 4 * WORDS, 8 * WORDS) or not 0 <= radius < blocks:
        raise ValueError(f"blocks must cut {64 * WORDS} bits into words or even parts of them, and outnumber the radius")
    choices = list(itertools.combinations(range(blocks), blocks - radius))
    mask = F.lit(-1 if width == 64 else (1 << width) - 1)

    def block(fp: Column, b: int) -> Column:
        return F.shiftrightunsigned(fp[b * width // 64], b * width % 64).bitwiseAND(mask)

    def keyed(rows: DataFrame) -> DataFrame:
        keys = [F.xxhash64(F.lit(t), *[block(F.col("fp"), b) for b in choice]) for t, choice in enumerate(choices)]
        return rows.select("fp", F.posexplode(F.array(*keys)).alias("t", "key"))

    met = keyed(queries.withColumnRenamed("fp", "q").select(F.col("q").alias("fp"))).withColumnRenamed("fp", "q")
    met = met.join(keyed(prints.select("fp")), ["t", "key"])
    q, fp = F.col("q"), F.col("fp")
    differ = sum((F.bit_count(q[i].bitwiseXOR(fp[i])) for i in range(1, WORDS)), F.bit_count(q[0].bitwiseXOR(fp[0])))
    agree = [block(q, b) == block(fp, b) for b in range(blocks)]
    first = F.lit(None).cast("int")
    for t in range(len(choices) - 1, -1, -1):
        whole = F.lit(True)
        for b in choices[t]:
            whole = whole & agree[b]
        first = F.when(whole, F.lit(t)).otherwise(first)
    return met.withColumn("differ", differ).where((F.col("differ") <= radius) & (F.col("t") == first)).select("q", "fp", "differ")


def near_counts(printed: DataFrame, asks: Column, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``(fp, near)`` for the fingerprints of the rows of ``printed (fp)`` that ``asks``: rows within ``radius`` bits, equal ones included."""
    distinct = printed.groupBy("fp").agg(F.count("*").alias("n"), F.max(asks.cast("int")).alias("asked"))
    pairs = within(distinct, distinct.where("asked = 1"), radius, blocks)
    return pairs.join(distinct.select("fp", "n"), "fp").groupBy(F.col("q").alias("fp")).agg(F.sum("n").alias("near"))


def edited(text: str, following: str) -> str:
    """The last half of the code points (rounded down) replaced by the first as many of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = (
    "id {id}, n_chars long, edited_sha256 string, fp array<long>, edited_fp array<long>, near_edited double, near_next double"
)


class _Rows:
    """Collects finished rows and ends of a partition as columns of a record batch."""

    def __init__(self, kind: pa.DataType, shingles: tuple[int, ...]):
        self.kind, self.shingles, self.rows = kind, shingles, []

    def add(self, key, text: str, fp: np.ndarray, following: str, next_fp: np.ndarray) -> None:
        changed = edited(text, following)
        new = fingerprint(changed, self.shingles)
        digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
        ints = fp.view("<i8").tolist(), new.view("<i8").tolist()
        self.rows.append((key, len(text), digest, *ints, likeness(fp, new), likeness(fp, next_fp)))

    def batch(self, *more) -> pa.RecordBatch:
        kinds = [self.kind, pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.float64(), pa.float64()]
        names = ["id", "n_chars", "edited_sha256", "fp", "edited_fp", "near_edited", "near_next"]
        columns = list(zip(*self.rows)) if self.rows else [()] * len(kinds)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        self.rows = []
        for name, k, value in more:
            arrays.append(pa.array([value] * len(arrays[0]), k))
            names.append(name)
        return pa.RecordBatch.from_arrays(arrays, names=names)


def with_next(docs: DataFrame, shingles: tuple[int, ...] = SHINGLES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_chars, edited_sha256, fp, edited_fp, near_edited, near_next)`` per row, against the next row by falling id.

    After the last row comes the first; a single row is its own next. Null ids come last, equal ids in the order of two
    hashes of id and text; rows equal in both are each other's next. A null text is an empty one; without words the fingerprint
    is zero. Other columns are ignored; an empty table gives an empty result. Texts move once, dealt out by ranges of the
    order, in which even one repeated row spreads over many tasks; a task holds two texts at a time. The two ends of each range
    are completed afterwards.
    """
    keys = ["id", "r1", "r2", "at"]
    rows = docs.select(
        F.col(id_col).alias("id"), *identity(id_col, text_col), F.monotonically_increasing_id().alias("at"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    order = [F.col("id").desc_nulls_last(), "r1", "r2", "at"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop(*keys[1:])
    id_type = rows.schema["id"].dataType.simpleString()
    schema = RESULT.format(id=id_type) + ", part int, end string, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, held = TaskContext.get().partitionId(), None, None
        ends = ("part", pa.int32(), part)
        nothing = ("text", pa.string(), None)
        for batch in batches:
            out = out or _Rows(batch.column(0).type, shingles)
            texts = batch.column(1)
            for i, key in enumerate(batch.column(0).to_pylist()):
                text = texts[i].as_py()
                fp = fingerprint(text, shingles)
                if held is None:
                    out.rows.append((key, len(text), None, fp.view("<i8").tolist(), None, None, None))
                    yield out.batch(ends, ("end", pa.string(), "first"), ("text", pa.string(), text))
                else:
                    out.add(*held, text, fp)
                held = key, text, fp
            if out.rows:
                yield out.batch(ends, ("end", pa.string(), None), nothing)
        if held is not None:
            key, text, fp = held
            out.rows.append((key, len(text), None, fp.view("<i8").tolist(), None, None, None))
            yield out.batch(ends, ("end", pa.string(), "last"), ("text", pa.string(), text))

    found = stored(ordered.mapInArrow(run, schema), "fingerprints-next")
    # The last row of a range is followed by the first of the next range that has rows. One narrow row per range is ordered here.
    firsts = found.where("end = 'first'")
    around = Window.orderBy("part")
    follows = firsts.select("part").withColumn("next", F.lead("part").over(around))
    follows = follows.withColumn("next", F.coalesce("next", F.min("part").over(Window.partitionBy())))
    pairs = found.where("end = 'last'").select("id", "fp", "text", "part").join(follows, "part").join(
        firsts.select(F.col("part").alias("next"), F.col("fp").alias("next_fp"), F.col("text").alias("following")), "next"
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = _Rows(batch.column(0).type, shingles)
            ids, fps, texts, next_fps, following = (c.to_pylist() for c in batch.columns)
            for key, fp, text, next_fp, more in zip(ids, fps, texts, next_fps, following):
                out.add(key, text, np.array(fp, "<i8").view("<u8"), more, np.array(next_fp, "<i8").view("<u8"))
            yield out.batch()

    closed = pairs.select("id", "fp", "text", "next_fp", "following").mapInArrow(finish, RESULT.format(id=id_type))
    return found.where("end IS NULL").drop("part", "end", "text").unionByName(closed)


@query(tested_by="tests/llm/test_new_operators.py")
def op13_fingerprints(spark, sf_dir):
    """All documents and their edited texts; ``n_near`` counts the other documents within 7 of 256 bits of every 20th id."""
    found = stored(with_next(table(spark, sf_dir, "documents")), "fingerprints")
    asks = F.coalesce(F.col("id") % 20 == 0, F.lit(False))
    counted = near_counts(found, asks)
    joined = found.where(asks).join(counted, "fp").withColumn("n_near", F.col("near") - 1)
    whole = joined.drop("near").unionByName(found.where(~asks).withColumn("n_near", F.lit(None).cast("long")))
    return whole.select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", digits(F.col("fp")).alias("fingerprint"),
        digits(F.col("edited_fp")).alias("edited_fingerprint"), "near_edited", "near_next", "n_near",
    )
