"""Quality classifier on random-indexing word vectors.

Every token has a fixed sparse index vector of a few +1 and -1, given by its hash. Its context vector is the sum of the index
vectors of its neighbours over all documents, so every word of the corpus has one of its own, in a stored table that grows with
the corpus. Both together are its word vector, in whole numbers; a document is the mean of its tokens' vectors. A two-layer
network reads the means; its probabilities are calibrated by a temperature.

The vectors of the most frequent words are broadcast, ``HEAD`` of them at most; all other words are joined, and as so many words are at
least nearly as frequent, none of those is a hot key. Sums are whole numbers, so the result does
not depend on how rows are dealt, nor on ``HEAD``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offermart.llm.common import stored, table
from offermart.llm.models import Network, fold, labelled
from offermart.llm.registry import query

DIMS, NONZERO, REACH = 48, 3, 2  # length of a vector, entries of an index vector, neighbours on each side
STEP = DIMS // NONZERO  # each entry has its own stretch of the vector
UNIT = 80  # whole numbers per unit of length
HEAD = 1 << 19  # most frequent words whose vectors are broadcast, 56 bytes each
REMEMBERED = 1 << 19  # tokens a worker remembers
TOKENS_AT_ONCE, CHUNK = 1 << 23, 1 << 19  # tokens counted before their sums leave a task, and those added at once
RARE = 5  # up to so many times a word's neighbours are named one by one, two bytes each, which is shorter than their sums
NOBODY = 1 << 15  # in place of a neighbour at the ends of a text

_TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")


def token_key(token: str) -> int:
    """63 bits of the hash of the token in lower case."""
    return xxhash.xxh64_intdigest(token.lower().encode("utf-8", "surrogatepass")) >> 1


class _Keys(dict):
    """The key of a token; of a word in the head its place there, and of others the complement of the key."""

    def __init__(self, head: dict[int, int] | None = None):
        super().__init__()
        self.head = head

    def __missing__(self, token: str) -> int:
        key = token_key(token)
        if self.head is not None:
            key = self.head.get(key, ~key)
        if len(self) < REMEMBERED:
            self[token] = key
        return key


class _Places(dict):
    """Tokens numbered as they come."""

    def __missing__(self, token: str) -> int:
        place = self[token] = len(self)
        return place


def index_vectors(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of every key's index vector: five bits of the key for each entry."""
    bits = np.asarray(keys, np.int64)[:, None] >> (5 * np.arange(NONZERO))
    return np.arange(NONZERO) * STEP + bits % STEP, bits // STEP % 2 * 2 - 1


def word_vectors_of(keys: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """Index vector and context vector, each of length 1, in whole numbers that fit eight bits."""
    at, signs = index_vectors(keys)
    out = contexts / np.maximum(np.linalg.norm(contexts, axis=1, keepdims=True), 1e-9)
    out[np.arange(len(out))[:, None], at] += signs / np.sqrt(NONZERO)
    return np.rint(out * UNIT).astype(np.int64)


# Marks beside the words themselves: a word in capitals, one that repeats its neighbour, and a text without words.
_MARKS = {m: word_vectors_of(np.array([token_key(m)]), np.zeros((1, DIMS)))[0] for m in ("<capitals>", "<again>", "<end>")}


def tokens(text: str | None, known: _Keys) -> tuple[np.ndarray, int, np.ndarray]:
    """Keys of the words of a whole text, the number of its words and marks, and the sum of the marks' vectors."""
    found = _TOKEN.findall(text or "")
    if not found:
        return np.zeros(0, np.int64), 1, _MARKS["<end>"]
    keys = np.fromiter(map(known.__getitem__, found), np.int64, len(found))
    again = int(np.count_nonzero(keys[1:] == keys[:-1]))
    capitals = sum(map(str.isupper, found))
    return keys, len(found) + again + capitals, again * _MARKS["<again>"] + capitals * _MARKS["<capitals>"]


def packed(rows: np.ndarray) -> pa.Array:
    """Each row of whole numbers as bytes: one per number where all fit, else four."""
    small = (np.abs(rows) < 128).all(axis=1)
    ends = np.concatenate([[0], np.cumsum(np.where(small, DIMS, 4 * DIMS))]).astype(np.int32)
    data = np.zeros(int(ends[-1]), np.uint8)
    for chosen, kind in ((small, np.int8), (~small, np.int32)):
        bytes_of = np.ascontiguousarray(rows[chosen].astype(kind)).view(np.uint8)
        data[ends[:-1][chosen][:, None] + np.arange(bytes_of.shape[1])] = bytes_of
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def unpacked(column: pa.Array) -> np.ndarray:
    """The rows of whole numbers; of rare words the sums of the index vectors of the neighbours that are named."""
    values = column.to_pylist()
    out = np.zeros((len(values), DIMS), np.int64)
    sizes = np.fromiter(map(len, values), np.int64, len(values))
    for chosen, kind in ((sizes == DIMS, np.int8), (sizes == 4 * DIMS, np.int32)):
        at = np.flatnonzero(chosen)
        if len(at):
            out[at] = np.frombuffer(b"".join(values[i] for i in at), kind).reshape(-1, DIMS)
    few = np.flatnonzero(sizes < DIMS)
    if len(few):
        others = np.frombuffer(b"".join(values[i] for i in few), np.uint16)
        rows = np.repeat(few, sizes[few] // 2)
        real = others < NOBODY
        at, signs = index_vectors(others[real])
        np.add.at(out, (rows[real, None], at), signs)
    return out


def _contexts(texts: list[np.ndarray], keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """Distinct keys, how often each stands in the texts, and its packed context. The texts hold places in ``keys``, which may repeat a key."""
    keys, place = np.unique(keys, return_inverse=True)
    nobody = len(keys)
    place = np.append(place, nobody).astype(np.int32)
    gap = np.full(REACH, -1, np.int32)
    line = place[np.concatenate([gap, *(part for text in texts for part in (text, gap))])]
    counts = np.bincount(line, minlength=nobody + 1)
    counts[nobody] = RARE + 1
    codes = np.append(keys % NOBODY, NOBODY).astype(np.uint16)
    # Rare words: the neighbours of each place, by word.
    rare = np.flatnonzero(counts[line] <= RARE)
    rare = rare[np.argsort(line[rare], kind="stable")]
    around = codes[line[rare[:, None] + [d for d in range(-REACH, REACH + 1) if d]]]
    words = np.flatnonzero(counts <= RARE)
    ends = np.concatenate([[0], np.cumsum(counts[words] * 4 * REACH)]).astype(np.int32)
    data = np.ascontiguousarray(around).view(np.uint8).ravel()
    yield keys[words], counts[words], pa.Array.from_buffers(pa.binary(), len(words), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    # The others: sums, with a last row for rare words and gaps.
    words = np.flatnonzero(counts[:nobody] > RARE)
    row = np.full(nobody + 1, len(words), np.int64)
    row[words] = np.arange(len(words))
    at, signs = index_vectors(np.append(keys, 0))
    at, signs = at.T.astype(np.int32), signs.T.astype(np.int32)
    signs[:, nobody] = 0
    total = np.zeros((len(words) + 1) * DIMS, np.int32)
    for start in range(0, len(line), CHUNK):
        piece = line[start : start + CHUNK + REACH]
        base = row[piece] * DIMS
        for k in range(NONZERO):
            where, sign = at[k][piece], signs[k][piece]
            for step in range(1, REACH + 1):
                lefts = slice(0, min(CHUNK, len(piece) - step))
                rights = slice(step, lefts.stop + step)
                np.add.at(total, base[lefts] + where[rights], sign[rights])
                np.add.at(total, base[rights] + where[lefts], sign[lefts])
    total = total.reshape(-1, DIMS)
    for start in range(0, len(words), 1 << 15):
        part = words[start : start + (1 << 15)]
        yield keys[part], counts[part], packed(total[start : start + len(part)])


def summed(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Sums of the column ``vec``, and of ``n``, over rows that lie sorted by ``key``, group by group.

    Yields batches of the first rows of groups with their sums. A group may run over any number of batches; of the last one only its first row and its sums
    are kept meanwhile.
    """
    first, sums, counts = None, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        part = np.add.reduceat(unpacked(batch.column("vec")), starts, axis=0)
        number = np.add.reduceat(batch.column("n").to_numpy(zero_copy_only=False), starts)
        rows = batch.take(pa.array(starts))
        if first is not None:
            if first.column(key)[0].as_py() == keys[0]:
                part[0] += sums[0]
                number[0] += counts[0]
                rows = pa.Table.from_batches([first, rows.slice(1)]).combine_chunks().to_batches()[0]
            else:
                yield first, sums, counts
        if len(starts) > 1:
            yield rows.slice(0, len(starts) - 1), part[:-1], number[:-1]
        first, sums, counts = rows.slice(len(starts) - 1), part[-1:], number[-1:]
    if first is not None:
        yield first, sums, counts


def word_vectors(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(token, n, vec)`` of every word of all rows: the key, how often it stands there and its vector. A stored table.

    Tasks add up what they read before anything moves, so a frequent word makes one row per ``TOKENS_AT_ONCE`` tokens.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, pending, size = _Places(), [], 0

        def counted():
            keys = np.fromiter(map(token_key, places), np.int64, len(places))
            for found, counts, sums in _contexts(pending, keys):
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts.astype(np.int64)), sums], names=["token", "n", "vec"])

        for batch in batches:
            for text in batch.column(0):
                found = _TOKEN.findall(text.as_py() or "")
                pending.append(np.fromiter(map(places.__getitem__, found), np.int32, len(found)))
                size += len(found)
                if size >= TOKENS_AT_ONCE:
                    yield from counted()
                    places, pending, size = _Places(), [], 0
        if pending:
            yield from counted()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, sums, counts in summed(batches, "token"):
            keys = rows.column("token").to_numpy()
            columns = [rows.column("token"), pa.array(counts), packed(word_vectors_of(keys, sums))]
            yield pa.RecordBatch.from_arrays(columns, names=["token", "n", "vec"])

    schema = "token long, n long, vec binary"
    parts = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, schema)
    return stored(parts.repartition("token").sortWithinPartitions("token").mapInArrow(add, schema), "quality-words")


def head_count(words: DataFrame, head: int) -> int:
    """The count from which on a word belongs to the head: ``head`` words at most. Found by eighths of octaves, of which there are a few hundred."""
    step = F.floor(F.log2("n") * 8).alias("step")
    steps = words.groupBy(step).agg(F.count("*").alias("words"), F.min("n").alias("least")).orderBy(F.desc("step")).collect()
    least, total = 1 << 62, 0
    for row in steps:
        total += row["words"]
        if total > head:
            break
        least = row["least"]
    return least


def pooled(
    docs: DataFrame, words: DataFrame, id_col: str, held_out: Column, text_col: str = "text", carry: bool = False, head: int = HEAD
) -> tuple[DataFrame, DataFrame | None]:
    """Two stored tables: ``(at, id, held_out, mean)`` with the mean of a row's token vectors, and the rows ``(at, row)`` if asked for, else None.

    ``at`` numbers the rows. Words of the head are added up where the text is read; of the others a row has a list of keys, which are
    joined with the table of words, and their vectors are added to the row's sum.
    """
    spark = docs.sparkSession
    least = head_count(words, head)
    top, rest = words.where(F.col("n") >= least).toArrow(), words.where(F.col("n") < least)
    places = spark.sparkContext.broadcast((top.column("token").to_numpy(), unpacked(top.column("vec")).astype(np.int8)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, vectors = places.value
        known = _Keys({int(k): i for i, k in enumerate(keys)})
        for batch in batches:
            sums, numbers, others = np.zeros((batch.num_rows, DIMS), np.int64), [], []
            for i, text in enumerate(batch.column("text")):
                found, n, marks = tokens(text.as_py(), known)
                inside = found >= 0
                sums[i] = marks
                for start in range(0, len(found), CHUNK):
                    piece = found[start : start + CHUNK]
                    sums[i] += vectors[piece[piece >= 0]].sum(0, dtype=np.int64)
                numbers.append(n)
                others.append(~found[~inside])
            ends = np.concatenate([[0], np.cumsum([len(o) for o in others])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *others])))
            columns = [batch.column("id"), batch.column("held_out"), pa.array(numbers, pa.int64()), packed(sums), lists]
            yield pa.RecordBatch.from_arrays([*columns, *batch.columns[3:]], names=["id", "held_out", "n", "vec", "others", *["row"] * carry])

    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"),
        *[F.struct(*docs.columns).alias("row")] * carry,
    )
    shape = rows.select(
        "id", "held_out", F.lit(0).cast("long").alias("n"), F.lit(b"").alias("vec"), F.array().cast("array<long>").alias("others"), *["row"] * carry
    ).schema
    rows = stored(rows.mapInArrow(read, shape).withColumn("at", F.monotonically_increasing_id()), "quality-rows")
    own = rows.select("at", F.lit(True).alias("own"), "id", "held_out", "n", "vec")
    other = rows.select("at", F.explode("others").alias("token")).join(rest.select("token", "vec"), "token")
    none = [F.lit(None).cast(own.schema[c].dataType).alias(c) for c in ("id", "held_out")]
    both = own.unionByName(other.select("at", F.lit(False).alias("own"), *none, F.lit(0).cast("long").alias("n"), "vec"))

    def divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, sums, numbers in summed(batches, "at"):
            means = (sums / (UNIT * numbers[:, None])).astype(np.float32)
            columns = [first.column(c) for c in ("at", "id", "held_out")] + [pa.array([m.tobytes() for m in means], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["at", "id", "held_out", "mean"])

    schema = own.select("at", "id", "held_out", F.col("vec").alias("mean")).schema
    means = both.repartition("at").sortWithinPartitions("at", F.desc("own")).mapInArrow(divide, schema)
    return stored(means, "quality-means"), rows.select("at", "row") if carry else None


def _matrix(means: list[bytes]) -> np.ndarray:
    return np.array([np.frombuffer(m, np.float32) for m in means], float).reshape(-1, DIMS)


def quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7,
    carry: bool = False, head: int = HEAD,
) -> DataFrame:
    """``(id, held_out, score, predicted)`` per row: the calibrated probability that the label is 1.

    With ``carry`` a last column ``row`` holds all columns of ``docs``, joined by the number that each row got when its text was read.

    Vectors come from all rows; the network from labelled rows outside the held-out fold. Null and empty texts are scored
    as a text of one end mark. Without labels of both kinds every score is the base rate. Rows repeat as they come, equal texts get equal
    scores; an empty table gives no rows.
    """
    spark = docs.sparkSession
    held_out = fold(F.col(id_col), 4) == 2
    means, carried = pooled(docs, word_vectors(docs, text_col), id_col, held_out, text_col, carry, head)
    coded = means.select(F.col("id").alias(id_col), F.hex("mean").alias("mean"))
    fitted = labelled(coded, labels, label, held_out, id_col, "mean").select("id", "y", F.unhex("text").alias("mean")).toPandas()
    fitted = fitted.assign(order=[zlib.crc32(str(i).encode()) for i in fitted["id"]]).sort_values(["order", "id"])
    network = spark.sparkContext.broadcast(Network().fit(_matrix([bytes(m) for m in fitted["mean"]]), fitted["y"].to_numpy(dtype=float)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = network.value.predict(_matrix(batch.column("mean").to_pylist()))
            columns = [batch.column(c) for c in ("at", "id", "held_out")] + [pa.array(p), pa.array((p >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["at", "id", "held_out", "score", "predicted"])

    schema = means.select("at", "id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema
    scored = means.mapInArrow(score, schema)
    return (scored.join(carried, "at") if carry else scored).drop("at")


@query(tested_by="tests/llm/test_learned_operators.py")
def op9_random_indexing(spark, sf_dir):
    found = quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id")
