"""Compression of vectors to codes of whole-number codebooks, learned exactly over Hilbert-sorted blocks.

Vectors become whole numbers and are cut into parts. The parts of each position are sorted along a Hilbert curve, so that
neighbours in the order are close in space, and laid into flat blocks with their box (smallest and largest component), their sum
and their count. A round of learning compares boxes first: an entry whose least distance to a box is above the largest
distance of some other entry can serve no part in it. If one entry is left the whole block is assigned by its sum; otherwise a small
exact kernel evaluates the entries of the shortlist. Only sums per entry leave a task. The blocks are written once and read by
every round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offermart.llm.common import stored, table
from offermart.llm.registry import query

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BLOCK_ROWS = 512
LARGEST = 1 << 27  # of a scaled component: squared distances of 64 components then fit a long


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of each row of whole numbers below ``2**bits``; ``bits`` times the columns is at most 63."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:  # undo the turns of the smaller cubes
        low = q - 1
        for i in range(n):
            turned = (x[i] & q) != 0
            swap = (x[0] ^ x[i]) & low
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            x[i] = np.where(turned, x[i], x[i] ^ swap)
        q >>= 1
    for i in range(1, n):  # Gray decoding
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = top
    while q > 1:
        flip = np.where((x[n - 1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _curve(parts: np.ndarray, most: int) -> np.ndarray:
    """Sort keys of parts whose components lie within ``most`` of zero; of very long parts the first 63 components count."""
    parts = parts[:, :63]
    bits = max(1, min(16, 63 // parts.shape[1]))
    cells = ((parts + most) * ((1 << bits) - 1)) // (2 * most + 1)
    return hilbert_keys(cells, bits)


def shortlist(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Indices of the entries that can be nearest to some point of the box, ascending. Ties keep all that share them."""
    below, above = low - entries, entries - high
    least = (np.maximum(np.maximum(below, above), 0) ** 2).sum(1)
    most = (np.maximum(np.abs(entries - low), np.abs(entries - high)) ** 2).sum(1)
    return np.flatnonzero(least <= most.min())


def nearest(parts: np.ndarray, entries: np.ndarray, listed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of an ascending shortlist, ties to the lower one, and the squared distance; exact."""
    apart = np.stack([((parts - entries[e]) ** 2).sum(1) for e in listed], axis=1)
    best = apart.argmin(1)
    return listed[best], apart[np.arange(len(parts)), best]


def kept_vectors(vectors: DataFrame, parts: int, scale: int, vec_col: str) -> DataFrame:
    """``vectors`` with ``_q``, the scaled whole numbers, where the vector is usable and as long as most.

    Left out are null vectors, those with a null or non-finite component, and those whose length is not a multiple of ``parts`` above 0
    or not the length of most usable ones (of equals the smallest length). The last two cannot be cut or compared alike.
    """
    v = F.col(vec_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    usable = vectors.where(v.isNotNull() & finite & (F.size(v) > 0) & (F.size(v) % parts == 0))
    sizes = usable.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), "n").first()
    q = F.transform(v, lambda x: F.floor(x.cast("double") * float(scale)))
    return usable.where(F.size(v) == (sizes["n"] if sizes else 0)).withColumn("_q", q)


def blocks_of(kept: DataFrame, parts: int, most: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Flat blocks ``(pos, n, low, high, total, flat, rids)`` of the parts of ``kept (rid, _q)``, sorted along the curve per position.

    Dealt out by ranges of (position, key, row), so even a third of all rows with one vector spreads over many tasks.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            q = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), parts, -1)
            for pos in range(parts):
                own = np.ascontiguousarray(q[:, pos])
                flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(own.shape[1] * 8), len(own), [None, pa.py_buffer(own.astype("<i8"))])
                columns = [pa.array(np.full(len(own), pos, np.int32)), pa.array(_curve(own, most)), batch.column(0), flat.cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["pos", "key", "rid", "part"])

    def lay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.DataFrame()
        for batch in batches:
            held = pd.concat([held, batch]) if len(held) else batch
            yield from filled(held[: len(held) // block_rows * block_rows])
            held = held[len(held) // block_rows * block_rows :]
        yield from filled(held)

    def filled(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        out = []
        for at in range(0, len(rows), block_rows):
            for pos, own in rows[at : at + block_rows].groupby("pos"):
                flat = np.frombuffer(b"".join(own["part"]), "<i8").reshape(len(own), -1)
                box = flat.min(0), flat.max(0)
                small = np.dtype("<i2") if max(-box[0].min(), box[1].max()) < 1 << 15 else np.dtype("<i4")
                rids = own["rid"].to_numpy().astype("<i8").tobytes()
                out.append((pos, len(own), box[0], box[1], flat.sum(0), small.itemsize, flat.astype(small).tobytes(), rids))
        if out:
            yield pd.DataFrame(out, columns=["pos", "n", "low", "high", "total", "width", "flat", "rids"])

    rows = kept.select("rid", "_q").mapInArrow(cut, "pos int, key long, rid long, part binary")
    ordered = rows.repartitionByRange("pos", "key", "rid").sortWithinPartitions("pos", "key", "rid")
    schema = "pos int, n int, low array<long>, high array<long>, total array<long>, width int, flat binary, rids binary"
    return ordered.mapInPandas(lay, schema)


def _assigned(block, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
    """Shortlist of a block; and, if more than one entry is left, its parts and the entry of each."""
    listed = shortlist(np.asarray(block.low), np.asarray(block.high), entries)
    if len(listed) == 1:
        return listed, None, None
    parts = _parts(block)
    return listed, parts, nearest(parts, entries, listed)[0]


def _parts(block) -> np.ndarray:
    return np.frombuffer(block.flat, f"<i{block.width}").reshape(block.n, -1).astype(np.int64)


def learn(blocks: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """``books (position, entry, component)`` after ``rounds`` rounds. Tasks send a sum and a count per entry; these few are added here."""
    shape = books.shape
    for _ in range(rounds):
        books_now = books

        def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total, count = np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64)
            for batch in batches:
                for block in batch.itertuples(index=False):
                    listed, parts, chosen = _assigned(block, books_now[block.pos])
                    if chosen is None:
                        total[block.pos, listed[0]] += np.asarray(block.total)
                        count[block.pos, listed[0]] += block.n
                    else:
                        np.add.at(total[block.pos], chosen, parts)
                        count[block.pos] += np.bincount(chosen, minlength=shape[1])
            pos, entry = np.nonzero(count)
            yield pd.DataFrame({"pos": pos, "entry": entry, "n": count[pos, entry], "total": list(total[pos, entry])})

        part = blocks.mapInPandas(sums, "pos int, entry int, n long, total array<long>")
        added = [F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(shape[2])]
        books = books.copy()
        for row in part.groupBy("pos", "entry").agg(F.sum("n").alias("n"), *added).collect():
            books[row["pos"], row["entry"]] = [row[f"s{i}"] // row["n"] for i in range(shape[2])]
    return books


def encode(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """``(rid, code, error)``: the entries of a row's parts as hex digits, two each, and its summed squared distance."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block in batch.itertuples(index=False):
                parts, entries = _parts(block), books[block.pos]
                chosen, apart = nearest(parts, entries, shortlist(np.asarray(block.low), np.asarray(block.high), entries))
                rids = np.frombuffer(block.rids, "<i8")
                yield pd.DataFrame({"rid": rids, "pos": block.pos, "entry": chosen, "apart": apart})

    each = blocks.mapInPandas(run, "rid long, pos int, entry int, apart long")
    digits = [F.lpad(F.lower(F.hex(F.max(F.when(F.col("pos") == p, F.col("entry"))))), 2, "0") for p in range(books.shape[0])]
    return each.groupBy("rid").agg(F.concat(*digits).alias("code"), F.sum("apart").alias("error"))


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components, comma-joined, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """``(id, label, code, error)`` per kept vector, and the codebooks ``(position, entry, component)``.

    The first entries are the parts of the vectors with the smallest ids; null ids come last, equal ids in the order of their
    numbers, and fewer vectors than ``entries`` make smaller codebooks. Repeated rows come back as often as they went in. Other columns
    are ignored. Without a kept vector the result is empty. See ``kept_vectors`` for what is left out. Components of 32,768 and more
    raise an error: their squared distances do not fit a long.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an index has two hex digits: 1 to 256 entries")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("_v"))
    kept = kept_vectors(rows, parts, scale, "_v").drop("_v").withColumn("rid", F.monotonically_increasing_id())
    kept = stored(kept, "vector-numbers")
    size = F.array_max(F.transform("_q", lambda x: F.abs(x)))
    most = kept.agg(F.max(size)).first()[0]
    if most is None:
        return kept.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), np.zeros((parts, 0, 0), np.int64)
    if most >= LARGEST:
        raise ValueError(f"a scaled component of {most} is too large for exact distances in a long")
    first = kept.orderBy(F.col("id").asc_nulls_last(), "_q").limit(entries).select("_q").collect()
    books = np.array([r[0] for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)
    blocks = stored(blocks_of(kept, parts, most), "vector-blocks")
    books = learn(blocks, books, rounds)
    return kept.select("rid", "id", "label").join(encode(blocks, books), "rid").drop("rid"), books


def label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the sum of ``error`` over equal labels, nulls together."""
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def _oracle() -> str:
    book = "SELECT p, e, i, x FROM (SELECT p, i, x, dense_rank() OVER (ORDER BY rid) - 1 AS e FROM part) WHERE e < 16"
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"book{r} AS ({book})" if r == 0 else f"""
            book{r} AS (SELECT b.p, b.e, b.i, coalesce(m.x, b.x) AS x FROM book{r - 1} b LEFT JOIN (
                SELECT a.p, a.e, q.i, (sum(q.x) - ((sum(q.x) % count(*)) + count(*)) % count(*)) // count(*) AS x
                FROM near{r - 1} a JOIN part q ON q.rid = a.rid AND q.p = a.p GROUP BY a.p, a.e, q.i) m USING (p, e, i))""")
        steps.append(f"""
            near{r} AS (SELECT rid, p, min({{'d': d, 'e': e}}).e AS e, min(d) AS d FROM (
                SELECT q.rid, q.p, b.e, sum((q.x - b.x) * (q.x - b.x)) AS d
                FROM part q JOIN book{r} b ON q.p = b.p AND q.i = b.i GROUP BY q.rid, q.p, b.e) GROUP BY rid, p)""")
    last = ROUNDS
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS q
            FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        flat AS (SELECT rid, unnest(q) AS x, generate_subscripts(q, 1) - 1 AS j, len(q) // {PARTS} AS w FROM kept),
        part AS MATERIALIZED (SELECT rid, j // w AS p, j % w AS i, x FROM flat),
        {", ".join(s.replace(" AS (", " AS MATERIALIZED (", 1) for s in steps)},
        coded AS (SELECT rid, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{last} GROUP BY rid)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
            (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, i)) FROM book{last}) AS codebooks_sha256
        FROM kept JOIN coded USING (rid)"""


@query(_oracle())
def op11_vector_codes(spark, sf_dir):
    coded, books = compress(table(spark, sf_dir, "embeddings"))
    return label_errors(coded).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
