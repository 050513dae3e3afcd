"""SimHash near-duplicates found with a Gray-ordered hierarchical index.

Two fingerprints that differ in at most ``max_bits`` bits agree on at least one of ``max_bits + 1`` equal segments. For each
segment the fingerprints are rotated so that it leads, and sorted by Gray rank, an order in which neighbours differ in
few bits. Consecutive runs form blocks, and a tree over a block keeps in each node the bits all its members share (mask
and pattern). A search walks down with the differences counted so far and leaves a whole group as soon as they exceed
the bound; a group whose open bits cannot reach the bound is accepted as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offermart.llm.common import components, identity, stored, table
from offermart.llm.registry import query

BLOCK_ROWS = 8192  # fingerprints of one tree
FANOUT = 8
QUERIES_AT_ONCE = 256
SHINGLES_AT_ONCE = 65_536
RANGE_ROWS = 200_000  # rows of one range partition


def text_fingerprint(text: bytes | None, shingle: int) -> int:
    """Majority bits of the XXH64 (seed 42) of all word shingles, repeats included; zero without words."""
    words = (text or b"").lower().split()  # bytes: only A-Z change, only ASCII white space separates
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, SHINGLES_AT_ONCE):
        part = words[at : at + SHINGLES_AT_ONCE + shingle - 1]
        grams = zip(*(part[i:] for i in range(shingle))) if len(words) >= shingle else [part]
        hashes = np.array([digest(b" ".join(g), 42) for g in grams], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, r1, r2, fp)`` per row; ``fp`` holds the 64 bits as a signed long. Rows, ids and texts may repeat or be null."""
    rows = docs.select(F.col(id_col).alias("id"), *identity(id_col, text_col), F.col(text_col).cast("binary").alias("text"))
    schema = rows.select("id", "r1", "r2", F.lit(0).cast("long").alias("fp")).schema

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(3)
            fps = np.array([text_fingerprint(texts[i].as_py(), shingle) for i in range(len(texts))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fps.view(np.int64))], names=["id", "r1", "r2", "fp"])

    return rows.mapInArrow(scan, schema)


def _gray_rank(bits):
    """Position in the Gray sequence (xor of all higher bits), shifted so that signed order is rank order."""
    for shift in (1, 2, 4, 8, 16, 32):
        bits = bits.bitwiseXOR(F.shiftrightunsigned(bits, shift))
    return bits.bitwiseXOR(F.lit(-(1 << 63)))


def _tree(leaves: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level, root first: pattern and mask of the bits shared below each node."""
    low, high = leaves, leaves
    levels = [(low, np.full(len(leaves), ~np.uint64(0)))]
    while len(low) > FANOUT:
        starts = np.arange(0, len(low), FANOUT)
        low, high = np.bitwise_and.reduceat(low, starts), np.bitwise_or.reduceat(high, starts)
        levels.append((low, ~(low ^ high)))
    return levels[::-1]


def _search(queries: np.ndarray, levels, lead: np.uint64, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, leaf) that agree on the leading segment and differ in at most ``bound`` bits.

    For a node accepted as a whole only its first leaf is returned: its leaves are linked among themselves.
    """
    found_q, found_leaf = [], []
    for at in range(0, len(queries), QUERIES_AT_ONCE):
        ids = np.arange(at, min(at + QUERIES_AT_ONCE, len(queries)))
        roots = len(levels[0][0])
        q, node = np.repeat(ids, roots), np.tile(np.arange(roots), len(ids))
        known, spent = np.zeros(len(q), np.uint64), np.zeros(len(q), np.int64)
        for depth, (pattern, mask) in enumerate(levels):
            differ = (queries[q] ^ pattern[node]) & mask[node] & ~known
            spent = spent + np.bitwise_count(differ)
            stay = (spent <= bound) & (differ & lead == 0)
            q, node, spent = q[stay], node[stay], spent[stay]
            whole = (spent + np.bitwise_count(~mask[node]) <= bound) & (~mask[node] & lead == 0)
            found_q.append(q[whole])
            found_leaf.append(node[whole] * FANOUT ** (len(levels) - 1 - depth))
            q, node, spent = q[~whole], node[~whole], spent[~whole]
            if depth + 1 == len(levels):
                break
            known = np.repeat(mask[node], FANOUT)
            q, spent = np.repeat(q, FANOUT), np.repeat(spent, FANOUT)
            node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            real = node < len(levels[depth + 1][0])
            q, node, spent, known = q[real], node[real], spent[real], known[real]
    return np.concatenate(found_q), np.concatenate(found_leaf)


def _group_links(levels, bound: int, lead: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Leaf pairs that tie together every node whose members all lie within the bound of each other."""
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    n = len(levels[-1][0])
    for depth, (_, mask) in enumerate(levels[:-1]):
        span = FANOUT ** (len(levels) - 1 - depth)
        first = np.flatnonzero((np.bitwise_count(~mask) <= bound) & (~mask & lead == 0)) * span
        members = (first[:, None] + np.arange(span)).ravel()
        a.append(np.repeat(first, span)[members < n])
        b.append(members[members < n])
    return np.concatenate(a), np.concatenate(b)


def merge_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joins the sets of ``a`` and ``b``; ``label`` names the smallest position of each set."""
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return label
        a, b = a[open_], b[open_]
        np.minimum.at(label, np.maximum(x, y)[open_], np.minimum(x, y)[open_])
        while (label[label] != label).any():
            label = label[label]


def block_links(left: np.ndarray, right: np.ndarray | None, lead_bits: int, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whatever lies within the bound, inside one block or between two; at most one per member."""
    lead = np.uint64(((1 << lead_bits) - 1) << (64 - lead_bits)) if lead_bits else np.uint64(0)
    indexed = left if right is None else right
    levels = _tree(indexed)
    values = left if right is None else np.concatenate([right, left])
    q, leaf = _search(left, levels, lead, bound)
    label = np.arange(len(values))
    label = merge_labels(label, *_group_links(levels, bound, lead))
    label = merge_labels(label, q + (0 if right is None else len(right)), leaf)
    moved = np.flatnonzero(label != np.arange(len(values)))
    return values[moved], values[label[moved]]


def links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Links ``(a, b)`` between the distinct fingerprints ``fp`` that connect all within ``max_bits`` bits.

    Within a block only a spanning set is returned: a block of mutual near copies costs a row per member, not per pair.
    """
    tables = max_bits + 1
    width = 64 // tables
    total = distinct.count()
    turned = [
        F.col("fp") if t == 0 else F.shiftleft("fp", t * width).bitwiseOR(F.shiftrightunsigned("fp", 64 - t * width))
        for t in range(tables)
    ]
    rows = distinct.select(F.posexplode(F.array(*turned)).alias("t", "bits"))
    rows = rows.select("t", "bits", _gray_rank(F.col("bits")).alias("rank"))
    ranges = max(1, -(-total * tables // RANGE_ROWS))
    ordered = rows.repartitionByRange(ranges, "t", "rank").sortWithinPartitions("t", "rank")

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base, seen = TaskContext.get().partitionId() << 32, {}
        for batch in batches:
            at = batch.groupby("t").cumcount() + batch["t"].map(lambda t: seen.get(t, 0))
            for t, n in batch["t"].value_counts().items():
                seen[t] = seen.get(t, 0) + n
            block = base + batch["t"].astype("int64") * 2**24 + at // BLOCK_ROWS
            yield pd.DataFrame({"block": block, "bits": batch["bits"], "rank": batch["rank"], "t": batch["t"]})

    blocks = stored(ordered.mapInPandas(number, "block long, bits long, rank long, t int"), "simhash-blocks")
    lead = F.shiftright("rank", 64 - width)
    shape = blocks.groupBy("t", "block").agg(
        F.min(lead).alias("first"), F.max(lead).alias("last"),
        F.expr("bit_and(bits)").alias("low"), F.expr("bit_or(bits)").alias("high"),
    )
    shape = stored(shape, "simhash-nodes")
    # Two blocks meet only where a leading segment runs on from one into the other, and only if their shared bits allow it.
    x, y = shape.alias("x"), shape.alias("y")
    apart = F.expr("bit_count((x.low & ~y.high) | (y.low & ~x.high))")
    across = x.join(y, F.expr("x.t = y.t AND x.last = y.first AND x.block < y.block")).where(apart <= max_bits)
    across = across.select(F.col("x.block").alias("i"), F.col("y.block").alias("j"), F.col("x.last").alias("lead"))
    alone = blocks.select(F.col("block").alias("i"), F.col("block").alias("j"), "t", "bits", F.lit(0).alias("side"))
    sides = [
        blocks.join(across, F.col("block") == F.col(end)).where(lead == F.col("lead")).select(
            "i", "j", "t", "bits", F.lit(side).alias("side")
        )
        for side, end in enumerate(("i", "j"))
    ]

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(u=pdf["bits"].to_numpy().view(np.uint64))
        left, right = (np.sort(_ranked(pdf.loc[pdf["side"] == s, "u"].to_numpy())) for s in (0, 1))
        same = pdf["i"].iloc[0] == pdf["j"].iloc[0]
        left, right = _unranked(left), _unranked(right)
        if not same and (len(left) == 0 or len(right) == 0):
            return pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
        a, b = block_links(left, None if same else right, width, max_bits)
        back = np.uint64(int(pdf["t"].iloc[0]) * width)
        a, b = (_turn_back(v, back).view(np.int64) for v in (a, b))
        return pd.DataFrame({"a": a, "b": b})

    pairs = alone.unionByName(sides[0]).unionByName(sides[1])
    return pairs.groupBy("i", "j").applyInPandas(search, "a long, b long")


def _ranked(bits: np.ndarray) -> np.ndarray:
    for shift in (1, 2, 4, 8, 16, 32):
        bits = bits ^ (bits >> np.uint64(shift))
    return bits


def _unranked(rank: np.ndarray) -> np.ndarray:
    return rank ^ (rank >> np.uint64(1))


def _turn_back(bits: np.ndarray, by: np.uint64) -> np.ndarray:
    return bits if by == 0 else (bits >> by) | (bits << (np.uint64(64) - by))


def near_copies(
    docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, r1, r2, fp, component)`` per row: ``component`` is the smallest id reachable over links of at most ``max_bits`` bits.

    Texts without words have fingerprint zero and are linked like any other. A null id gets its group's smallest id; null
    if the group has none. Repeated rows come back as often as they went in. Other columns are ignored. An empty
    table gives an empty result. A near-copy group of any size costs a row per distinct fingerprint and table.
    """
    if not 0 <= max_bits <= 15:
        raise ValueError("max_bits must be 0 to 15: each of max_bits + 1 segments needs some bits")
    printed = stored(fingerprints(docs, shingle, id_col, text_col), "simhash-fingerprints")
    smallest = stored(printed.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    tied = components(links(smallest.select("fp"), max_bits))
    grouped = smallest.join(tied, F.col("fp") == F.col("node"), "left")
    grouped = grouped.select("fp", "least", F.coalesce("component", "fp").alias("root"))
    named = grouped.join(grouped.groupBy("root").agg(F.min("least").alias("component")), "root")
    return printed.join(named.select("fp", "root", "component"), "fp").select("id", "r1", "r2", "fp", "root", "component")


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one row of each group of near copies: the smallest id, of equal ids the smallest hash.

    Rows without id come last; of rows that are equal in id and text one stays.
    """
    found = near_copies(docs, shingle, max_bits, id_col, text_col)
    best = F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "r1", "r2")).alias("best")
    chosen = found.groupBy("root").agg(best).select("best.r1", "best.r2")
    r1, r2 = identity(id_col, text_col)
    named = docs.withColumns({"_r1": r1, "_r2": r2}).join(
        chosen.select(F.col("r1").alias("_r1"), F.col("r2").alias("_r2")), ["_r1", "_r2"], "left_semi"
    )
    return named.dropDuplicates(["_r1", "_r2"]).select(*docs.columns)


@query(tested_by="tests/llm/test_text_operators.py")
def op2_simhash(spark, sf_dir):
    found = near_copies(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), F.col("component").alias("component_id"))
