"""Near-duplicate embeddings by E8 lattice hashing.

Each table projects the unit vectors at random into spaces of eight dimensions and decodes every projection to its nearest
point of the E8 lattice; the points together name the vector's cell. A vector also probes the neighbouring cells that it lies
closest to. What meets in a cell passes a 128-bit sign sketch and is verified by its cosine.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offermart.llm.common import components, stored, table
from offermart.llm.registry import query

COSINE = 0.93
TABLES, BLOCKS, PROBES, SCALE = 6, 2, 24, 0.27  # at a cosine of 0.93 about 5 in 100,000 pairs fail to meet (see the tests)
SKETCH_BITS = 40  # bits of 128 in which a pair may differ; 15 are expected at a cosine of 0.93, 64 of strangers


def lattice_roots() -> np.ndarray:
    """The 240 shortest vectors of E8: the steps from a lattice point to its neighbours."""
    pairs = [
        np.eye(8)[i] * s + np.eye(8)[j] * t for i, j in itertools.combinations(range(8), 2) for s in (1, -1) for t in (1, -1)
    ]
    halves = [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if np.prod(s) > 0]
    return np.array(pairs + halves)


def _even_point(x: np.ndarray) -> np.ndarray:
    """Nearest point with integer coordinates of even sum: round, and where the sum is odd round the worst one the other way."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(1) % 2)
    worst = np.abs(off[odd]).argmax(1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1, -1)
    return near


def nearest_point(x: np.ndarray) -> np.ndarray:
    """Nearest E8 point: the better of the even points and of those moved by one half."""
    whole, moved = _even_point(x), _even_point(x - 0.5) + 0.5
    better = ((x - whole) ** 2).sum(1) <= ((x - moved) ** 2).sum(1)
    return np.where(better[:, None], whole, moved)


class Hasher:
    """Cells and probes for vectors of one length; the same numbers everywhere, by its seed."""

    def __init__(self, dims: int, tables: int, blocks: int, probes: int, scale: float, seed: int = 5):
        rng = np.random.default_rng([seed, dims])
        self.tables, self.blocks, self.probes = tables, blocks, probes
        width = 8 * blocks
        # Orthonormal directions, in the length they have on average for a vector of 64.
        self.planes = [
            np.linalg.qr(rng.normal(size=(max(dims, width), width)))[0][:dims] * np.sqrt(max(dims, width) / 64) / scale
            for _ in range(tables)
        ]
        self.roots = lattice_roots()
        self.mix = rng.integers(1, 1 << 62, size=(tables, width), dtype=np.int64) | 1
        self.sketch_planes = rng.normal(size=(dims, 128))

    def sketches(self, unit: np.ndarray) -> np.ndarray:
        return np.packbits(unit @ self.sketch_planes >= 0, axis=1).view("<i8")

    def cells(self, unit: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the home cell, and of the home cell and ``probes`` others in order of closeness."""
        x = (unit @ self.planes[t]).reshape(len(unit), self.blocks, 8)
        cost, code = np.zeros((len(unit), 1)), np.zeros((len(unit), 1), np.int64)
        with np.errstate(over="ignore"):
            for b in range(self.blocks):
                home = nearest_point(x[:, b])
                mix = self.mix[t, 8 * b : 8 * b + 8]
                # Squared distance to a neighbour, less that to the point itself.
                more = 2 - 2 * ((x[:, b] - home) @ self.roots.T)
                near = np.argpartition(more, self.probes, axis=1)[:, : self.probes]
                here = (2 * home).astype(np.int64) @ mix
                steps = ((2 * self.roots).astype(np.int64) @ mix)[near]
                costs = np.hstack([np.zeros((len(x), 1)), np.take_along_axis(more, near, axis=1)])
                codes = here[:, None] + np.hstack([np.zeros((len(x), 1), np.int64), steps])
                cost = (cost[:, :, None] + costs[:, None, :]).reshape(len(x), -1)
                code = (code[:, :, None] + codes[:, None, :]).reshape(len(x), -1)
                best = np.argsort(cost, axis=1, kind="stable")[:, : self.probes + 1]
                cost, code = np.take_along_axis(cost, best, axis=1), np.take_along_axis(code, best, axis=1)
            code = (code ^ (code >> 31)) * np.int64(0x9E3779B97F4A7C1) + self.mix[t, 0] * (t + 1)
        return code[:, 0], code


def unit_vectors(lists: pa.Array) -> np.ndarray:
    """Rows of equal length as doubles of length one."""
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def links(
    classes: DataFrame, cosine: float = COSINE, tables: int = TABLES, blocks: int = BLOCKS, probes: int = PROBES, scale: float = SCALE
) -> DataFrame:
    """Links ``(a, b)``, a < b, between the distinct vectors ``(cid, kind, v)``: equal kind and a cosine of at least ``cosine``."""

    def hash_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashers: dict[int, Hasher] = {}
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column(2)])
            for dims in np.unique(sizes):
                rows = pa.array(np.flatnonzero(sizes == dims))
                hasher = hashers.setdefault(int(dims), Hasher(int(dims), tables, blocks, probes, scale))
                cid, kind = (batch.column(i).take(rows).to_numpy(zero_copy_only=False) for i in (0, 1))
                unit = unit_vectors(batch.column(2).take(rows))
                sketch = hasher.sketches(unit)
                for t in range(tables):
                    home, probed = hasher.cells(unit, t)
                    times = probed.shape[1]
                    with np.errstate(over="ignore"):
                        cells = (np.concatenate([home[:, None], probed], axis=1) ^ kind[:, None]) * np.int64(0x5851F42D4C957F2D)
                    each = lambda x: pa.array(np.repeat(x, times + 1))
                    asks = np.tile(np.arange(times + 1) > 0, len(cid))
                    data = [pa.array(cells.ravel()), each(cid), pa.array(asks), each(sketch[:, 0]), each(sketch[:, 1])]
                    yield pa.RecordBatch.from_arrays(data, names=["cell", "cid", "asks", "s1", "s2"])

    schema = "cell long, cid long, asks boolean, s1 long, s2 long"
    cells = stored(classes.select("cid", "kind", "v").mapInArrow(hash_, schema), "lattice-cells")
    home, ask = cells.where("NOT asks").alias("h"), cells.where("asks").alias("q")
    alike = F.expr("bit_count(h.s1 ^ q.s1) + bit_count(h.s2 ^ q.s2)") <= SKETCH_BITS
    met = home.join(ask, F.expr("h.cell = q.cell AND h.cid <> q.cid") & alike)
    met = met.select(F.expr("least(h.cid, q.cid)").alias("a"), F.expr("greatest(h.cid, q.cid)").alias("b")).distinct()
    vectors = classes.select("cid", "kind", "v")
    left = vectors.select(F.col("cid").alias("a"), F.col("kind").alias("ka"), F.col("v").alias("va"))
    right = vectors.select(F.col("cid").alias("b"), F.col("kind").alias("kb"), F.col("v").alias("vb"))
    pairs = met.join(left, "a").join(right, "b").where(F.expr("ka = kb AND size(va) = size(vb)")).select("a", "b", "va", "vb")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column(2)])
            good = np.zeros(len(sizes), bool)
            for dims in np.unique(sizes):
                rows = np.flatnonzero(sizes == dims)
                x, y = (unit_vectors(batch.column(i).take(pa.array(rows))) for i in (2, 3))
                good[rows] = np.einsum("ij,ij->i", x, y) >= cosine
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(good)) for i in (0, 1)], names=["a", "b"])

    return pairs.mapInArrow(verify, "a long, b long")


def near_copies(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | None = "label", **options
) -> DataFrame:
    """``(id, n_links, component, kept)`` per row: linked rows, and the smallest id reachable over links.

    Only rows with equal, known labels are compared (all rows if ``label_col`` is None). Vectors that are null, empty, zero or hold a
    null or non-finite number link with nothing, nor do vectors of different lengths. Equal vectors form one
    class: their links are counted, not made. Rows with a null id are linked, but name a component only if it has no other id.
    """
    label = F.lit(0) if label_col is None else F.col(label_col)
    v = F.col(vector_col).cast("array<double>")
    fine = label.isNotNull() & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    fine = F.coalesce(fine & F.exists(v, lambda e: e != 0), F.lit(False))
    rows = embeddings.select(F.col(id_col).alias("id"), label.alias("label"), F.when(fine, v).alias("v"))
    rows = rows.withColumn("k1", F.when(F.col("v").isNotNull(), F.xxhash64("label", "v")))
    rows = rows.withColumn("k2", F.when(F.col("v").isNotNull(), F.xxhash64("v", "label")))
    classes = rows.where("v IS NOT NULL").groupBy("k1", "k2").agg(
        F.any_value("v").alias("v"), F.any_value(F.xxhash64("label", F.size("v"))).alias("kind"),
        F.min("id").alias("least"), F.count("*").alias("n"),
    )
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "lattice-classes")
    found = stored(links(classes, **options), "lattice-links")
    sizes = classes.select(F.col("cid").alias("b"), F.col("n").alias("m"))
    both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counted = both.join(sizes, "b").groupBy(F.col("a").alias("cid")).agg(F.sum("m").alias("m"))
    tied = components(found).withColumnRenamed("node", "cid")
    named = classes.join(tied, "cid", "left").join(counted, "cid", "left").select(
        "k1", "k2", "least", F.coalesce("component", "cid").alias("root"),
        (F.col("n") - 1 + F.coalesce("m", F.lit(0))).alias("n_links"),
    )
    named = named.join(named.groupBy("root").agg(F.min("least").alias("component")), "root")
    out = rows.select("id", "k1", "k2").join(named.select("k1", "k2", "n_links", "component"), ["k1", "k2"], "left")
    return out.select(
        "id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "id").alias("component"),
    ).withColumn("kept", F.col("id").eqNullSafe(F.col("component")))


_OP1_SQL = f"""
WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= {COSINE}),
r(node, seen) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.seen FROM r JOIN l ON l.a = r.node),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT node AS vec_id, coalesce(n_links, 0) AS n_links, component_id, node = component_id AS kept
FROM c LEFT JOIN n ON a = node
"""


@query(_OP1_SQL)
def op1_lattice(spark, sf_dir):
    found = near_copies(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")
