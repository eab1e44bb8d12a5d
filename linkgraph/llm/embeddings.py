"""Embedding near-dedup by a subspace pigeonhole join.

Vectors are normalised and rotated, and the coordinates split into blocks. If two unit vectors have a
cosine of at least c, their squared distance is at most 2 - 2c; as it is the sum of the blocks' squared
distances, some block's is within its budget, a share of the whole in proportion to the block's part of
the variance. So each block is range-joined for itself: along its widest direction the vectors are cut
into slabs at least as wide as the block's radius, a slab meets itself and the next, and the block's
distances decide. A pair belongs to the first block that admits it, and is then verified in double
precision on the unrotated vectors.

Links are counted where they are found and never written out pair by pair: a task returns counts, and of
the links themselves a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkgraph.llm.common import arrow_map, cut
from linkgraph.operators.components import connected_components

BLOCKS = 4
#: Rows of one side of a tile; a slab of more is dealt out in tiles, each two of which meet in a task of their own.
TILE = 8192
#: The rotation, the blocks' parts of the variance and the slabs' bounds are taken from at most so many vectors; no result depends on them.
SAMPLE = 4000
#: Room for the rounding of single precision in the blocks' distances, which only propose.
ROOM = 1e-4


@dataclass
class Plan:
    """rotation: columns by block; cuts: where blocks begin; radius2: budgets; bounds: slab edges of each block's first column."""

    rotation: np.ndarray
    cuts: list[int]
    radius2: np.ndarray
    bounds: list[np.ndarray]


def unit_rows(col: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Which rows can be linked, and these as unit vectors in double precision.

    Null, empty and zero vectors and those with null or non-finite components can't; nor, if dim is given, those of another length.
    """
    lists, ok, out = col.to_pylist() if len({*np.diff(col.offsets.to_numpy())}) > 1 or col.null_count or col.values.null_count else None, np.zeros(len(col), bool), []
    if lists is None:
        off = col.offsets.to_numpy()
        x = col.values.slice(off[0], off[-1] - off[0]).to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1) if off[-1] > off[0] else np.zeros((len(col), 0))
        ok = np.isfinite(x).all(1) & (x != 0).any(1) & (dim is None or x.shape[1] == dim)
        x = x[ok]
    else:
        for k, v in enumerate(lists):
            if v and None not in v and (dim is None or len(v) == dim):
                a = np.array(v, np.float64)
                if np.isfinite(a).all() and a.any():
                    ok[k] = True
                    out.append(a)
        x = np.stack(out) if out and len({len(a) for a in out}) == 1 else np.zeros((0, dim or 0)) if not out else None
        if x is None:
            raise ValueError("vectors of different lengths: give dim")
    if len(x):
        x = x / np.abs(x).max(1, keepdims=True)  # so that squares neither vanish nor overflow
        x = x / np.sqrt((x * x).sum(1, keepdims=True))
    return ok, x


def make_plan(sample: np.ndarray, budget: float, blocks: int, slabs: int) -> Plan:
    dim = sample.shape[1]
    q, _ = np.linalg.qr(np.random.default_rng(11).standard_normal((dim, dim)))
    cuts = [round(k * dim / blocks) for k in range(blocks + 1)]
    y = sample @ q
    bounds, share = [], np.zeros(blocks)
    for k in range(blocks):
        part = y[:, cuts[k] : cuts[k + 1]]
        centred = part - part.mean(0)
        share[k] = max((centred**2).sum() / len(part), 1e-12)
        _, v = np.linalg.eigh(centred.T @ centred)
        q[:, cuts[k] : cuts[k + 1]] = q[:, cuts[k] : cuts[k + 1]] @ v[:, ::-1]  # the widest direction of the block first
    radius2 = budget * share / share.sum()
    y = sample @ q
    for k in range(blocks):
        edges = np.quantile(y[:, cuts[k]], np.linspace(0, 1, slabs + 1)[1:-1])
        wide = []
        for e in edges:
            if not wide or e - wide[-1] >= np.sqrt(radius2[k] + 2 * ROOM):
                wide.append(float(e))
        bounds.append(np.array(wide))
    return Plan(q, cuts, radius2, bounds)


def forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Edges (2, k) with the same components as the links a-b; at most one for each node."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[: len(a)], inv[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        while (new != new[new]).any():
            new = new[new]
        new = new[root]
        if (new == root).all():
            break
        root = new
    moved = root != np.arange(len(nodes))
    return np.stack([nodes[moved], nodes[root[moved]]])


def tile_links(x: np.ndarray, y: np.ndarray, ids: tuple[np.ndarray, np.ndarray], plan: Plan, block: int, least: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (in x, in y) of the links between two tiles that this block is the first to admit."""
    rx, ry = (x @ plan.rotation).astype(np.float32), (y @ plan.rotation).astype(np.float32)

    def within(k: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        d = u[:, plan.cuts[k] : plan.cuts[k + 1]] - v[:, plan.cuts[k] : plan.cuts[k + 1]]
        return (d.astype(np.float64) ** 2).sum(1) <= plan.radius2[k] + ROOM

    p, q = rx[:, plan.cuts[block] : plan.cuts[block + 1]], ry[:, plan.cuts[block] : plan.cuts[block + 1]]
    found_a, found_b = [], []
    # Half the squared distance, less what both lengths add to it, is one product of matrices.
    one, half = np.ones((len(p), 1), np.float32), -0.5 * (q * q).sum(1, keepdims=True)
    left = np.concatenate([p, one, -0.5 * (p * p).sum(1, keepdims=True)], 1)
    right = np.ascontiguousarray(np.concatenate([q, half, np.ones((len(q), 1), np.float32)], 1).T)
    bound = np.float32(-0.5 * (plan.radius2[block] + 2 * ROOM))
    for k in range(0, len(p), 256):
        part = left[k : k + 256]
        near = part @ right >= bound
        if same:
            near &= np.arange(k, k + len(part))[:, None] < np.arange(len(q))[None]
        a, b = np.nonzero(near)
        a += k
        for s in range(0, len(a), 1 << 16):
            u, v = a[s : s + (1 << 16)], b[s : s + (1 << 16)]
            ok = within(block, rx[u], ry[v])
            for earlier in range(block):
                ok &= ~within(earlier, rx[u], ry[v])
            u, v = u[ok], v[ok]
            ok = np.einsum("ij,ij->i", x[u], y[v]) >= least
            found_a.append(u[ok])
            found_b.append(v[ok])
    z = np.zeros(0, np.int64)
    return np.concatenate([z, *found_a]), np.concatenate([z, *found_b])


def links(vectors: DataFrame, least: float, blocks: int = BLOCKS) -> DataFrame:
    """Of vectors (row long, vector array) rows (kind, a, b): 'count' has the number b of links of a found in a task, 'edge' an edge of its spanning forest."""
    spark = vectors.sparkSession
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = vectors.filter(F.col("vector").isNotNull() & finite & F.exists("vector", lambda v: v != 0))  # as unit_rows has it
    found = spark.createDataFrame([], "kind string, a long, b long")
    # A table has as many lengths as models that made it: few.
    for dim, total in usable.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n")).filter("n > 1").orderBy("dim").collect():
        found = found.unionByName(links_of(usable.filter(F.size("vector") == dim), total, dim, least, blocks))
    return found


def links_of(kept: DataFrame, total: int, dim: int, least: float, blocks: int) -> DataFrame:
    """links() for `total` vectors of one length that can all be linked."""
    spark, element = kept.sparkSession, dict(kept.dtypes)["vector"]
    rows = kept.select("vector").orderBy(F.xxhash64("vector")).limit(SAMPLE).toArrow().combine_chunks()["vector"]
    sample = unit_rows(rows.combine_chunks() if isinstance(rows, pa.ChunkedArray) else rows, dim)[1]
    blocks = min(blocks, dim)
    plan = make_plan(sample, 2 - 2 * least, blocks, max(2, total // TILE))
    sent = spark.sparkContext.broadcast(plan)

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        ok, x = unit_rows(batch.column(1), dim)
        own = batch.column(0).filter(pa.array(ok))
        y = x @ sent.value.rotation
        n, out = len(x), []
        for k in range(blocks):
            slab = np.searchsorted(sent.value.bounds[k], y[:, sent.value.cuts[k]], side="right")
            out.append((np.full(n, k), slab))
        rows_of = pa.array(np.tile(np.arange(n), blocks))
        flat = batch.column(1).filter(pa.array(ok))
        return pa.RecordBatch.from_arrays([own.take(rows_of), pa.array(np.concatenate([o[0] for o in out]).astype(np.int32)), pa.array(np.concatenate([o[1] for o in out]).astype(np.int32)), flat.take(rows_of)], names=["row", "block", "slab", "x"])

    placed = arrow_map(kept.select("row", "vector"), place, f"row long, block int, slab int, x {element}")
    per_slab = {(r[0], r[1]): r[2] for r in placed.groupBy("block", "slab").count().collect()}  # few: a slab is at least as wide as the block's radius, and the vectors have length 1
    tiles = F.create_map(*[c for (k, s), n in per_slab.items() for c in (F.lit(k * 1_000_000 + s), F.lit(-(-n // TILE)))]) if per_slab else F.lit(None)
    n_own = tiles[F.col("block") * 1_000_000 + F.col("slab")]
    n_next = F.coalesce(F.try_element_at(tiles, F.col("block") * 1_000_000 + F.col("slab") + 1), F.lit(0))
    n_before = F.coalesce(F.try_element_at(tiles, F.col("block") * 1_000_000 + F.col("slab") - 1), F.lit(0))
    own_tile = F.pmod(F.xxhash64("row"), F.lit(1) * n_own).cast("int")
    # A group is two tiles: of one slab (kind 0, tiles i <= j) or of a slab and the next (kind 1).
    inside = F.transform(F.sequence(F.lit(0), n_own - 1), lambda o: F.struct(F.lit(0).alias("kind"), F.col("slab").alias("at"), F.least("tile", o).alias("i"), F.greatest("tile", o).alias("j"), (F.col("tile") == F.least("tile", o)).alias("left")))
    up = F.when(n_next > 0, F.transform(F.sequence(F.lit(0), n_next - 1), lambda o: F.struct(F.lit(1).alias("kind"), F.col("slab").alias("at"), F.col("tile").alias("i"), o.alias("j"), F.lit(True).alias("left"))))
    down = F.when(n_before > 0, F.transform(F.sequence(F.lit(0), n_before - 1), lambda o: F.struct(F.lit(1).alias("kind"), (F.col("slab") - 1).alias("at"), o.alias("i"), F.col("tile").alias("j"), F.lit(False).alias("left"))))
    dealt = placed.withColumn("tile", own_tile).withColumn("g", F.explode(F.array_compact(F.concat(inside, F.coalesce(up, F.array().cast("array<struct<kind:int,at:int,i:int,j:int,left:boolean>>")), F.coalesce(down, F.array().cast("array<struct<kind:int,at:int,i:int,j:int,left:boolean>>")))))).select("block", "g.*", "row", "x")

    def meet(g: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        row, left = g["row"].to_numpy(), g["left"].to_numpy(zero_copy_only=False)
        x = g["x"].combine_chunks()
        x = unit_rows(x.chunk(0) if isinstance(x, pa.ChunkedArray) else x, dim)[1]
        same = g["kind"][0].as_py() == 0 and g["i"][0].as_py() == g["j"][0].as_py()
        a, b = (np.arange(len(row)),) * 2 if same else (np.flatnonzero(left), np.flatnonzero(~left))
        u, v = tile_links(x[a], x[b], (row[a], row[b]), sent.value, g["block"][0].as_py(), least, same)
        return row[a][u], row[b][v]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(t: pa.Table) -> pa.RecordBatch:
            key = np.stack([t[c].to_numpy() for c in ("block", "kind", "at", "i", "j")])
            edges = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
            found = [meet(t.slice(lo, hi - lo).combine_chunks()) for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), t.num_rows], strict=True)]
            a, b = (np.concatenate(c) for c in zip(*found, strict=True))
            who, n = np.unique(np.concatenate([a, b]), return_counts=True)
            tree = forest(a, b) if len(a) else np.zeros((2, 0), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(["count"] * len(who) + ["edge"] * tree.shape[1], pa.string()), pa.array(np.concatenate([who, tree[0]])), pa.array(np.concatenate([n, tree[1]]))], names=["kind", "a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("block", "kind", "at", "i", "j")]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            if held and any(k[0] != held[-1].column(held[-1].schema.get_field_index(c))[held[-1].num_rows - 1].as_py() for c, k in zip(("block", "kind", "at", "i", "j"), keys, strict=True)):
                yield done(pa.Table.from_batches(held))
                held = []
            if len(change):
                last = int(change[-1])
                yield done(pa.Table.from_batches([*held, batch.slice(0, last)]))
                held = [batch.slice(last)]
            else:
                held.append(batch)
        if held:
            yield done(pa.Table.from_batches(held))

    keys = ["block", "kind", "at", "i", "j"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).select(*keys, "left", "row", "x").mapInArrow(run, "kind string, a long, b long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.9) -> DataFrame:
    """Per row of vectors: its id, n_links (other rows with a cosine of at least `least`), component_id (smallest id reachable) and kept.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and
    vectors only with others of their length. Rows without id link with nothing, have no component and are kept. Rows of one id are
    linked as different vectors are, and each counts.
    """
    found = cut(links(vectors.select(F.col(id_col).cast("long").alias("row"), F.col(vector_col).alias("vector")).filter("row is not null"), least))
    counts = found.filter("kind = 'count'").groupBy("a").agg(F.sum("b").alias("n_links"))
    parts = connected_components(found.filter("kind = 'edge'"), "a", "b")
    return (
        vectors.select(F.col(id_col)).join(counts.withColumnRenamed("a", "_a"), F.col(id_col) == F.col("_a"), "left").join(parts, F.col(id_col) == F.col("node"), "left")
        .select(F.col(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component", F.col(id_col).cast("long")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))
    )
