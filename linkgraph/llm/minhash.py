"""MinHash near-dedup by an inverted join of signature coordinates.

Documents of one shingle set are one class, and only its smallest document goes on. Each is posted under
its signature's coordinate-value pairs; of these a prefix is enough, as two documents that agree on m of
K coordinates share one of any K - m + 1 of them, and the rarest are taken, frequent values last. Two
merges of the posting lists follow:

- each list's members are held against its smallest; the best match of each document is confirmed on full
  sets, and confirmed links give first components;
- lists whose members are in one component are skipped; in the others the collisions of pairs of different
  components are counted, list blocks of bounded size against one another, each pair in the first list
  that it shares, and those above the match threshold confirmed likewise. Pairs don't leave their task:
  members with a match go on to a second one with their texts, which gives the links that join components.

So every pair that agrees on enough coordinates is confirmed or already joined, and no list's pairs are
written out. A link of similarity t is missed only if its coordinates fall short by SLACK standard deviations.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkgraph.llm.common import U64, KeyFilter, arrow_map, doc_key, fresh, give_back, mix, prefix_sums, range_hash, saved, scratch, slices, small_batches, text_bytes, word_hashes, words_of
from linkgraph.operators.components import connected_components

POSTED = 40
#: All coordinates that are compared; those that aren't posted are kept as eight bits, which can only add agreements.
COORDINATES = 200
SLACK = 5.2
#: Members of a list that are held against as many others at a time.
BLOCK = 1024
#: A token is frequent if more than this part of all tokens are equal to it; so no more than its inverse are.
FREQUENT = 1e-5
_A = mix(np.arange(1, COORDINATES + 1, dtype=U64)) | U64(1)
_C = mix(np.arange(1001, COORDINATES + 1001, dtype=U64))


@dataclass(frozen=True)
class Likeness:
    """Shingles of `words` words; documents are alike from `percent` per cent of intersection by union on."""

    words: int = 5
    percent: int = 80

    def least(self, coordinates: int) -> int:
        """Coordinates on which a pair that is just alike agrees, all but never fewer."""
        t = self.percent / 100
        return max(1, math.floor(coordinates * t - SLACK * math.sqrt(coordinates * t * (1 - t))))

    @property
    def prefix(self) -> int:
        return POSTED - self.least(POSTED) + 1


def shingles(col: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each different shingle, by row; a text of fewer words is one shingle, one without words none."""
    raw, off = text_bytes(col)
    starts, ends, doc = words_of(raw, off)
    c = prefix_sums(word_hashes(raw, starts, ends, lower=True))
    n = np.bincount(doc, minlength=len(col))
    at = np.arange(len(doc))
    past = np.cumsum(n)[doc] if len(doc) else at
    full = at + words <= past
    short = np.flatnonzero((n > 0) & (n < words))
    first = (np.cumsum(n) - n)[short]
    rows = np.concatenate([doc[full], short])
    hashes = np.concatenate([range_hash(c, at[full], at[full] + words), range_hash(c, first, first + n[short])])
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def signatures(docs: DataFrame, like: Likeness) -> DataFrame:
    """Per row of docs (_id, _key, _text): _id, _key, n (shingles), d1 and d2 (128 bits of its set), sig (POSTED numbers of 32 bits, then the rest of 8)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, h = shingles(batch.column(2), like.words)
        n = np.bincount(rows, minlength=batch.num_rows)
        some = np.flatnonzero(n)
        first = (np.cumsum(n) - n)[some]
        sums, sig = np.zeros((2, batch.num_rows), U64), np.zeros((batch.num_rows, COORDINATES), np.uint32)
        if len(some):
            for k in range(2):
                sums[k, some] = np.add.reduceat(mix(h ^ U64(0x1234567 + k)), first)
            for k in range(COORDINATES):
                sig[some, k] = np.minimum.reduceat((h ^ _C[k]) * _A[k] >> U64(32), first)
        both = np.concatenate([sig[:, :POSTED].view(np.uint8), (sig[:, POSTED:] & np.uint32(255)).astype(np.uint8)], 1)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), *(pa.array(s.view(np.int64)) for s in sums), pa.array([r.tobytes() for r in both], pa.binary())], names=["_id", "_key", "n", "d1", "d2", "sig"])

    return arrow_map(docs.select("_id", "_key", "_text"), run, f"_id {dict(docs.dtypes)['_id']}, _key long, n long, d1 long, d2 long, sig binary")


WIDTH = 4 * POSTED + COORDINATES - POSTED


def matrix(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The posted coordinates, and the others."""
    raw, _ = text_bytes(col)
    rows = raw.reshape(len(col), WIDTH)
    return np.ascontiguousarray(rows[:, : 4 * POSTED]).view(np.uint32), np.ascontiguousarray(rows[:, 4 * POSTED :])


def tokens(posted: np.ndarray) -> np.ndarray:
    return mix((posted.astype(U64) << U64(8)) | np.arange(POSTED, dtype=U64))


def are_late(t: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Which tokens are among the frequent ones (sorted)."""
    return hot[np.minimum(np.searchsorted(hot, t), len(hot) - 1)] == t if len(hot) else np.zeros(t.shape, bool)


def frequent(reps: DataFrame) -> np.ndarray:
    """Tokens of more than FREQUENT of all, so 1 / FREQUENT of them at most."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        t, n = np.unique(tokens(matrix(batch.column(0))[0]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.array(n)], names=["token", "n"])

    total = reps.count() * POSTED
    got = arrow_map(reps.select("sig"), run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).filter(F.col("n") > max(32, FREQUENT * total)).select("token").toArrow()
    return np.sort(got["token"].to_numpy().astype(np.int64).view(U64))


def postings(reps: DataFrame, hot: Broadcast[np.ndarray], like: Likeness) -> DataFrame:
    """(token, rep) under the prefix of each document's tokens, frequent ones last."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        t = tokens(matrix(batch.column(1))[0])
        order = np.lexsort((t, are_late(t, hot.value)), axis=1)[:, : like.prefix]
        t = np.take_along_axis(t, order, 1)
        return pa.RecordBatch.from_arrays([pa.array(t.ravel().view(np.int64)), batch.column(0).take(pa.array(np.repeat(np.arange(len(t)), t.shape[1])))], names=["token", "rep"])

    return arrow_map(reps.select("rep", "sig"), run, f"token long, rep {dict(reps.dtypes)['rep']}")


def agreeing(pairs: DataFrame, like: Likeness) -> DataFrame:
    """(a, b, same) of the pairs (a, b, sig_a, sig_b, n_a, n_b) that agree on enough coordinates and are of sizes that can be alike."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, y = matrix(batch.column(2)), matrix(batch.column(3))
        na, nb = batch.column(4).to_numpy(), batch.column(5).to_numpy()
        same = (x[0] == y[0]).sum(1) + (x[1] == y[1]).sum(1)
        keep = pa.array((same >= like.least(COORDINATES)) & (100 * np.minimum(na, nb) >= like.percent * np.maximum(na, nb)))
        return pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep), pa.array(same).filter(keep)], names=["a", "b", "same"])

    return arrow_map(pairs.select("a", "b", "sig_a", "sig_b", "n_a", "n_b"), run, f"a {dict(pairs.dtypes)['a']}, b {dict(pairs.dtypes)['a']}, same long")


def by_group(batches: Iterator[pa.RecordBatch], keys: list[str], done: Callable[[pa.Table], pa.RecordBatch | None]) -> Iterator[pa.RecordBatch]:
    """Gives done the rows of sorted batches, whole groups of equal keys (longs or ints) at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)).to_numpy() for k in keys]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
        if held and any(c[0] != held[-1].column(held[-1].schema.get_field_index(k))[held[-1].num_rows - 1].as_py() for k, c in zip(keys, cols, strict=True)):
            if (out := done(pa.Table.from_batches(held))) is not None:
                yield out
            held = []
        if len(change):
            last = int(change[-1])
            if (out := done(pa.Table.from_batches([*held, batch.slice(0, last)]))) is not None:
                yield out
            held = [batch.slice(last)]
            give_back()
        else:
            held.append(batch)
    if held and (out := done(pa.Table.from_batches(held))) is not None:
        yield out


def confirm(pairs: DataFrame, texts: Callable[[DataFrame], DataFrame], like: Likeness) -> DataFrame:
    """The pairs (tile, a, b) whose full sets are alike, as (a, b).

    texts gives (rep, _text) of the documents asked for; a document's text goes once to each tile that
    names it. Tiles must be of bounded size.
    """
    needs = pairs.select("tile", F.explode(F.array("a", "b")).alias("rep")).distinct()
    kind = dict(pairs.dtypes)["a"]
    sides = needs.join(texts(needs.select("rep").distinct()), "rep").select("tile", F.lit(0).alias("part"), F.col("rep").alias("a"), F.lit(None).cast(kind).alias("b"), "_text").unionByName(pairs.select("tile", F.lit(1).alias("part"), "a", "b", F.lit(None).cast("string").alias("_text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sets = None, {}
        for whole in batches:
            for batch in slices(whole):
                tile, part, a, b = (batch.column(k).to_pylist() for k in range(4))
                rows, h = shingles(batch.column(4), like.words)
                own = np.split(h, np.searchsorted(rows, np.arange(1, len(tile))))
                out = []
                for k, t in enumerate(tile):
                    if t != now:
                        now, sets = t, {}
                    if part[k] == 0:
                        sets[a[k]] = own[k]
                    else:
                        x, y = sets[a[k]], sets[b[k]]
                        both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                        if 100 * both >= like.percent * (len(x) + len(y) - both):
                            out.append(k)
                at = pa.array(out, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(2).take(at), batch.column(3).take(at)], names=["a", "b"])

    small_batches(pairs.sparkSession)
    return sides.repartition("tile").sortWithinPartitions("tile", "part").mapInArrow(run, f"a {kind}, b {kind}")


def agreeing_in(t: pa.Table, hot: np.ndarray, like: Likeness) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Agreeing pairs (as rows of t) of different components within the groups of a table sorted by token, i, j; and where its groups begin and end.

    A pair counts only in the group of the first token that its members share, in the order of postings.
    """
    token, i, j, own, n = (t[c].to_numpy() for c in ("token", "i", "j", "_own", "n"))
    comp = np.unique(t["comp"].to_numpy(zero_copy_only=False), return_inverse=True)[1]
    x = matrix(t["sig"].chunk(0))
    edges = np.flatnonzero((token[1:] != token[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
    starts, ends = np.concatenate([[0], edges]), np.append(edges, len(token))
    group = np.repeat(np.arange(len(starts)), ends - starts)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    least = like.least(COORDINATES)

    def test(u: np.ndarray, v: np.ndarray) -> None:
        keep = (comp[u] != comp[v]) & (100 * np.minimum(n[u], n[v]) >= like.percent * np.maximum(n[u], n[v]))
        u, v = u[keep], v[keep]
        for q in range(0, len(u), 1 << 15):
            a, b = u[q : q + (1 << 15)], v[q : q + (1 << 15)]
            ok = (x[0][a] == x[0][b]).sum(1) + (x[1][a] == x[1][b]).sum(1) >= least
            a, b = a[ok], b[ok]
            if len(a):
                shared, agreed = tokens(x[0][a]), x[0][a] == x[0][b]
                late = are_late(shared, hot)
                rank = np.where(agreed & ~late, shared >> U64(1), np.where(agreed, (shared >> U64(1)) | U64(1 << 63), U64(2**64 - 1)))
                first = np.take_along_axis(shared, rank.argmin(1)[:, None], 1)[:, 0].view(np.int64)
                here = first == token[a]
                found.append((a[here], b[here]))

    small = (ends - starts <= 64)[group]
    for d in range(1, min(64, int((ends - starts).max(initial=0)))):
        u = np.flatnonzero(small[:-d] & (group[:-d] == group[d:])) if d < len(group) else np.zeros(0, np.int64)
        if len(u):
            test(u, u + d)
    for g in np.flatnonzero(ends - starts > 64):
        at = np.arange(starts[g], ends[g])
        left, right = at[own[at] == i[at[0]]], at[own[at] == j[at[0]]]
        same = i[at[0]] == j[at[0]]
        for k in range(0, len(left), 64):
            u, v = np.repeat(left[k : k + 64], len(right)), np.tile(right, len(left[k : k + 64]))
            test(*((u[u < v], v[u < v]) if same else (u, v)))
    u, v = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
    return u, v, starts, ends


def across(lists: DataFrame, hot: Broadcast[np.ndarray], like: Likeness) -> DataFrame:
    """Of lists (token, size, rep, comp, n, sig) the members that agree with one of another component, by group (token, i, j, _own, rep, comp).

    A list of more than BLOCK members is dealt out in blocks by rep, and each two blocks meet in a group of their own.
    """
    kind = dict(lists.dtypes)["rep"]
    blocks = lists.withColumn("_of", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn("_own", F.pmod(F.xxhash64("rep"), F.col("_of")).cast("int"))
    dealt = blocks.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_of") - 1))).select("token", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), "_own", "rep", "comp", "n", "sig")

    def done(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        u, v, _, _ = agreeing_in(t, hot.value, like)
        return t.select(["token", "i", "j", "_own", "rep", "comp"]).take(pa.array(np.unique(np.concatenate([u, v])))).combine_chunks().to_batches(max_chunksize=1 << 30)[0] if len(u) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from by_group(batches, ["token", "i", "j"], done)

    small_batches(lists.sparkSession)
    return dealt.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j").mapInArrow(run, f"token long, i int, j int, _own int, rep {kind}, comp {kind}")


def confirm_within(groups: DataFrame, hot: Broadcast[np.ndarray], like: Likeness) -> DataFrame:
    """Edges (a, b) that join what confirmed links join: of groups (token, i, j, _own, rep, comp, n, sig, _text), whose agreeing pairs are held together on full sets.

    Pairs of components that a link of the group has joined already are passed over, so at most one edge for each member comes out.
    """
    kind = dict(groups.dtypes)["rep"]

    def done(t: pa.Table) -> pa.RecordBatch | None:
        t = t.combine_chunks()
        u, v, starts, ends = agreeing_in(t, hot.value, like)
        if not len(u):
            return None
        group = np.searchsorted(ends, u, side="right")
        comp, out = t["comp"].to_numpy(zero_copy_only=False), []
        for g in np.unique(group):
            lo, hi = starts[g], ends[g]
            rows, h = shingles(t["_text"].chunk(0).slice(lo, hi - lo), like.words)
            codes = np.unique(h, return_inverse=True)[1]
            off = np.searchsorted(rows, np.arange(hi - lo + 1))
            by_code = np.argsort(codes, kind="stable")
            holders, at = rows[by_code], np.searchsorted(codes[by_code], np.arange(codes.max(initial=-1) + 2))
            root: dict = {}

            def top(c: object, root: dict = root) -> object:
                while (up := root.get(c, c)) != c:
                    root[c] = c = root.get(up, up)
                return c

            own = group == g
            order = np.argsort(u[own], kind="stable")
            a, b = u[own][order] - lo, v[own][order] - lo
            cuts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
            for s, e in zip(cuts, [*cuts[1:], len(a)], strict=True):
                x, ys = int(a[s]), b[s:e]
                mine = codes[off[x] : off[x + 1]]
                n = at[mine + 1] - at[mine]
                who = holders[np.repeat(at[mine], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
                both = np.bincount(who, minlength=hi - lo)[ys]
                total = len(mine) + off[ys + 1] - off[ys] - both
                for y in ys[100 * both >= like.percent * total]:
                    p, q = top(comp[lo + x]), top(comp[lo + y])
                    if p != q:
                        root[q] = p
                        out.append((lo + x, lo + int(y)))
        one, two = (t["rep"].chunk(0).take(pa.array([o[k] for o in out], pa.int64())) for k in range(2))
        return pa.RecordBatch.from_arrays([one, two], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from by_group(batches, ["token", "i", "j"], done)

    small_batches(groups.sparkSession)
    return groups.select("token", "i", "j", "_own", "rep", "comp", "n", "sig", "_text").repartition("token", "i", "j").sortWithinPartitions("token", "i", "j").mapInArrow(run, f"a {kind}, b {kind}")


def classes(rows: DataFrame, like: Likeness, node: str = "_id") -> DataFrame:
    """_id, _key, n and component of each of rows (_id, _key, _text); documents without shingles or node are components of their own.

    node is the column that tells documents apart and of which a component is the smallest: _id or _key.
    """
    spark = rows.sparkSession

    def keep(df: DataFrame, name: str) -> DataFrame:
        return saved(df, scratch(spark, f"minhash-{name}"))

    sigs = keep(signatures(rows, like), "signatures")
    usable = sigs.filter(f"n > 0 and {node} is not null")
    chosen = usable.groupBy("d1", "d2").agg(F.min(node).alias("rep"))
    reps = keep(usable.join(chosen, ["d1", "d2"]).filter(f"{node} = rep").dropDuplicates(["d1", "d2"]).select("d1", "d2", "rep", "_key", "n", "sig"), "classes")
    hot = spark.sparkContext.broadcast(frequent(reps))
    posted = postings(reps, hot, like)
    sizes = posted.groupBy("token").agg(F.count("*").alias("size"), F.min("rep").alias("pivot")).filter("size > 1")
    lists = keep(posted.join(sizes, "token"), "lists")
    slim = reps.select("rep", "n", "sig")

    def texts(asked: DataFrame) -> DataFrame:
        named = asked.join(reps.select("rep", "_key"), "rep")
        return KeyFilter(named, "_key").keep(rows, "_key").join(named.withColumnRenamed("_key", "_k"), (F.col("_key") == F.col("_k")) & (F.col(node) == F.col("rep"))).dropDuplicates(["rep"]).select("rep", "_text")

    star = lists.filter("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    star = star.join(slim.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("sig").alias("sig_b")), "b").join(slim.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("sig").alias("sig_a")), "a")
    best = keep(agreeing(star, like), "star")
    top = best.groupBy("b").agg(F.max("same").alias("same"))
    best = best.join(top, ["b", "same"]).groupBy("b").agg(F.min("a").alias("a"))
    load = best.groupBy("a").agg(F.count("*").alias("k"))
    tiled = keep(best.join(load, "a").select(F.xxhash64("a", F.pmod(F.xxhash64("b"), F.ceil(F.col("k") / BLOCK))).alias("tile"), "a", "b"), "star-tiles")
    links = keep(confirm(tiled, texts, like), "star-links")
    first = connected_components(links, "a", "b")
    labelled = lists.select("token", "rep").join(first.select(F.col("node").alias("rep"), "component"), "rep", "left").select("token", "rep", F.coalesce("component", "rep").alias("comp"))
    open_lists = labelled.groupBy("token").agg(F.count("*").alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("token", "size")
    more = keep(across(labelled.join(open_lists, "token").join(slim, "rep"), hot, like), "members")
    held = more.join(slim, "rep").join(texts(more.select("rep").distinct()), "rep")
    links = links.unionByName(keep(confirm_within(held, hot, like), "links"))
    found = connected_components(links, "a", "b")
    named = reps.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(F.col("d1").alias("_d1"), F.col("d2").alias("_d2"), F.coalesce("component", "rep").alias("component"))
    return sigs.join(named, (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2")) & (F.col("n") > 0) & F.col(node).isNotNull(), "left").select("_id", "_key", "n", F.coalesce("component", node).alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", like: Likeness = Likeness()) -> DataFrame:  # noqa: B008
    """Per row of docs: its id, n_shingles, component_id (smallest id reachable by links, itself included) and kept (it is that one).

    Words are `[^\\x20\\x09-\\x0D]+`, A-Z lowered. Null and empty texts have no shingles and no links,
    nor have rows without id (component_id null, kept). Rows of one id and text are alike.
    """
    out = classes(doc_key(docs, id_col, text_col), like)
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.coalesce(F.col("_id") == F.col("component"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", like: Likeness = Likeness()) -> DataFrame:  # noqa: B008
    """docs with one row of each group that links join, over any number of links; all columns stay.

    The row of smallest id stays, of equal ids that of the smallest hash of id and text; rows without id
    come last. Rows are told apart by id and text (64 bits of them), so rows of one id and different
    texts are documents of their own. Of rows equal in both one stays, that of the smallest hash of all
    columns. Rows without words are linked with nothing and all stay.
    """
    key = fresh(docs, "_row")
    rows = doc_key(docs, id_col, text_col)
    found = saved(classes(rows, like, "_key"), scratch(docs.sparkSession, "minhash-classes")).filter("n > 0")
    order = F.struct(F.col("_id").isNull().alias("late"), F.col("_id"), F.col("_key"))
    chosen = found.groupBy("component").agg(F.min(order).alias("c"), F.count("*").alias("k")).filter("k > 1").select("component", F.col("c._key").alias("stays"))
    chosen = saved(chosen, scratch(docs.sparkSession, "minhash-chosen"))  # apart from the join, so that a large group can be split there
    drop = found.join(chosen, "component").filter("_key <> stays").select(F.col("_key").alias(key)).distinct()
    out = docs.withColumn(key, F.xxhash64(F.col(id_col), F.col(text_col).cast("string")))
    out = out.join(drop, key, "left_anti")
    again = found.groupBy("_key").agg(F.count("*").alias("k")).filter("k > 1").select(F.col("_key").alias(key))
    if not again.isEmpty():
        place = fresh(docs, "_place")
        several = out.join(again, key, "left_semi").withColumn(place, F.row_number().over(Window.partitionBy(key).orderBy(F.xxhash64(*docs.columns)))).filter(F.col(place) == 1).drop(place)
        out = out.join(again, key, "left_anti").unionByName(several)
    return out.drop(key).select(*docs.columns)
