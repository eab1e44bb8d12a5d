"""What the operators of this subpackage share: shared storage, Arrow helpers and vectorised hashing of texts.

Texts are handled as UTF-8 bytes in numpy arrays, a slice of about a megabyte at a time, so that a
Python worker holds little whatever the size of its partition.
"""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 19
#: Rows that Spark hands to Python at a time; whole documents make large rows.
ARROW_ROWS = 1000
U64 = np.uint64


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where a session has none it gets one here if it is all in one process, as in tests; on a cluster
    that is an error, as a folder of one machine goes with it.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = f"{tempfile.gettempdir()}/linkgraph-{spark.sparkContext.applicationId}"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder. What is left of it goes when the application ends; operators remove earlier what they no longer read."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p.getParent())
    _left_to_exit(fs, p)
    return path


def _left_to_exit(fs: object, p: object) -> None:
    """deleteOnExit only takes a path that exists."""
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    fs.delete(p, True)


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder; its lineage ends there, so a lost executor costs a read."""
    shared_dir(df.sparkSession)
    out = df.checkpoint()
    release(df.sparkSession)
    return out


def release(spark: SparkSession) -> None:
    """Lets Spark delete shuffle files that nothing refers to any more: it does so only for what the driver's collectors have found dead."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes what was written below path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def saved(df: DataFrame, path: str) -> DataFrame:
    """df, written as Parquet in the shared folder and read again."""
    df.write.parquet(path)
    release(df.sparkSession)
    return df.sparkSession.read.parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_map(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | Iterator[pa.RecordBatch] | None], schema: str) -> DataFrame:
    """mapInArrow over slices of about SLICE_BYTES of text; f gets one slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out = f(part)
                if out is None:
                    continue
                if isinstance(out, pa.RecordBatch):
                    yield out
                else:
                    yield from out
            give_back()

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Returns memory that this worker holds but doesn't use to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def small_batches(spark: SparkSession) -> None:
    """Holds the session to ARROW_ROWS rows a batch, for good: plans read the setting when they run. The README names it as a requirement."""
    if not 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= ARROW_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces whose strings have about limit bytes; a longer text is a piece of its own."""
    n = batch.num_rows
    if not n:
        return
    size = np.zeros(n, np.int64)
    for col in batch.columns:
        if pa.types.is_string(col.type) or pa.types.is_binary(col.type):
            size += pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.cumsum(size)
    start = 0
    while start < n:
        base = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """All rows of batches in pieces whose strings have about limit bytes, across batches; a longer text is a piece of its own."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for part in slices(batch, max(1, limit // 8)):
            own = sum(c.get_total_buffer_size() if pa.types.is_nested(c.type) else c.nbytes for c in part.columns)
            if held and size + own > limit:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
            held.append(part)
            size += own
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the column, one text after the other, and the n + 1 offsets; null is empty."""
    if col.null_count:
        col = pc.fill_null(col, "")
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit."""
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    h = h ^ (h >> U64(29))
    h = h * U64(0x9E3779B97F4A7C15)
    return h ^ (h >> U64(32))


BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0xA0761D6478BD642F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_POW: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    if "p" not in _POW or len(_POW["p"]) < n:
        m = max(n, SLICE_BYTES + 4096)
        base = 0x9FB21C651E98DF25
        for key, b in (("p", base), ("i", pow(base, -1, 1 << 64))):
            a = np.full(m, b, U64)
            a[0] = 1
            _POW[key] = np.multiply.accumulate(a)
    return _POW["p"][:n], _POW["i"][:n]


def prefix_sums(x: np.ndarray) -> np.ndarray:
    """Sums of x[i] * base**i before each place; with range_hash, a hash of any range of symbols."""
    c = np.zeros(len(x) + 1, U64)
    np.cumsum(x * powers(len(x))[0], out=c[1:])
    return c


def range_hash(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the symbols from start to end; equal ranges of random 64-bit symbols have equal hashes."""
    return mix((c[end] - c[start]) * powers(len(c))[1][start] + (end - start).astype(U64))


def word_table(kind: str) -> np.ndarray:
    """Which bytes belong to words: 'plain' is all but ASCII white space, 'alnum' ASCII letters, digits and all beyond ASCII."""
    t = np.ones(256, bool)
    if kind == "plain":
        t[9:14] = t[32] = False
    else:
        t[:128] = False
        t[48:58] = t[65:91] = t[97:123] = True
    return t


def words_of(raw: np.ndarray, off: np.ndarray, kind: str = "plain") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in raw, and the document of each; no word crosses documents."""
    n = len(raw)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = word_table(kind)[raw]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    first = off[:-1]
    before[first[first < n]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    last = off[1:]
    after[last[last > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(off, starts, side="right") - 1


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word's bytes, A-Z lowered if asked."""
    return range_hash(prefix_sums(BYTE[LOWER[raw] if lower else raw]), starts, ends)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Smallest of each w neighbours."""
    span = 1
    while span * 2 <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (w - span)], x[w - span :]) if w > span else x


#: Bits of the filter that tells which rows can have a partner in a join; its size is fixed, whatever the tables'.
FILTER_BITS = 22


class KeyFilter:
    """Which keys (longs, not null) may be among those of a DataFrame, by a bit for each of 2**FILTER_BITS hashes; all its keys go in.

    For joins of long texts with few rows: the texts that have no partner needn't move.
    """

    def __init__(self, partners: DataFrame, key: str) -> None:
        hit = partners.select(self.bucket(key).alias("h")).distinct().toArrow()["h"].to_numpy()
        bits = np.zeros(1 << FILTER_BITS, bool)
        bits[hit] = True
        self.sent = partners.sparkSession.sparkContext.broadcast(np.packbits(bits).tobytes())

    @staticmethod
    def bucket(key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(1 << FILTER_BITS)).cast("int")

    def __getstate__(self) -> dict:
        return {"sent": self.sent}

    def may(self, buckets: pa.Array) -> np.ndarray:
        at = buckets.to_numpy(zero_copy_only=False)
        return (np.frombuffer(self.sent.value, np.uint8)[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)

    def keep(self, df: DataFrame, key: str) -> DataFrame:
        """The rows of df whose key may be there."""

        @F.arrow_udf("boolean")
        def may(h: pa.Array) -> pa.Array:
            return pa.array(self.may(h))

        return df.filter(may(self.bucket(key)))


def doc_key(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id and text as (_id, _text, _key); _key tells rows of one id but different texts apart, and is never null."""
    return df.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).withColumn("_key", F.xxhash64(F.col("_id"), F.col("_text")))
