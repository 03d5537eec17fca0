"""Helpers shared by the training-data operators of this subpackage.

Nothing here keeps state on the driver: intermediate tables are written as
parquet below the folder the session names in ``spark.checkpoint.dir`` (shared
by driver and executors), so a lost executor never takes lineage with it.
"""
from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: rows of a batch that Python gets while an intermediate table is written
BATCH_ROWS = 2000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    """The text column with NULL read as the empty string."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a scratch folder only for a local master."""
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        return jdir.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="tessera-llm-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Arrow batches of few rows while a table is written: rows here are whole
    texts and sets, and a batch is held twice, in the JVM and in Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), rows)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the table written here is complete, not at some later garbage collection."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def drop(table: DataFrame) -> None:
    """Delete the files of a table that ``cut`` wrote and nothing reads any more."""
    spark = table.sparkSession
    files = table.inputFiles()
    if files:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here.

    The table is removed when the application ends.  ``codec``: a parquet
    compression other than the session's.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"
    with small_batches(spark):
        df.write.parquet(path, compression=codec)
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return freed memory to the system when a task ends: the Python worker
    lives on for the next task, maybe another operator's, beside the executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow form of a DDL schema (made on the driver, shipped with a closure)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def map_batches(df: DataFrame, ddl: str, make: Callable[[], Callable]) -> DataFrame:
    """Arrow batches through a function that ``make`` builds once a task.

    The function gets a record batch and returns a dict of columns (lists or
    Arrow arrays) by the names of ``ddl``, or ``None`` for no rows.  If it has
    an attribute ``finish``, that is called when the task ends.
    """
    schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        try:
            for batch in batches:
                out = fn(batch) if batch.num_rows else None
                if out is not None:
                    yield as_batch(out, schema)
        finally:
            getattr(fn, "finish", int)()
            del fn
            give_back()

    return df.mapInArrow(run, ddl)


def as_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [columns[f.name].cast(f.type) if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type)
         for f in schema], schema=schema)


def one(col) -> pa.Array:
    """A record batch column as one Arrow array (chunks joined)."""
    return col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col


# ---------------------------------------------------------------- word hashes
_U = np.uint64
MIX1, MIX2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)  # fixed values: splitmix64
_BASE = 0x9E3779B97F4A7C15 | 1


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """splitmix64 finaliser over a uint64 array."""
    x = x + _U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x ^= x >> _U(30)
    x *= MIX1
    x ^= x >> _U(27)
    x *= MIX2
    x ^= x >> _U(31)
    return x


_POW: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^i and B^-i modulo 2^64 for i < n."""
    have = _POW.get("p")
    if have is None or len(have) < n:
        m = 1 << max(16, (n - 1).bit_length())
        p, q = np.full(m, _BASE, _U), np.full(m, pow(_BASE, -1, 2**64), _U)
        p[0] = q[0] = 1
        with np.errstate(over="ignore"):
            _POW["p"], _POW["q"] = np.multiply.accumulate(p), np.multiply.accumulate(q)
    return _POW["p"][:n], _POW["q"][:n]


#: byte values spread over 64 bits, so that sums of few bytes don't collide
_BYTE = mix64(np.arange(1, 257, dtype=_U), 7)
#: A-Z to a-z; and which bytes are word separators (space and \t..\r)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array (no nulls) as one array, and the offsets."""
    texts = one(texts)
    if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type):
        width = np.int64
    else:
        width = np.int32
    offsets = np.frombuffer(texts.buffers()[1], width)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def words_of(raw: np.ndarray, offsets: np.ndarray, lower: bool = True
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of concatenated texts, without a Python loop.

    Returns the 64-bit hash, start and end byte of every word, and for each
    text the index of its first word (one entry more than texts).  A-Z are
    lower-cased when ``lower``.
    """
    n = len(raw)
    word = ~_SPACE[raw]
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    edges = offsets[:-1][offsets[:-1] < n]  # a text's first byte starts a word of its own
    begin[edges] = word[edges]
    stop = np.zeros(n + 1, bool)
    stop[1:] = word
    stop[1:n] &= ~word[1:] | begin[1:]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop)
    p, q = powers(n + 1)
    acc = np.zeros(n + 1, _U)
    np.cumsum(_BYTE[_LOWER[raw] if lower else raw] * p[:n], out=acc[1:])
    hashes = mix64((acc[end] - acc[start]) * q[start])
    return hashes, start, end, np.searchsorted(start, offsets)


def shingles_of(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``size`` words within each text, and where texts begin.

    A text with fewer words (but at least one) has one shingle: all of them.
    """
    count = np.diff(first)
    made = np.where(count >= size, count - size + 1, (count > 0).astype(np.int64))
    begin = np.concatenate(([0], np.cumsum(made)))
    at = np.arange(begin[-1]) - np.repeat(begin[:-1], made) + np.repeat(first[:-1], made)
    have = np.minimum(np.repeat(count, made), size)
    out = np.zeros(len(at), _U)
    padded = np.concatenate((hashes, np.zeros(size, _U)))
    for j in range(size):
        out = mix64(out ^ np.where(j < have, padded[at + j], _U(j + 1)), j + 1) if size > 1 else padded[at]
    return out, begin


#: bytes of text that numpy code looks at together; whole texts, so at least one
SLICE_BYTES = 1_000_000


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """Consecutive slices of a string array of about ``size`` bytes each."""
    texts = one(texts)
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    at = np.frombuffer(texts.buffers()[1], width)[texts.offset:texts.offset + len(texts) + 1]
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(at, at[low] + size, "right")) - 1)
        yield texts.slice(low, high - low)
        low = high


def add_parts(parts: DataFrame, blocks: int) -> np.ndarray:
    """Sum float64 arrays handed in by tasks as (block, bucket, part).

    Parts meet within (block, bucket) and then within the block, so that no
    task sees more than one part a bucket at the end; only the finished sums,
    of a size the caller fixes, reach the driver.
    """
    ddl = "block int, bucket int, part binary"

    def add(pdf):
        total = np.zeros(len(pdf["part"].iloc[0]) // 8)
        for p in pdf["part"]:
            total += np.frombuffer(p)
        out = pdf.iloc[:1].copy()
        out["part"] = [total.tobytes()]
        del pdf, total
        give_back()
        return out

    sums = parts.groupBy("block", "bucket").applyInPandas(add, ddl).groupBy("block").applyInPandas(add, ddl)
    found = {r.block: np.frombuffer(r.part) for r in sums.collect()}
    return np.concatenate([found[i] for i in range(blocks)]) if found else np.zeros(0)
