"""Table access and vectorised text primitives shared by the operators."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy pass handles; a longer text is a pass of its own.
PASS_BYTES = 2 << 20
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


#: Rows of a batch that goes to Python, where the session leaves Spark's default: long texts make those too large for memory
#: beside the heap.
BATCH_ROWS = 1024


def small_batches(spark: SparkSession) -> None:
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, "10000") == "10000":
        spark.conf.set(name, str(BATCH_ROWS))


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """The named columns of a table, and nothing else of it."""
    small_batches(spark)
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share. Where it is unset a session with local
    executors only, as in tests, gets a temporary folder; on a cluster that is an error."""
    import re
    import tempfile
    import uuid

    small_batches(spark)
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="retort-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/retort/{uuid.uuid4().hex}"


def stored(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut and a lost executor costs no recomputation."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    schema = df.schema
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(schema).parquet(path)


def carried(docs: DataFrame, keep: tuple[str, ...], text: str, made: str) -> tuple[DataFrame, str, list[str], str]:
    """(kept columns and text, the text's name there, kept names, the result's schema) for a map that adds the columns
    `made`. A kept column whose name is made anew gives way; a kept text isn't sent twice."""
    taken = {x.split()[0] for x in made.split(", ")}
    keep = [k for k in dict.fromkeys(keep) if k not in taken]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema), made])
    if text in keep:
        return docs.select(*keep), text, keep, schema
    return docs.select(*keep, docs[text].alias("__text")), "__text", keep, schema


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; after the last, the memory that a reused worker would keep goes back to the system."""
    try:
        yield from batches
    finally:
        give_back()


def give_back() -> None:
    """Return freed memory of this process: Arrow's pool, and what the C library holds for later."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc; elsewhere there is nothing to do
    if trim is not None:
        trim(0)


def parts_for(rows: int, per_part: int) -> int:
    return max(1, math.ceil(rows / per_part))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX_A
    x ^= x >> np.uint64(27)
    x *= MIX_B
    x ^= x >> np.uint64(31)
    return x


def salt(*numbers: int) -> np.uint64:
    """A fixed 64-bit constant for a tuple of numbers."""
    x = np.array([0x9E3779B97F4A7C15], dtype=np.uint64)
    for n in numbers:
        x = mix(x + np.uint64(n % (1 << 64)))
    return x[0]


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes inside a word of the language models: all but ASCII white space.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes inside a word of letters and digits, all of UTF-8's multibyte sequences included.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def text_slices(column: pa.Array, limit: int = PASS_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of its rows in these bytes): runs of rows of at most limit bytes, or one row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64, count=n + 1, offset=8 * column.offset)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        j = min(j, n)
        yield i, j, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words of each row): maximal runs of bytes marked inside, which never cross rows."""
    rows = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(rows, np.int64)
    mark = inside[data]
    edge = np.empty(len(data), dtype=bool)
    edge[0] = True
    np.not_equal(mark[1:], mark[:-1], out=edge[1:])
    edge[offsets[:-1][offsets[:-1] < len(data)]] = True
    at = np.flatnonzero(edge)
    ends = np.append(at[1:], len(data))
    keep = mark[at]
    starts, ends = at[keep], ends[keep]
    bounds = np.searchsorted(starts, offsets)
    return starts, ends, np.diff(bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each word; equal words have equal hashes wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lens = ends - starts
    first = np.concatenate([[0], np.cumsum(lens)[:-1]])
    pos = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(first, lens)
    powers = np.cumprod(np.full(int(lens.max()), 0xD1342543DE82EF95, dtype=np.uint64))
    body = data[np.repeat(starts, lens) + pos]
    return mix(np.add.reduceat(BYTE_CODES[body] * powers[pos], first) + lens.astype(np.uint64))


def windows(hashes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of each row's runs of k consecutive hashes, runs of each row); a row of fewer, but not none, is one run."""
    n = len(hashes)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64) if len(counts) else np.zeros(0, np.int64)
    out = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    if not n:
        return np.zeros(0, np.uint64), out
    acc = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        acc[: n - i] += hashes[i:] * salt(i, 77) if i else hashes * salt(0, 77)
    idx = np.repeat(first - np.concatenate([[0], np.cumsum(out)[:-1]]).astype(np.int64), out) + np.arange(int(out.sum()))
    runs = mix(acc[idx])
    short = np.flatnonzero((counts < k) & (counts > 0))
    if len(short):
        at = np.concatenate([[0], np.cumsum(out)[:-1]]).astype(np.int64)
        for r in short:
            x = hashes[first[r] : first[r] + counts[r]]
            runs[at[r]] = mix(np.array([(sum(int(h) * int(salt(i, 77)) for i, h in enumerate(x)) + int(counts[r])) % (1 << 64)], dtype=np.uint64))[0]
    return runs, out


def row_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of values, empty groups included."""
    total = np.concatenate([[0], np.cumsum(values)])
    end = np.cumsum(counts)
    return total[end] - total[end - counts]


def crc_of_id(column: str) -> F.Column:
    """CRC-32 of the decimal digits of an id, by which held-out rows are told apart."""
    return F.crc32(F.col(column).cast("string").cast("binary"))
