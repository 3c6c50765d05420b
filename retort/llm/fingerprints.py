"""Order MinHash fingerprints, whose likeness follows edit distance rather than the set of words."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retort.llm.common import ALNUM, LOWER, carried, mix, parts_for, read, released, salt, text_slices, word_hashes, words

#: Words of a k-mer, k-mers of a tuple, tuples of a fingerprint.
K, TUPLE, SKETCHES = 3, 2, 64
#: Rows of a run of consecutive documents, which one task handles; runs at most, beyond which they grow.
RUN_ROWS, MOST_RUNS = 4096, 1 << 16


def numbered(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Hashes of (k-mer, how many equal ones stand before it in its row): repeats become different elements."""
    keyed = mix(hashes ^ (rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    order = np.argsort(keyed, kind="stable")
    ranked = keyed[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    start = np.maximum.accumulate(np.where(new, np.arange(len(ranked)), 0))
    count = np.empty(len(hashes), dtype=np.uint64)
    count[order] = (np.arange(len(ranked)) - start).astype(np.uint64)
    return np.where(count == 0, hashes, mix(hashes + count * np.uint64(0xD1342543DE82EF95)))


def kmers(hashes: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of k words, runs of each row); a row of fewer words, none included, is one run of what it has."""
    runs = np.maximum(counts - k + 1, 1)
    first = np.cumsum(counts) - counts
    pad = np.concatenate([hashes, np.zeros(k + 1, np.uint64)])
    at = np.repeat(first - (np.cumsum(runs) - runs), runs) + np.arange(int(runs.sum()))
    left = np.repeat(first + counts, runs) - at
    out = np.zeros(len(at), np.uint64)
    for i in range(k):
        np.add(out, np.where(left > i, pad[np.minimum(at + i, len(pad) - 1)] * salt(k, i), np.uint64(i + 1)), out=out)
    return mix(out), runs


def sketch(data: np.ndarray, offsets: np.ndarray, k: int = K, size: int = TUPLE, sketches: int = SKETCHES) -> np.ndarray:
    """uint32 (rows, sketches): of each row's numbered k-mers, the `size` least under each hash, in text order, hashed."""
    data = LOWER[data]
    starts, ends, counts = words(data, offsets, ALNUM)
    hashes, runs = kmers(word_hashes(data, starts, ends), counts, k)
    n = len(runs)
    rows = np.repeat(np.arange(n), runs)
    elements = numbered(hashes, rows)
    ends_at = np.cumsum(runs)
    # Of a row with r elements, those under a hash threshold of about 12/r of the range hold the least ones, almost
    # always; the rows of which they don't are done again with all elements.
    share = np.minimum(1.0, 12.0 / runs)
    limit = np.where(share >= 1, np.uint64(0xFFFFFFFFFFFFFFFF), (share * 2.0**64 * (1 - 1e-9)).astype(np.float64).clip(0, 1.8446744073709e19).astype(np.uint64))
    limits = np.repeat(limit, runs)
    out = np.zeros((n, sketches), dtype=np.uint32)
    for s in range(sketches):
        x = elements * (salt(s, 1) | np.uint64(1))
        x ^= x >> np.uint64(32)
        x *= salt(s, 2) | np.uint64(1)
        under = np.flatnonzero(x <= limits)
        have = np.bincount(rows[under], minlength=n)
        need = np.minimum(runs, size)
        if len(again := np.flatnonzero(have < need)):
            more = np.concatenate([np.arange(ends_at[r] - runs[r], ends_at[r]) for r in again])
            under = np.union1d(under, more)
        by = under[np.lexsort((x[under], rows[under]))]
        owner = rows[by]
        rank = np.arange(len(by)) - np.searchsorted(owner, owner)
        by = by[rank < size]
        owner = rows[by]
        by = by[np.lexsort((by, owner))]  # back in text order
        place = np.arange(len(by)) - np.searchsorted(owner, owner)
        tuples = np.zeros(n, np.uint64)
        for p in range(size):
            at = place == p
            tuples[owner[at]] += elements[by[at]] * (salt(p, 5) | np.uint64(1))
        out[:, s] = (mix(tuples + salt(s, 9)) >> np.uint64(32)).astype(np.uint32)
    return out


def fingerprints(texts: list[str], **params: int) -> np.ndarray:
    column = pa.array(texts, pa.large_string())
    parts = [sketch(data, offsets, **params) for _, _, data, offsets in text_slices(column)]
    return np.concatenate(parts) if parts else np.zeros((0, params.get("sketches", SKETCHES)), np.uint32)


def to_text(rows: np.ndarray) -> list[str]:
    return [r.astype(">u4").tobytes().hex() for r in rows]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of tuples on which fingerprints agree."""
    return (a == b).mean(axis=1)


def fingerprint(docs: DataFrame, *keep: str, text: str = "text", **params: int) -> DataFrame:
    """The kept columns and each text's fingerprint (hexadecimal). Null counts as empty, all empty texts being alike;
    texts of fewer than k words are one k-mer; white space, punctuation and the case of A-Z don't count. Very long texts are
    whole, each a pass of its own; an empty table gives an empty result; columns that aren't kept are ignored."""
    rows, name, kept, schema = carried(docs, keep, text, "fingerprint string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            found = to_text(fingerprints(batch.column(name).fill_null("").to_pylist(), **params))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), pa.array(found, pa.string())], names=[*kept, "fingerprint"])

    return rows.mapInArrow(run, schema)


def _keys(ids: pa.Array, hashes: pa.Array) -> np.ndarray:
    """17 bytes of each row, ordered as descending ids, null last, and hashes."""
    out = np.zeros((len(ids), 17), np.uint8)
    out[:, 0] = np.asarray(ids.is_null())
    top = np.int64(-(2**63))
    out[:, 1:9] = (~ids.fill_null(0).to_numpy(zero_copy_only=False) ^ top).astype(">i8").view(np.uint8).reshape(-1, 8)
    out[:, 9:] = (hashes.to_numpy(zero_copy_only=False) ^ top).astype(">i8").view(np.uint8).reshape(-1, 8)
    return out.reshape(-1).view("S17")


def in_runs(docs: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """doc_id, text, run and ghost: runs of consecutive documents by descending doc_id, null last, ties by a hash of the
    text and by the text, in partitions of their own.

    Each run also has, as ghosts, the first documents of the run after it (of the first one, after the last). The bounds
    are the first key of each partition of the ids and hashes alone, dealt by range; no more than MOST_RUNS of these
    reach the driver, whatever the table's size, since a task reads its run row by row. Only rows alike in both id and
    text can't be parted.
    """
    keyed = docs.select("doc_id", F.xxhash64("text").alias("hash"))
    runs = min(MOST_RUNS, parts_for(keyed.count(), run_rows))
    ranged = keyed.repartitionByRange(runs, F.col("doc_id").desc_nulls_last(), "hash") if runs > 1 else keyed.coalesce(1)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.bitwise_not("doc_id").alias("down"), "hash", "doc_id"))
    found = ranged.groupBy(F.spark_partition_id().alias("at")).agg(first.alias("first")).select("first.doc_id", "first.hash").toArrow()
    if not found.num_rows:
        return docs.select("doc_id", "text", F.lit(0).alias("run"), F.lit(False).alias("ghost"))
    heads = np.unique(_keys(found.column("doc_id").combine_chunks(), found.column("hash").combine_chunks()))

    @F.arrow_udf("array<struct<run:int,ghost:boolean>>")
    def runs_of(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        keys = _keys(ids, hashes)
        own = np.searchsorted(heads, keys, side="right") - 1
        head = heads[own] == keys  # the run before gets it too
        counts = 1 + head
        at = np.cumsum(counts) - counts
        run, ghost = np.zeros(int(counts.sum()), np.int32), np.zeros(int(counts.sum()), dtype=bool)
        run[at] = own
        run[at[head] + 1], ghost[at[head] + 1] = (own[head] - 1) % len(heads), True
        rows = pa.StructArray.from_arrays([pa.array(run), pa.array(ghost)], names=["run", "ghost"])
        return pa.ListArray.from_arrays(pa.array(np.append(at, len(run)), pa.int32()), rows)

    dealt = docs.withColumn("_hash", F.xxhash64("text")).select("doc_id", "text", "_hash", F.inline(runs_of("doc_id", "_hash")))
    return dealt.repartition(len(heads), "run").sortWithinPartitions(F.col("run"), F.col("ghost"), F.col("doc_id").desc_nulls_last(), F.col("_hash"), F.col("text")).drop("_hash")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ties of doc_id are ordered by a hash of the text, then the text, null as empty. With one document only, it is its own
    next document; an empty table gives an empty result. Very long texts are fingerprinted whole."""
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def finish(ids: list, texts: list[str], nexts: list[str], own: np.ndarray, after: np.ndarray) -> pa.RecordBatch:
        edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts, nexts, strict=True)]
        marks = fingerprints(edited)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
                pa.array(to_text(own), pa.string()),
                pa.array(to_text(marks), pa.string()),
                pa.array(likeness(own, marks), pa.float64()),
                pa.array(likeness(own, after), pa.float64()),
            ],
            names=[x.split()[0] for x in schema.split(", ")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # run, id, text, fingerprint, ghost of the row before
        for whole in released(batches):
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts, runs = batch.column("text").fill_null("").to_pylist(), batch.column("run").to_pylist()
                ids, ghosts = batch.column("doc_id").to_pylist(), batch.column("ghost").to_pylist()
                marks = fingerprints(texts)
                if last is not None:
                    texts, runs, ids, ghosts = [last[2], *texts], [last[0], *runs], [last[1], *ids], [last[4], *ghosts]
                    marks = np.concatenate([last[3][None], marks])
                # A row's next document is the row after it: the run's next own row, or for its last one the first ghost.
                ready = [i for i in range(len(ids) - 1) if not ghosts[i] and runs[i + 1] == runs[i]]
                if ready:
                    after = [i + 1 for i in ready]
                    yield finish([ids[i] for i in ready], [texts[i] for i in ready], [texts[i] for i in after], marks[ready], marks[after])
                last = (runs[-1], ids[-1], texts[-1], marks[-1], ghosts[-1])

    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return in_runs(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))).mapInArrow(run, schema)
