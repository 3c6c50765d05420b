"""Packing tokenised documents into windows by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retort.llm.common import give_back, parts_for, read, released, stored

CAPACITY = 4096
END_ID = 2
#: Longest piece that the differencing places; longer documents are cut into such pieces, and whole windows.
MAX_PIECE = 1024
#: Tokens and pieces that one differencing run shares out, about.
BLOCK_TOKENS, BLOCK_PIECES = 256 * CAPACITY, 16384
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLACED = PIECES + ", sequence_id long, offset long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def cut(tokens: int, capacity: int = CAPACITY, max_piece: int = MAX_PIECE) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole windows first, then pieces of nearly equal length."""
    whole = tokens // capacity * capacity
    out = [(at, capacity) for at in range(0, whole, capacity)]
    if rest := tokens - whole:
        parts = math.ceil(rest / max_piece)
        edges = [whole + rest * i // parts for i in range(parts + 1)]
        out += [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]
    return out


def difference(sizes: np.ndarray, ways: int) -> list[list[int]]:
    """Karmarkar-Karp: items by window, for `ways` windows of near-equal sums.

    Each item begins as a partition with one window in use. The two partitions of the largest spread are merged again
    and again, the fullest window of one with the emptiest of the other, until one partition is left. A partition holds
    its used windows only, sums descending, so all together never hold more than one number an item.
    """
    if ways == 1:
        return [list(range(len(sizes)))]
    left, right = [-1] * len(sizes), [-1] * len(sizes)
    heap: list[tuple[int, int, np.ndarray, np.ndarray]] = [(-size, i, np.array([size]), np.array([i])) for i, size in enumerate(sizes.tolist())]
    heapq.heapify(heap)
    turn = len(sizes)
    while len(heap) > 1:
        _, _, a, x = heapq.heappop(heap)
        _, _, b, y = heapq.heappop(heap)
        b, y = b[::-1], y[::-1]
        both = max(0, len(a) + len(b) - ways)  # windows that both use: the emptiest of one with the fullest of the other
        alone, joined = len(a) - both, []
        for i, j in zip(x[alone:].tolist(), y[:both].tolist(), strict=True):
            joined.append(len(left))
            left.append(i)
            right.append(j)
        sums = np.concatenate([a[:alone], a[alone:] + b[:both], b[both:]])
        nodes = np.concatenate([x[:alone], np.array(joined, dtype=np.int64), y[both:]])
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        if len(sums) == ways:
            sums = sums - sums[-1]
        heapq.heappush(heap, (-int(sums[0]), turn, sums, nodes))
        turn += 1
    out = []
    for node in (heap[0][3].tolist() if heap else []):
        items, stack = [], [node]
        while stack:
            n = stack.pop()
            if left[n] < 0:
                items.append(n)
            else:
                stack += [left[n], right[n]]
        out.append(sorted(items))
    return out + [[] for _ in range(ways - len(out))]


def pack_block(sizes: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Items by window, no window over capacity: as few windows as their sum needs, one more whenever that fails."""
    ways = max(1, math.ceil(int(sizes.sum()) / capacity))
    while True:
        found = [w for w in difference(sizes, ways) if w]
        if all(int(sizes[w].sum()) <= capacity for w in found):
            return found
        ways += 1


def tokenise(docs: DataFrame, path: str | None, capacity: int, max_piece: int) -> DataFrame:
    """The pieces of every document with the checksum of their ids, and a number of its row, by which rows that are
    alike in everything are dealt out too; that number is settled only once the result is stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark import TaskContext

        from retort.llm.tokenize import of_process

        tokenizer, end = of_process(path or default_tokenizer()), np.array([END_ID], dtype="<u4").tobytes()
        row = TaskContext.get().partitionId() << 40
        for batch in released(batches):
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for doc, ids in zip(part.column("doc_id").to_pylist(), tokenizer.encode(part.column("text")), strict=True):
                    n, raw = len(ids) + 1, ids.astype("<u4").tobytes() + end
                    rows += [(doc, s, k, zlib.crc32(raw[4 * s : 4 * (s + k)]), n, row) for s, k in cut(n, capacity, max_piece)]
                    row += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "row"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES + ", row long")


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, max_piece: int = MAX_PIECE, block_tokens: int = BLOCK_TOKENS, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of each piece of each document.

    A null or empty text is a document of one token, its end. Pieces that fill a window are windows of their own; the
    others are dealt by a hash of their row over blocks of about block_tokens, or block_pieces if these are more, and
    each block's windows are made by differencing, so a task holds the lengths of one block whatever the table's size
    and however alike its rows are. A very long text is cut like any other. Repeated rows and ids are separate
    documents; null ids are kept; other columns are ignored. An empty table gives an empty result.
    """
    pieces = stored(tokenise(docs, tokenizer, capacity, max_piece))
    full = pieces.filter(F.col("length") == capacity)
    rest = pieces.filter(F.col("length") < capacity)
    total, many = rest.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
    blocks = max(parts_for(total, block_tokens), parts_for(many, block_pieces))
    rest = rest.withColumn("block", F.pmod(F.xxhash64("row", "start"), F.lit(blocks)))

    def place(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.drop_columns(["block"]).sort_by([(c, "ascending") for c in ("doc_id", "start", "ids_crc32", "length", "row")]).drop_columns(["row"])
        sizes = table.column("length").to_numpy()
        sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        for k, items in enumerate(pack_block(sizes, capacity)):
            sequence[items] = (key[0].as_py() << 20) + k
            offset[items] = np.concatenate([[0], np.cumsum(sizes[items])[:-1]])
        give_back()
        return table.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    placed = rest.groupBy("block").applyInArrow(place, PLACED)
    alone = full.drop("row").withColumn("sequence_id", F.lit(blocks << 20) + F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    return placed.unionByName(alone)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents", "doc_id", "text"))
