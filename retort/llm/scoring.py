"""Scoring by a Katz backoff model whose counts, partitioned over tasks, never leave them."""

from __future__ import annotations

import gc
import json
import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retort.llm.common import LOWER, NOT_SPACE, crc_of_id, give_back, mix, parts_for, read, salt, shared_dir, text_slices, word_hashes, words

#: Good-Turing discounts counts of 1 to K. A context that makes up a large part of a partition's tokens is split over all.
K = 5
#: Bytes of text whose tokens are looked up together, and that a partition of the counts stands for.
UNIT_BYTES, PART_BYTES = 10 << 20, 8 << 20
END = salt(21)
ROW = "unit long, bucket long, kind int, body binary"
# Kinds of rows: a unit's tokens, its words for one partition, the counts of these, its bigrams for one partition,
# their part of the scores, the part of a split context, statistics, and what of a unit's scores needs no bigrams.
TOKENS, WORDS, COUNTS, BIGRAMS, SCORES, SPLIT, STATS, BASE = range(8)


CODEC = pa.Codec("zstd", compression_level=3)


def _planes(a: np.ndarray, width: int) -> np.ndarray:
    """The first bytes of all numbers, then all second ones, and so on: high bytes, mostly alike, compress to nothing."""
    return np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(-1, width).T)


def pack(**arrays: np.ndarray) -> bytes:
    """Arrays in one compressed string; whole numbers in as few bytes as their largest needs."""
    heads, bodies = [], []
    for name, a in arrays.items():
        if a.dtype.kind in "iu" and (not len(a) or int(a.min()) >= 0):
            top = int(a.max()) if len(a) else 0
            a = a.astype("u1" if top < 1 << 8 else "u2" if top < 1 << 16 else "u4" if top < 1 << 32 else "u8")
        raw = (_planes(a, a.dtype.itemsize) if a.dtype.kind in "iu" else np.ascontiguousarray(a)).tobytes()
        small = CODEC.compress(raw, asbytes=True) if raw else b""
        heads.append((name, a.dtype.str, len(raw), len(small)))
        bodies.append(small)
    head = json.dumps(heads).encode()
    return b"".join([struct.pack("<I", len(head)), head, *bodies])


def unpack(body: bytes) -> dict[str, np.ndarray]:
    n = struct.unpack_from("<I", body)[0]
    at, out = 4 + n, {}
    for name, kind, size, small in json.loads(body[4 : 4 + n]):
        raw = CODEC.decompress(body[at : at + small], decompressed_size=size, asbytes=True) if size else b""
        width = np.dtype(kind).itemsize if np.dtype(kind).kind in "iu" else 1
        planes = np.frombuffer(raw, np.uint8).reshape(width, -1) if size else np.zeros((width, 0), np.uint8)
        out[name], at = (np.ascontiguousarray(planes.T) if width > 1 else planes).ravel().view(kind), at + small
    return out


def rows_of(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    u, b, k, x = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.table({"unit": pa.array(u, pa.int64()), "bucket": pa.array(b, pa.int64()), "kind": pa.array(k, pa.int32()), "body": pa.array(x, pa.binary())})


def lean(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    """The rows of a group, after what earlier groups of this worker took is given back."""
    give_back()
    return rows_of(rows)


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The partition of each hash; ascending hashes have ascending partitions."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def discounts(of_counts: np.ndarray) -> np.ndarray:
    """d[r] for r of 0 to K by Good-Turing from the numbers of types seen 1 to K+1 times: (r* / r - A) / (1 - A) with
    A = (K + 1) n[K+1] / n[1]. Where a count of counts makes that useless, all are (r - D) / r, D = n1 / (n1 + 2 n2)."""
    n = np.concatenate([[0.0], of_counts.astype(np.float64)])
    d = np.ones(K + 1)
    r = np.arange(1, K + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        cut = (K + 1) * n[K + 1] / n[1]
        d[1:] = ((r + 1) * n[2 : K + 2] / n[1 : K + 1] / r - cut) / (1 - cut)
    if not np.all(np.isfinite(d)) or np.any(d[1:] <= 0) or np.any(d[1:] >= 1):
        less = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        d[1:] = (r - less) / r
    return d


@dataclass
class Unigrams:
    """P(w) = d[c] c / N for c > 0; the rest of the mass, at least 1 / (N + 1), is that of all unknown words together."""

    tokens: int
    types: int
    d: np.ndarray
    kept: float
    unknown: float

    @staticmethod
    def of(tokens: int, types: int, of_counts: np.ndarray) -> Unigrams:
        d = discounts(of_counts)
        if not tokens:
            return Unigrams(0, 0, d, 1.0, 1.0)
        lost = float(sum(of_counts[r - 1] * r * (1 - d[r]) for r in range(1, K + 1))) / tokens
        kept = 1.0 if lost >= 1 / (tokens + 1) else (1 - 1 / (tokens + 1)) / (1 - lost)
        return Unigrams(tokens, types, d, kept, 1 - kept * (1 - lost))

    def p(self, counts: np.ndarray) -> np.ndarray:
        c = counts.astype(np.float64)
        return np.where(counts > 0, self.kept * self.d[np.minimum(counts, K)] ** (counts <= K) * c / max(1, self.tokens), self.unknown)


def seen_share(d: np.ndarray, total: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The mass of a context's seen words: all of it but the discounts on counts of 1 to K (columns of low)."""
    return (total - low @ (np.arange(1, K + 1) * (1 - d[1:]))) / total


def units_of(docs: DataFrame) -> DataFrame:
    """TOKENS and WORDS rows. docs: doc_id, text, held_out. A unit's words are in the order of their hashes; tokens are
    places in it. Only the first call's order of rows gives unit numbers a meaning, so the result must be stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0

        def unit(parts: list[tuple]) -> pa.RecordBatch:
            nonlocal made
            ids, held = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            tokens, n = np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts])
            distinct, which = np.unique(tokens, return_inverse=True)
            counts = np.bincount(which[np.repeat(~held, n)], minlength=len(distinct))
            number = (task << 24) + made
            made += 1
            own = pack(ids=ids.view(np.uint64), null=np.concatenate([p[4] for p in parts]), held=held.astype(np.uint8), n=n, which=which, words=np.array([len(distinct)]))
            step = np.diff(distinct, prepend=np.uint64(0))
            return rows_of([(number, 0, TOKENS, own), (number, 0, WORDS, pack(step=step, counts=counts))]).to_batches()[0]

        parts, size = [], 0
        for batch in batches:
            for i, j, data, offsets in text_slices(batch.column("text")):
                data = LOWER[data]
                starts, ends, n = words(data, offsets, NOT_SPACE)
                hashes, last = word_hashes(data, starts, ends), np.cumsum(n)
                tokens = np.insert(hashes, last, END)
                ids, held = batch.column("doc_id").slice(i, j - i), batch.column("held_out").slice(i, j - i)
                null = ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8)
                parts.append((ids.fill_null(0).to_numpy(), held.to_numpy(zero_copy_only=False).astype(bool), tokens, n + 1, null))
                size += len(data)
                if size >= UNIT_BYTES:
                    yield unit(parts)
                    parts, size = [], 0
        if parts:
            yield unit(parts)
        give_back()

    return docs.select("doc_id", "text", "held_out").mapInArrow(run, ROW)


def ask_words(units: DataFrame, parts: int) -> DataFrame:
    """The WORDS rows, a row for each partition of the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for u, body in zip(batch.column("unit").to_pylist(), batch.column("body").to_pylist(), strict=True):
                x = unpack(body)
                hashes = np.cumsum(x["step"].astype(np.uint64))
                cuts = np.searchsorted(part_of(hashes, parts), np.arange(parts + 1)).tolist()
                for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    if a < b:
                        yield rows_of([(u, p, WORDS, pack(hashes=hashes[a : a + 1], step=np.diff(hashes[a:b], prepend=hashes[a]), counts=x["counts"][a:b]))]).to_batches()[0]

    return units.filter(F.col("kind") == WORDS).mapInArrow(run, ROW)


def count_words(asked: DataFrame, parts: int) -> DataFrame:
    """COUNTS rows (the training count and the number of each word asked for) and a STATS row for each partition."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        found = [unpack(x) for x in table.column("body").to_pylist()]
        hashes = [x["hashes"].astype(np.uint64)[0] + np.cumsum(x["step"].astype(np.uint64)) for x in found]
        known, which = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(which, weights=np.concatenate([x["counts"] for x in found]).astype(np.float64), minlength=len(known)).astype(np.int64)
        bucket, at, rows = key[0].as_py(), 0, []
        for u, h in zip(table.column("unit").to_pylist(), hashes, strict=True):
            own = which[at : at + len(h)]
            at += len(h)
            rows.append((u, bucket, COUNTS, pack(number=own.astype(np.int64) * parts + bucket, counts=total[own])))
        stats = np.bincount(np.minimum(total, K + 2), minlength=K + 3)[: K + 2]
        stats[0] = np.count_nonzero(total)
        rows.append((-1, bucket, STATS, pack(stats=np.concatenate([stats, [total.sum()]]))))
        return lean(rows)

    return asked.groupBy("bucket").applyInArrow(run, ROW)


def statistics(rows: DataFrame) -> np.ndarray:
    """The sum of the STATS rows: types, types seen 1 to K+1 times, tokens. A few numbers come from each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column("body").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([unpack(body)["stats"].astype(np.int64).tolist()], pa.list_(pa.int64()))], names=["v"])

    sums = rows.filter(F.col("kind") == STATS).select("body").mapInArrow(run, "v array<long>").agg(*[F.sum(F.col("v")[i]) for i in range(K + 3)]).first()
    return np.array([x or 0 for x in sums], dtype=np.int64)


def ask_bigrams(units: DataFrame, counts: DataFrame, parts: int, unigrams: Unigrams) -> DataFrame:
    """From each unit and the counts of its words: a BASE row, and BIGRAMS rows by partition of the context (of the
    whole bigram for split contexts): contexts, words, training counts, and the documents each bigram is in."""
    split_at = max(1000, unigrams.tokens // (2 * parts))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        by = {k: [] for k in (TOKENS, COUNTS)}
        for b, k, body in zip(table.column("bucket").to_pylist(), table.column("kind").to_pylist(), table.column("body").to_pylist(), strict=True):
            by[k].append((b, body))
        unit, own = key[0].as_py(), unpack(by[TOKENS][0][1])
        told = [unpack(body) for _, body in sorted(by[COUNTS])]
        number = np.concatenate([x["number"].astype(np.int64) for x in told])
        count = np.concatenate([x["counts"].astype(np.int64) for x in told])
        n, which = own["n"].astype(np.int64), own["which"].astype(np.int64)
        docs, last = np.repeat(np.arange(len(n)), n), np.cumsum(n)
        c = count[which]
        logs = np.log10((c + 1) / (unigrams.tokens + unigrams.types + 1))
        base = pack(ids=own["ids"], null=own["null"], held=own["held"], n=n, known=np.bincount(docs[c > 0], minlength=len(n)), base=np.bincount(docs, weights=logs, minlength=len(n)))
        rows = [(unit, parts + unit, BASE, base)]
        before = np.empty(len(which), np.int64)
        before[1:] = which[:-1]
        before[last - n] = which[last - 1]  # a text begins after an end
        context = number[before]
        split = count[before] >= split_at
        where = mix(context.astype(np.uint64) + np.where(split, mix(number[which].astype(np.uint64) + np.uint64(1)), np.uint64(0)))
        bucket = part_of(where, parts)
        held = own["held"].astype(bool)[docs]
        order = np.lexsort((docs, number[which], context, bucket))
        bucket, context, word, doc, held = bucket[order], context[order], number[which][order], docs[order], held[order]
        c, total, split = c[order], count[before][order], split[order]
        new_pair = np.ones(len(order), dtype=bool)
        new_pair[1:] = (word[1:] != word[:-1]) | (context[1:] != context[:-1])
        new = new_pair.copy()
        new[1:] |= doc[1:] != doc[:-1]
        pairs, entries = np.flatnonzero(new_pair), np.flatnonzero(new)
        times = np.diff(np.append(entries, len(order)))
        trained = np.add.reduceat((~held).astype(np.int64), pairs)
        per_pair = np.diff(np.append(np.searchsorted(entries, pairs), len(entries)))
        new_context = np.ones(len(pairs), dtype=bool)
        new_context[1:] = context[pairs][1:] != context[pairs][:-1]
        cuts = np.searchsorted(bucket, np.arange(parts + 1))
        at_pair, at_entry = np.searchsorted(pairs, cuts), np.searchsorted(entries, cuts)
        for p in range(parts):
            a, b = at_pair[p], at_pair[p + 1]
            if a == b:
                continue
            mine, first = pairs[a:b], np.union1d([0], np.flatnonzero(new_context[a:b]))
            heads = mine[first]
            body = pack(
                context=np.diff(context[heads], prepend=0),
                total=np.where(split[heads], total[heads], 0),
                words=np.diff(np.append(first, b - a)),
                word=word[mine],
                count=c[mine],
                trained=trained[a:b],
                docs=per_pair[a:b],
                doc=doc[entries[at_entry[p] : at_entry[p + 1]]],
                times=times[at_entry[p] : at_entry[p + 1]],
                size=np.array([len(n)]),
            )
            rows.append((unit, p, BIGRAMS, body))
        return lean(rows)

    told = units.filter(F.col("kind") == TOKENS).unionByName(counts.filter(F.col("kind") == COUNTS))
    return told.groupBy("unit").applyInArrow(run, ROW)


def score_bigrams(asked: DataFrame, unigrams: Unigrams) -> DataFrame:
    """A partition's bigram counts, and with them, for each unit: of every document the sum of log10(c / c(context))
    over its seen bigrams and how many of these have each count of 1 to K; and every unseen bigram with its context's
    counts, by which the backoff weight follows. Partitions of training counts and STATS rows come out too."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        if table.column("kind")[0].as_py() == BASE:
            return table.select(["unit", "bucket", "kind", "body"])
        bucket = key[0].as_py()
        found = [unpack(x) for x in table.column("body").to_pylist()]
        heads = [np.cumsum(x["context"].astype(np.int64)) for x in found]
        context = np.concatenate([np.repeat(h, x["words"].astype(np.int64)) for h, x in zip(heads, found, strict=True)])
        split_total = np.concatenate([np.repeat(x["total"].astype(np.int64), x["words"].astype(np.int64)) for x in found])
        word = np.concatenate([x["word"].astype(np.int64) for x in found])
        of_word = np.concatenate([x["count"].astype(np.int64) for x in found])
        trained = np.concatenate([x["trained"].astype(np.int64) for x in found])
        order = np.lexsort((word, context))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (word[order][1:] != word[order][:-1]) | (context[order][1:] != context[order][:-1])
        pair_of = np.empty(len(order), np.int64)
        pair_of[order] = np.cumsum(new) - 1
        first = order[new]
        count = np.bincount(pair_of, weights=trained, minlength=len(first)).astype(np.int64)
        c1, ctx, total = of_word[first], context[first], split_total[first]
        start = np.ones(len(ctx), dtype=bool)
        start[1:] = ctx[1:] != ctx[:-1]
        ctx_of = np.cumsum(start) - 1
        contexts = int(ctx_of[-1]) + 1
        own = np.bincount(ctx_of, weights=count, minlength=contexts).astype(np.int64)
        low = np.stack([np.bincount(ctx_of[count == r], minlength=contexts) for r in range(1, K + 1)], axis=1)
        p1 = unigrams.p(c1)
        mass = np.bincount(ctx_of, weights=np.where(count > 0, p1, 0.0), minlength=contexts)
        shared = total[start] > 0  # split over partitions: its total is known, the rest isn't yet
        # Of a context without a count that is discounted one more token is set aside, so that unseen words have a share.
        # Of one that is split this shows only later: what was seen of it here, if no count is discounted here, waits too.
        bare = (low.sum(axis=1) == 0) & (own > 0)
        waits = shared & bare
        own = np.where(shared, total[start], own + bare)
        rows = []
        names = ctx[start]
        if shared.any():
            rows.append((-1, bucket, SPLIT, pack(context=names[shared], low=low[shared].ravel(), mass=mass[shared], total=own[shared])))
        with np.errstate(divide="ignore"):
            value = np.where(count > 0, np.log10(np.maximum(count, 1) / np.maximum(own[ctx_of], 1)), 0.0)
        at = 0
        for u, x in zip(table.column("unit").to_pylist(), found, strict=True):
            pairs = pair_of[at : at + len(x["word"])]
            at += len(pairs)
            entry = np.repeat(pairs, x["docs"].astype(np.int64))
            doc, times, size = x["doc"].astype(np.int64), x["times"].astype(np.int64), int(x["size"][0])
            cnt = count[entry]
            hits = np.stack([np.bincount(doc[cnt == r], weights=times[cnt == r], minlength=size) for r in range(1, K + 1)], axis=1).astype(np.int64)
            late = np.flatnonzero((cnt == 0) | waits[ctx_of[entry]])
            lc = ctx_of[entry[late]]
            rows.append(
                (
                    u,
                    bucket,
                    SCORES,
                    pack(
                        value=np.bincount(doc, weights=value[entry] * times, minlength=size),
                        hits=hits.ravel(),
                        doc=doc[late],
                        times=times[late],
                        split=np.where(shared[lc], names[lc] + 1, 0),
                        total=np.where(shared[lc], 0, own[lc]),
                        low=np.where(shared[lc][:, None], 0, low[lc]).ravel(),
                        mass=np.where(shared[lc], 0.0, mass[lc]),
                        p=np.where(cnt[late] > 0, 0.0, p1[entry[late]]),
                    ),
                )
            )
        kept = np.flatnonzero(count > 0)
        rows.append((-1, bucket, WORDS, pack(context=np.diff(ctx[kept], prepend=0), word=word[first][kept], count=count[kept])))
        stats = np.bincount(np.minimum(count, K + 2), minlength=K + 3)[: K + 2]
        stats[0] = len(kept)
        rows.append((-1, bucket, STATS, pack(stats=np.concatenate([stats, [count.sum()]]))))
        return lean(rows)

    return asked.groupBy("bucket").applyInArrow(run, ROW)


def finish(scored: DataFrame, d: np.ndarray, split: dict[int, tuple[float, float]]) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, base_score and score of each document, from its unit's rows."""
    log_d = np.log10(d[1:])
    names = np.array(sorted(split), dtype=np.int64)
    weights = np.array([split[k] for k in names.tolist()]).reshape(-1, 2)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        base, score = None, 0.0
        for kind, body in zip(table.column("kind").to_pylist(), table.column("body").to_pylist(), strict=True):
            x = unpack(body)
            if kind == BASE:
                base = x
                continue
            part = x["value"] + x["hits"].reshape(-1, K).astype(np.float64) @ log_d
            total, low = x["total"].astype(np.float64), x["low"].reshape(-1, K).astype(np.float64)
            with np.errstate(divide="ignore", invalid="ignore"):
                rest = np.where(total > 0, (1 - seen_share(d, np.maximum(total, 1), low)) + _aside(total, low), 1.0)
                alpha = np.log10(np.where(total > 0, rest / (1 - x["mass"]), 1.0))
            if len(names):
                hot = x["split"].astype(np.int64)
                at = np.minimum(np.searchsorted(names, hot - 1), len(names) - 1)
                alpha = np.where(hot > 0, np.where(x["p"] > 0, weights[at, 0], weights[at, 1]), alpha)
            seen = x["p"] == 0  # of split contexts: only the token set aside is still to be reckoned with
            part += np.bincount(x["doc"].astype(np.int64), weights=x["times"] * (alpha + np.where(seen, 0.0, np.log10(np.where(seen, 1.0, x["p"])))), minlength=len(part))
            score = score + part
        give_back()
        n = base["n"].astype(np.int64)
        return pa.table(
            {
                "doc_id": pa.array(base["ids"].astype(np.uint64).view(np.int64), mask=base["null"].astype(bool)),
                "held_out": pa.array(base["held"].astype(bool)),
                "n_tokens": pa.array(n),
                "n_known": pa.array(base["known"].astype(np.int64)),
                "base_score": pa.array(base["base"].astype(np.float64)),
                "score": pa.array(np.zeros(len(n)) + score),
            }
        )

    return scored.filter(F.col("kind").isin(SCORES, BASE)).groupBy("unit").applyInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")


def _aside(total: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The share of the token that is set aside where no count is discounted."""
    return np.where(low.sum(axis=1) == 0, 1 / np.maximum(total, 1), 0.0)


def split_weights(scored: DataFrame, d: np.ndarray) -> dict[int, tuple[float, float]]:
    """Of each split context, of which there are at most two for each partition: log10 of its backoff weight, and of
    the share that the token set aside leaves to seen words, 0 if there is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column("body").to_pylist():
                x = unpack(body)
                yield pa.RecordBatch.from_arrays([pa.array(x["context"].astype(np.int64)), pa.array(x["low"].reshape(-1, K).astype(np.int64).tolist(), pa.list_(pa.int64())), pa.array(x["mass"]), pa.array(x["total"].astype(np.int64))], names=["context", "low", "mass", "total"])

    parts = scored.filter(F.col("kind") == SPLIT).select("body").mapInArrow(run, "context long, low array<long>, mass double, total long")
    rows = parts.groupBy("context").agg(F.max("total").alias("total"), F.sum("mass").alias("mass"), *[F.sum(F.col("low")[i]).alias(f"low{i}") for i in range(K)]).collect()
    out = {}
    for r in rows:
        low = np.array([[r[f"low{i}"] for i in range(K)]], dtype=np.float64)
        total = r["total"] + float(low.sum() == 0)
        seen = float(seen_share(d, np.array([r["total"]], dtype=np.float64), low)[0]) * r["total"] / total
        out[r["context"]] = (math.log10((1 - seen) / (1 - r["mass"])), math.log10(r["total"] / total))
    return out


class Store:
    """Tables in the shared folder; what is done with is emptied, and the shuffle files behind it are let go.

    Spark forgets shuffle files once the driver's JVM has collected what refers to them. Where the session has a JVM at
    hand it is asked to; elsewhere the files stay until it happens to. Results don't depend on it, only disk does.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, shared_dir(spark)

    def keep(self, df: DataFrame, name: str, *by: str) -> DataFrame:
        df.write.option("compression", "none").partitionBy(*by).parquet(f"{self.root}/{name}")
        del df
        gc.collect()
        jvm = getattr(getattr(self.spark, "sparkContext", None), "_jvm", None)
        if jvm is not None:
            jvm.System.gc()
        return self.spark.read.schema(ROW).parquet(f"{self.root}/{name}")

    def drop(self, name: str) -> None:
        self.spark.createDataFrame([], ROW).write.mode("overwrite").parquet(f"{self.root}/{name}")


def katz_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document, learned from those that
    aren't held_out.

    docs: doc_id, text, held_out. Words are runs of bytes other than ASCII white space, A-Z lowered; each text ends
    with a token, after which the next begins, so a null or empty text is one token. The model is
    P(w | h) = d[c] c(h, w) / c(h) for bigrams seen in training, else alpha(h) P(w), alpha(h) being what the seen words
    of h leave over what they have of P; P backs off in turn to one class for all unknown words. Rows that repeat
    an id are separate documents. Without training text every token is unknown and certain, and the score 0.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "held_out")
    store = Store(docs.sparkSession)
    parts = parts_for(docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0], PART_BYTES)
    units = store.keep(units_of(docs), "units", "kind")
    counts = store.keep(count_words(ask_words(units, parts), parts), "counts", "kind")
    store.drop(f"units/kind={WORDS}")
    stats = statistics(counts)
    unigrams = Unigrams.of(int(stats[-1]), int(stats[0]), stats[1 : K + 2])
    scored = store.keep(score_bigrams(ask_bigrams(units, counts, parts, unigrams), unigrams), "bigrams", "kind")
    store.drop("units")
    d = discounts(statistics(scored)[1 : K + 2])
    return finish(scored, d, split_weights(scored, d)).withColumn("train_tokens", F.lit(unigrams.tokens).cast("long"))


def op6_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    held = F.coalesce(F.pmod(crc_of_id("doc_id"), F.lit(7)) == 2, F.lit(False))
    found = katz_scores(docs.withColumn("held_out", held))
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
