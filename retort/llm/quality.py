"""Selection by graded quality: ordinal cumulative-link regression on hashed text, trained here in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retort.llm.common import ALNUM, LOWER, NOT_SPACE, carried, mix, read, released, salt, stored, text_slices, word_hashes, words

#: Hashed weights; labelled documents of each grade in the training sample, at most about so many whatever the table's size.
BITS, SAMPLE_PER_GRADE = 20, 4000
#: Bytes of features of the training sample, about; beyond them fewer of its texts are taken, each of them whole.
SAMPLE_BYTES = 256 << 20
EPOCHS, BATCH, RATE, DECAY, LEAST_DOCS, LEAST_SHARE = 30, 256, 0.3, 1e-3, 5, 0.005
#: Ids of labelled documents that may be broadcast.
BROADCAST_IDS = 500_000
#: A document is selected if the probability of the highest grade is at least this.
SELECT_AT = 0.2
# Classes of bytes for shapes: letters of upper and lower case, digits; any other byte is its own class.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[65:91], SHAPE[97:123], SHAPE[128:], SHAPE[48:58] = 65, 97, 97, 48


@dataclass
class Model:
    """score = weights . features; P(grade <= j) = logistic(thresholds[j] - score), thresholds ascending."""

    weights: np.ndarray
    thresholds: np.ndarray


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slots, values, features of each row). Features of a text: its different words (1 each); the shares of its tokens'
    shapes, of tokens that repeat the one before, and of distinct words (6 times the square root); the class of its length."""
    n = len(offsets) - 1
    at = np.uint64(64 - bits)
    lowered = LOWER[data]
    starts, ends, counts = words(lowered, offsets, ALNUM)
    hashed = word_hashes(lowered, starts, ends)
    rows = np.repeat(np.arange(n, dtype=np.uint64), counts)
    distinct = np.unique((rows << np.uint64(bits)) | (hashed >> at))
    row_of, slot = (distinct >> np.uint64(bits)).astype(np.int64), (distinct & np.uint64((1 << bits) - 1)).astype(np.int64)
    kinds = np.bincount(row_of, minlength=n)
    parts = [(row_of, slot, np.ones(len(slot), np.float32))]

    starts, ends, tokens = words(data, offsets, NOT_SPACE)
    if len(starts):
        owner = np.repeat(np.arange(n), tokens)
        shape = SHAPE[data]
        mark = np.empty(len(shape), dtype=bool)
        mark[0] = True
        np.not_equal(shape[1:], shape[:-1], out=mark[1:])
        mark[starts] = True
        mark &= NOT_SPACE[data]
        kept = np.flatnonzero(mark)
        lens = np.diff(np.append(np.searchsorted(kept, starts), len(kept)))
        begins = np.cumsum(lens) - lens
        shapes = mix(word_hashes(shape[kept], begins, begins + lens) + salt(1))
        whole = word_hashes(data, starts, ends)
        again = np.zeros(len(whole), dtype=bool)
        again[1:] = (whole[1:] == whole[:-1]) & (owner[1:] == owner[:-1])
        keys = np.concatenate([shapes, np.full(int(again.sum()), salt(2))])
        owners = np.concatenate([owner, owner[again]]).astype(np.uint64)
        seen, times = np.unique((owners << np.uint64(bits)) | (keys >> at), return_counts=True)
        r = (seen >> np.uint64(bits)).astype(np.int64)
        parts.append((r, (seen & np.uint64((1 << bits) - 1)).astype(np.int64), (6 * np.sqrt(times / tokens[r])).astype(np.float32)))
    size = np.floor(np.log2(np.maximum(1, counts))).astype(np.uint64)
    everyone = np.arange(n)
    parts.append((everyone, (mix(size + salt(3)) >> at).astype(np.int64), np.ones(n, np.float32)))
    parts.append((everyone, np.full(n, int(salt(4) >> at)), (6 * np.sqrt(kinds / np.maximum(1, counts))).astype(np.float32)))
    row, slot, value = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(row, kind="stable")
    return slot[order], value[order], np.bincount(row, minlength=n)


def scores(model: Model, slots: np.ndarray, values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    rows = np.repeat(np.arange(len(counts)), counts)
    return np.bincount(rows, weights=model.weights[slots] * values, minlength=len(counts))


def tail(model: Model, score: np.ndarray) -> np.ndarray:
    """(rows, thresholds): P(grade > j)."""
    return _logistic(score[:, None] - model.thresholds[None, :])


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], grades: int, bits: int = BITS, seed: int = 5) -> Model:
    """Maximise the cumulative-link likelihood, grades weighted equally, by Adagrad with weight decay.

    Features of fewer than LEAST_DOCS documents, or LEAST_SHARE of them, get no weight. Without rows the model gives every text the same score.
    """
    weights, cuts = np.zeros(1 << bits, np.float32), np.linspace(-1, 1, grades - 1) if grades > 2 else np.zeros(grades - 1)
    if not rows:
        return Model(weights, cuts)
    seen = np.bincount(np.concatenate([s for s, _, _ in rows]), minlength=1 << bits)
    least = max(LEAST_DOCS, LEAST_SHARE * len(rows))
    rows = [(s[seen[s] >= least], v[seen[s] >= least], g) for s, v, g in rows]
    grade = np.array([g for _, _, g in rows])
    share = len(rows) / np.maximum(1, np.bincount(grade, minlength=grades)) / grades
    past, past_cuts = np.full(1 << bits, 1e-6, np.float32), np.full(grades - 1, 1e-6)
    r = np.random.default_rng(seed)
    for epoch in range(EPOCHS):
        order = r.permutation(len(rows))
        rate = RATE * (1 - epoch / (EPOCHS + 1))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            slots = np.concatenate([rows[i][0] for i in pick])
            values = np.concatenate([rows[i][1] for i in pick])
            owner = np.repeat(np.arange(len(pick)), [len(rows[i][0]) for i in pick])
            score = np.bincount(owner, weights=weights[slots] * values, minlength=len(pick))
            g = grade[pick]
            below = np.where(g > 0, _logistic(np.append(0.0, cuts)[g] - score), 0.0)  # P(grade < g)
            upto = np.where(g < grades - 1, _logistic(np.append(cuts, 0.0)[np.minimum(g, grades - 1)] - score), 1.0)
            chance = np.maximum(upto - below, 1e-9)
            d_below, d_upto = below * (1 - below) * (g > 0), upto * (1 - upto) * (g < grades - 1)
            weight = share[g] / len(pick)
            d_score = weight * (d_upto - d_below) / chance
            d_cuts = np.zeros(grades - 1)
            np.add.at(d_cuts, g[g < grades - 1], (-weight * d_upto / chance)[g < grades - 1])
            np.add.at(d_cuts, g[g > 0] - 1, (weight * d_below / chance)[g > 0])
            used, inverse = np.unique(slots, return_inverse=True)
            grad = np.bincount(inverse, weights=d_score[owner] * values, minlength=len(used)) + DECAY * weights[used]
            past[used] += grad**2
            weights[used] -= rate * grad / np.sqrt(past[used])
            past_cuts += d_cuts**2
            cuts = np.maximum.accumulate(cuts - rate * d_cuts / np.sqrt(past_cuts))
    return Model(weights, cuts)


def sample(docs: DataFrame, grades: DataFrame, per_grade: int = SAMPLE_PER_GRADE, most_bytes: int = SAMPLE_BYTES) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """The features of about per_grade documents of each grade, chosen by a hash of the id; computed where the texts are.

    The choice is made among the labels, so that only its ids, a bounded number, go to the texts, which are read whole.
    If their features take more than about most_bytes, a share of the texts that fits is taken, by a hash of the features.
    """
    counts = {r["grade"]: r["count"] for r in grades.groupBy("grade").count().collect()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, per_grade / n))])
    unit = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    ids = grades.filter(unit < share[F.col("grade")])
    if sum(min(n, per_grade) for n in counts.values()) <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    chosen = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(ids, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_slices(batch.column("text")):
                slots, values, n = features(data, offsets)
                ends = np.cumsum(n)
                cut = lambda a, kind: pa.array([a[e - k : e].astype(kind).tobytes() for e, k in zip(ends, n, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("grade").slice(i, j - i), cut(slots, "<u4"), cut(values, "<f4")], names=["grade", "slots", "vals"])

    found = stored(chosen.select("grade", "text").mapInArrow(run, "grade int, slots binary, vals binary"))
    size = found.agg(F.sum(F.octet_length("slots") + F.octet_length("vals"))).first()[0] or 0
    if size > most_bytes:
        found = found.filter(F.pmod(F.xxhash64("slots", F.lit(5)), F.lit(1 << 30)) < int(most_bytes / size * (1 << 30)))
    rows = found.collect()
    rows = sorted((r["grade"], bytes(r["slots"]), bytes(r["vals"])) for r in rows)
    return [(np.frombuffer(s, "<u4").astype(np.int64), np.frombuffer(v, "<f4"), g) for g, s, v in rows]


def grade(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """The kept columns, expected_grade, tail_probability (of the highest grade) and selected of every document.

    Null and empty texts have only the features of an empty text. Equal texts get equal grades. A very long text is one
    pass of its own. An empty table gives an empty result; rows that repeat an id are graded each; columns that aren't
    kept are ignored, and a kept one whose name is made here gives way.
    """
    rows, name, kept, schema = carried(docs, keep, "text", "expected_grade double, tail_probability double")
    used = np.flatnonzero(model.weights)
    packed = (used, model.weights[used], model.thresholds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(1 << BITS, np.float32)
        weights[packed[0]] = packed[1]
        own = Model(weights, packed[2])
        for batch in released(batches):
            for i, j, data, offsets in text_slices(batch.column(name)):
                above = tail(own, scores(own, *features(data, offsets)))
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(i, j - i) for k in kept), pa.array(above.sum(axis=1)), pa.array(above[:, -1])], names=[*kept, "expected_grade", "tail_probability"])

    found = rows.mapInArrow(run, schema)
    return found.withColumn("selected", F.col("tail_probability") >= SELECT_AT)


def grades_of(labels: DataFrame) -> DataFrame:
    """doc_id and grade: 0 toxic, 1 of low quality, 2 neither; labels that are null, or of no document, are left out."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade")).filter("doc_id is not null and grade is not null")


def quality_model(docs: DataFrame, labels: DataFrame) -> Model:
    return fit(sample(docs, grades_of(labels)), 3)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return grade(docs, quality_model(docs, read(spark, sf_dir, "labels")), "doc_id")
