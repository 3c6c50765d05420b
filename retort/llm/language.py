"""Language identification by a bidirectional gated recurrent network over bytes, trained here in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retort.llm.common import carried, crc_of_id, read, released, text_slices

#: Bytes that the network sees together, its states in each direction, and the windows that one pass handles.
WINDOW, STATES, PASS_WINDOWS = 64, 8, 4096
#: The training sample: about so many documents of each language, so many stretches of each. It's bounded whatever the table's size.
SAMPLE_DOCS, SAMPLE_STRETCHES = 400, 8
STEPS, BATCH, RATE = 400, 128, 0.02
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Network:
    """inputs: (2, 3 * states, 256), a column for each byte; recurrent: (2, 3 * states, states); gates: update, reset, candidate."""

    labels: list[str]
    inputs: np.ndarray
    recurrent: np.ndarray
    candidate_bias: np.ndarray
    output: np.ndarray
    output_bias: np.ndarray

    def params(self) -> list[np.ndarray]:
        return [self.inputs, self.recurrent, self.candidate_bias, self.output, self.output_bias]


def new_network(labels: list[str], states: int = STATES, seed: int = 7) -> Network:
    r = np.random.default_rng(seed)
    draw = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(np.float32)
    return Network(labels, draw(2, 3 * states, 256, scale=0.4), draw(2, 3 * states, states, scale=0.3), np.zeros((2, states, 1), np.float32), draw(len(labels), 2 * states, scale=0.3), np.zeros((len(labels), 1), np.float32))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= np.float32(0.5)
    np.tanh(x, out=x)
    x *= np.float32(0.5)
    x += np.float32(0.5)
    return x


def states_of(net: Network, side: int, x: np.ndarray, trace: list | None = None) -> np.ndarray:
    """(steps, states, windows): the states of one direction at every position of x (steps, windows)."""
    steps, width = x.shape
    n = net.recurrent.shape[2]
    table, recurrent, bias = net.inputs[side], net.recurrent[side], net.candidate_bias[side]
    out = np.empty((steps, n, width), np.float32)
    h = np.zeros((n, width), np.float32)
    a = np.empty((3 * n, width), np.float32)
    for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
        np.take(table, x[t], axis=1, out=a, mode="clip")
        u = recurrent @ h
        gates = a[: 2 * n]
        gates += u[: 2 * n]
        _sigmoid(gates)
        z, r = gates[:n], gates[n:]
        inner = u[2 * n :] + bias
        c = a[2 * n :]
        c += r * inner
        np.tanh(c, out=c)
        if trace is not None:
            trace.append((t, h, z.copy(), r.copy(), inner, c.copy()))
        h = c + z * (h - c)
        out[t] = h
    return out


def position_probabilities(net: Network, x: np.ndarray) -> np.ndarray:
    """(steps, labels, windows): the label probabilities of every position."""
    n = net.recurrent.shape[2]
    logits = np.matmul(net.output[:, :n], states_of(net, 0, x))
    logits += np.matmul(net.output[:, n:], states_of(net, 1, x))
    logits += net.output_bias
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def gradients(net: Network, x: np.ndarray, y: np.ndarray, mask: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over the positions in mask, and its gradients by backpropagation through time. y: label of each window."""
    n, (steps, width) = net.recurrent.shape[2], x.shape
    traces: list[list] = [[], []]
    both = np.concatenate([states_of(net, side, x, traces[side]) for side in (0, 1)], axis=1)
    logits = np.matmul(net.output, both) + net.output_bias
    logits -= logits.max(axis=1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=1, keepdims=True)
    weight = mask / max(1, mask.sum())
    loss = -float((np.log(p[:, y, np.arange(width)] + 1e-12) * weight).sum())
    p[:, y, np.arange(width)] -= 1
    p *= weight[:, None, :]
    d_output = np.einsum("tlw,tsw->ls", p, both)
    d_output_bias = p.sum(axis=(0, 2))[:, None]
    d_states = np.matmul(net.output.T, p)
    d_inputs, d_recurrent, d_bias = np.zeros_like(net.inputs), np.zeros_like(net.recurrent), np.zeros_like(net.candidate_bias)
    for side in (0, 1):
        carry = np.zeros((n, width), np.float32)
        d_table = np.zeros((256, 3 * n), np.float32)
        for t, h, z, r, inner, c in reversed(traces[side]):
            g = d_states[t, side * n : (side + 1) * n] + carry
            dc = g * (1 - z) * (1 - c * c)
            dz = g * (h - c) * z * (1 - z)
            dr = dc * inner * r * (1 - r)
            d_inner = dc * r
            d_u = np.concatenate([dz, dr, d_inner])
            d_recurrent[side] += d_u @ h.T
            d_bias[side] += d_inner.sum(axis=1, keepdims=True)
            carry = g * z + net.recurrent[side].T @ d_u
            np.add.at(d_table, x[t], np.concatenate([dz, dr, dc]).T)
        d_inputs[side] = d_table.T
    return loss, [d_inputs, d_recurrent, d_bias, d_output.astype(np.float32), d_output_bias.astype(np.float32)]


def train(windows: list[bytes], labels: list[str], states: int = STATES, steps: int = STEPS, seed: int = 7) -> Network | None:
    """Fit a network by Adam on stretches of bytes and their labels; None without any."""
    names = sorted(set(labels))
    if not names:
        return None
    net = new_network(names, states, seed)
    x = np.zeros((len(windows), WINDOW), np.uint8)
    mask = np.zeros((len(windows), WINDOW), np.float32)
    for i, w in enumerate(windows):
        w = w[:WINDOW]
        x[i, : len(w)] = np.frombuffer(w, np.uint8)
        mask[i, : len(w)] = 1
    y = np.array([names.index(label) for label in labels])
    groups = [np.flatnonzero(y == k) for k in range(len(names))]
    r = np.random.default_rng(seed)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.params()]
    for step in range(1, steps + 1):
        pick = np.concatenate([r.choice(g, max(1, BATCH // len(names))) for g in groups])
        _, grads = gradients(net, np.ascontiguousarray(x[pick].T), y[pick], mask[pick].T)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = RATE * min(1.0, 2.0 * (1 - step / (steps + 1)))
        for p, g, (m, v) in zip(net.params(), grads, moments, strict=True):
            g = g * min(1.0, 1.0 / max(norm, 1e-9))
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def pooled(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, labels): the mean over all bytes of each row's text of the position probabilities. Texts are whole: each
    byte lies in one window, in which both directions begin anew."""
    lens = np.diff(offsets)
    per_row = -(-lens // WINDOW)
    total = np.zeros((len(lens), len(net.labels)))
    owner = np.repeat(np.arange(len(lens)), per_row)
    first = np.repeat(offsets[:-1] - WINDOW * (np.cumsum(per_row) - per_row), per_row) + WINDOW * np.arange(len(owner))
    end = np.repeat(offsets[1:], per_row)
    padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    for at in range(0, len(owner), PASS_WINDOWS):
        f, e, who = (v[at : at + PASS_WINDOWS] for v in (first, end, owner))
        places = np.arange(WINDOW)[:, None] + f[None, :]
        inside = places < e[None, :]
        x = np.where(inside, padded[places], 0).astype(np.uint8)
        p = position_probabilities(net, x)
        p *= inside[:, None, :]
        sums = p.sum(axis=0).T
        np.add.at(total, who, sums)
    return total / np.maximum(lens, 1)[:, None]


def sample(docs: DataFrame, per_label: int = SAMPLE_DOCS, stretches: int = SAMPLE_STRETCHES) -> tuple[list[bytes], list[str]]:
    """About per_label different texts of each label, chosen by a hash of the text, and hashed places in each, so that a
    text that is repeated counts once. Labels are few by nature."""
    labelled = docs.filter(F.col("label").isNotNull())
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n")).collect()}
    if not counts:
        return [], []
    share = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, per_label / max(1, n)))])
    unit = F.pmod(F.xxhash64("text", F.lit(1)), F.lit(1 << 30)) / float(1 << 30)
    chosen = labelled.filter(F.col("text").isNotNull() & (unit < share[F.col("label")]))
    start = lambda j: F.pmod(F.xxhash64("text", j), F.greatest(F.char_length("text") - WINDOW, F.lit(1)))
    cuts = F.transform(F.sequence(F.lit(2), F.lit(stretches + 1)), lambda j: F.substring(F.col("text"), (start(j) + 1).cast("int"), F.lit(WINDOW)))
    rows = chosen.select("label", F.explode(F.array_distinct(cuts)).alias("cut")).distinct().orderBy("label", "cut").collect()
    return [r["cut"].encode() for r in rows], [r["label"] for r in rows]


def identify(docs: DataFrame, net: Network | None, *keep: str) -> DataFrame:
    """The kept columns, lang_pred and score (the pooled probability of that language) of every document.

    A text that is null or has no letter is `und` with score 0, as is every text if no labels were there to learn from.
    Equal texts get equal labels, and of labels equally probable the first by name; very long texts are read whole, in
    passes of windows. An empty table gives an empty result; columns that aren't kept are ignored, and a kept one whose
    name is made here gives way.
    """
    rows, name, kept, schema = carried(docs, keep, "text", "lang_pred string, score double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            column = batch.column(name)
            for i, j, data, offsets in text_slices(column):
                part = batch.slice(i, j - i)
                known = [net is not None and t is not None and _LETTER.search(t) is not None for t in part.column(name).to_pylist()]
                p = pooled(net, data, offsets) if net is not None else np.zeros((j - i, 1))
                best = p.argmax(axis=1)
                pred = [net.labels[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
                score = np.where(known, np.clip(p[np.arange(len(best)), best], 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in kept), pa.array(pred, pa.string()), pa.array(score)], names=[*kept, "lang_pred", "score"])

    return rows.mapInArrow(run, schema)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    docs = docs.withColumn("held_out", F.coalesce(F.pmod(crc_of_id("doc_id"), F.lit(5)) == 0, F.lit(False)))
    net = train(*sample(docs.filter(~F.col("held_out")).select("text", F.col("lang").alias("label"))))
    return identify(docs, net, "doc_id", "held_out")
