"""Near-duplicate classes: DartMinHash signatures, banded joining, exact verification, connected classes."""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retort.llm.common import ALNUM, LOWER, mix, read, released, salt, stored, text_slices, windows, word_hashes, words

#: Words of a shingle and the least Jaccard similarity of two texts' shingles that links them.
SHINGLE, LEAST = 5, 0.8
BANDS, ROWS = 25, 5
COORDINATES = BANDS * ROWS
#: Pairs for each row of an index from which on stars are tried once more, half the hubs of a token in a round of these, and the
#: share of pairs linked that makes another round worth it. What they leave is joined exactly, so neither changes the result.
CROWDED, HUBS, WORTH = 16, 2, 0.1
#: Ids that may be broadcast as a filter; beyond, Spark shuffles.
BROADCAST_IDS = 500_000


def shingles(data: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct shingle hashes, row by row and ascending; how often each occurs; distinct shingles of each row)."""
    data = LOWER[data]
    starts, ends, counts = words(data, offsets, ALNUM)
    runs, n = windows(word_hashes(data, starts, ends), counts, k)
    rows = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((runs, rows))
    runs, rows = runs[order], rows[order]
    new = np.ones(len(runs), dtype=bool)
    new[1:] = (runs[1:] != runs[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    return runs[at], np.diff(np.append(at, len(runs))), np.bincount(rows[at], minlength=len(n))


def dart_minhash(elements: np.ndarray, weights: np.ndarray, counts: np.ndarray, coordinates: int = COORDINATES, scale: float = 1.0) -> np.ndarray:
    """uint32 (rows, coordinates): the dart that each row's weighted set keeps in each coordinate; weights are positive.

    Over an element's weight axis lie the regions [0, 1), [1, 2), [2, 4), [4, 8) ... Into each region falls a Poisson
    process of darts along a rank axis, as dense as the region is wide, drawn by hashing element, region and turn: the
    same for every set. A dart has a rank, a height in its region and a coordinate; a set owns the darts below its
    weight. A coordinate keeps the earliest, so two sets agree in it with the probability of their weighted Jaccard
    similarity. Darts are thrown only up to the rank by which every coordinate should be filled; rows in which one is
    not are thrown again up to twice that rank. Rows without elements keep zeros.
    """
    n = len(counts)
    out = np.full(n * coordinates, np.uint64(0xFFFFFFFFFFFFFFFF))
    rows = np.repeat(np.arange(n), counts)
    total = np.bincount(rows, weights=weights, minlength=n)
    reach = scale * (coordinates * np.log(coordinates) + 2 * coordinates) / np.maximum(total, 1e-12)
    region, low, width = 0, 0.0, 1.0
    while len(owned := np.flatnonzero(weights > low)):
        state = mix(elements[owned] + salt(region, 11))
        row, weight = rows[owned], weights[owned]
        rank = np.zeros(len(owned))
        limit = reach[row]
        while len(state):
            state = mix(state + np.uint64(0x9E3779B97F4A7C15))
            rank = rank - np.log(((state >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / width
            on = rank < limit
            state, rank, row, weight, limit = state[on], rank[on], row[on], weight[on], limit[on]
            dart = mix(state ^ salt(12))
            height = low + width * (dart >> np.uint64(32)).astype(np.float64) / 2.0**32
            hit = height < weight
            where = row[hit] * coordinates + ((dart[hit] & np.uint64(0xFFFFFFFF)) * np.uint64(coordinates) >> np.uint64(32)).astype(np.int64)
            value = ((rank[hit] / limit[hit] * 2.0**40).astype(np.uint64) << np.uint64(24)) | (mix(dart[hit] ^ salt(13)) >> np.uint64(40))
            np.minimum.at(out, where, value)
        region, low, width = region + 1, low + width, 1.0 if region == 0 else 2 * width
    out = out.reshape(n, coordinates)
    bare = np.flatnonzero((out == np.uint64(0xFFFFFFFFFFFFFFFF)).any(axis=1) & (counts > 0))
    marks = (out & np.uint64(0xFFFFFF)).astype(np.uint32)
    marks[counts == 0] = 0
    if len(bare):
        mine = np.isin(rows, bare)
        marks[bare] = dart_minhash(elements[mine], weights[mine], counts[bare], coordinates, 2 * scale)
    return marks


def band_keys(marks: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(marks), BANDS), np.uint64)
    for b in range(BANDS):
        for r in range(ROWS):
            keys[:, b] += marks[:, b * ROWS + r].astype(np.uint64) * (salt(r, 14) | np.uint64(1))
        keys[:, b] = mix(keys[:, b] + salt(b, 15))
    return keys.view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash (by which a row is found again), set_key (of the shingles, or of a text without words) and bands
    array<long> of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for i, j, data, offsets in text_slices(batch.column("text")):
                found, _, n = shingles(data, offsets)
                marks = dart_minhash(found, np.ones(len(found)), n)  # links are by distinct shingles, so each weighs the same
                ends = np.cumsum(n)
                keys = [hashlib.md5(b"s" + found[e - k : e].tobytes() if k else b"t" + data[a:z].tobytes()).digest() for e, k, a, z in zip(ends, n, offsets, offsets[1:], strict=False)]
                bands = [x.tolist() if k else [] for x, k in zip(band_keys(marks), n, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), batch.column("text_hash").slice(i, j - i), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    names=["doc_id", "text_hash", "set_key", "bands"],
                )

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, "doc_id long, text_hash long, set_key binary, bands array<long>")


def sets_of(wanted: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and the bytes of its ascending shingles for the wanted nodes (node); made again from the texts, and stored."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for i, j, data, offsets in text_slices(batch.column("text")):
                found, _, n = shingles(data, offsets)
                ends = np.cumsum(n)
                parts = [found[e - k : e].tobytes() for e, k in zip(ends, n, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(i, j - i), pa.array(parts, pa.binary())], names=["node", "shingles"])

    wanted = stored(wanted.join(nodes.select("node", "doc_id", "text_hash"), "node").select("node", F.col("doc_id").alias("_doc"), "text_hash"))
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("_hash"))
    met = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["_doc"]) & (texts["_hash"] == wanted["text_hash"])).select("node", "text")
    return stored(met.mapInArrow(sets, "node long, shingles binary")).dropDuplicates(["node"])


def similarities(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b and the exact Jaccard similarity of the shingles of each pair of nodes."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                out.append(both / max(1, len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.float64())], names=["a", "b", "similarity"])

    left, right = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(compare, "a long, b long, similarity double")


def ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()


def prefixes(sets: DataFrame) -> DataFrame:
    """token, node, n, pos and indexed: of each set (node, shingles) the shingles of which a linked set must share one.

    With shingles in one order, two sets of n >= m elements and a Jaccard similarity of t at least share one among the
    first n - ceil(t n) + 1 of the one and m - ceil(2t / (1 + t) m) + 1 (the indexed) of the other, and the first that
    they share leaves them enough elements to share the rest. Rare shingles come first, so that what a whole family of
    texts has in common lies behind, and what meets is mostly linked. Shingles are counted exactly: counters of a fixed
    number fill up as the table grows, until rare shingles can't be told from common ones. Those of one set alone meet
    nothing; they take the first positions and aren't given.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, found in zip(batch.column("node").to_pylist(), batch.column("shingles").to_pylist(), strict=True):
                found = np.frombuffer(found, np.int64)
                n = len(found)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.full(n, node)), pa.array(np.full(n, n))], names=["token", "node", "n"])

    every = sets.mapInArrow(run, "token long, node long, n long")
    counts = every.groupBy("token").agg(F.count("*").alias("c")).filter("c > 1")
    of_node = Window.partitionBy("node")
    alone = F.col("n") - F.count("*").over(of_node)
    placed = every.join(counts, "token").withColumn("pos", alone + F.row_number().over(of_node.orderBy("c", "token")) - 1)
    probe = F.col("n") - F.ceil(LEAST * F.col("n") - 1e-9) + 1
    index = F.col("n") - F.ceil(2 * LEAST / (1 + LEAST) * F.col("n") - 1e-9) + 1
    return placed.filter(F.col("pos") < probe).select("token", "node", "n", "pos", (F.col("pos") < index).alias("indexed"))


def may_link(x: str, y: str) -> F.Column:
    """Whether the larger set x may be linked with the smaller y, for which the token stands in its indexed part."""
    c = lambda side, name: F.col(f"{side}.{name}")
    larger = (c(x, "n") > c(y, "n")) | ((c(x, "n") == c(y, "n")) & (c(x, "node") > c(y, "node")))
    left = F.least(c(x, "n") - c(x, "pos"), c(y, "n") - c(y, "pos"))
    enough = (c(y, "n") >= c(x, "n") * LEAST - 1e-6) & (left >= (c(x, "n") + c(y, "n")) * (LEAST / (1 + LEAST)) - 1e-6)
    return c(y, "indexed") & (c(x, "part") != c(y, "part")) & larger & enough


def several_parts(tokens: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    """The rows of tokens (node, key) with the node's part, as far as rows of one key have several parts."""
    placed = tokens.join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
    several = placed.groupBy(key).agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low <> high").select(key)
    return stored(placed.join(several, key, "left_semi"))


def crowding(tokens: DataFrame) -> tuple[int, int]:
    """(rows of tokens, pairs of rows of one token and different parts of which one is indexed): the most there is to join."""
    own = tokens.groupBy("token", "part").agg(F.count("*").alias("n"), F.count_if("indexed").alias("k"))
    pairs = own.groupBy("token").agg(F.sum("n").alias("rows"), (F.sum("n") * F.sum("k") - F.sum(F.col("n") * F.col("k"))).alias("pairs"))
    return tuple(pairs.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("pairs"), F.lit(0))).first())


def prefix_pairs(tokens: DataFrame, turn: int | None = None) -> DataFrame:
    """a, b: the pairs of sets of different parts that share a token where they may be linked; with a turn, of each token
    only those with 2 * HUBS of its sets, others in each turn: a bounded number of pairs a row."""
    row = F.struct("node", "part", "n", "pos", "indexed")
    if turn is not None:
        ranked = [F.struct(F.xxhash64("node", "token", F.lit(turn * HUBS + i)).alias("h"), row.alias("hub")) for i in range(HUBS)]  # others for each token
        hubs = tokens.groupBy("token").agg(*[f(r).alias(f"{f.__name__}{i}") for i, r in enumerate(ranked) for f in (F.min, F.max)])
        hubs = hubs.select("token", F.explode(F.array_distinct(F.array(*[f"{f}{i}.hub" for i in range(HUBS) for f in ("min", "max")]))).alias("y"))
        met = tokens.select("token", row.alias("x")).join(hubs, "token").filter(may_link("x", "y") | may_link("y", "x"))
    else:
        met = tokens.select("token", row.alias("x")).join(tokens.filter("indexed").select("token", row.alias("y")), "token").filter(may_link("x", "y"))
    return met.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """node, part: of every node of the edges (a, b), the least node that it is connected with.

    Each round every part takes the least neighbouring part as its parent, parents are followed once more, and the edges are
    drawn between the new parts, until none is left; tables are written after each round.
    """
    edges = stored(edges.filter("a <> b").distinct())
    labels = stored(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("part", F.col("node")))
    while edges.limit(1).count():
        both = edges.union(edges.select("b", "a"))
        parents = stored(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("parent")))
        up = parents.select(F.col("a").alias("parent"), F.col("parent").alias("grand"))
        parents = stored(parents.join(up, "parent", "left").select("a", F.coalesce("grand", "parent").alias("parent")))
        labels = stored(labels.join(parents.withColumnRenamed("a", "part"), "part", "left").select("node", F.coalesce("parent", "part").alias("part")))
        low, high = parents.select("a", F.col("parent").alias("x")), parents.select(F.col("a").alias("b"), F.col("parent").alias("y"))
        edges = stored(edges.join(low, "a").join(high, "b").filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    return labels


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, class_id (the least doc_id of the class) and is_representative (its own) of every row of docs.

    Texts are linked if at least 0.8 of their distinct shingles of five words (runs of letters and digits, A-Z lowered)
    are common; a text of fewer words is one shingle; one of no words, null and empty among them, is linked with equal
    texts only. Classes are what links connect. Candidates come from the bands: each bucket links its members with its
    hub, the member of least hash. The texts of buckets that still hold several classes are then joined by the rare
    shingles that a link must share, an exact way for whatever the hub leaves: first each with one text of each of its
    shingles, again as long as many pairs are left and that links many, then all pairs of different classes. Equal shingle sets are one node
    throughout, so copies make no pairs. Rows that repeat a doc_id are one document only if their texts are equal; others
    are linked by their texts alone. An id of several texts names the class of one of these; a class that no id is left
    to name, as one without any id, has a hash above all ids as its class_id, and all its rows are representatives. Very long texts are one
    set of shingles each; an empty table gives an empty result; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = stored(signatures(docs))
    other = F.lit(1 << 62) + F.pmod(F.xxhash64("set_key"), F.lit(1 << 61))
    nodes = stored(rows.groupBy("set_key").agg(F.min(F.coalesce("doc_id", other)).alias("node"), F.min(F.struct("doc_id", "text_hash")).alias("at"), F.first("bands").alias("bands")))
    shared = stored(nodes.groupBy("node").agg(F.count("*").alias("n"), F.min("set_key").alias("first")).filter("n > 1"))
    if shared.limit(1).count():  # ids of several texts: one of these is the id's node, the others have nodes of their own
        nodes = stored(nodes.join(shared, "node", "left").withColumn("node", F.when(F.col("set_key") != F.col("first"), other).otherwise(F.col("node"))).drop("n", "first"))
    nodes = nodes.select("set_key", "node", "at.doc_id", "at.text_hash", "bands")
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    order = F.struct(F.xxhash64("node", F.lit(16)).alias("h"), F.col("node").alias("hub"))
    hubs = buckets.groupBy("bucket").agg(F.count("*").alias("size"), F.min(order).alias("first")).filter("size > 1")
    buckets = stored(buckets.join(hubs, "bucket").select("bucket", "node", "first.h", "first.hub"))
    best = buckets.filter("node <> hub").groupBy("node").agg(F.min(F.struct("h", "hub")).alias("best"))
    pairs = stored(best.select(F.least("best.hub", "node").alias("a"), F.greatest("best.hub", "node").alias("b")))
    met = [stored(similarities(pairs, sets_of(ends(pairs), docs, nodes)))]

    def links() -> DataFrame:
        return functools.reduce(DataFrame.union, met).filter(F.col("similarity") >= LEAST).select("a", "b")

    def unmet(found: DataFrame) -> DataFrame:
        found = stored(found)  # distinct pairs are looked up, not each pair once for every shingle that it shares
        return stored(found.join(functools.reduce(DataFrame.union, met).select("a", "b"), ["a", "b"], "left_anti"))

    parts = connected(links())
    still = several_parts(buckets.select("bucket", "node"), parts, "bucket").select("node").distinct()
    sets = sets_of(still, docs, nodes)
    tokens = several_parts(stored(prefixes(sets)), parts, "token")
    for turn in itertools.count():
        held, most = crowding(tokens)
        stars = not turn or most > CROWDED * held  # pairs that link grow with the square of a family; stars link it by a few for each text
        met.append(stored(similarities(unmet(prefix_pairs(tokens, turn if stars else None)), sets)))
        tried, linked = met[-1].agg(F.count("*"), F.count_if(F.col("similarity") >= LEAST)).first()
        if linked:
            parts = connected(links())
        if not stars:
            break
        tokens = several_parts(tokens.drop("part"), parts, "token")
        if linked < WORTH * tried or not tried:
            met.append(stored(similarities(unmet(prefix_pairs(tokens)), sets)))
            parts = connected(links())
            break
    of_key = stored(nodes.select("set_key", "node").join(parts, "node", "left").select("set_key", F.coalesce("part", "node").alias("class_id")))
    found = rows.select("doc_id", "text_hash", "set_key").join(of_key, "set_key")
    best = (F.col("class_id") >= 1 << 62) | F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False))
    return found.select("doc_id", "text_hash", "class_id", best.alias("is_representative"))


def representatives(docs: DataFrame) -> DataFrame:
    """One row of docs for each class, with all its columns: of the least doc_id, null last, then of the least text hash.

    Rows alike in id and text are interchangeable, and one of them stays; null counts as empty text.
    """
    found = classes(docs).groupBy("class_id", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash", "n"))
    kept = stored(found.groupBy("class_id").agg(first.alias("first")).select(F.col("first.doc_id").alias("_doc"), F.col("first.text_hash").alias("_hash"), F.col("first.n").alias("_n")))
    small = kept.count() <= BROADCAST_IDS
    text_hash = F.xxhash64(F.coalesce(docs["text"], F.lit("")))

    def rows_of(some: DataFrame) -> DataFrame:
        some = F.broadcast(some) if small else some
        return docs.join(some, docs["doc_id"].eqNullSafe(some["_doc"]) & (text_hash == some["_hash"]), "left_semi")

    out = rows_of(kept.filter("_n = 1"))
    if kept.filter("_n > 1").limit(1).count():
        again = rows_of(kept.filter("_n > 1")).withColumn("_hash", text_hash).dropDuplicates(["doc_id", "_hash"]).drop("_hash")
        out = out.unionByName(again)
    return out


def op5_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(read(spark, sf_dir, "documents", "doc_id", "text")).drop("text_hash")


#: Exact classes by an inverted list of shingles, for tables of a size at which that is cheap.
OP5_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN ['text ' || t] ELSE list_transform(range(0, greatest(len(w) - 4, 1)), lambda i: array_to_string(list_slice(w, i + 1, i + 5), ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE k >= 0.8 * (x.n + y.n - k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT a AS doc_id, min(b) AS class_id, a = min(b) AS is_representative FROM r GROUP BY a
"""
