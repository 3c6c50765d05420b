"""Phrases whose words belong together, by counts of all word n-grams from sorted suffixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retort.llm.common import LOWER, parts_for, read, released, stored, words

MAX_N, LEAST, TOP = 3, 10, 2000
#: Percent of a phrase's occurrences from which on a longer phrase stands for it.
ABSORBED = 50
NO_LANG = "und"
#: Bytes of text whose suffixes are counted together before they are shuffled, rows of a range, rows of one stack pass.
COUNTED_BYTES, RANGE_ROWS, STACK_ROWS = 4 << 20, 1 << 19, 1 << 16
#: Words whose suffixes are cut out at once.
CUT_WORDS = 1 << 18
#: Parts in which the phrases of a lang are ranked before the best of all parts are.
RANK_PARTS = 64
# Bytes that end a piece, and bytes between words.
ENDS = np.zeros(256, dtype=bool)
ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
INSIDE = ~ENDS
INSIDE[[0x20, 0x09]] = False


def gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the bytes of all slices one after the other, their offsets)."""
    lens = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)
    return data[np.arange(offsets[-1], dtype=np.int64) + np.repeat(starts - offsets[:-1], lens)], offsets


def binaries(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def suffixes(data: np.ndarray, offsets: np.ndarray, max_n: int, cut_words: int = CUT_WORDS) -> pa.ChunkedArray:
    """Of every word the words from it on in its piece, max_n at most, each with a space behind it; texts at offsets."""
    data = LOWER[data]
    starts, ends, counts = words(data, offsets, INSIDE)
    if not len(starts):
        return pa.chunked_array([], pa.large_binary())
    piece = np.cumsum(ENDS[data], dtype=np.int32)[starts]
    row = np.repeat(np.arange(len(counts)), counts)
    last = np.flatnonzero(np.append((piece[1:] != piece[:-1]) | (row[1:] != row[:-1]), True))  # last word of each piece
    until = np.repeat(last, np.diff(np.concatenate([[-1], last]))) + 1
    until = np.minimum(np.arange(len(starts)) + max_n, until)
    data = np.append(data, np.uint8(0x20))
    chunks = []
    for i in range(0, len(starts), cut_words):
        j = min(i + cut_words, len(starts))
        z = int(until[i:j].max())
        # Each word with one space behind it, so that a suffix is one slice.
        clean, begin = gathered(data, starts[i:z], ends[i:z] + 1)
        clean[begin[1:] - 1] = 0x20
        chunks.append(binaries(*gathered(clean, begin[: j - i], begin[until[i:j] - i])))
    return pa.chunked_array(chunks)


def in_order(found: pa.Array) -> np.ndarray:
    """An order by the first eight bytes: neighbours are alike, which is what compression needs."""
    offsets = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1, 8 * found.offset)
    data = np.append(np.frombuffer(found.buffers()[2], np.uint8), np.zeros(8, np.uint8))
    key, lens = np.zeros(len(found), np.uint64), np.diff(offsets)
    for i in range(8):
        key = (key << np.uint64(8)) | np.where(lens > i, data[np.minimum(offsets[:-1] + i, len(data) - 1)], 0).astype(np.uint64)
    return np.argsort(key)


def suffix_counts(docs: DataFrame, max_n: int = MAX_N) -> DataFrame:
    """suffix and n: the truncated suffixes of docs (lang, text), counted within runs of a task's texts.

    A suffix begins with its lang and a tab, and each of its words ends with a space; neither stands in words, nor in
    langs as they are written here, so one comparison of bytes orders by language, first word and what follows.
    """

    def count(lang: list, texts: list) -> Iterator[pa.RecordBatch]:
        column = pa.chunked_array(texts, pa.large_string()).combine_chunks()
        langs = pa.chunked_array(lang, pa.string()).combine_chunks()
        for name in pc.unique(langs):
            mine = column.filter(pc.equal(langs, name))
            mine = mine.combine_chunks() if isinstance(mine, pa.ChunkedArray) else mine
            _, where, body = mine.buffers()
            offsets = np.frombuffer(where, np.int64, len(mine) + 1, 8 * mine.offset)
            raw = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
            counted = suffixes(raw[offsets[0] : offsets[-1]], offsets - offsets[0], max_n).value_counts()
            if not len(counted):
                continue
            order = pa.array(in_order(counted.field(0)))
            found, n = counted.field(0).take(order), counted.field(1).take(order)
            begin = name.as_py().replace("%", "%25").replace(" ", "%20").replace("\t", "%09") + "\t"
            found = pc.binary_join_element_wise(pa.scalar(begin.encode(), pa.large_binary()), found, pa.scalar(b"", pa.large_binary()))
            yield pa.RecordBatch.from_arrays([found.cast(pa.binary()), n.cast(pa.int64())], names=["suffix", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, texts, held = [], [], 0
        for batch in released(batches):
            for i in range(batch.num_rows):
                text = batch.column("text").slice(i, 1).cast(pa.large_string())
                if held and held + text.nbytes > COUNTED_BYTES:
                    yield from count(lang, texts)
                    lang, texts, held = [], [], 0
                lang.append(batch.column("lang").slice(i, 1))
                texts.append(text)
                held += text.nbytes
        if texts:
            yield from count(lang, texts)

    rows = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "suffix binary, n long")


class PrefixStack:
    """Counts of all prefixes of suffixes that come in order, with one entry for the lang and each word of the one at hand.

    A suffix that shares its first d entries with the one before it ends the prefixes of more, which are given out if they
    are frequent; the shared ones stay open. Those open at the first and the last suffix of a range may go on in another
    range and are given out whatever their count, marked as parts. Rows are handled by the batch.
    """

    def __init__(self, max_n: int, least: int) -> None:
        self.depth, self.least = max_n + 1, least
        self.last: pa.Array | None = None  # the last row's suffix
        self.open = [0] * self.depth
        self.first = [True] * self.depth  # whether the open prefix began with the range

    def add(self, suffix: pa.Array, n: np.ndarray, end: bool = False) -> Iterator[pa.RecordBatch]:
        fresh = self.last is None
        if not fresh:  # the last row once more, with nothing of its own, carries what is open
            suffix, n = pa.concat_arrays([self.last, suffix]), np.concatenate([[0], n])
        if not len(suffix):
            return
        offsets = np.frombuffer(suffix.buffers()[1], np.int64, len(suffix) + 1, 8 * suffix.offset)
        data = np.frombuffer(suffix.buffers()[2], np.uint8)
        here = data[offsets[0] : offsets[-1]]
        marks = offsets[0] + np.flatnonzero((here == 0x20) | (here == 0x09))  # the ends of the lang and of the words
        mark = np.searchsorted(marks, offsets)
        size, mark = np.diff(mark), mark[:-1]
        shared = self.shared(data, offsets, marks, mark)
        for k in range(1, self.depth + 1):
            at = np.flatnonzero(shared < k)
            total = np.add.reduceat(n, at)
            has = size[at] >= k
            if not fresh:
                total[0] += self.open[k - 1]
            part = np.zeros(len(at), bool)
            part[0] = fresh or self.first[k - 1]
            self.open[k - 1], self.first[k - 1] = int(total[-1]), bool(part[-1])
            part[-1] |= end
            give = has & (part | (total >= self.least))
            give[-1] &= end
            rows = at[give]
            if len(rows):
                prefix = binaries(*gathered(data, offsets[rows], marks[mark[rows] + k - 1]))
                yield pa.RecordBatch.from_arrays(
                    [prefix.cast(pa.large_string()).cast(pa.string()), pa.array(np.full(len(rows), k - 1, np.int32)), pa.array(total[give]), pa.array(part[give])],
                    names=["prefix", "words", "n", "part"],
                )
        self.last = suffix.slice(len(suffix) - 1)

    @staticmethod
    def shared(data: np.ndarray, offsets: np.ndarray, marks: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """Of each row how many of its first entries it shares with the row before; none for the first."""
        starts, lens = offsets[:-1], np.diff(offsets)
        both = np.minimum(lens[1:], lens[:-1])
        flat = np.concatenate([[0], np.cumsum(both)]).astype(np.int64)
        shared = np.zeros(len(lens), np.int64)
        if len(lens) > 1:
            inside = np.arange(flat[-1], dtype=np.int64) - np.repeat(flat[:-1], both)
            differ = data[np.repeat(starts[1:], both) + inside] != data[np.repeat(starts[:-1], both) + inside]
            common = np.minimum(np.minimum.reduceat(np.where(differ, inside, len(data)), flat[:-1]), both)  # no suffix is empty
            shared[1:] = np.searchsorted(marks, starts[1:] + common) - mark[1:]
        return shared


def phrase_counts(counted: DataFrame, max_n: int = MAX_N, least: int = LEAST) -> DataFrame:
    """lang, phrase, words and n of every phrase of at most max_n words that occurs `least` times or more; and of the
    phrase of no words the number of all words of the lang.

    The suffixes (suffix, n) go to ranges by language and first word; a word that begins many is split by the words
    behind it. Each range is sorted in reverse and passed over once; of what crosses the ranges' ends, a few prefixes
    a range, the parts are summed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack, held, rows = PrefixStack(max_n, least), [], 0

        def taken() -> tuple[pa.Array, np.ndarray]:
            suffix = pa.concat_arrays([b.column("suffix") for b in held]) if held else pa.array([], pa.binary())
            return suffix.cast(pa.large_binary()), np.concatenate([np.zeros(0, np.int64), *[b.column("n").to_numpy(zero_copy_only=False) for b in held]])

        for batch in released(batches):
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= STACK_ROWS:
                yield from stack.add(*taken())
                held, rows = [], 0
        yield from stack.add(*taken(), end=True)

    ranged = counted.repartitionByRange(parts_for(counted.count(), RANGE_ROWS), "suffix")
    found = stored(ranged.sortWithinPartitions(F.desc("suffix")).mapInArrow(run, "prefix string, words int, n long, part boolean"))
    parts = found.filter("part").groupBy("prefix", "words").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    whole = found.filter("NOT part").drop("part").unionByName(parts)
    lang = F.substring_index("prefix", "\t", 1)
    for written, meant in (("%20", " "), ("%09", "\t"), ("%25", "%")):
        lang = F.replace(lang, F.lit(written), F.lit(meant))
    phrase = F.when(F.col("words") == 0, F.lit("")).otherwise(F.substring_index("prefix", "\t", -1))
    return whole.select(lang.alias("lang"), phrase.alias("phrase"), "words", "n")


def subphrase(first: int | Column, size: int | Column) -> Column:
    return F.array_join(F.slice("tokens", first, size), " ")


def scored(phrases: DataFrame, max_n: int = MAX_N) -> DataFrame:
    """lang, phrase, words, a, l, r and score of the phrases of several words: of the cut with the lowest score, the first
    of such ones. The counts of the parts are joined; a part is at least as frequent as the phrase, so none is missing."""
    several = phrases.filter("words > 1").withColumn("tokens", F.split("phrase", " "))
    cuts = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cut = several.select("lang", "phrase", "words", F.col("n").alias("a"), "tokens", cuts)
    cut = cut.select("lang", "phrase", "words", "a", "k", subphrase(1, F.col("k")).alias("left"), subphrase(F.col("k") + 1, F.col("words")).alias("right"))
    count = lambda name, n: phrases.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    cut = cut.join(count("left", "l"), ["lang", "left"]).join(count("right", "r"), ["lang", "right"])
    exact = F.expr("(1000000 * cast(a AS decimal(15,0)) * cast(a AS decimal(15,0))) div (cast(l AS decimal(15,0)) * cast(r AS decimal(15,0)))")
    best = F.min(F.struct(exact.alias("score"), "k", "l", "r")).alias("best")
    return cut.groupBy("lang", "phrase", "words", "a").agg(best).select("lang", "phrase", "words", "a", "best.l", "best.r", "best.score")


def unabsorbed(candidates: DataFrame, absorbed: int = ABSORBED) -> DataFrame:
    """The candidates (lang, phrase, words, a) whose words aren't mostly those of a longer one, dropped or not."""
    inner = candidates.filter("words > 2").withColumn("tokens", F.split("phrase", " "))
    sizes = F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size")
    inner = inner.select("lang", "a", "tokens", "words", sizes)
    inner = inner.select("lang", "a", "tokens", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("first"))
    longer = inner.groupBy("lang", subphrase(F.col("first"), F.col("size")).alias("phrase")).agg(F.max("a").alias("longer"))
    return candidates.join(longer, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("longer") < absorbed * F.col("a"), F.lit(True))).drop("longer")


def collocations(docs: DataFrame, max_n: int = MAX_N, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: the best phrases of each language of docs (lang, text).

    A text, A-Z lowered, is cut into pieces at punctuation and line ends and these into words at spaces and tabs. Phrases
    of 2 to max_n words that occur `least` times or more are scored by 1,000,000 a^2 / (l r), exactly. Null langs are
    `und`, null and empty texts have no words, very long texts are read whole and repeated rows count again; texts without
    frequent phrases and empty tables give an empty result; other columns are ignored.
    """
    counted = stored(suffix_counts(docs.select("lang", "text"), max_n))
    phrases = stored(phrase_counts(counted, max_n, least))
    total = phrases.filter("words = 0").select("lang", "n")
    kept = unabsorbed(stored(scored(phrases, max_n)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = kept.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    best = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).filter(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return best.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents", "lang", "text"))


OP13_SQL = rf"""
WITH p AS (SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS t FROM documents),
w AS (SELECT lang, row_number() OVER () AS piece, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM p),
total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
x AS (SELECT lang, piece, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w),
y AS (SELECT lang, [x, lead(x, 1) OVER o, lead(x, 2) OVER o] AS y FROM x WINDOW o AS (PARTITION BY piece ORDER BY i)),
g AS (SELECT lang, k, list_slice(y, 1, k) AS g FROM y, range(1, {MAX_N} + 1) AS s(k) WHERE y[k] IS NOT NULL),
f AS (SELECT lang, k, g, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= {LEAST}),
c AS (SELECT * FROM f WHERE k > 1),
cut AS (SELECT lang, k, g, f, unnest(range(1, k)) AS cut_at FROM c),
s AS (SELECT cut.lang, cut.k, cut.g, cut.f AS a, cut_at, x.f AS l, y.f AS r, ((1000000::HUGEINT * cut.f * cut.f) // (x.f::HUGEINT * y.f))::BIGINT AS score
 FROM cut JOIN f x ON x.lang = cut.lang AND x.g = list_slice(cut.g, 1, cut_at) JOIN f y ON y.lang = cut.lang AND y.g = list_slice(cut.g, cut_at + 1, cut.k)),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut_at) = 1),
i AS (SELECT lang, f, g, size, unnest(range(1, k - size + 2)) AS first FROM (SELECT *, unnest(range(2, k)) AS size FROM c)),
longer AS (SELECT lang, list_slice(g, first, first + size - 1) AS g, max(f) AS most FROM i GROUP BY ALL),
kept AS (SELECT b.*, array_to_string(b.g, ' ') AS phrase FROM b LEFT JOIN longer USING (lang, g) WHERE most IS NULL OR 100 * most < {ABSORBED} * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= {TOP}
"""
