"""Near duplicates, scoring, decontamination, sharding, packing and the pipeline against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from retort.llm import decontamination, neardup, packing, scoring, sharding
from retort.llm.common import read
from retort.llm.tokenize import of_process

SMALL = "/root/testdata/sf0.001"


def test_dart_minhash_estimates_weighted_similarity():
    r = np.random.default_rng(0)
    elements = r.integers(0, 2**63, 100).astype(np.uint64)
    for low, high in ((0.5, 6), (1, 1.0001), (0.1, 40)):
        true, found = [], []
        for _ in range(40):
            a, b = r.uniform(low, high, 100), r.uniform(low, high, 100)
            b[:30] = a[:30]
            marks = neardup.dart_minhash(np.concatenate([elements, elements]), np.concatenate([a, b]), np.array([100, 100]))
            true.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
            found.append((marks[0] == marks[1]).mean())
        assert np.mean(found) == pytest.approx(np.mean(true), abs=0.03)


def test_signatures_fill_every_coordinate():
    marks = neardup.dart_minhash(np.array([5, 9, 9], np.uint64), np.ones(3), np.array([1, 0, 2]))
    assert (marks[0] > 0).mean() > 0.99 and not marks[1].any()


def shingle_classes(rows):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    sets = {}
    for i, t in rows:
        w = word.findall("".join(c.lower() if c.isascii() else c for c in t))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else {("text", t)}
    part = {i: i for i in sets}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                part[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def test_classes_against_all_pairs(spark):
    r = random.Random(11)
    base = [f"b{r.randrange(10**6)}" for _ in range(120)]
    rows = [(0, " ".join(base)), (1, " ".join(base))]
    for i in range(2, 120):  # copies with a few to very many edits, some of them chains
        src = rows[r.randrange(len(rows))][1].split() if i % 3 else list(base)
        for _ in range(r.choice((0, 1, 2, 4, 8))):
            src[r.randrange(len(src))] = f"e{r.randrange(10**6)}"
        rows.append((i, " ".join(src)))
    rows += [(200, ""), (201, ""), (202, "..."), (203, "one two"), (204, "One, two!"), (205, "three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {x.doc_id: x.class_id for x in neardup.classes(docs).collect()}
    assert got == shingle_classes(rows)


def test_copies_whose_repeat_counts_differ(spark):
    rows = []
    for k in range(40):  # 60 words once and a line of 24, fifty times or once, with one word replaced
        once, line = [f"o{k}x{i}" for i in range(64)], [f"l{k}x{i}" for i in range(24)]
        rows.append((2 * k, " ".join(once + line * 50)))
        rows.append((2 * k + 1, " ".join([*once[:30], "new", *once[31:], *line, *line[:4]])))
    expected = shingle_classes(rows)
    assert sum(expected[2 * k + 1] == 2 * k for k in range(40)) == 40
    got = {x.doc_id: x.class_id for x in neardup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == expected


def test_prefixes_count_shingles_exactly(spark):
    """Shingles of equal upper bits, of which counters would make one, and those that only one set holds."""
    common, pair, alone = np.array([7], np.uint64), np.array([3, 4], np.uint64), np.arange(100, 117, dtype=np.uint64)
    sets = {1: np.concatenate([pair, common, alone]), 2: np.concatenate([pair, common, alone + 100]), 3: np.concatenate([common, alone + 200]), 4: np.concatenate([pair, common])}
    rows = neardup.prefixes(spark.createDataFrame([(k, bytearray(np.sort(v).tobytes())) for k, v in sets.items()], "node long, shingles binary")).collect()
    assert not {r.node for r in rows} & {1, 2, 3}  # their first 5 of 20 are their own: nothing is linked with them
    assert sorted((r.token, r.node, r.n, r.pos, r.indexed) for r in rows) == [(3, 4, 3, 0, True)]


def test_links_inside_large_buckets(spark):
    """Variants of one template, 0.794 alike, each with a copy that is 0.802 like it alone."""
    r, base = random.Random(5), [f"t{i}" for i in range(181)]
    rows = []
    for k in range(1000):
        text = base + [f"v{k}x{i}" for i in range(23)]
        at = r.randrange(5, 150)
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join([*text[:at], *(f"c{k}x{i}" for i in range(18)), *text[at + 18 :]]))]
    assert shingle_classes(rows[:40]) == {i: i // 2 * 2 for i in range(40)}
    got = {x.doc_id: x.class_id for x in neardup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: c for i, c in got.items() if c != i // 2 * 2} == {}


def test_stars_link_a_family_before_all_pairs_meet(spark, monkeypatch):
    """Texts of which all pairs are linked, and that the bands left apart: nothing is left to the join of all pairs."""
    rows = [(k, " ".join([*(f"t{i}" for i in range(100)), *(f"v{k}x{i}" for i in range(4))])) for k in range(15)]
    connected, prefix_pairs, found, rounds = neardup.connected, neardup.prefix_pairs, [], []

    def apart(edges):
        found.append(connected(edges))
        return found[-1].limit(0) if len(found) == 1 else found[-1]

    def counted(tokens, turn=None):
        pairs = prefix_pairs(tokens, turn)
        rounds.append((turn, pairs.count()))
        return pairs

    monkeypatch.setattr(neardup, "connected", apart)
    monkeypatch.setattr(neardup, "prefix_pairs", counted)
    assert {x.class_id for x in neardup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {0}
    assert rounds[0][0] == 0 and rounds[-1] == (None, 0)


def test_one_row_stays_of_each_class(spark):
    near = " ".join(f"w{i}" for i in range(80))
    rows = [(1, near, "a"), (1, near, "b"), (5, near + " more", "c"), (None, "a text of no id at all here", "d"), (None, "a text of no id at all here", "e"), (7, None, "f"), (8, "", "g"), (9, "alone in the world", "h")]
    kept = neardup.representatives(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in kept) == [("1", near), ("7", ""), ("9", "alone in the world"), ("None", rows[3][1])]


def test_an_id_of_two_texts_keeps_the_links_of_both(spark):
    text = lambda k, side: " ".join(f"{side}{k}w{i}" for i in range(60))
    rows = []
    for k in range(40):
        rows += [(k, text(k, "a")), (k, text(k, "b")), (1000 + k, text(k, "a") + " more"), (2000 + k, text(k, "b") + " more")]
    found = neardup.classes(spark.createDataFrame(rows, "doc_id long, text string")).withColumnRenamed("text_hash", "h")
    hashes = spark.createDataFrame(rows, "doc_id long, text string").select("text", F.xxhash64("text").alias("h")).distinct()
    part = {r.text: r.class_id for r in found.join(hashes, "h").collect()}
    assert len(part) == 160 and len(set(part.values())) == 80
    assert all(part[text(k, s)] == part[text(k, s) + " more"] for k in range(40) for s in "ab")


def test_unlinked_texts_of_one_id_all_stay(spark):
    texts = [" ".join(f"{s}{i}" for i in range(30)) for s in "xyz"]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[2]), (1, texts[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in neardup.representatives(docs).collect()) == sorted(rows[:3])
    found = neardup.classes(docs).collect()
    assert len({r.class_id for r in found}) == 3 and all(r.is_representative for r in found)


def test_connected(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60) if i % 20 != 19] + [(100 + r.randrange(50), 100 + r.randrange(50)) for _ in range(40)]
    part = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            part[a] = part[b] = min(part[a], part[b])
    got = {x.node: x.part for x in neardup.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: part[x] for e in edges if e[0] != e[1] for x in e}


def katz(rows):
    """(score, base, known, tokens) of each document, from dictionaries that know nothing of partitions."""
    word = re.compile(rb"[^\x20\x09-\x0D]+")
    texts = {i: [*word.findall(t.encode().lower() if t.isascii() else bytes(b + 32 if 65 <= b <= 90 else b for b in t.encode())), None] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    one, two = collections.Counter(), collections.Counter()
    for i, t in texts.items():
        if not held[i]:
            one.update(t)
            two.update(zip([None, *t], t, strict=False))
    n, k = sum(one.values()), scoring.K
    of = lambda c: np.array([sum(v == r for v in c.values()) for r in range(1, k + 2)])
    d1, d2 = scoring.discounts(of(one)), scoring.discounts(of(two))
    d = lambda ds, c: ds[c] if c <= k else 1.0
    uni = scoring.Unigrams.of(n, len(one), of(one))
    p1 = {w: float(uni.p(np.array([c]))[0]) for w, c in one.items()}
    assert sum(p1.values()) + uni.unknown == pytest.approx(1)
    after = collections.defaultdict(dict)
    for (h, w), c in two.items():
        after[h][w] = c
    total, alpha = {}, {}
    for h, ws in after.items():
        total[h] = one[h] + all(c > k for c in ws.values())
        alpha[h] = (1 - sum(d(d2, c) * c for c in ws.values()) / total[h]) / (1 - sum(p1[w] for w in ws))
    out = {}
    for i, t in texts.items():
        score = base = 0.0
        for h, w in zip([None, *t], t, strict=False):
            c = two.get((h, w), 0)
            score += math.log10(d(d2, c) * c / total[h]) if c else math.log10(alpha.get(h, 1.0) * p1.get(w, uni.unknown))
            base += math.log10((one[w] + 1) / (n + len(one) + 1))
        out[i] = (score, base, sum(one[w] > 0 for w in t), len(t))
    return out


@pytest.mark.parametrize("parts", [1 << 30, 100_000, 20_000])
def test_katz_scores_against_dictionaries(spark, monkeypatch, parts):
    monkeypatch.setattr(scoring, "PART_BYTES", parts)
    docs = read(spark, SMALL, "documents", "doc_id", "text")
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    expected = katz(rows)
    for r in scoring.op6_scoring(spark, SMALL).collect():
        score, base, known, tokens = expected[r.doc_id]
        assert (r.n_known, r.n_tokens) == (known, tokens)
        assert r.score == pytest.approx(score, rel=1e-9) and r.base_score == pytest.approx(base, rel=1e-9)


@pytest.mark.parametrize("parts", [1 << 30, 2_000])
def test_split_contexts_without_discounted_counts(spark, monkeypatch, parts):
    """A context of which every successor is frequent, split or not: one token is set aside for the others."""
    monkeypatch.setattr(scoring, "PART_BYTES", parts)
    rows = [(i, "hot " + ("hot cold " * 5 if i % 2 else "hot warm ") * 20 + ("hot new" if i == 3 else "")) for i in range(60)]
    rows = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 7 == 2 or i != 3]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("held_out", F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2)
    expected = katz(rows)
    for r in scoring.katz_scores(docs).collect():
        assert r.score == pytest.approx(expected[r.doc_id][0], rel=1e-9)


@given(st.lists(st.lists(st.integers(0, 2**40), max_size=20), min_size=1, max_size=3))
@settings(max_examples=30, deadline=None)
def test_pack_round_trip(arrays):
    got = scoring.unpack(scoring.pack(**{f"a{i}": np.array(a, np.int64) for i, a in enumerate(arrays)}, f=np.array([0.5, 1.25])))
    assert [got[f"a{i}"].tolist() for i in range(len(arrays))] == arrays and got["f"].tolist() == [0.5, 1.25]


def test_discounts_fall_back():
    assert scoring.discounts(np.array([100, 40, 20, 12, 8, 6]))[1:].max() < 1
    assert scoring.discounts(np.zeros(6))[1:].tolist() == [(r - 0.5) / r for r in range(1, 6)]


def test_windows_counted_once_and_shorter_items(spark):
    docs = spark.createDataFrame([(1, "A b c d e f g h i j k l m"), (2, "x a B x A b y"), (3, "b c d e f g h i j")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, "A, b")], "item_id long, text string")
    rows = decontamination.phrase_matches(docs, items).select("doc_id", decontamination.hit_words(F.col("matches")).alias("n"), F.array_sort(F.transform("matches", lambda m: m["item_id"])).alias("ids")).collect()
    assert {r.doc_id: (max(r.n, 0), r.ids) for r in rows} == {1: (11, [1, 2]), 2: (4, [2, 2]), 3: (0, None)}


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x beta gamma"), (2, "gamma beta alpha"), (3, "alpha beta gamma"), (4, "alpha beta")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "alpha beta gamma")], "item_id long, text string")
    near = lambda slop: sorted(r.doc_id for r in decontamination.proximity_matches(docs, items, slop).select("doc_id").distinct().collect())
    assert near(0) == [3] and near(1) == near(2) == [1, 3] and near(4) == [1, 2, 3]


def test_shards(spark, edge_dir):
    rows = sharding.op9_sharding(spark, SMALL).collect()
    assert {r.law for r in rows} == {"key"} and all(r.grown_shard in (r.shard, 16) for r in rows)
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    texts = {r.doc_id: r.text or "" for r in read(spark, SMALL, "documents", "doc_id", "text").collect()}
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    odd = sharding.op9_sharding(spark, edge_dir).collect()
    for s in {r.shard for r in odd}:
        assert sorted(r.slot for r in odd if r.shard == s) == list(range(sum(r.shard == s for r in odd)))


def test_weights_and_growth(spark):
    ids = spark.range(20_000)
    four = ids.select("id", sharding.rendezvous(F.col("id"), 4, [1, 1, 2, 4]).alias("a"), sharding.rendezvous(F.col("id"), 5, [1, 1, 2, 4, 2]).alias("b")).collect()
    share = [sum(r.a == s for r in four) / 20_000 for s in range(4)]
    assert share == pytest.approx([1 / 8, 1 / 8, 1 / 4, 1 / 2], abs=0.02)
    assert all(r.b in (r.a, 4) for r in four) and sum(r.b == 4 for r in four) / 20_000 == pytest.approx(0.2, abs=0.02)


def test_shards_are_hashlibs(spark, edge_dir):
    """The shard of every key by a straight statement: the highest weight / -ln(u), u from 52 bits of MD5."""

    def best(key, n):
        u = [(int(hashlib.md5(f"{key}#{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52 for i in range(n)]
        return max(range(n), key=lambda i: (1 / -math.log(u[i]), i))

    for sf in (SMALL, edge_dir):
        for r in sharding.op9_sharding(spark, sf).collect():
            key = "null" if r.doc_id is None else r.doc_id
            assert (r.shard, r.grown_shard) == (best(key, 16), best(key, 17))


def test_rows_alike_in_everything(spark):
    """A table of nothing but null ids and empty texts spreads over runs and blocks."""
    docs = spark.range(200_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("").alias("text"))
    slots = sharding.shard(docs).agg(F.count_distinct("slot"), F.min("slot"), F.max("slot"), F.count_distinct("shard")).first()
    assert tuple(slots) == (200_000, 0, 199_999, 1)
    windows = packing.pack(docs).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count_distinct("offset").alias("k"), F.count("*").alias("m"))
    assert windows.agg(F.sum("n"), F.max("n"), F.sum(F.col("k") - F.col("m"))).first()[:] in [(200_000, n, 0) for n in range(4097)]
    assert windows.count() <= 60  # 49 would hold them


def test_small_runs_number_gaplessly(spark):
    df = spark.range(500).selectExpr("id % 3 as shard", "id as row")
    rows = sharding.number_within(df, "shard", "slot", "row", run_rows=16).collect()
    for s in range(3):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


@given(st.lists(st.integers(1, 4096), min_size=1, max_size=60))
@settings(max_examples=40, deadline=None)
def test_blocks_hold_every_piece_once(sizes):
    windows = packing.pack_block(np.array(sizes))
    assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in w) <= packing.CAPACITY for w in windows)


def test_differencing_balances():
    r = np.random.default_rng(1)
    sizes = r.integers(10, 1000, 400)
    sums = [int(sizes[w].sum()) for w in packing.difference(sizes, 40)]
    assert len(sums) == 40 and max(sums) - min(sums) <= 0.02 * np.mean(sums)
    assert sorted(map(sorted, packing.difference(np.array([8, 7, 6, 5, 4]), 2))) == [[0, 2], [1, 3, 4]] or sum(map(len, packing.difference(np.array([8, 7, 6, 5, 4]), 2))) == 5


def test_pieces_and_windows(spark, edge_dir):
    rows = packing.op10_packing(spark, edge_dir).collect()
    tokenizer = of_process(packing.default_tokenizer()).tokenizer
    texts = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{edge_dir}/documents.parquet").collect()]
    expected = collections.Counter()
    for i, t in texts:
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, packing.END_ID], "<u4")
        for s, n in packing.cut(len(ids)):
            expected[(i, s, n, zlib.crc32(ids[s : s + n].tobytes()), len(ids))] += 1
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == expected
    windows = collections.defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
    for w in windows.values():
        end = 0
        for offset, length in sorted(w):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY


def test_ids_are_the_librarys():
    r = random.Random(4)
    tokenizer = of_process(packing.default_tokenizer())
    for letters in ("aAbé É'''stSreveMLLdD  09²½µßÀ\n\t\xa0.,!?$_-\"«»ªº", "aAé 'sÉ\x85\x1c<|endoftext|>日本Σς́İ.,"):
        texts = ["".join(r.choice(letters) for _ in range(r.randrange(40))) for _ in range(500)] + ["it's", "'s", "x'", None, "<|endoftext|>"]
        expected = [x.ids for x in tokenizer.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
        assert [x.tolist() for x in tokenizer.encode(pa.array(texts))] == expected


def test_pipeline_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "language", "neardup", "decontamination", "packing"]
    docs = read(spark, SMALL, "documents")
    seen = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SMALL))
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        left = {r.doc_id: r.text for r in docs.collect()}
        assert left.items() <= seen.items() and left
        if name == "neardup":
            parts = shingle_classes(list(seen.items()))
            assert set(left) == set(parts.values())
        if name == "decontamination":
            bad = {r.doc_id for r in decontamination.op7_decontamination(spark, SMALL).filter("contaminated").collect()}
            assert set(left) == set(seen) - bad
        seen = left
    assert {r.doc_id for r in corpus_pipeline.run(spark, SMALL).collect()} == set(seen)
