"""Extraction, fingerprints, language, quality and chat formatting on cases whose results are known."""

import collections
import hashlib
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from retort.llm import chat, fingerprints, html_text, language, quality
from retort.llm.common import text_slices, word_hashes, words, ALNUM

PAGE = """<html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body><header><h1>Site</h1></header>
<div id="wrap"><div class="sidebar"><p>Long sidebar text that goes on and on about other things entirely.</p></div>
<div class="content"><h1>Title</h1><p>First para with a good deal of text to be read by people &amp; others.</p><p>Short.</p>
<p>Second   para
 with <b>bold</b> text.<br>After &eacute;&#39;s break</p><div class="ad-box">Buy!</div><ul><li>one</li><li>two</li></ul></div></div>
<div id="comments"><p>I am a comment which is very long, longer than anything else on this page, and even more so because I like it a lot.</p></div>
<form><p>Subscribe to all of our many letters now</p></form><footer>foot</footer></body></html>"""


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (PAGE, "Title\n\nFirst para with a good deal of text to be read by people & others.\n\nShort.\n\nSecond para with bold text. After é's break\n\none\n\ntwo"),
        ("<body><nav><a href=x>Home</a></nav><main><article><p>Para one.<p>Para two.</article><section class=comments><article class=comment><p>Nice</article></section></main>", "Para one.\n\nPara two."),
        ("<article><p>Before <svg><title>x</title></svg>after<noscript><p>no</p></noscript> end</p><blockquote>Quote</blockquote></article>", "Before after end\n\nQuote"),
        ("<div class='page has-sidebar'><p>Kept text.</p></div>", "Kept text."),
        ("<body><div class='layout sidebar-right'><p>Kept text that is long enough.</p><p>More of it.</p></div></body>", "Kept text that is long enough.\n\nMore of it."),
        ("<div class='content login-required'><p>Kept text.</p></div>", "Kept text."),
        ("<form><div class=page><article><p>Kept text.</p></article></div></form>", "Kept text."),
        ("<article><h1>T</h1><p>Text of the article.</p><section id='discussion'><h2>Discussion</h2><p>What it means.</p></section></article>", "T\n\nText of the article.\n\nDiscussion\n\nWhat it means."),
        ("<article><p>Text of the article.</p><section class='related-work'><p>Others did the same.</p></section><div class='related-posts'><p>See also</p></div></article>", "Text of the article.\n\nOthers did the same."),
        ("<article><header><h1>The title</h1></header><p>Text of the article.</p></article>", "The title\n\nText of the article."),
        ("<main><p>Text of the article, a long line of it.</p><div class=box><a href=a>One</a><a href=b>Two</a></div><p>Text again, which is long as well.</p></main>", "Text of the article, a long line of it.\n\nText again, which is long as well."),
        ("<main><p>Text of the article.</p><div class=remarks><p>I like it very much indeed, it is so good.</p></div></main>", "Text of the article."),
        ("just text", "just text"),
        ("", ""),
        (None, ""),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


LONG_PARTS = [f"Paragraph number {i} tells at some length what the article has to say about its subject, clearly." for i in range(6)]
TOLD = "".join(f"<p>{x}</p>" for x in LONG_PARTS)
LEAD = "The lead of this article says in one long sentence what all of the rest is going to be about."


@pytest.mark.parametrize(
    "part, kept",
    [
        (f'<div class="article-header"><h1>A Title</h1><p>{LEAD}</p></div>', ["A Title", LEAD]),
        ('<div class="entry-header"><h1>A Title</h1></div>', ["A Title"]),
        ("<header><h1>A Title</h1></header>", ["A Title"]),
        ('<h2 id="navigation">Navigation</h2>', ["Navigation"]),
        ('<h2 id="social">Social</h2>', ["Social"]),
        ('<h2 id="cookies">Cookies</h2>', ["Cookies"]),
        ('<h3 id="comments-on-law">Comments on Law</h3>', ["Comments on Law"]),
        ('<h2><span id="Register">Register</span></h2>', ["Register"]),
        (f'<section id="replies"><h2>Replies</h2><p>{LEAD}</p></section>', ["Replies", LEAD]),
        (f'<div class="recipe-widget"><p>{LEAD}</p></div>', [LEAD]),
        (f'<p class="social-history">{LEAD}</p>', [LEAD]),
        ("<p>The place where <math><mi>x</mi></math> holds is known to all who read it in this article.</p>", ["The place where x holds is known to all who read it in this article."]),
        (f'<div class="comments"><p>{LEAD}</p></div>', []),
        (f'<section class="comment-list"><p>{LEAD}</p></section>', []),
        (f'<div id="comments"><p>{LEAD}</p></div>', []),
        (f'<div class="sidebar"><p>{LEAD}</p></div>', []),
        ('<div class="ad">Buy now and save a lot of money</div>', []),
        ('<div class="ad-slot"><p>Buy now and save a lot of money</p></div>', []),
        ('<div class="share-buttons"><a href="/x">Share this</a> <a href="/y">Post it</a></div>', []),
        ('<div class="main-menu"><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></div>', []),
        (f'<div class="cookie-banner"><p>{LEAD}</p></div>', []),
        ('<form><p>Subscribe to our letters</p></form>', []),
    ],
)
@pytest.mark.parametrize("root", ["article", "main"])
def test_hints_never_drop_what_an_article_says(root, part, kept):
    page = f"<html><body><nav><a href='/'>Home</a></nav><{root}>{part}{TOLD}</{root}><footer>foot</footer></body></html>"
    assert html_text.main_text(page) == "\n\n".join(kept + LONG_PARTS)


@pytest.mark.parametrize("tag", ["div", "section"])
def test_articles_over_sibling_containers(tag):
    paragraphs = [f"Paragraph {i} " + "has words to be read by people. " * 25 for i in range(6)]
    p = [f"<p>{x}</p>" for x in paragraphs]
    whole = "\n\n".join(x.strip() for x in paragraphs)
    for at in (1, 2, 5):
        page = f"<body><div id=content><{tag} class=part>{''.join(p[:at])}</{tag}><{tag} class=part>{''.join(p[at:])}</{tag}></div><div><a href=x>Other pages of this site</a></div></body>"
        assert html_text.main_text(page) == whole


@pytest.mark.parametrize("page", ["<div>x" * 20_000, "<b>x" * 20_000 + "</i>" * 20_000, "<p>" + "<i>" * 20_000 + "</b>" * 20_000 + "x" + "</div>" * 20_000])
def test_time_does_not_grow_with_depth(page):
    began = time.time()
    assert html_text.main_text(page)
    assert time.time() - began < 3


def test_smoothing_and_clusters_by_their_definitions():
    r = np.random.default_rng(3)
    for n in (1, 2, 3, 9, 40):
        x = r.gamma(0.5, 40.0, n)
        for sigma in (0.5, 1.0, 2.5):
            reach = max(1, int(3 * sigma))
            expected = []
            for i in range(n):
                near = [j for j in range(n) if abs(i - j) <= reach]
                w = [np.exp(-((i - j) ** 2) / (2 * sigma**2)) for j in near]
                expected.append(sum(a * x[j] for a, j in zip(w, near, strict=True)) / sum(w))
            assert html_text.smoothed(x, sigma) == pytest.approx(expected)
        cut = html_text.content_threshold(x)
        assert x.min() <= cut <= x.mean() + 1e-9
        above, below = x[x > cut], x[x <= cut]
        if cut < x.mean() - 1e-9 and len(above) and len(below):  # a fixed point of two means
            assert cut == pytest.approx((above.mean() + below.mean()) / 2)


def test_smoothing_keeps_constants_and_threshold_separates():
    assert np.allclose(html_text.smoothed(np.full(9, 3.0)), 3.0)
    cut = html_text.content_threshold(np.array([1.0, 2.0, 1.5, 80.0, 90.0]))
    assert 2.0 < cut < 80.0


def test_words_do_not_cross_rows():
    column = pa.array(["ab cd", "", None, "cd"])
    for i, j, data, offsets in text_slices(column):
        starts, ends, counts = words(data, offsets, ALNUM)
        assert (i, j) == (0, 4) and counts.tolist() == [2, 0, 0, 1]
        h = word_hashes(data, starts, ends)
        assert h[1] == h[2] != h[0]


def brute_fingerprint(text):
    """Straight from the definition, one k-mer at a time."""
    from retort.llm.common import LOWER, mix, salt
    from retort.llm.fingerprints import K, SKETCHES, TUPLE, kmers

    raw = text.encode()
    data, offsets = LOWER[np.frombuffer(raw, np.uint8)], np.array([0, len(raw)])
    starts, ends, counts = words(data, offsets, ALNUM)
    seen, elements, size = {}, [], 1 << 64
    for x in kmers(word_hashes(data, starts, ends), counts, K)[0].tolist():
        n = seen[x] = seen.get(x, -1) + 1
        elements.append(int(mix(np.array([(x + n * 0xD1342543DE82EF95) % size], np.uint64))[0]) if n else x)
    out = []
    for s in range(SKETCHES):
        ranked = []
        for i, x in enumerate(elements):
            y = x * (int(salt(s, 1)) | 1) % size
            y ^= y >> 32
            ranked.append((y * (int(salt(s, 2)) | 1) % size, i))
        least = sorted(i for _, i in sorted(ranked)[:TUPLE])
        total = sum(elements[i] * (int(salt(p, 5)) | 1) for p, i in enumerate(least)) % size
        out.append(int(mix(np.array([(total + int(salt(s, 9))) % size], np.uint64))[0]) >> 32)
    return out


def test_fingerprints_follow_the_definition():
    r = random.Random(3)
    texts = [" ".join(r.choice("a b c dd ee ff gg".split()) for _ in range(n)) for n in (0, 1, 2, 3, 40, 300)]
    got = fingerprints.fingerprints(texts)
    for t, g in zip(texts, got, strict=True):
        assert brute_fingerprint(t) == g.tolist()


def test_fingerprints_see_order():
    r = random.Random(5)
    body = [f"w{r.randrange(10**6)}" for _ in range(400)]
    texts = [" ".join(body), " ".join(body[:-1] + ["changed"]), " ".join(body[200:] + body[:200]), " ".join(r.sample(body, len(body)))]
    f = fingerprints.fingerprints(texts)
    near = [float((f[0] == x).mean()) for x in f[1:]]
    assert near[0] > 0.9 > near[1] > near[2] and near[1] < 0.75


def test_edited_texts(spark, edge_dir):
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{edge_dir}/documents.parquet").collect()]
    docs.sort(key=lambda d: (d[0] is None, -(d[0] or 0), d[1]))  # ids that repeat have one text here
    expected = []
    for i, (k, t) in enumerate(docs):
        half = len(t) // 2
        expected.append((str(k), hashlib.sha256((t[: len(t) - half] + docs[(i + 1) % len(docs)][1][:half]).encode()).hexdigest()))
    rows = fingerprints.op2_fingerprints(spark, edge_dir).collect()
    assert sorted((str(r.doc_id), r.edited_sha256) for r in rows) == sorted(expected)
    by = {}
    for (_, t), r in zip(docs, sorted(rows, key=lambda r: (r.doc_id is None, -(r.doc_id or 0))), strict=True):
        assert by.setdefault(t, r.fingerprint) == r.fingerprint and 0 <= r.near_next <= 1


def test_runs_cover_all_documents(spark):
    docs = spark.range(1000).selectExpr("id * id as doc_id", "concat('t', id) as text")
    rows = fingerprints.in_runs(docs, run_rows=64).collect()
    own = [r for r in rows if not r.ghost]
    assert len(own) == 1000 and len({r.run for r in own}) > 8
    assert {r.run for r in rows if r.ghost} == {r.run for r in own}


def test_runs_part_a_repeated_id(spark):
    docs = spark.range(3000).selectExpr("cast(null as long) as doc_id", "concat('t', id) as text")
    rows = fingerprints.in_runs(docs, run_rows=64).collect()
    sizes = collections.Counter(r.run for r in rows if not r.ghost)
    assert sum(sizes.values()) == 3000 and max(sizes.values()) < 400


def test_likeness_to_edited_and_next(spark, edge_dir):
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{edge_dir}/documents.parquet").dropDuplicates(["doc_id"]).collect() if r.doc_id is not None]
    docs.sort(reverse=True)
    marks = fingerprints.fingerprints([t for _, t in docs])
    spark.createDataFrame(docs, "doc_id long, text string").write.mode("overwrite").parquet(f"{edge_dir}/once/documents.parquet")
    rows = {r.doc_id: r for r in fingerprints.op2_fingerprints(spark, f"{edge_dir}/once").collect()}
    for i, (k, t) in enumerate(docs):
        after = (i + 1) % len(docs)
        edited = fingerprints.fingerprints([t[: len(t) - len(t) // 2] + docs[after][1][: len(t) // 2]])[0]
        assert rows[k].near_next == float((marks[i] == marks[after]).mean()) and rows[k].near_edited == float((marks[i] == edited).mean())


def test_gradients_by_differences():
    net = language.new_network(["a", "b", "c"], 3, seed=1)
    r = np.random.default_rng(2)
    x, y, mask = r.integers(0, 256, (6, 5)).astype(np.uint8), np.array([0, 1, 2, 0, 1]), np.ones((6, 5), np.float32)
    mask[4:, 1] = 0
    _, grads = language.gradients(net, x, y, mask)
    for p, g in zip(net.params(), grads, strict=True):
        at = np.unravel_index(int(np.abs(g).argmax()), g.shape)
        old, step = p[at], np.float32(1e-2)
        p[at] = old + step
        up, _ = language.gradients(net, x, y, mask)
        p[at] = old - step
        down, _ = language.gradients(net, x, y, mask)
        p[at] = old
        assert g[at] == pytest.approx((up - down) / (2 * step), rel=0.05, abs=1e-4)


def test_language_accuracy_on_held_out_documents(spark):
    found = language.op3_language(spark, "/root/testdata/sf0.01").filter("held_out").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(found) > 150
    assert sum(r.lang_pred == r.lang for r in found) / len(found) >= 0.95


def test_documents_without_letters(spark, edge_dir):
    rows = {r.doc_id: r for r in language.op3_language(spark, edge_dir).collect()}
    assert {rows[i].lang_pred for i in (2, 3, 4, 7)} == {"und"} and rows[2].score == 0


def test_quality_orders_grades(spark):
    sf = "/root/testdata/sf0.1"
    grades = quality.grades_of(spark.read.parquet(f"{sf}/labels.parquet"))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    model = quality.fit(quality.sample(docs, grades.filter(half)), 3)
    assert model.thresholds[0] <= model.thresholds[1]
    rows = quality.grade(docs, model, "doc_id").join(grades.filter(~half), "doc_id").collect()
    mean = [np.mean([r.expected_grade for r in rows if r.grade == g]) for g in range(3)]
    kept = [np.mean([r.selected for r in rows if r.grade == g]) for g in range(3)]
    assert mean[0] < mean[2] and mean[1] < mean[2]
    assert kept[2] > 0.97 and kept[1] < 0.25 and kept[0] < 0.45  # some 100 toxic ones to learn from


def test_quality_by_straight_statements():
    """Features of a text from dictionaries, the score as a sum over them, the grade's probabilities, and the likelihood's fit."""
    shape_of = lambda w: re.sub("0+", "0", re.sub("a+", "a", re.sub("A+", "A", "".join("A" if c.isascii() and c.isupper() else "a" if not c.isascii() or c.islower() else "0" if c.isdigit() else c for c in w))))
    texts = ["Aa bb Bb 12 x x x, y.", "", "one ONE one", "Z9! Z9! q"]
    column = pa.array(texts, pa.large_string())
    (_, _, data, offsets), = text_slices(column)
    slots, values, counts = quality.features(data, offsets)
    ends = np.cumsum(counts)
    for t, e, k in zip(texts, ends, counts, strict=True):
        found = sorted(np.round(values[e - k : e].astype(float), 4).tolist())
        plain = re.findall("[0-9A-Za-z\x80-\U0010ffff]+", t)
        tokens = t.split()
        expected = [1.0] * len({w.lower() for w in plain}) + [1.0, 6 * (len({w.lower() for w in plain}) / max(1, len(plain))) ** 0.5]
        expected += [6 * (n / len(tokens)) ** 0.5 for n in collections.Counter(shape_of(w) for w in tokens).values()]
        if again := sum(a == b for a, b in zip(tokens, tokens[1:], strict=False)):
            expected.append(6 * (again / len(tokens)) ** 0.5)
        assert found == pytest.approx(sorted(expected), abs=1e-3)
    r = np.random.default_rng(0)
    model = quality.Model(r.normal(size=1 << quality.BITS).astype(np.float32), np.array([-0.5, 0.7]))
    score = quality.scores(model, slots, values, counts)
    for i, (e, k) in enumerate(zip(ends, counts, strict=True)):
        assert score[i] == pytest.approx(sum(float(model.weights[s]) * float(v) for s, v in zip(slots[e - k : e], values[e - k : e], strict=True)), rel=1e-4)
    assert quality.tail(model, score) == pytest.approx(np.array([[1 / (1 + np.exp(c - s)) for c in model.thresholds] for s in score]))
    # One feature, on in a tenth, half and nine tenths of the grades: no change of the fitted numbers makes the grades more likely.
    rows = [(np.array([3, 9]), np.array([float((i % 10 == 0, i % 2 == 0, i % 10 != 0)[g]), 1.0]), g) for i in range(90) for g in range(3)]
    fitted = quality.fit(rows, 3, bits=4)

    def likelihood(w: float, cuts: np.ndarray) -> float:
        out = 0.0
        for _, v, g in rows:
            upto = np.append(1 / (1 + np.exp(w * v[0] + fitted.weights[9] - cuts)), 1.0)
            out += np.log(upto[g] - (upto[g - 1] if g else 0.0))
        return out / len(rows)

    best = likelihood(float(fitted.weights[3]), fitted.thresholds)
    for step in (-0.3, 0.3):
        assert likelihood(fitted.weights[3] + step, fitted.thresholds) < best + 0.01
        for j in (0, 1):
            assert likelihood(float(fitted.weights[3]), fitted.thresholds + step * (np.arange(2) == j)) < best + 0.01


def test_the_sample_takes_whole_texts_and_fewer_of_them_beyond_its_bytes(spark):
    texts = [(i, " ".join(f"w{i}x{k}" for k in range(9000 if i == 0 else 50))) for i in range(200)]
    docs, grades = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([(i, i % 3) for i in range(200)], "doc_id long, grade int")
    whole = quality.sample(docs, grades)
    assert len(whole) == 200 and max(len(s) for s, _, _ in whole) > 8900
    fewer = quality.sample(docs, grades, most_bytes=sum(8 * len(s) for s, _, _ in whole) // 2)
    known = {(g, s.tobytes(), v.tobytes()) for s, v, g in whole}
    assert 50 < len(fewer) < 150 and all((g, s.tobytes(), v.tobytes()) in known for s, v, g in fewer)
    assert quality.sample(docs.filter("false"), grades) == [] == quality.sample(docs, grades.filter("false"))


def test_many_turns_and_a_conversation_of_the_probes_number(spark, tmp_path):
    """Time in proportion to the turns; a real conversation -1 stays apart from the probe."""
    rows = [(-1, 0, "user", "mine")] + [(7, i, ("user", "assistant")[i // 3 % 2], f"turn {i} <é>") for i in range(20_000)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    began = time.time()
    found = chat.op8_chat(spark, str(tmp_path)).collect()
    assert time.time() - began < 20
    assert sorted((r.conv_id, r.n_turns) for r in found) == [(-1, 1), (-1, 2), (7, 20_000)]
    learned = "".join(t for _, _, role, t in rows[1:] if role == "assistant")
    assert [r.loss_sha256 for r in found if r.conv_id == 7] == [hashlib.sha256(learned.encode()).hexdigest()]


def test_chats_come_back(spark, edge_dir):
    turns = spark.read.parquet(f"{edge_dir}/conversations.parquet")
    formatted = chat.format_chats(turns)
    back = {r.conv_id: r for r in chat.parse_chats(formatted).collect()}
    assert [(x.role, x.text) for x in back[1].turns] == [("user", "hi"), ("user", "again <|end|>"), ("assistant", "tie"), ("assistant", "yes \\l [x]")]
    assert back[1].loss_text == "tieyes \\l [x]"
    assert [(x.role, x.text) for x in back[2].turns] == [("assistant", ""), ("", "")]
    assert back[3].turns[0].role == "we<ird|>"
    assert back[1].formatted.count("<|user|>") == 1, "adjacent turns of a role share a block"
    for r in formatted.collect():
        assert "[" not in r.formatted.replace("\\s", "")
