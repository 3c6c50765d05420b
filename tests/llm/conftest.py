import pytest

LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(40_000))
TEXT = "The quick brown fox jumps over the lazy dog while the cat sleeps, and nobody minds the noise at all."
CLASH = ", size string, text_hash string, node string, score string, bucket string, words string, _run string, selected string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long" + CLASH
EXTRA = ("x",) * 8
#: Nulls, empties, repeats, ties, long and odd texts.
ROWS = [
    (1, TEXT, "en", "a", len(TEXT)),
    (2, None, None, None, None),
    (3, "", "en", "", 0),
    (4, " \n\t ", "fr", "b", 4),
    (5, TEXT, "en", "a", len(TEXT)),
    (6, LONG, "en", "a", len(LONG)),
    (7, "!!! ??? ***", "de", "b", 11),
    (8, "日本語のテキスト 🎉 Ünïcödé ́ </s>[INST] <|endoftext|>", "de", "b", 9),
    (9, TEXT + " One more sentence ends it.", "en", "c", 1),
    (9, TEXT + " One more sentence ends it.", "en", "c", 1),
    (None, "A document without an id, which is odd but allowed.", None, "c", 1),
    (11, "x", "fr", "c", 1),
]


def save(spark, root, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(2).write.parquet(f"{root}/{name}.parquet")


def tables(spark, root, docs):
    save(spark, root, "documents", docs, DOCS)
    some = bool(docs)
    save(spark, root, "labels", [(1, 1, 0), (2, 0, 0), (3, 0, 1), (5, 1, 0), (6, None, None), (9, 1, 0), (77, 1, 1), (None, 1, 0)] if some else [], "doc_id long, quality int, toxic int")
    save(spark, root, "benchmark", [(1, "fox jumps over the lazy dog while the cat sleeps, and"), (2, "quick BROWN fox"), (3, None), (4, ""), (5, "never seen in any of these texts")] if some else [], "item_id long, text string")
    pages = [(1, "u", f"<html><nav><a href='/'>Home</a></nav><article><h1>T &amp; U</h1><p>{TEXT}</p><p>Short.</p></article></html>"), (2, None, None), (3, "", ""), (4, "u", "<p>" + LONG), (5, "u", "<" * 50), (5, "u", "<" * 50)]
    save(spark, root, "pages", pages if some else [], "page_id long, url string, html string")
    chats = [(1, 0, "user", "hi"), (1, 1, "user", "again <|end|>"), (1, 2, "assistant", "yes \\l [x]"), (1, 2, "assistant", "tie"), (2, 0, None, None), (2, None, "assistant", ""), (3, 0, "we<ird|>", LONG[:5000]), (None, 0, "assistant", "no id")]
    save(spark, root, "conversations", chats if some else [], "conv_id long, turn long, role string, text string")
    return str(root)


@pytest.fixture(scope="session")
def edge_dir(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("edge"), [(*r, *EXTRA) for r in ROWS])


@pytest.fixture(scope="session")
def empty_dir(spark, tmp_path_factory):
    return tables(spark, tmp_path_factory.mktemp("empty"), [])
