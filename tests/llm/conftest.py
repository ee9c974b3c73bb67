import pytest

TEXTS = [
    None,
    "",
    " \t\n ",
    "one",
    "the quick brown fox jumps over the lazy dog and runs away from it all",
    "The QUICK brown fox jumps over the lazy dog and runs away from it all",
    "the quick brown fox jumps over the lazy dog and runs away from it all again",
    "mail jo.1@mail.example.com from 10.0.0.1 and 999.1.1.1, call +1 (555) 123-4567 or 4111 1111 1111 1111 now",
    "First line here. Second sentence!\nA new paragraph.\n\nA new section, é ü 中文 😀.",
    "word " * 3000 + "end",
    "x" * 20000,
]


@pytest.fixture(scope="module")
def edge_docs(spark):
    """Nulls in every column, empty, blank, short and very long texts, repeated rows and ids, and
    extra columns whose names clash with working names."""
    rows = [(i, t, "en", "src%d" % (i % 3), len(t or "")) for i, t in enumerate(TEXTS)]
    rows += [(None, "no id here at all my friend", None, None, None), (None, None, None, None, None)]
    rows += [rows[4], rows[4], (4, "another text under the id four which differs", "en", "src1", 5)]
    base = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return base.selectExpr(
        "*", "1 AS size", "2 AS shard", "3 AS score", "4 AS part", "5 AS key", "6 AS id", "7 AS n", "8 AS stat_words", "9 AS mix_size"
    )


@pytest.fixture(scope="module")
def no_docs(edge_docs):
    return edge_docs.limit(0)
