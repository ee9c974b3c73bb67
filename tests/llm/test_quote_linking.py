"""Quotation linking: parsing, links, conversations, edge rows."""

from tavola.llm import quote_linking as ql


def test_parse_levels():
    text = "Hi\n\nOn Monday, Ann wrote:\n> First line\n> second\n>> older\n> > older too\n> third\nBye"
    own, passages = ql.parse(text)
    assert own == "Hi\n\nBye"
    assert passages == [(1, "First line\nsecond"), (2, "older\nolder too"), (1, "third")]
    assert ql.parse(None) == ("", []) and ql.parse("> \n>") == ("", [])
    assert ql.parse("He wrote: yes\na > b")[0] == "He wrote: yes\na > b"
    assert ql.parse("Bob wrote:\nno quote") == ("Bob wrote:\nno quote", [])


def test_long_text_is_linear():
    own, passages = ql.parse("> quoted line\nown line\n" * 20000)
    assert own.count("\n") == 19999 and len(passages) == 20000


def link(spark, rows):
    df = spark.createDataFrame(rows, "conv long, at long, who string, body string, thread int, depth int")
    got = ql.link(df, "conv", "at", "who", "body").collect()
    return {(r.thread, r.sent): r for r in got}, got


def test_links_and_conversations(spark):
    rows = [
        (1, 0, "a", "Shall we meet?\n\nSecond paragraph.", 0, 0),
        (1, 1, "b", "Yes.\n\na wrote:\n> SHALL we\n> meet?", 0, 0),
        (1, 2, "a", "Good.\nb wrote:\n> Yes.\n>> Shall we meet?", 0, 0),
        (1, 3, "c", "Another answer\n> Second paragraph.", 0, 0),
        (2, 5, "d", "Forwarded\n> Another answer", 0, 0),
        (2, 6, "d", "Unknown\n> nobody said this", 0, 0),
        (3, 1, "e", "later text", 0, 0),
        (3, 0, "e", "quotes what comes later\n> later text", 0, 0),
    ]
    at, _ = link(spark, rows)
    parent = {k: (r.parent_thread, r.parent_sent) if r.parent_sent is not None else None for k, r in at.items()}
    assert parent == {
        (1, 0): None, (1, 1): (1, 0), (1, 2): (1, 1), (1, 3): (1, 0), (2, 5): (1, 3), (2, 6): None, (3, 1): None, (3, 0): None,
    }
    assert [at[1, k].depth for k in range(4)] == [0, 1, 2, 1] and at[2, 5].depth == 2
    assert (at[2, 5].conversation_thread, at[2, 5].conversation_sent) == (1, 0)
    assert at[1, 2].n_quotes == 2 and at[1, 2].n_linked == 2 and at[2, 6].n_quotes == 1 and at[2, 6].n_linked == 0
    assert at[1, 1].text == "Yes." and at[1, 2].text == "Good."


def test_edge_rows(spark):
    rows = [
        (1, 0, "a", "hello", 0, 0), (1, 0, "a", "hello", 0, 0), (1, 1, None, "x\n> hello", 0, 0), (1, 1, "b", "y\n> hello", 0, 0),
        (None, 1, "n", "> hello", 0, 0), (1, None, "n", "> hello", 0, 0), (1, 2, "n", None, 0, 0), (1, 3, "n", "", 0, 0), (1, 4, "n", "> ", 0, 0),
    ]
    at, got = link(spark, rows)
    assert len(got) == len(rows) and at[1, 1].parent_sent == 0 and at[1, 1].depth == 1
    assert at[None, 1].depth == 0 and at[None, 1].parent_sent is None
    empty = spark.createDataFrame([], "conv long, at long, who string, body string")
    assert ql.link(empty, "conv", "at", "who", "body").count() == 0


def test_deep_chain(spark):
    rows = [(1, 0, "a", "message 0", 0, 0)] + [(1, k, "a", f"message {k}\n> message {k - 1}", 0, 0) for k in range(1, 40)]
    at, _ = link(spark, rows)
    assert [at[1, k].depth for k in range(40)] == list(range(40))
    assert {at[1, k].conversation_sent for k in range(40)} == {0}


def test_conversations_come_back_from_mail(spark):
    sf = "/root/testdata/sf0.001"
    want = {(r.conv_id, r.turn): r.text.strip() for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()}
    got = ql.query(spark, sf).collect()
    assert {(r.conv_id, r.turn): r.text for r in got} == want
    assert all(r.n_linked == r.n_quotes == min(r.turn, 2) for r in got)


def test_two_turns_before_whatever_the_ranges(spark, monkeypatch):
    """Also where one conversation, or none, holds most messages, and turns lie far apart."""
    import random

    rng = random.Random(3)
    rows = [(1, 10 * i + (i > 700) * 10**9, f"m{i}") for i in range(900)] + [(None, i, f"n{i}") for i in range(400)] + [(2 + i // 3, i % 3, f"c{i}") for i in range(300)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string").repartition(5)
    want = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])
        for k, (c, t, x) in enumerate(own):
            want[c, t] = (x, own[k - 1][2] if k else None, own[k - 2][2] if k > 1 else None)
    for size in (1, 2, 7, 100, 10**6):
        monkeypatch.setattr(ql, "RANGE_ROWS", size)
        got = {(r.conv_id, r.turn): (r.text, r.one, r.two) for r in ql._with_two_before(df).collect()}
        assert got == want, size
    assert ql._with_two_before(df.limit(0)).count() == 0
