"""Merkle fingerprints against a tree built in Python."""

import hashlib
import re

from pyspark.sql import functions as F

from tavola.llm import merkle
from tavola.llm._shared import Ranges


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def cut(text, end):
    return [p for p in re.split(end, text) if p]


def marked(text):
    """The text with marks behind the words that its content picks."""
    words = re.findall(r"(?s)[^ \n]*[ \n]|[^ \n]+$", text.replace("\x01", "\x01\x01"))
    picked = lambda w: hashlib.md5(w.encode()).hexdigest()[0] == "0" and re.search("[^.!?] $", w)
    return "".join(w + merkle.MARK if picked(w) else w for w in words)


def plain(text):
    """(root, set of leaves)."""
    sections, leaves = [], set()
    for section in cut(marked(text), merkle.SECTION_END):
        paragraphs = []
        for paragraph in cut(section, merkle.PARAGRAPH_END):
            own = [sha("leaf:" + s) for s in re.findall(r"(?s).*?(?:[.!?] |\x01\x02)|.+$", paragraph)]
            leaves |= set(own)
            paragraphs.append(sha("paragraph:" + "".join(own)))
        sections.append(sha("section:" + "".join(paragraphs)))
    return sha("document:" + "".join(sections)), leaves


def like(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_equals_python(spark, edge_docs, no_docs, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_ROWS", 3)
    rows = sorted(((r.doc_id, r.text or "") for r in edge_docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    want = []
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        (root, own), (edited_root, changed), (_, after) = plain(text), plain(edited), plain(following)
        want.append((i, len(text), sha(edited), root, edited_root, like(own, changed), like(own, after)))
    got = [tuple(r) for r in merkle.fingerprints(edge_docs).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(want, key=key)
    assert merkle.fingerprints(no_docs).count() == 0


def test_one_document_follows_itself(spark):
    df = spark.createDataFrame([(5, "abcd")], "doc_id long, text string")
    r = merkle.fingerprints(df).first()
    assert r.edited_sha256 == sha("abab") and r.near_next == 1.0


def test_differing_branches_locate_edits(spark):
    a = "One. Two.\nThree.\n\nFour.\nFive."
    cases = [(a, a, []), (a, a.replace("Five", "5"), [(1, 1)]), (a, a.replace("Two", "2"), [(0, 0)]), (a, a + "\n\nSix.", [(1, 1), (2, 0)]), ("", a, [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1)]), (None, "", [])]
    df = spark.createDataFrame([(i, x, y) for i, (x, y, _) in enumerate(cases)], "i int, x string, y string")
    df = df.withColumns({c: F.coalesce(c, F.lit("")) for c in "xy"})
    df = merkle.with_tree(merkle.with_tree(df, "x", "tx"), "y", "ty")
    got = {r.i: [tuple(b) for b in r.at] for r in df.select("i", merkle.differing_branches(F.col("tx"), F.col("ty")).alias("at")).collect()}
    # a section ends at a blank line, which is a paragraph of its own at its end
    for i, (x, y, where) in enumerate(cases):
        assert (got[i] == []) == ((x or "") == (y or ""))
        if len(where) == 1:
            assert got[i] == where


def test_unchanged_halves_share_leaves(spark):
    """Also in texts without full stops or line breaks."""
    words = [f"word{i * 7919 % 1000}" for i in range(300)]
    rows = [(0, " ".join(words)), (1, ".&&& ".join(words)), (2, " | ".join(words)), (3, "x" * 50), (4, "tail\x01\x02 " * 40)]
    got = {r.doc_id: r for r in merkle.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i].near_edited > 0.2 for i in (0, 1, 2))


def test_marks_tell_texts_apart(spark):
    texts = ["a b\x01c", "a b\x01\x01c", "a b\x02c", "a b\x01\x02c", "a bc", "\x01", "\x01\x01"]
    picked = next(w for w in (f"w{i} " for i in range(500)) if hashlib.md5(w.encode()).hexdigest()[0] == "0")
    texts += [picked + "x", picked + "\x01\x02x", picked + "\x02x", picked + "\x01x"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert merkle.fingerprints(df).select("fingerprint").distinct().count() == len(texts)


def test_ranges_follow_the_data(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_ROWS", 100)
    for rows in (
        [(i, f"text {i}") for i in range(2000)] + [(10**12, "far")],
        [(None, f"{i} text") for i in range(2000)],
        [(7, f"{i} text") for i in range(2000)] + [(8, "next")],
    ):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        follows = {r: want[(k + 1) % len(want)][1] for k, r in enumerate(want)}
        got = merkle.with_next(df).collect()
        assert {(r.doc_id, r.text): r.next.text for r in got} == follows and len(got) == len(rows)
        keys = df.select("doc_id", F.substring("text", 1, merkle.PREFIX).alias("prefix"))
        sizes = [r["count"] for r in Ranges(keys, 100).number(keys, "range").groupBy("range").count().collect()]
        assert len(sizes) >= 20 and max(sizes) <= 101


def test_plan_has_no_python(spark, edge_docs):
    plan = merkle.fingerprints(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_matches_sql_on_runs_of_line_breaks(spark):
    import duckdb

    from tavola.llm.oracle import OP3

    texts = ["a\n\n\nb", "\n\n\n", "a. b\n\n\n\n\nc! d\n", "\n\n\n\na", "\n", "a\n\nb\n\n", None, "", "x? . . y"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    cur = con.execute(OP3)
    names = [c[0] for c in cur.description]
    assert sorted(tuple(r) for r in merkle.fingerprints(df).select(names).collect()) == sorted(cur.fetchall())
