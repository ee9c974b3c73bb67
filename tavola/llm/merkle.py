"""Merkle fingerprints of documents (DataFrame functions only).

A text is a tree: sections (a section ends at a blank line), their paragraphs (lines), and as
leaves the sentences of a paragraph, cut further behind words that their content picks: one word in
sixteen, by its hash, so long text without full stops has leaves too, and what is unchanged in an
edited text is cut as it was. Every cut keeps its separator with the piece before it, so the leaves in
order spell the whole text. A leaf's hash is SHA-256 of a tag and the piece, a node's hash is SHA-256
of a tag and its children's hashes in order; the root is the fingerprint. Equal roots mean equal texts;
``differing_branches`` walks two trees from the root and names the sections and paragraphs that differ;
``likeness`` is the share of distinct leaves that two trees have in common.

The picked words are marked in the text before it is cut; the mark's first character is doubled where
a text holds it, so marked texts are equal only if the texts are. Leaves of two documents are compared by
64 bits of their hashes.

The document that follows is found inside ranges of the order, whose bounds are taken from the data: a
far id makes no range long, and ids that repeat, or are missing, are cut by the beginnings of their texts.

Defined cases: a null text is the empty text, whose tree is a root without children; two empty
texts have likeness 1, an empty and another text 0; a text of any length is one tree, held by one row; a
null doc_id sorts first; rows that repeat a doc_id follow each other in text order, equal rows in any;
in an empty table nothing follows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tavola.llm._shared import Ranges, stash, table, whole_text

#: Where sections end in a text without three line breaks in a row; see ``_sections`` for all texts.
SECTION_END = r"(?<=\n\n)"
PARAGRAPH_END = r"(?<=\n)"
WORD_END = r"(?<=[ \n])"
#: What stands behind a picked word, and where leaves end.
ESCAPE, MARK = "\x01", "\x01\x02"
LEAF_END = r"(?<=[.!?] |\x01\x02)"
#: Documents that are ordered in one task.
RANGE_ROWS = 4096
#: Characters of a text that place it among others of the same doc_id.
PREFIX = 16


def marked(text: Column) -> Column:
    """The text with a mark behind every picked word: one followed by a blank, not the last of a
    sentence, whose MD5 begins with 0."""
    words = F.split(F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + ESCAPE)), WORD_END)
    picked = lambda w: F.md5(w).startswith("0") & w.rlike(r"[^.!?] $")
    return F.array_join(F.transform(words, lambda w: F.when(picked(w), F.concat(w, F.lit(MARK))).otherwise(w)), "")


def _pieces(text: Column, end: str) -> Column:
    return F.filter(F.split(text, end), lambda p: p != "")


def _sections(text: Column) -> Column:
    """Pieces up to and with each blank line, from the left; no line break counts for two blank lines."""
    parts = F.split(text, "\n\n", -1)
    ended = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p: F.concat(p, F.lit("\n\n")))
    return F.filter(F.concat(ended, F.slice(parts, F.size(parts), F.lit(1))), lambda p: p != "")


def _node(tag: str, hashes: Column) -> Column:
    return F.sha2(F.concat(F.lit(tag), F.array_join(hashes, "")), 256)


def _paragraph(text: Column) -> Column:
    leaves = F.transform(_pieces(text, LEAF_END), lambda s: F.sha2(F.concat(F.lit("leaf:"), s), 256))
    return F.struct(leaves.alias("leaves"))


def _section(text: Column) -> Column:
    paragraphs = F.transform(_pieces(text, PARAGRAPH_END), _paragraph)
    return F.transform(paragraphs, lambda p: F.struct(_node("paragraph:", p["leaves"]).alias("hash"), p["leaves"].alias("leaves")))


def with_tree(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds ``name``: struct(root, sections), a section being struct(hash, paragraphs) and a
    paragraph struct(hash, leaves). Each level is a column of its own, computed once."""
    cut, paragraphs, sections = f"__merkle_m_{name}", f"__merkle_p_{name}", f"__merkle_s_{name}"
    df = df.withColumn(cut, marked(F.col(text)))
    df = df.withColumn(paragraphs, F.transform(_sections(F.col(cut)), _section))
    df = df.withColumn(
        sections,
        F.transform(
            F.col(paragraphs),
            lambda ps: F.struct(
                _node("section:", F.transform(ps, lambda p: p["hash"])).alias("hash"), ps.alias("paragraphs")
            ),
        ),
    )
    root = _node("document:", F.transform(F.col(sections), lambda s: s["hash"]))
    return df.withColumn(name, F.struct(root.alias("root"), F.col(sections).alias("sections"))).drop(cut, paragraphs, sections)


def leaves(tree: Column) -> Column:
    """The distinct leaf hashes of a tree."""
    of_sections = F.transform(tree["sections"], lambda s: F.flatten(F.transform(s["paragraphs"], lambda p: p["leaves"])))
    return F.array_distinct(F.flatten(of_sections))


def likeness(a: Column, b: Column) -> Column:
    """Share of the distinct leaves of two leaf sets that both have; 1 for two empty sets."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, F.lit(1.0)).otherwise(common.cast("double") / F.greatest(union, F.lit(1)))


def differing_branches(a: Column, b: Column) -> Column:
    """array of struct(section, paragraph), counted from 0: where two trees differ. Equal roots
    and equal sections are not entered; positions that one tree lacks count as different."""

    def sections(root_a: Column, root_b: Column) -> Column:
        most = F.greatest(F.size(root_a), F.size(root_b))
        pairs = F.when(most > 0, F.sequence(F.lit(0), most - 1)).otherwise(F.array().cast("array<int>"))
        return F.flatten(F.transform(pairs, lambda i: paragraphs(i, F.get(root_a, i), F.get(root_b, i))))

    def paragraphs(i: Column, sa: Column, sb: Column) -> Column:
        size = lambda s: F.coalesce(F.size(s["paragraphs"]), F.lit(0))
        count = lambda s: F.when(s.isNull(), 0).otherwise(size(s))
        most = F.greatest(count(sa), count(sb))
        each = F.when(~sa["hash"].eqNullSafe(sb["hash"]) & (most > 0), F.sequence(F.lit(0), most - 1)).otherwise(
            F.array().cast("array<int>")
        )
        differs = F.filter(
            each, lambda j: ~F.get(sa["paragraphs"], j)["hash"].eqNullSafe(F.get(sb["paragraphs"], j)["hash"])
        )
        return F.transform(differs, lambda j: F.struct(i.alias("section"), j.alias("paragraph")))

    return sections(a["sections"], b["sections"])


def with_next(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, more) plus ``next``, a struct of text and more: what follows in
    (doc_id, text) order; after the last the first. One shuffle of the texts: they are cut into ranges,
    each ordered in one task, and the first document of a range is also sent to the end of the range
    before it."""
    carried = [c for c in docs.columns if c != "doc_id"]
    d = docs.withColumn("prefix", F.substring("text", 1, PREFIX))
    ranges = Ranges(d.select("doc_id", "prefix"), RANGE_ROWS)
    d = ranges.number(d, "bucket").withColumn("key", ranges.key())
    # one row a range
    every = Window.orderBy("bucket")
    heads = d.groupBy("bucket").agg(F.min("key").alias("head"))
    last = F.max("bucket").over(Window.partitionBy())
    heads = stash(heads.select(F.col("bucket").alias("head_of"), "head", F.coalesce(F.lag("bucket").over(every), last).alias("also_in")), "merkle-heads")
    d = d.join(F.broadcast(heads), (F.col("bucket") == F.col("head_of")) & F.col("key").eqNullSafe(F.col("head")), "left")
    at = lambda b, tail: F.struct(F.col(b).alias("range"), F.lit(tail).alias("tail"))
    places = F.when(F.col("head_of").isNull(), F.array(at("bucket", False))).otherwise(
        F.array(at("bucket", False), at("also_in", True))
    )
    d = d.select("doc_id", *carried, F.explode(places).alias("at"))
    order = Window.partitionBy("at.range").orderBy("at.tail", "doc_id", "text")
    d = d.withColumn("next", F.lead(F.struct(*carried)).over(order))
    return d.filter(~F.col("at.tail")).drop("at")


def with_edited(df: DataFrame) -> DataFrame:
    """Adds ``edited``: the last floor(n / 2) code points replaced by the first as many (or all)
    of the next text."""
    n = F.char_length("text")
    half = F.floor(n / F.lit(2)).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), n - half)
    return df.withColumn("edited", F.concat(kept, F.substring(F.col("next.text"), F.lit(1), half)))


def _with_leaves(df: DataFrame, text: str, root: str, leaf_set: str) -> DataFrame:
    """Adds the root of the tree of ``text`` and 64 bits of each of its distinct leaves."""
    df = with_tree(df, text, "__merkle_tree")
    short = F.transform(leaves(F.col("__merkle_tree")), lambda h: F.xxhash64(h))
    return df.withColumns({root: F.col("__merkle_tree.root"), leaf_set: short}).drop("__merkle_tree")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text and of its edited text, with their likenesses. The tree of a text is
    built where it is read; its root and leaves go with it, also to the document before."""
    d = _with_leaves(docs.select("doc_id", whole_text().alias("text")), "text", "fingerprint", "leaves")
    d = _with_leaves(with_edited(with_next(d)), "edited", "edited_fingerprint", "edited_leaves")
    return d.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("leaves"), F.col("edited_leaves")).alias("near_edited"),
        likeness(F.col("leaves"), F.col("next.leaves")).alias("near_next"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents")).withColumn("doc_id", F.col("doc_id").cast("long"))
