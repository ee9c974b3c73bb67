"""Chat formatting by quotation linking.

A message is parsed into its own lines and quoted passages: a passage is a run of lines of one
quote level (the number of ``>`` before them), levels nest, and a line such as "On Monday X
wrote:" right before a deeper level belongs to the quote. Passages are normalised (lower case,
single spaces) and hashed as a whole, by paragraph and by line, and so are the own texts of all
messages. A passage's original is the earliest message that has its hash in its own text, in the
same thread if there is one, and sent before the quoting message; coarser hashes go first. The
parent of a message is the original of its outermost passage. Following parents by pointer
doubling gives each message its conversation (the first ancestor) and depth; ordered by depth
and time, a conversation reads in the order of replies, without quotes.

Hashes are reduced to one original each before the join, so a passage that a third of all
messages quote costs one row on that side, and no pairs of messages are made.

Defined cases: a null text is empty; a text of any length is parsed whole, in linear time; of several
originals sent at once the one of the smaller thread counts; empty and blank passages link to nothing; a null thread or
time makes a message that neither quotes nor is quoted, its own conversation at depth 0; rows that
repeat (thread, time) share one place in the conversation, whose parent is the least of theirs;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tavola.llm._shared import Ranges, on_workers, stash, table
from tavola.operators.joins import broadcast_if_small

_QUOTED = re.compile(r"((?:[ \t]?>)+)[ \t]?(.*)", re.DOTALL)
_WROTE = re.compile(r"(?i)\s*(?:on\b.*|.*\b)(?:wrote|writes|said)\s*:\s*")
_BLANK = " \t\n\r\x0b\x0c"
#: Messages that are ordered in one task.
RANGE_ROWS = 4096
#: The grains a text is hashed in, coarsest first.
WHOLE, PARAGRAPH, LINE = 0, 1, 2


def _hash(text: str) -> bytes | None:
    """16 bytes for the normalised text, None if nothing is left of it."""
    import xxhash

    normal = " ".join(text.lower().split())
    return xxhash.xxh3_128_digest(normal.encode()) if normal else None


def grains(text: str) -> list[tuple[int, bytes]]:
    """(grain, hash) of the whole text, its paragraphs and lines, each hash at its coarsest."""
    found: dict[bytes, int] = {}
    pieces = [(WHOLE, text)]
    pieces += [(PARAGRAPH, p) for p in re.split(r"\n[ \t]*\n", text)]
    pieces += [(LINE, line) for line in text.split("\n")]
    for grain, piece in pieces:
        if (h := _hash(piece)) is not None:
            found.setdefault(h, grain)
    return [(g, h) for h, g in found.items()]


def parse(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """(own text, [(level, passage)] in order)."""
    lines = []
    for line in (text or "").split("\n"):
        m = _QUOTED.fullmatch(line)
        lines.append((m[1].count(">"), m[2]) if m else (0, line))
    own, passages = [], []
    current: list[str] = []
    level = 0
    following = 0  # level of the next line that is not blank
    deeper = [False] * len(lines)
    for i in range(len(lines) - 1, -1, -1):
        deeper[i] = following > lines[i][0]
        if lines[i][1].strip(_BLANK):
            following = lines[i][0]
    for i, (own_level, line) in enumerate([*lines, (0, "")]):
        if i == len(lines) or own_level != level:
            if level and "\n".join(current).strip(_BLANK):
                passages.append((level, "\n".join(current).strip(_BLANK)))
            current, level = [], own_level
        if i < len(lines) and not (deeper[i] and _WROTE.fullmatch(line)):
            (current if own_level else own).append(line)
    return "\n".join(own).strip(_BLANK), passages


def parsed(messages: DataFrame) -> DataFrame:
    """thread, sent, role, text (own), own (its hashes), quotes (place, level, grain, hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = pa.list_(pa.binary())
        quotes = pa.list_(pa.struct([("place", pa.int32()), ("level", pa.int32()), ("grain", pa.int32()), ("hash", pa.binary())]))
        names = ["thread", "sent", "role", "text", "own", "quotes"]
        for batch in batches:
            for b in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                texts, own, quoted = [], [], []
                for text in b["raw"].to_pylist():
                    clean, passages = parse(text)
                    texts.append(clean)
                    own.append([h for _, h in grains(clean)])
                    quoted.append(
                        [{"place": k, "level": n, "grain": g, "hash": h} for k, (n, p) in enumerate(passages) for g, h in grains(p)]
                    )
                columns = [b["thread"], b["sent"], b["role"], pa.array(texts, pa.string()), pa.array(own, hashes), pa.array(quoted, quotes)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "thread long, sent long, role string, text string, own array<binary>, quotes array<struct<place:int,level:int,grain:int,hash:binary>>"
    return on_workers(messages).select("thread", "sent", "role", F.col("text").alias("raw")).mapInArrow(run, schema)


def link(messages: DataFrame, thread: str, sent: str, role: str, text: str) -> DataFrame:
    """thread, sent, role, text (without quotes), n_quotes, n_linked, parent_thread, parent_sent,
    conversation_thread, conversation_sent and depth of every message."""
    c = lambda name, kind: F.col(name).cast(kind)
    read = messages.select(
        c(thread, "long").alias("thread"), c(sent, "long").alias("sent"), c(role, "string").alias("role"), c(text, "string").alias("text")
    )
    m = stash(parsed(read), "messages")
    known = F.col("thread").isNotNull() & F.col("sent").isNotNull()
    own = m.filter(known).select("thread", "sent", F.explode("own").alias("hash"))
    here = stash(own.groupBy("thread", "hash").agg(F.min("sent").alias("first")), "originals-here")
    anywhere = stash(here.groupBy("hash").agg(F.min(F.struct("first", "thread")).alias("at")), "originals")
    q = m.filter(known).select("thread", "sent", F.explode("quotes").alias("q")).select("thread", "sent", "q.*")
    q = q.join(here, ["thread", "hash"], "left")
    q = q.join(anywhere, "hash", "left").filter("coalesce(first < sent, false) OR coalesce(at.first < sent, false)")
    local = F.coalesce(F.col("first") < F.col("sent"), F.lit(False))
    q = q.select(
        "thread", "sent", "place", "level", "grain",
        F.when(local, F.struct(F.col("first").alias("sent"), F.col("thread").alias("thread")))
        .otherwise(F.struct(F.col("at.first").alias("sent"), F.col("at.thread").alias("thread"))).alias("origin"),
    )
    # of a passage the coarsest hit, of a message the first passage of level 1
    passages = q.groupBy("thread", "sent", "place", "level").agg(F.min(F.struct("grain", "origin")).alias("best"))
    found = passages.groupBy("thread", "sent").agg(
        F.count(F.lit(1)).alias("n_linked"),
        F.min(F.when(F.col("level") == 1, F.struct("place", F.col("best.grain").alias("grain"), F.col("best.origin").alias("origin")))).alias("parent"),
    )
    found = stash(found.select("thread", "sent", "n_linked", F.col("parent.origin").alias("parent")), "parents")
    places = stash(_ancestors(found.filter("parent IS NOT NULL").select("thread", "sent", "parent")), "places")
    out = m.join(found, ["thread", "sent"], "left").join(places, ["thread", "sent"], "left")
    levels = F.size(F.array_distinct(F.transform("quotes", lambda x: x["place"])))
    return out.select(
        "thread", "sent", "role", "text", levels.cast("int").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("int").alias("n_linked"),
        F.col("parent.thread").alias("parent_thread"), F.col("parent.sent").alias("parent_sent"),
        F.coalesce("root.thread", "thread").alias("conversation_thread"), F.coalesce("root.sent", "sent").alias("conversation_sent"),
        F.coalesce("depth", F.lit(0)).cast("int").alias("depth"),
    )


def _ancestors(parents: DataFrame) -> DataFrame:
    """thread, sent, root and depth of every message with a parent. Parents are sent earlier, so
    there are no circles; each round doubles the distance looked back, and only messages whose
    root has a parent itself go into the next."""
    columns = ["thread", "sent", "root", "depth"]
    open_ = stash(parents.select("thread", "sent", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")), "ancestors")
    done = None
    while True:
        every = open_ if done is None else done.unionByName(open_)
        up = every.select(
            F.col("thread").alias("t"), F.col("sent").alias("s"), F.col("root").alias("next"), F.col("depth").alias("more")
        )
        joined = open_.join(up, (open_["root.thread"] == up["t"]) & (open_["root.sent"] == up["s"]), "left")
        new = joined.select(
            "thread", "sent", F.coalesce("next", "root").alias("root"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("next").isNotNull().alias("moved"),
        )
        new = stash(new, "ancestors")
        settled = new.filter("NOT moved").select(*columns)
        done = settled if done is None else done.unionByName(settled)
        open_ = new.filter("moved").select(*columns)
        if open_.isEmpty():
            return done


def _with_two_before(d: DataFrame) -> DataFrame:
    """``d`` (conv_id, turn, text, more) plus one and two, the texts of the two turns before in the same
    conversation. Messages are cut into ranges of (conv_id, turn) with bounds from the data, and the
    last two of a range are also sent to the next, so a conversation of any length is ordered by many
    tasks."""
    ranges = Ranges(d.select("conv_id", "turn").distinct(), max(3, RANGE_ROWS))
    d = ranges.number(d, "range")
    # the keys at which ranges begin, and the two keys before each
    until = ranges.placed.select("conv_id", "turn", "__at", F.pmod(-F.col("__at"), F.lit(ranges.rows)).alias("off")).filter("off <= 2")
    until = until.withColumn("of", F.col("__at") + F.col("off"))
    begins = ranges.number(until.filter("off = 0"), "also_in").select("of", "also_in")
    ends = until.filter("off > 0").select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), "of").join(F.broadcast(begins), "of")
    sent = ends.groupBy("c", "t").agg(F.collect_set("also_in").alias("also_in"))
    d = d.join(broadcast_if_small(sent), F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")), "left")
    more = F.filter(F.coalesce("also_in", F.array().cast("array<bigint>")), lambda r: r != F.col("range"))
    at = F.concat(F.array(F.struct(F.col("range").alias("range"), F.lit(True).alias("own"))), F.transform(more, lambda r: F.struct(r.alias("range"), F.lit(False).alias("own"))))
    d = d.withColumn("at", F.explode(at)).drop("c", "t", "also_in", "range")
    before = Window.partitionBy("at.range").orderBy("conv_id", "turn", "at.own")
    last = lambda k: F.when(F.lag("conv_id", k).over(before).eqNullSafe(F.col("conv_id")), F.lag("text", k).over(before))
    return d.withColumns({"one": last(1), "two": last(2)}).filter("at.own").drop("at")


def as_mail(conversations: DataFrame) -> DataFrame:
    """The conversations as mail: each turn quotes the turn before it in full and, one level
    deeper, the turn before that, as mail programs do."""
    quoted = lambda col, mark: F.concat(F.lit(mark), F.regexp_replace(col, "\n", "\n" + mark))
    text = F.coalesce(F.col("text"), F.lit(""))
    d = conversations.select("conv_id", "turn", "role", text.alias("text"))
    d = _with_two_before(d)
    mail = F.concat_ws(
        "\n", "text",
        F.when(F.col("one").isNotNull(), F.concat(F.lit("\nThe other side wrote:\n"), quoted(F.col("one"), "> "))),
        F.when(F.col("two").isNotNull(), F.concat(F.lit("> You wrote:\n"), quoted(F.col("two"), ">> "))),
    )
    return d.select("conv_id", "turn", "role", mail.alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations are written as mail and read back: own texts, parents and depths."""
    mail = as_mail(table(spark, sf_dir, "conversations"))
    out = link(mail, "conv_id", "turn", "role", "text")
    return out.select(
        F.col("thread").alias("conv_id"), F.col("sent").alias("turn"), "role", "text", "n_quotes", "n_linked",
        F.col("parent_sent").alias("parent_turn"), F.col("conversation_sent").alias("first_turn"), "depth",
    )
