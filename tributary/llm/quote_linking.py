"""Chat formatting by quotation linking.

Lines are parsed into quote levels (``>``, ``> >``, ``>>``). Quoted lines are
normalised and hashed and joined to the message of the conversation that first
said them. Lines that are nobody's whole line (wrapped anew, or a part of one)
are joined by windows of words: quoted lines of one level in a row make a
passage, windows run across its line breaks, and the line goes to the earlier
message that said most of its words. The message answered is the one that most of the innermost quote
comes from. Messages then stand in reply order, without quotes: depth first
through the tree of answers, found by pointer doubling over written tables.

A conversation is never gathered: originals are found by a minimum per
(conversation, line), neighbours and threads by windows over blocks of turns
with one carried value per block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import drop_written, written

#: Quote marks and blanks before a line; one possessive class, so that no line is too long for it.
MARKS = r"^[ \t>]*+"
#: A line of own words that may announce a quote: it ends with a colon.
ANNOUNCES = r":[ \t]*$"
BLOCK = 1024
#: Words of a window; a passage of fewer words is one window.
WINDOW = 5


def _parsed() -> Column:
    """The text's lines that hold words: quote level (0 for own words) and the normalised line."""
    def one(line: Column) -> Column:
        bare = F.lower(F.trim(F.regexp_replace(F.regexp_replace(line, MARKS, ""), r"\s+", " ")))
        return F.struct(_depth(line).alias("depth"), bare.alias("bare"))

    return F.filter(F.transform(F.split("text", "\r?\n"), one), lambda x: x["bare"] != "")


def _depth(line: Column) -> Column:
    """How many quote marks stand before a line."""
    return F.length(F.translate(F.regexp_extract(line, MARKS, 0), " \t", ""))


def own_lines(text: Column) -> Column:
    """The lines without quotes, and without the line that announces one: it
    stands directly before a quoted line and ends with a colon."""
    lines = F.transform(F.split(text, "\r?\n"), lambda x: F.struct(x.alias("line"), (_depth(x) > 0).alias("quoted")))

    def own(lines: Column) -> Column:
        follows = lambda i: F.coalesce(F.get(lines, i + 1)["quoted"], F.lit(False))
        return F.filter(lines, lambda x, i: ~x["quoted"] & ~(follows(i) & x["line"].rlike(ANNOUNCES)))

    return F.transform(own(lines), lambda x: x["line"])


def _lines(messages: DataFrame) -> DataFrame:
    """conv_id, turn, depth and the hash of the normalised line."""
    return messages.select("conv_id", "turn", F.explode(_parsed()).alias("x")).select(
        "conv_id", "turn", F.col("x.depth").alias("depth"), F.md5("x.bare").alias("line"))


def passages(lines: list[tuple[int, str]]) -> Iterator[tuple[int, list[tuple[str, str]]]]:
    """Depth and (word, line) of each run of lines of one depth."""
    at = 0
    while at < len(lines):
        end = at
        while end < len(lines) and lines[end][0] == lines[at][0]:
            end += 1
        yield lines[at][0], [(w, bare) for _, bare in lines[at:end] for w in bare.split(" ")]
        at = end


def _hash(words: list[tuple[str, str]]) -> str:
    return hashlib.md5(" ".join(w for w, _ in words).encode()).hexdigest()


def _windows(messages: DataFrame, quoted: bool) -> DataFrame:
    """Quoted: conv_id, turn, depth, line, window, words (of the window in the
    line, for each window of a quoted passage). Else conv_id, turn, window of
    own words, of all lengths up to ``WINDOW``."""
    keys = f"conv_id {messages.schema['conv_id'].dataType.simpleString()}, turn long, window string"

    def rows(lines: list[tuple[int, str]]) -> Iterator[tuple]:
        for depth, words in passages(lines):
            if quoted and depth:
                n = min(WINDOW, len(words))
                for i in range(len(words) - n + 1):
                    window, inside = _hash(words[i:i + n]), {}
                    for _, bare in words[i:i + n]:
                        inside[bare] = inside.get(bare, 0) + 1
                    for bare, many in inside.items():
                        yield window, depth, hashlib.md5(bare.encode()).hexdigest(), many
            elif not quoted and not depth:
                for w in {_hash(words[i:i + n]) for n in range(1, WINDOW + 1) for i in range(len(words) - n + 1)}:
                    yield (w,)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int32(), pa.string(), pa.int64()] if quoted else [pa.string()]
        names = ["window", "depth", "line", "words"] if quoted else ["window"]
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                out, source = [], []
                for i, lines in enumerate(part.column(2).to_pylist()):
                    new = list(rows([(x["depth"], x["bare"]) for x in lines]))
                    out += new
                    source += [i] * len(new)
                cols = list(zip(*out, strict=True)) if out else [[] for _ in names]
                take = pa.array(source, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).take(take), part.column(1).take(take), *map(pa.array, cols, kinds)], ["conv_id", "turn", *names])

    return messages.select("conv_id", "turn", _parsed().alias("lines")).mapInArrow(run, keys + (", depth int, line string, words long" if quoted else ""))


def passage_links(messages: DataFrame, missing: DataFrame) -> DataFrame:
    """missing (conv_id, turn, depth, line), quoted lines that are no earlier
    message's whole line -> those found by windows, with ``said``.

    At least half of the words of a line's windows must have been said earlier;
    a window belongs to the message that first said it, the line to the one
    (the latest of equals) with most words."""
    asked = messages.join(missing.select("conv_id", "turn").distinct(), ["conv_id", "turn"], "left_semi")
    spoken = messages.join(missing.select("conv_id").distinct(), "conv_id", "left_semi")
    first = _windows(spoken, False).groupBy("conv_id", "window").agg(F.min("turn").alias("said"))
    wanted = _windows(asked, True).groupBy("conv_id", "turn", "depth", "line", "window").agg(F.sum("words").alias("words"))
    by = wanted.join(first, ["conv_id", "window"], "left").withColumn("said", F.when(F.col("said") < F.col("turn"), F.col("said")))
    by = by.groupBy("conv_id", "turn", "depth", "line", "said").agg(F.sum("words").alias("words"))
    known = F.when(F.col("said").isNotNull(), F.struct("words", "said"))
    best = by.groupBy("conv_id", "turn", "depth", "line").agg(F.sum("words").alias("all"), F.sum(known["words"]).alias("met"), F.max(known).alias("best"))
    found = best.filter(2 * F.col("met") >= F.col("all")).select("conv_id", "turn", "depth", "line", F.col("best.said").alias("passage"))
    return missing.join(found, ["conv_id", "turn", "depth", "line"], "left")


def reply_links(messages: DataFrame) -> DataFrame:
    """conv_id, turn, quoted (lines quoted), linked (those found in an earlier
    message, whole or by windows), answers (the turn answered, null if nothing is linked)."""
    messages = messages.filter("conv_id is not null and turn is not null")
    lines = _lines(messages)
    quotes = lines.filter("depth > 0").groupBy("conv_id", "turn", "depth", "line").agg(F.count("*").alias("times"))
    first = lines.filter("depth = 0").groupBy("conv_id", "line").agg(F.min("turn").alias("said"))
    found = quotes.join(first, ["conv_id", "line"], "left").withColumn("said", F.when(F.col("said") < F.col("turn"), F.col("said")))
    found = written(found, "quotes-found")
    missing = found.filter("said is null")
    if missing.limit(1).count():
        missing = passage_links(messages, missing).select("conv_id", "line", "turn", "depth", "times", F.col("passage").alias("said"))
        found = written(found.filter("said is not null").unionByName(missing), "quotes-passages")
    by = found.groupBy("conv_id", "turn", "depth", "said").agg(F.sum("times").alias("times"))
    counts = by.groupBy("conv_id", "turn").agg(F.sum("times").alias("quoted"), F.sum(F.when(F.col("said").isNotNull(), F.col("times")).otherwise(0)).alias("linked"),
                                              F.max(F.when(F.col("said").isNotNull(), F.struct(-F.col("depth"), "times", "said"))).alias("best"))
    return counts.select("conv_id", "turn", "quoted", "linked", F.col("best.said").alias("answers"))


def threads(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, answers) distinct -> conv_id, turn, parent_turn, thread.

    Without a link a message answers the one before it. It starts a thread
    when it answers another than that; else it goes on with its neighbour's."""
    turns = turns.withColumn("block", F.floor(F.col("turn") / BLOCK))
    here = Window.partitionBy("conv_id", "block").orderBy("turn")
    ends = turns.groupBy("conv_id", "block").agg(F.max("turn").alias("last"))
    over = Window.partitionBy("conv_id").orderBy("block")
    ends = ends.select("conv_id", "block", F.lag("last").over(over).alias("before"))
    linked = turns.join(ends, ["conv_id", "block"]).withColumn("previous", F.coalesce(F.lag("turn").over(here), F.col("before")))
    forks = linked.withColumn("parent_turn", F.coalesce("answers", "previous")).withColumn(
        "fork", F.when(F.col("previous").isNull() | (F.col("parent_turn") != F.col("previous")), F.col("turn")))
    forks = forks.withColumn("sofar", F.max("fork").over(here.rowsBetween(Window.unboundedPreceding, 0)))
    carry = forks.groupBy("conv_id", "block").agg(F.max("fork").alias("top")).select(
        "conv_id", "block", F.max("top").over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    return forks.join(carry, ["conv_id", "block"]).select("conv_id", "turn", "parent_turn", F.coalesce("sofar", "carried").alias("thread"))


def list_ends(lists: DataFrame) -> DataFrame:
    """lists (conv_id, turn, to), linked lists of turns (``to`` null at an end)
    -> conv_id, turn, end, steps: the end of a turn's list and how far it is.

    Pointer doubling: rounds grow with the logarithm of the longest list. No
    two turns that still move point at one turn, so no join has a hot key."""
    moving = lists.filter("to is not null")
    known = lists.select("conv_id", F.col("turn").alias("to"), F.col("to").isNotNull().alias("open"))
    state = moving.join(known, ["conv_id", "to"]).select("conv_id", "turn", F.col("to").alias("end"), F.lit(1).cast("long").alias("steps"), "open").union(
        lists.filter("to is null").select("conv_id", "turn", "turn", F.lit(0).cast("long"), F.lit(False)))
    state = written(state, "quotes-list")
    while state.filter("open").limit(1).count():
        on = state.select("conv_id", F.col("turn").alias("end"), F.col("end").alias("beyond"), F.col("steps").alias("more"), F.col("open").alias("still"))
        moved = state.filter("open").join(on, ["conv_id", "end"]).select("conv_id", "turn", F.col("beyond").alias("end"), F.col("steps") + F.col("more"), "still")
        new = written(state.filter("not open").union(moved), "quotes-list")
        drop_written(state)
        state = new
    return state.drop("open")


def reply_order(placed: DataFrame) -> DataFrame:
    """placed (conv_id, turn, parent_turn, thread) distinct -> conv_id, turn,
    place: a number that sorts a conversation depth first, a message before
    its answers and these by turn.

    All messages of a conversation reach its first one. Without a fork the
    place is the turn. With one, the successor of a message is its first
    answer, or else the next sibling of the nearest message above (or itself)
    that has one; the place is minus the distance to the last message."""
    forked = placed.groupBy("conv_id").agg(F.min("thread").alias("low"), F.max("thread").alias("high")).filter("low <> high").select("conv_id")
    plain = placed.join(forked, "conv_id", "left_anti").select("conv_id", "turn", F.col("turn").alias("place"))
    tree = placed.join(forked, "conv_id", "left_semi").select("conv_id", "turn", "parent_turn").withColumn("block", F.floor(F.col("turn") / BLOCK))
    here = Window.partitionBy("conv_id", "parent_turn", "block").orderBy("turn")
    over = Window.partitionBy("conv_id", "parent_turn").orderBy("block")
    heads = tree.filter("parent_turn is not null").groupBy("conv_id", "parent_turn", "block").agg(F.min("turn").alias("head"))
    firsts = heads.groupBy("conv_id", F.col("parent_turn").alias("turn")).agg(F.min("head").alias("first"))
    heads = heads.select("conv_id", "parent_turn", "block", F.lead("head").over(over).alias("after"))
    tree = tree.withColumn("lead", F.lead("turn").over(here)).join(heads, ["conv_id", "parent_turn", "block"], "left")
    tree = written(tree.withColumn("next", F.coalesce("lead", "after")).join(firsts, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "parent_turn", "next", "first"), "quotes-tree")
    above = list_ends(tree.select("conv_id", "turn", F.when(F.col("next").isNull(), F.col("parent_turn")).alias("to")))
    leaves = tree.filter("first is null").select("conv_id", "turn").join(above, ["conv_id", "turn"])
    leaves = leaves.join(tree.select("conv_id", F.col("turn").alias("end"), F.col("next").alias("to")), ["conv_id", "end"]).select("conv_id", "turn", "to")
    line = written(leaves.union(tree.filter("first is not null").select("conv_id", "turn", "first")), "quotes-successors")
    return plain.union(list_ends(line).select("conv_id", "turn", -F.col("steps")))


def quote_linking(conversations: DataFrame) -> DataFrame:
    """conversations (conv_id, turn, role, text) -> conv_id, thread, turn, role,
    parent_turn, quoted, linked, content, formatted, place; one row for each row.

    Rows are sorted by (conv_id, place), the conversation in reply order (see
    ``reply_order``); with interleaved threads that is not the order of turns.
    ``thread`` is the latest turn so far that did not answer its neighbour.
    ``content`` is the text without quoted lines and the lines that announce
    them (see ``own_lines``), trimmed;
    ``formatted`` is it under its role. A null text counts as empty, a null
    role as ``unknown``. A null conversation or turn links with nothing
    (parent_turn and thread null). Rows of one conversation and turn share
    their links. Lines may be of any length and depth. Extra columns are not read; an empty table gives an empty
    result.
    """
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    turns = rows.filter("conv_id is not null and turn is not null").select("conv_id", "turn").distinct()
    turns = written(turns.join(reply_links(rows), ["conv_id", "turn"], "left"), "quotes-turns")
    placed = written(threads(turns.select("conv_id", "turn", "answers")), "quotes-placed")
    placed = placed.join(turns.select("conv_id", "turn", "quoted", "linked"), ["conv_id", "turn"]).join(reply_order(placed), ["conv_id", "turn"])
    own = F.array_join(own_lines(F.col("text")), "\n")
    out = rows.join(placed, ["conv_id", "turn"], "left").orderBy("conv_id", "place", "turn")
    out = out.withColumn("content", F.regexp_replace(own, r"^\s+|\s+$", ""))
    return out.select("conv_id", "thread", "turn", "role", "parent_turn", F.coalesce("quoted", F.lit(0)).cast("long").alias("quoted"),
                      F.coalesce("linked", F.lit(0)).cast("long").alias("linked"), "content",
                      F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.col("content")).alias("formatted"), "place")
