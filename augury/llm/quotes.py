"""Chat formatting by quotation linking, with DataFrame functions only.

Leading `>` marks give each line's quote level. Runs of lines of one level are passages; a quoted passage is normalised
(marks off, lower case, single blanks), hashed and joined to the messages of the same conversation that said it: each
original contributes the hash of its whole unquoted text, of each of its passages, of their paragraphs (parts between
blank lines) and of its runs of lines that are as long as a quote of that conversation. A quote is looked up whole, by
its paragraphs and by its lines, each of them in the latest earlier message that has it. A message answers the message
that one of its quotes was found in; of several quotes the least nested, then the first, counts; its whole goes before
its parts, and of these the message with the most text of parts, then the latest, counts. Following the answers up gives
the thread and depth; messages are ordered by thread, depth and turn, and their text is left without quotes.

A null text is an empty message. A null conv_id is a conversation of its own; a null turn sorts first and cannot be
quoted. Rows that repeat (conv_id, turn) are messages of their own: a quote found in them links to that turn, and they
are ordered by role and a hash of the text. Blank passages are never linked. A very long message is an array of lines in
one row. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from augury.llm.common import ranked, remove, written

_MARKS = r"^((?:[ \t]*>)+)"
_BLANK = r"\n\s*\n"
_TEXTS = "array<string>"


def normal(text: Column) -> Column:
    return F.btrim(F.lower(F.regexp_replace(text, r"\s+", " ")))


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 1), "[^>]", ""))


def parsed(messages: DataFrame) -> DataFrame:
    """Adds passages: runs of lines of one level, as arrays of struct(level, text). Most messages have no mark at all and
    are one passage as they stand."""
    split = F.split(F.coalesce("text", F.lit("")), r"\r?\n")
    marked = F.coalesce(F.contains(F.col("text"), F.lit(">")), F.lit(False))
    rows = messages.withColumn("marked", marked).withColumn("lines", F.when(F.col("marked"), F.transform(split, lambda x: F.struct(_level(x).alias("level"), F.regexp_replace(x, _MARKS, "").alias("text")))))
    # A passage starts at the first line and wherever the level changes.
    changes = lambda i: F.when(i == 1, True).otherwise(F.element_at("lines", i)["level"] != F.element_at("lines", i - 1)["level"])
    rows = rows.withColumn("starts", F.when(F.col("marked"), F.filter(F.sequence(F.lit(1), F.size("lines")), changes)))

    def passage(start: Column, k: Column) -> Column:
        after = F.coalesce(F.get("starts", k + 1), F.size("lines") + 1)
        text = F.array_join(F.transform(F.slice("lines", start, after - start), lambda x: x["text"]), "\n")
        return F.struct(F.element_at("lines", start)["level"].alias("level"), text.alias("text"))

    whole = F.array(F.struct(F.lit(0).alias("level"), F.regexp_replace(F.coalesce("text", F.lit("")), r"\r\n", "\n").alias("text")))
    return rows.withColumn("passages", F.when(F.col("marked"), F.transform("starts", passage)).otherwise(whole)).drop("starts", "lines", "marked")


def _hash(text: Column) -> Column:
    return F.xxhash64(normal(text))


def _full(texts: Column) -> Column:
    return F.filter(texts, lambda x: normal(x) != "")


def _parts(text: Column, by: str) -> Column:
    """Parts of a text that are not blank; none if it is not divided."""
    parts = F.split(text, by)
    return F.when(F.size(parts) > 1, _full(parts)).otherwise(F.array().cast(_TEXTS))


def _pieces(text: Column) -> Column:
    """Array of struct(part, size, hash): the whole, and the paragraphs and lines that it is divided into."""
    piece = lambda part: lambda x: F.struct(F.lit(part).alias("part"), F.length(normal(x)).alias("size"), _hash(x).alias("hash"))
    return F.concat(F.array(piece(False)(text)), F.transform(F.concat(_parts(text, _BLANK), _parts(text, "\n")), piece(True)))


def _said(own: DataFrame, lengths: DataFrame) -> DataFrame:
    """Rows (conv_id, parent, hash) of what the messages own (conv_id, turn, clean, said: unquoted passages) offer to
    quotes whose pieces have the numbers of lines listed for their conversation (conv_id, lengths)."""
    asked = lengths.select(F.col("conv_id").alias("c"), "lengths")
    own = own.join(asked, F.col("conv_id").eqNullSafe(F.col("c")))
    lines = _full(F.flatten(F.transform("said", lambda p: F.split(p, "\n"))))
    own = own.select("conv_id", F.col("turn").alias("parent"), "clean", "said", "lengths", lines.alias("lines"))
    paragraphs = F.flatten(F.transform("said", lambda p: _parts(p, _BLANK)))

    def runs(n: Column) -> Column:
        # sequence() counts down past its end, so messages shorter than the run are left out first.
        starts = F.when(F.size("lines") >= n, F.sequence(F.lit(1), F.size("lines") - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda k: _hash(F.array_join(F.slice("lines", k, n), "\n")))

    hashes = F.concat(F.array(_hash(F.col("clean"))), F.transform(F.concat("said", paragraphs), _hash), F.flatten(F.transform("lengths", runs)))
    return own.select("conv_id", "parent", F.explode(F.array_distinct(hashes)).alias("hash")).distinct()


def _latest(asked: DataFrame, there: DataFrame) -> DataFrame:
    """Rows of asked (conv_id, hash, turn and others) with parent, the latest turn of there (conv_id, parent,
    hash) before theirs; linear in both, however often a passage is repeated."""
    wanted = asked.select(F.col("conv_id").alias("c"), F.col("hash").alias("h")).distinct()
    there = there.join(wanted, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("hash") == F.col("h")), "left_semi")
    said = there.select("conv_id", "hash", F.col("parent").alias("turn"), "parent")
    before = Window.partitionBy("conv_id", "hash").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    both = asked.unionByName(said, allowMissingColumns=True).withColumn("parent", F.last("parent", ignorenulls=True).over(before))
    return both.where("id is not null and parent is not null")


def linked(messages: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, id, text_hash, clean, n_quotes, level, parent): parent is the turn that the message
    answers. Texts are parsed once and written; only conversations that quote at all are hashed."""
    rows = parsed(messages.select("conv_id", "turn", "role", "text"))
    own = F.transform(F.filter("passages", lambda p: p["level"] == 0), lambda p: p["text"])
    clean = F.btrim(F.array_join(own, "\n"), F.lit(" \t\r\n"))
    quotes = F.filter("passages", lambda p: (p["level"] > 0) & (normal(p["text"]) != ""))
    # The passages of a message of one passage are not kept beside its text.
    rows = rows.select("conv_id", "turn", "role", F.xxhash64("text").alias("text_hash"), clean.alias("clean"), quotes.alias("quotes"), F.when(F.size(own) != 1, own).alias("said"))
    rows = written(rows.withColumn("id", F.monotonically_increasing_id()), "messages")
    asked = rows.where((F.size("quotes") > 0) & F.col("turn").isNotNull()).select("conv_id", "id", "turn", F.posexplode("quotes").alias("nth", "q"))
    lengths = asked.select("conv_id", F.size(_full(F.split("q.text", "\n"))).alias("n")).union(asked.select("conv_id", F.lit(1)).distinct()).groupBy("conv_id").agg(F.collect_set("n").alias("lengths"))
    there = _said(rows.where("turn is not null").select("conv_id", "turn", "clean", F.coalesce("said", F.array("clean")).alias("said")), lengths)
    asked = asked.select("conv_id", "id", "turn", "nth", F.col("q.level").alias("level"), F.explode(_pieces(F.col("q.text"))).alias("p")).select("conv_id", "id", "turn", "nth", "level", "p.part", "p.size", "p.hash")
    votes = _latest(asked, there).groupBy("id", "level", "nth", "part", "parent").agg(F.sum("size").alias("n"))
    best = votes.groupBy("id").agg(F.min_by("parent", F.struct("level", "nth", "part", -F.col("n"), -F.col("parent"))).alias("parent"))
    level = F.coalesce(F.array_max(F.transform("quotes", lambda q: q["level"])), F.lit(0))
    return rows.join(best, "id", "left").select("conv_id", "turn", "role", "id", "text_hash", "clean", F.size("quotes").cast("long").alias("n_quotes"), level.cast("long").alias("level"), "parent")


def threads(rows: DataFrame) -> DataFrame:
    """Adds thread (turn of the first message of the chain of answers) and depth, by doubling the steps followed."""
    rows = written(rows, "linked")
    # One message stands for each turn that is answered.
    order = F.struct(F.col("parent").isNull(), "role", "text_hash")
    nodes = rows.where("turn is not null").groupBy("conv_id", "turn").agg(F.min_by("parent", order).alias("up"))
    state = written(nodes.where("up is not null").select("conv_id", "turn", "up", F.lit(1).cast("long").alias("steps")), "chains")
    while True:
        above = state.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("up").alias("up2"), F.col("steps").alias("more"))
        joined = state.join(above, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("up") == F.col("t")), "left")
        moved = written(joined.select("conv_id", "turn", F.coalesce("up2", "up").alias("up"), (F.col("steps") + F.coalesce("more", F.lit(0).cast("long"))).alias("steps"), F.col("up2").isNotNull().alias("moved")), "chains")
        remove(state)
        state = moved.drop("moved")
        if not moved.where("moved").limit(1).count():
            break
    tops = state.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("up").alias("top"), F.col("steps").alias("above"))
    # A message hangs under its own parent, whichever message stands for its turn.
    out = rows.join(tops, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("parent") == F.col("t")), "left")
    thread = F.when(F.col("parent").isNull(), F.col("turn")).otherwise(F.coalesce("top", "parent"))
    depth = F.when(F.col("parent").isNull(), 0).otherwise(1 + F.coalesce("above", F.lit(0).cast("long")))
    return out.select(*rows.columns, thread.alias("thread"), depth.cast("long").alias("depth"))


def conversations(messages: DataFrame) -> DataFrame:
    """One row per message: conv_id, position (0-based, in reply order), turn, role, parent, thread, depth, n_quotes,
    level (deepest quote), text without quotes."""
    placed = ranked(threads(linked(messages)), ["conv_id", "thread", "depth", "turn", "role", "text_hash", "id"])
    first = placed.groupBy("conv_id").agg(F.min("rank").alias("first")).select(F.col("conv_id").alias("c"), "first")
    out = placed.join(first, F.col("conv_id").eqNullSafe(F.col("c")))
    return out.select("conv_id", (F.col("rank") - F.col("first")).alias("position"), "turn", "role", "parent", "thread", "depth", "n_quotes", "level", F.col("clean").alias("text"))
