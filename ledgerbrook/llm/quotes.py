"""Chat formatting by quotation linking.

A line that starts with ``>`` quotes; the number of marks is its level.  The lines of level 0 are a message's
own.  Every line is normalised (marks off, lower case, runs of blanks as one); lines of one level that
follow each other without a blank one are a *passage*, joined by blanks, so that new line ends change nothing.  Passages and
their lines are hashed, and so is every run of ``WINDOW`` words in them.  Within its conversation, a quoted
passage is joined to messages of earlier turns:

* to the nearest that has it as a passage or a line of its own;
* else, with ``WINDOW`` words or more, if each of its runs of so many words stands in some earlier message: to
  the one that is nearest for most of them, the nearer of two (a quote of a part, or over line ends);
* else its lines are looked for one by one by the same rules.

The message quoted most (by lines) at the shallowest level becomes the *parent*;
messages without one open a thread.  Quotes that found their origin go from the content, others stay.  A conversation is ordered by its threads: a reply follows the
message it answers, siblings by turn.

Only conversations with a quote are looked at.  The nearest earlier writer of a hash is found by running
maxima, within spans of ``SPAN`` turns and then over the spans, so common lines and large conversations make no pairs and
no task sees all places of a line.  Paths to the root are found by pointer
jumping.  Null texts are empty messages; null turns are never quoted and come first; rows with the same
conversation and turn share a parent, and all stay.  Empty tables give empty ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from .tables import saved

WINDOW = 8
SPAN = 1024
_MARKS = r"^([\x20\x09]*>)+"


def normalised(line: Column) -> Column:
    bare = F.regexp_replace(line, _MARKS, "")
    return F.lower(F.trim(F.regexp_replace(bare, r"[\x20\x09-\x0D]+", " ")))


def level(line: Column) -> Column:
    return F.regexp_count(F.regexp_extract(line, _MARKS, 0), F.lit(">"))


def own_text(text: Column, linked: Column) -> Column:
    """The lines but for quotes that found their origin; blank lines that these leave at both ends go.

    ``linked`` has the places of such lines; with any, blank quoted lines go, too.
    """
    gone = lambda line, place: line.rlike(_MARKS) & (
        (normalised(line) == "") & (F.size(linked) > 0) | F.array_contains(linked, place)
    )
    lines = F.filter(F.split(text, "\n"), lambda line, place: ~gone(line, place))
    return F.regexp_replace(F.array_join(lines, "\n"), r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")


_MESSAGE = ["conv", "turn", "body"]


def _pieces(rows: DataFrame) -> DataFrame:
    """Passages and the lines of passages with several: ``conv, turn, body, first, size, line, level, words``.

    ``first`` and ``size`` are the places of the lines in the message; ``line`` is -1 for a passage.
    """
    bodies = rows.select(*_MESSAGE, "text").distinct()
    lines = bodies.select(*_MESSAGE, F.posexplode(F.split("text", "\n")).alias("place", "line"))
    lines = lines.select(*_MESSAGE, "place", level(F.col("line")).alias("level"), normalised(F.col("line")).alias("line"))
    before = Window.partitionBy(*_MESSAGE).orderBy("place")
    starts = (F.col("level") != F.lag("level", 1, -1).over(before)) | (F.lag("line", 1, "").over(before) == "")
    runs = lines.withColumn("starts", starts.cast("int")).withColumn("run", F.sum("starts").over(before)).where("line <> ''")
    passages = runs.groupBy(*_MESSAGE, "run").agg(
        F.min("level").alias("level"), F.array_sort(F.collect_list(F.struct("place", "line"))).alias("lines")
    )
    passages = passages.withColumns({"first": F.col("lines")[0]["place"], "size": F.size("lines")})
    one = lambda first, size, line, text: F.struct(
        first.alias("first"), size.alias("size"), line.alias("line"), F.split(text, " ").alias("words")
    )
    whole = one(F.col("first"), F.col("size"), F.lit(-1), F.array_join("lines.line", " "))
    each = F.transform("lines", lambda x: one(x["place"], F.lit(1), x["place"], x["line"]))
    parts = F.concat(F.array(whole), F.when(F.col("size") > 1, each).otherwise(F.slice(each, 1, 0)))
    return passages.select(*_MESSAGE, "level", "run", F.explode(parts).alias("part")).select(
        *_MESSAGE, "level", "run", "part.*"
    )


def _hashes(pieces: DataFrame, *columns: str) -> DataFrame:
    """The columns, ``hash`` and ``whole``: a row for each piece and for each run of ``WINDOW`` words in it."""
    runs = F.when(F.size("words") >= WINDOW, F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)))
    name = lambda words: F.xxhash64(F.array_join(words, " "))
    each = F.transform(runs, lambda i: F.struct(name(F.slice("words", i, WINDOW)).alias("hash"), F.lit(False).alias("whole")))
    whole = F.array(F.struct(name(F.col("words")).alias("hash"), F.lit(True).alias("whole")))
    found = F.explode(F.concat(whole, F.coalesce(each, F.slice(whole, 1, 0))))
    return pieces.select(*columns, found.alias("found")).select(*columns, "found.*")


def nearest(own: DataFrame, asked: DataFrame) -> DataFrame:
    """``conv, hash, turn, origin``: for each asked turn the largest smaller one in ``own``, if there is one."""
    keys = ["conv", "hash", "turn"]
    both = own.select(*keys, F.col("turn").alias("own")).unionByName(
        asked.select(*keys, F.lit(None).cast("bigint").alias("own"))
    )
    span = F.floor(F.col("turn") / SPAN).alias("span")
    both = both.groupBy(*keys).agg(F.max("own").alias("own"), F.bool_or(F.col("own").isNull()).alias("asked"))
    both = both.select("*", span)
    inside = Window.partitionBy("conv", "hash", "span").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy("conv", "hash").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = both.groupBy("conv", "hash", "span").agg(F.max("own").alias("last"))
    spans = spans.withColumn("older", F.max("last").over(ahead)).select("conv", "hash", "span", "older")
    near = both.withColumn("near", F.max("own").over(inside)).where("asked").join(spans, ["conv", "hash", "span"])
    return near.select(*keys, F.coalesce("near", "older").alias("origin")).where("origin is not null")


def _origins(pieces: DataFrame) -> DataFrame:
    """The quoted pieces that found their ``origin``, a passage in place of its lines."""
    own = _hashes(pieces.where("level = 0 and turn is not null"), "conv", "turn")
    piece = [*_MESSAGE, "run", "line"]
    asked = _hashes(pieces.where("level > 0 and turn is not null"), *piece, "level", "first", "size")
    found = asked.join(nearest(own, asked), ["conv", "hash", "turn"], "left")
    votes = found.groupBy(*piece, "level", "first", "size", "whole", "origin").agg(F.count("*").alias("n"))
    part = F.when(~F.col("whole") & F.col("origin").isNotNull(), F.struct("n", "origin"))
    votes = votes.groupBy(*piece, "level", "first", "size").agg(
        F.max(F.when(F.col("whole"), F.col("origin"))).alias("same"),
        F.max(part)["origin"].alias("most"),
        F.bool_or(~F.col("whole") & F.col("origin").isNull()).alias("open"),
    )
    votes = votes.withColumn("origin", F.expr("coalesce(same, if(open, null, most))")).where("origin is not null")
    whole = votes.where("line = -1").select(*_MESSAGE, "run")
    return votes.where("line = -1").unionByName(votes.where("line >= 0").join(whole, [*_MESSAGE, "run"], "left_anti"))


def _linked(origins: DataFrame) -> DataFrame:
    """``conv, turn, body, linked``: the places of the lines that found their origin."""
    places = F.sequence("first", F.col("first") + F.col("size") - 1)
    return origins.groupBy(*_MESSAGE).agg(F.flatten(F.collect_list(places)).alias("linked"))


def _parents(origins: DataFrame) -> DataFrame:
    """``conv, turn, parent``: the earlier message quoted most by each message with a found quote."""
    votes = origins.groupBy("conv", "turn", "origin").agg(F.min("level").alias("level"), F.sum("size").alias("n"))
    best = F.min_by("origin", F.struct("level", -F.col("n"), -F.col("origin")))
    return votes.groupBy("conv", "turn").agg(best.alias("parent"))


def _paths(parents: DataFrame) -> DataFrame:
    """``conv, turn, path``: the turns above a reply, from the thread's first message on."""
    jumps = saved(parents.select("conv", "turn", F.col("parent").alias("top"), F.array("parent").alias("path")), "jumps")
    while True:
        above = jumps.select("conv", F.col("turn").alias("top"), F.col("top").alias("next"), F.col("path").alias("more"))
        joined = jumps.join(above, ["conv", "top"], "left")
        moved = saved(
            joined.select(
                "conv", "turn", F.coalesce("next", "top").alias("top"),
                F.when(F.col("next").isNull(), F.col("path")).otherwise(F.concat("more", "path")).alias("path"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "jumps",
        )
        jumps = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return jumps.select("conv", "turn", "path")


def threads(
    table: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Per message: conversation, turn, role, ``parent_turn``, ``depth``, ``place`` and the formatted ``content``.

    Sorting a conversation by ``place`` (an array of turns) gives its reply order.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = table.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.col(f"`{role}`").cast("string").alias("role"), body.alias("text"),
    )
    rows = rows.withColumn("body", F.xxhash64("text"))
    quoting = rows.where(F.col("text").rlike(f"(?m){_MARKS}")).select("conv").distinct()
    pieces = _pieces(rows.join(quoting, "conv", "left_semi"))
    origins = saved(_origins(saved(pieces, "pieces")), "origins")
    parents = saved(_parents(origins), "parents")
    paths = _paths(parents).join(parents, ["conv", "turn"])
    joined = rows.alias("m").join(
        paths.alias("p"), F.expr("m.conv <=> p.conv and m.turn <=> p.turn"), "left"
    ).join(_linked(origins).alias("l"), F.expr("m.conv = l.conv and m.turn = l.turn and m.body = l.body"), "left")
    path = F.coalesce("p.path", F.array().cast("array<bigint>"))
    linked = F.coalesce("l.linked", F.array().cast("array<int>"))
    content = F.concat(F.lit("<|"), F.coalesce("m.role", F.lit("")), F.lit("|>\n"), own_text(F.col("m.text"), linked), F.lit("\n"))
    return joined.select(
        F.col("m.conv").alias(conv),
        F.col("m.turn").alias(turn),
        F.col("m.role").alias(role),
        F.col("p.parent").alias("parent_turn"),
        F.size(path).cast("bigint").alias("depth"),
        F.concat(path, F.array("m.turn")).alias("place"),
        content.alias("content"),
    )
