"""Chat formatting (operator 12): reply trees to training conversations.

Messages form trees by their parent. Iterative self-joins enumerate the paths from roots to
leaves: every round joins each message with the message it points to and doubles the
distance it points over, so depth n takes log2 n rounds; distance and score add up on the
way. The leaves of a tree are ranked by their path's score and the best ones kept; the
rounds' tables, joined the other way round, list each kept path's messages. Only ids and
numbers take part in this; the texts of the kept messages are met once at the end, and each
path becomes one conversation.

The template marks turns and roles; in roles and texts a backslash is doubled and one is
put behind the first character of every control string, so that no mark can come from a
text, and both are taken back by reading (``read_back``). ``loss`` lists the spans of the
formatted text that are learned: the assistant's texts.

Joins on ids that many rows share (a message with very many replies) are salted: ids with
1/``HOT`` of a side's rows or more, of which there are at most ``HOT``, are dealt to many
tasks.

Defined results: a null or empty text is an empty turn, a null role an empty one; a parent
that is null or that no message has makes a root; equal ids in a tree are one parent, the
first row of them (all stay messages); messages of a circle, and below one, have no
root and no path; equal scores rank by the leaf's row; an empty table gives an empty
result. Further columns are not read, whatever their names. A formatted path is one value
and must fit in a row.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm import textkit as K
from starmart.llm.components import stored
from starmart.operators.changes import lag_within_key

BEGIN, END = "<|start|>", "<|end|>"
BODY = "<|message|>"
#: Control strings of this template and of other common ones; none may come from a text.
CONTROL = [r"<\|[^<>|]*\|>", "</?s>", r"\[/?INST\]", "<</?SYS>>"]
LEARNED = "assistant"
HOT = 1024                     # a join key with 1/HOT of the rows is dealt to many tasks
HOT_ROWS = 10_000              # and only from this many rows on


# --- the template -----------------------------------------------------------------------------

def escaped(text: Column) -> Column:
    """Text that holds no control string. A pattern matches where one starts, so
    overlapping ones are all broken."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"\\", r"\\\\")
    return F.regexp_replace(t, rf"(?={'|'.join(CONTROL)})(.)", r"$1\\")


def turn_text(role: Column, text: Column) -> Column:
    return F.concat(F.lit(BEGIN), escaped(role), F.lit(BODY), escaped(text), F.lit(END))


TURN = re.compile(f"{re.escape(BEGIN)}(.*?){re.escape(BODY)}(.*?){re.escape(END)}", re.S)
BACKSLASH = re.compile(r"\\(.)", re.S)


def plain(text: str) -> str:
    """A text without its escapes."""
    return BACKSLASH.sub(r"\1", text) if "\\" in text else text


def read_batches(batches):
    """Worker: what each formatted text says, read from it and its loss spans alone."""
    for b in batches:
        texts, spans = b.column("formatted").to_pylist(), b.column("loss").to_pylist()
        turns = [TURN.findall(t) for t in texts]
        yield pa.record_batch(
            [*b.columns, pa.array([[plain(r) for r, _ in x] for x in turns], pa.list_(pa.string())),
             pa.array([[plain(t) for _, t in x] for x in turns], pa.list_(pa.string())),
             pa.array(["".join(plain(t[s["start"]:s["end"]]) for s in x) for t, x in zip(texts, spans)], pa.string())],
            names=[*b.schema.names, "roles", "texts", "learned"])


def read_back(conversations: DataFrame) -> DataFrame:
    """The formatted conversations with roles, texts and learned (all text under the loss
    mask), as read from formatted and loss."""
    more = T._parse_datatype_string("roles array<string>, texts array<string>, learned string")
    return K.arrow_map(conversations, "starmart.llm.replytree:read_batches", T.StructType([*conversations.schema.fields, *more.fields]))


# --- joins on ids that may be hot --------------------------------------------------------------

def join_hot(left: DataFrame, key: str, right: DataFrame, unique: str) -> DataFrame:
    """left join right on left.key = right.unique (a column of different name, no two rows
    alike). Left rows of a hot key are dealt over salts, for which its one right row is
    repeated."""
    total = left.count()
    least = max(HOT_ROWS, -(-total // HOT))
    hot = left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= least)
    keys = [(r[0], int(r[1] // least) + 1) for r in hot.collect()]            # at most HOT rows
    if not keys:
        return left.join(right, left[key] == right[unique], "left")
    kind = dict(right.dtypes)[unique]
    table = F.broadcast(left.sparkSession.createDataFrame(keys, f"hot_key {kind}, salts int"))
    salt = F.pmod(F.xxhash64("rid"), F.coalesce("salts", F.lit(1))).cast("int")
    a = left.join(table, left[key] == table["hot_key"], "left").withColumn("salt", salt).drop("hot_key", "salts")
    b = (right.join(table, right[unique] == table["hot_key"], "left")
         .withColumn("salt2", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("hot_key", "salts"))
    return a.join(b, (a[key] == b[unique]) & (a["salt"] == b["salt2"]), "left").drop("salt", "salt2")


# --- trees and their paths ----------------------------------------------------------------------

def chain_links(messages: DataFrame) -> DataFrame:
    """Links of plain conversations: each message answers the one before it by turn (equal
    turns by role and the text's digest); rows without a conv_id stand alone. The order
    inside a long conversation is cut into range partitions, so none is one task's."""
    place = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.md5(F.coalesce("text", F.lit(""))).alias("digest"), "rid")
    light = messages.select("conv_id", "rid", place.alias("place"))
    known = lag_within_key(light.where("conv_id is not null"), "conv_id", "place", "rid", "up").select("conv_id", "rid", "up")
    alone = light.where("conv_id is null").select("conv_id", "rid", F.lit(None).cast("long").alias("up"))
    return known.unionByName(alone).select("rid", F.col("conv_id").alias("tree"), "up", F.lit(0.0).alias("score"))


def tree_links(messages: DataFrame) -> DataFrame:
    """Links of reply trees (tree, id, parent, score): up is the row of the parent."""
    key = lambda c: F.struct(F.col("tree").cast("string").alias("tree"), F.col(c).cast("string").alias("id"))
    first = messages.groupBy(key("id").alias("own")).agg(F.min("rid").alias("up"))
    light = messages.select("rid", "tree", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
                            F.when(F.col("parent").isNotNull(), key("parent")).alias("wanted"))
    return join_hot(light, "wanted", first, "own").select("rid", "tree", "up", "score")


def climbed(links: DataFrame) -> list[DataFrame]:
    """State tables (rid, jump, root, depth, total): after k rounds jump is the message 2^k
    above, null where there is none; then root, depth and the summed score are known."""
    up = F.col("up")
    now = stored(links.select("rid", up.alias("jump"), F.when(up.isNull(), F.col("rid")).alias("root"),
                              up.isNotNull().cast("long").alias("depth"), F.col("score").alias("total")), "chat-state")
    states, most = [now], now.count().bit_length() + 1
    while len(states) <= most and now.where("jump is not null").limit(1).count():
        far = now.select(F.col("rid").alias("above"), F.col("jump").alias("far"), F.col("root").alias("far_root"),
                         F.col("depth").alias("far_depth"), F.col("total").alias("far_total"))
        moved = join_hot(now.where("jump is not null"), "jump", far, "above").select(
            "rid", F.col("far").alias("jump"), F.col("far_root").alias("root"),
            (F.col("depth") + F.col("far_depth")).alias("depth"), (F.col("total") + F.col("far_total")).alias("total"))
        now = stored(now.where("jump is null").unionByName(moved), "chat-state")
        states.append(now)
    return states


def best_paths(links: DataFrame, branches: int = 1) -> DataFrame:
    """(path, tree, rid, back, branch, path_score) of every message on a kept path: the leaf
    names the path, back counts from it. A tree keeps its ``branches`` best leaves by the mean
    score of their path."""
    states = climbed(links)
    parents = links.where("up is not null").select(F.col("up").alias("rid")).distinct()
    leaves = (states[-1].where("jump is null").join(parents, "rid", "left_anti")
              .withColumn("path_score", F.col("total") / (F.col("depth") + 1)))
    order = Window.partitionBy("root").orderBy(F.col("path_score").desc(), F.col("rid"))
    # the filter on the rank lets every task send its best leaves of a tree only
    kept = leaves.withColumn("branch", F.row_number().over(order)).where(F.col("branch") <= branches)
    kept = kept.join(links.select("rid", "tree"), "rid")
    paths = stored(kept.select(F.col("rid").alias("path"), "tree", "rid", F.lit(0).cast("long").alias("back"), "branch", "path_score"), "chat-paths")
    for k, state in enumerate(states[:-1]):
        above = state.where("jump is not null").select("rid", "jump")
        further = paths.join(above, "rid").select("path", "tree", F.col("jump").alias("rid"), (F.col("back") + 2**k).alias("back"), "branch", "path_score")
        paths = stored(paths.unionByName(further), "chat-paths")
    return paths


# --- conversations --------------------------------------------------------------------------------

def formatted(messages: DataFrame, links: DataFrame, branches: int = 1) -> DataFrame:
    """conv_id, path, branch, path_score, n_turns, formatted and loss (spans of code points)
    of every kept path."""
    turns = best_paths(links, branches).join(messages.select("rid", "role", "text"), "rid")
    turns = turns.withColumns({"turn": turn_text(F.col("role"), F.col("text")), "size": F.length(escaped(F.col("text"))),
                               "learn": F.coalesce(F.col("role") == LEARNED, F.lit(False))})
    here = Window.partitionBy("path").orderBy(F.col("back").desc())
    before = F.coalesce(F.sum(F.length("turn")).over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    end = before + F.length("turn") - len(END)
    span = F.struct((end - F.col("size")).cast("long").alias("start"), end.cast("long").alias("end"))
    turns = turns.select("path", "tree", "branch", "path_score", "back", "turn", F.when(F.col("learn"), span).alias("span"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("back")).alias("at"), "turn"))), lambda t: t["turn"]), "")
    return turns.groupBy("path").agg(
        F.first("tree").alias("conv_id"), F.first("branch").alias("branch"), F.first("path_score").alias("path_score"),
        F.count(F.lit(1)).alias("n_turns"), text.alias("formatted"), F.sort_array(F.collect_list("span")).alias("loss"))


def format_chains(conversations: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) formatted, one a conv_id."""
    messages = numbered(conversations, "conv_id", "turn", "role", "text")
    return formatted(messages, chain_links(messages))


def format_trees(messages: DataFrame, branches: int = 1) -> DataFrame:
    """Reply trees (tree, id, parent, role, text, score): the best branches, formatted."""
    rows = numbered(messages, "tree", "id", "parent", "role", "text", "score")
    return formatted(rows, stored(tree_links(rows), "chat-links"), branches)


def numbered(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns, stored, each row with a number of its own."""
    text = {"role": F.col("role").cast("string"), "text": F.col("text").cast("string")}
    return stored(df.select(*columns).withColumns(text).withColumn("rid", F.monotonically_increasing_id()), "chat-messages")
