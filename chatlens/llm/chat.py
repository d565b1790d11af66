"""Chat formatting of reply trees.

Messages name their parent. Self-joins that double the distance to an ancestor (1, 2, 4, ...) find
the depth and the summed score of every message in as many rounds as the deepest branch has binary
digits. Leaves are ranked by the mean score of their branch, and the same jump tables, walked from
the longest jump to the shortest, mark the messages of each chosen branch: every ancestor distance
is a sum of powers of two, so the marked rows are just the chosen paths, never all partial ones.
Each chosen path is one formatted conversation. Only DataFrame functions are used.

Template: ``<s>[role]text</s>`` and a line feed per turn. Inside roles and texts the characters
``~ < [ ]`` are written ``~0 ~1 ~2 ~3``, so no text can forge a mark, and reading back restores it.
``loss_spans`` are the code point ranges (end exclusive) of the assistant's texts.

Defined cases: a null role or text is empty; the null conversation id is a conversation; turns are
ordered by turn (null last), role, text, so repeated rows and ties are turns of their own; a message
whose parent is missing is a root; messages on a cycle have no root and are left out; ties between
branches go to the deeper one, then to the smaller leaf id; other columns are ignored; empty tables
give empty results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatlens.llm.staging import stage

# The template's marks and escapes.
ESCAPES = (("~", "~0"), ("<", "~1"), ("[", "~2"), ("]", "~3"))
START, TURN_END = "<s>[", "</s>\n"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), ESCAPES, text)


def unescape(text: Column) -> Column:
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[1]), F.lit(pair[0])), reversed(ESCAPES), text)


def turns_as_tree(conversations: DataFrame) -> DataFrame:
    """Linear conversations as trees: every turn replies to the one before it."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), F.col("role"), F.col("text"))
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = rows.withColumn("msg_id", F.row_number().over(order).cast("long") - 1)
    parent = F.when(F.col("msg_id") > 0, F.col("msg_id") - 1)
    return rows.select(
        F.col("conv_id").alias("tree_id"), "msg_id", parent.alias("parent_id"), "role", "text",
        F.length("text").cast("double").alias("score"),
    )


def _to(left: DataFrame, key: str, right: DataFrame, how: str) -> DataFrame:
    """Follow a pointer: right's columns t, m are matched with left's t and ``key``, then dropped."""
    right = right.withColumnsRenamed({"t": "_t", "m": "_m"})
    joined = left.join(right, left["t"].eqNullSafe(right["_t"]) & (left[key] == right["_m"]), how)
    return joined if how in ("left_semi", "left_anti") else joined.drop("_t", "_m")


def reply_paths(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """tree_id, msg_id, parent_id, score -> the messages of the best branches of each tree.

    Returns tree_id, leaf_id, branch_rank, branch_score, depth, msg_id. Message ids are unique in a tree.
    """
    nodes = messages.select(
        F.col("tree_id").alias("t"), F.col("msg_id").alias("m"), F.col("parent_id").alias("anc"),
        F.coalesce("score", F.lit(0.0)).alias("s"),
    )
    known = nodes.select("t", "m", F.lit(True).alias("known"))
    start = _to(nodes, "anc", known, "left")
    start = start.select("t", "m", F.when(F.col("known"), F.col("anc")).alias("anc"), "s")
    state = stage(start.withColumn("depth", F.col("anc").isNotNull().cast("long")))
    largest = state.groupBy("t").count().agg(F.max("count")).first()[0] or 0
    jumps = []
    for _ in range(largest.bit_length()):
        if state.where("anc IS NOT NULL").isEmpty():
            break
        jumps.append(state.select("t", "m", "anc").where("anc IS NOT NULL"))
        further = state.select("t", "m", F.col("anc").alias("anc2"), F.col("s").alias("s2"), F.col("depth").alias("depth2"))
        joined = _to(state, "anc", further, "left")
        state = stage(
            joined.select(
                "t", "m", F.col("anc2").alias("anc"),
                (F.col("s") + F.coalesce("s2", F.lit(0.0))).alias("s"),
                (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth"),
            )
        )
    rooted = state.where("anc IS NULL").select("t", "m", "s", "depth")
    parents = start.where("anc IS NOT NULL").select("t", F.col("anc").alias("m")).distinct()
    leaves = _to(rooted, "m", parents, "left_anti")
    score = F.col("s") / (F.col("depth") + 1)
    ranked = Window.partitionBy("t").orderBy(F.col("score").desc(), F.col("depth").desc(), "m")
    best = leaves.withColumn("score", score).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= per_tree)
    marked = stage(best.select("t", F.col("m").alias("leaf"), "rank", "score", "m"))
    for jump in reversed(jumps):
        above = _to(marked, "m", jump, "inner").select("t", "leaf", "rank", "score", F.col("anc").alias("m"))
        marked = stage(marked.unionByName(above))
    return _to(marked, "m", rooted.select("t", "m", "depth"), "inner").select(
        F.col("t").alias("tree_id"), F.col("leaf").alias("leaf_id"), F.col("rank").alias("branch_rank"),
        F.col("score").alias("branch_score"), "depth", F.col("m").alias("msg_id"),
    )


def format_paths(messages: DataFrame, paths: DataFrame) -> DataFrame:
    """Each path as one conversation: tree_id, leaf_id, branch_rank, formatted, loss_spans."""
    texts = messages.select(
        F.col("tree_id").alias("t"), F.col("msg_id").alias("m"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    pieces = _to(paths.withColumnRenamed("tree_id", "t"), "msg_id", texts, "inner").select(
        "t", "leaf_id", "branch_rank", "depth", "role",
        F.concat(F.lit(START), escape(F.col("role")), F.lit("]")).alias("head"), escape(F.col("text")).alias("body"),
    )
    turn = F.struct("depth", "role", "head", "body", F.lit(TURN_END).alias("tail"))
    grouped = pieces.groupBy("t", "leaf_id", "branch_rank").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    whole = F.array_join(F.transform("turns", lambda x: F.concat(x["head"], x["body"], x["tail"])), "")

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["head"])
        end = start + F.length(x["body"])
        spans = F.when(
            x["role"] == TRAINED_ROLE, F.concat(acc["spans"], F.array(F.struct(start.alias("start"), end.alias("end"))))
        ).otherwise(acc["spans"])
        return F.struct((end + F.length(x["tail"])).alias("at"), spans.alias("spans"))

    none = F.array().cast("array<struct<start:int,end:int>>")
    spans = F.aggregate("turns", F.struct(F.lit(0).alias("at"), none.alias("spans")), add, lambda acc: acc["spans"])
    return grouped.select(
        F.col("t").alias("tree_id"), "leaf_id", "branch_rank", whole.alias("formatted"), spans.alias("loss_spans")
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Add ``turns`` (role and text of each turn) and ``loss_text``, read from the formatted text."""
    pieces = F.filter(F.split("formatted", TURN_END), lambda p: p != "")

    def parse(piece: Column) -> Column:
        head = F.instr(piece, "]")
        role = F.substring(piece, F.lit(len(START) + 1), head - F.lit(len(START) + 1))
        return F.struct(unescape(role).alias("role"), unescape(F.substring(piece, head + 1, F.length(piece))).alias("text"))

    masked = F.transform(
        "loss_spans", lambda x: F.substring(F.col("formatted"), x["start"] + 1, x["end"] - x["start"])
    )
    return formatted.withColumn("turns", F.transform(pieces, parse)).withColumn(
        "loss_text", F.array_join(F.transform(masked, unescape), "")
    )
