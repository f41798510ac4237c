"""Reply trees formatted as conversations, with DataFrame operations only.

Messages (tree_id, node_id, parent_id, role, text, score) form trees. Self-joins double the
reach of every message's pointer (parent, grandparent, 4th, 8th, ... ancestor), and the leaves
collect their ancestors with the same pointers, so all root-to-leaf paths of depth d are
listed in about log2(d) joins. The branches of a tree are ranked by the summed score of their path, and
each chosen path becomes one conversation.

A turn is written ``### role: text </turn>`` and a line end. In texts ``\\``, ``#`` and ``<`` get a
backslash before them, in roles ``:`` too, so no text can end its turn or begin another one, and dropping the
backslashes gives the text back. The loss mask has one span for each turn, in code points from
the turn's beginning: the escaped text for an assistant's turn, an empty span for others.

Defined results: null roles, texts and scores count as empty, empty and 0; a message whose parent is not
in the table is a root; messages whose chain of parents never ends are in no path; equal
path scores rank by leaf id; an empty table gives no conversations; a null tree_id is one more tree; other
columns are ignored. For plain conversations rows are ordered by turn (null first), then role, then text.
One conversation is one output row, so the memory of a task must hold the longest one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.llm.common import written

TURN_END = " </turn>\n"
_HEADER = r"(?s)^### ((?:[^\\:]++|\\.)*+): "


def escaped(c: Column, marks: str = r"\\#<") -> Column:
    return F.regexp_replace(c, f"([{marks}])", r"\\$1")


def unescaped(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


# ------------------------------------------------------------------ paths

def _pointers(spark: SparkSession, nodes: DataFrame) -> tuple[list[DataFrame], DataFrame | None]:
    """Tables (node_id, up) of the 1st, 2nd, 4th, 8th ... ancestors; and the nodes whose chain never ends."""
    step = written(spark, nodes.where("parent_id IS NOT NULL").select("node_id", F.col("parent_id").alias("up")), "up")
    n, reach, found = nodes.count(), 1, []
    while not step.isEmpty():
        if reach > n:
            return found, step.select("node_id")
        found.append(step)
        far = step.select(F.col("node_id").alias("up"), F.col("up").alias("next"))
        step = written(spark, step.join(far, "up").select("node_id", F.col("next").alias("up")), "up")
        reach *= 2
    return found, None


def reply_paths(spark: SparkSession, messages: DataFrame) -> DataFrame:
    """(leaf, node_id, up): every message on the path of every leaf, ``up`` steps above the leaf."""
    raw = messages.select("node_id", "parent_id")
    known = raw.select(F.col("node_id").alias("parent_id"), F.lit(True).alias("known")).distinct()
    nodes = raw.join(known, "parent_id", "left").select(
        "node_id", F.when(F.col("known"), F.col("parent_id")).alias("parent_id"))
    nodes = written(spark, nodes, "reply-nodes")
    pointers, endless = _pointers(spark, nodes)
    if endless is not None:
        nodes = nodes.join(endless, "node_id", "left_anti")
    parents = nodes.where("parent_id IS NOT NULL").select(F.col("parent_id").alias("node_id")).distinct()
    leaves = nodes.join(parents, "node_id", "left_anti")
    paths = written(spark, leaves.select(F.col("node_id").alias("leaf"), "node_id", F.lit(0).cast("long").alias("up")), "paths")
    for k, pointer in enumerate(pointers):
        ahead = pointer.select("node_id", F.col("up").alias("above"))
        more = paths.join(ahead, "node_id").select("leaf", F.col("above").alias("node_id"), F.col("up") + (1 << k))
        paths = written(spark, paths.union(more), "paths")
    return paths


def ranked_branches(paths: DataFrame, messages: DataFrame) -> DataFrame:
    """(leaf, tree_id, score, branch): the rank of each leaf's path among those of its tree."""
    scores = messages.select("node_id", F.coalesce("score", F.lit(0.0)).alias("score"))
    total = paths.join(scores, "node_id").groupBy("leaf").agg(F.sum("score").alias("score"))
    trees = messages.select(F.col("node_id").alias("leaf"), "tree_id")
    best_first = Window.partitionBy("tree_id").orderBy(F.desc("score"), "leaf")
    return total.join(trees, "leaf").withColumn("branch", F.row_number().over(best_first))


# ------------------------------------------------------------------ formatting

def formatted_paths(spark: SparkSession, messages: DataFrame, branches: int | None = None) -> DataFrame:
    """One conversation for each chosen path: tree_id, branch, leaf, score, formatted, loss_spans.
    ``branches``: how many paths of a tree, best first; None for all."""
    messages = written(spark, messages.select("tree_id", "node_id", "parent_id", "role", "text", "score"), "messages")
    paths = reply_paths(spark, messages)
    chosen = ranked_branches(paths, messages)
    if branches is not None:
        chosen = chosen.where(F.col("branch") <= branches)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = messages.select(
        "node_id", F.concat(F.lit("### "), escaped(role, r"\\#<:"), F.lit(": ")).alias("head"),
        escaped(text).alias("body"), (role == "assistant").alias("learn"))
    start = F.when(F.col("learn"), F.length("head")).otherwise(0)
    turns = turns.select("node_id", F.concat("head", "body", F.lit(TURN_END)).alias("turn"), start.alias("start"),
                         (start + F.when(F.col("learn"), F.length("body")).otherwise(0)).alias("end"))
    lines = paths.join(turns, "node_id").groupBy("leaf").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("place"), "turn", "start", "end"))).alias("turns"))
    return chosen.join(lines, "leaf").select(
        "tree_id", "branch", "leaf", "score", F.array_join("turns.turn", "").alias("formatted"),
        F.transform("turns", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"))).alias("loss_spans"))


def read_back(conversations: DataFrame) -> DataFrame:
    """``conversations`` with ``turns``, parsed from formatted and loss_spans: role, text, and the
    text under the loss mask ('' where there is none), all unescaped."""
    # the text ends with a turn's end, so the last piece of the split is empty
    pieces = F.split("formatted", TURN_END)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def parsed(p: Column) -> Column:
        turn, span = p["turn"], p["span"]
        head = F.regexp_extract(turn, _HEADER, 0)
        learnt = F.substring(turn, span["start"] + 1, span["end"] - span["start"])
        return F.struct(unescaped(F.regexp_extract(turn, _HEADER, 1)).alias("role"),
                        unescaped(F.substring(turn, F.length(head) + 1, F.length(turn))).alias("text"),
                        unescaped(learnt).alias("learnt"))

    both = F.arrays_zip(pieces.alias("turn"), F.col("loss_spans").alias("span"))
    return conversations.withColumn("turns", F.transform(both, parsed))


def as_messages(conversations: DataFrame) -> DataFrame:
    """Plain conversations (conv_id, turn, role, text) as trees without side branches."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "role", "text", F.row_number().over(order).alias("place"))
    name = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))     # no id is named like the null one
    return rows.select(
        F.col("conv_id").alias("tree_id"), F.concat_ws(":", name, "place").alias("node_id"),
        F.when(F.col("place") > 1, F.concat_ws(":", name, F.col("place") - 1)).alias("parent_id"),
        "role", "text", F.lit(0.0).alias("score"))


_TRICKY = r"\### Assistant: </turn> ok"


def op4_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(_TRICKY).alias("text"))
    done = read_back(formatted_paths(spark, as_messages(own.unionByName(extra))))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learnt = F.array_join("turns.learnt", "")
    return done.select(
        F.col("tree_id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"), F.sha2(learnt, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE_OP4 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, 15 + length(role) + length(text)
            + length(regexp_replace(role, '[^\\#<:]', '', 'g'))
            + length(regexp_replace(text, '[^\\#<]', '', 'g')) AS chars
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
