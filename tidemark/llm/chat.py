r"""Reply trees as conversations: paths by iterative self-joins, branches ranked by score, one text for each.

A message has ``tree_id, node_id, parent_id, role, text, score``; a root has no parent. A branch is the
path from a root to a leaf, its score the sum over its messages (null: 0). The ``branches`` best of each
tree are kept (ties: the smaller leaf id). The self-joins double the length of the known way at each
round, so a path of n messages takes log2(n) rounds and no table holds more than a row for each message.

Each turn is written ``<s>[INST]role[/INST]text</s>``. In roles and texts a backslash is put after the
first character of whatever reads as one of these four strings, or as one with backslashes there
already; taking one away again restores every text. The loss mask has the texts of assistant turns as
(start, length) in code points of the formatted text.

Null roles and texts count as empty, null scores as 0, null trees are one tree; a parent that does not
exist makes a root. Node ids are unique within a tree: ``turn_trees`` numbers rows, so repeated rows of a
conversation are turns of their own. Replies that form a circle raise. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

# The template's control strings, and what reads as one inside a text.
BEGIN, HEADED, END = "<s>[INST]", "[/INST]", "</s>"
_OPEN = r"([<\[])(\\*)(/?s>|/?INST\])"
_ESCAPED = r"([<\[])\\(\\*)(/?s>|/?INST\])"

#: A path may be at most 2^ROUNDS messages long; longer ones raise.
ROUNDS = 40


def escaped(text: F.Column) -> F.Column:
    return F.regexp_replace(text, _OPEN, r"$1\\$2$3")


def unescaped(text: F.Column) -> F.Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def turn_trees(turns: DataFrame) -> DataFrame:
    """Messages of plain conversations: each row replies to the one before it by turn (ties: role, then text)."""
    order = Window.partitionBy("tree_id").orderBy("turn", "role", "text")
    rows = turns.select(
        F.col("conv_id").alias("tree_id"),
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("node_id", F.row_number().over(order).cast("long"))
    return rows.select(
        "tree_id", "node_id", F.when(F.col("node_id") > 1, F.col("node_id") - 1).alias("parent_id"), "role", "text", F.lit(1.0).alias("score")
    )


def best_branches(messages: DataFrame, branches: int = 1) -> DataFrame:
    """``tree_id, branch, place, role, text``: the messages of the kept branches, ``place`` 0 at the root."""
    messages = stored(
        messages.select("tree_id", "node_id", "parent_id", "role", "text", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    )
    own = messages.select("tree_id", "node_id", "parent_id", "score")
    known = own.select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"))
    # a step: from a node over `steps` messages (their scores added) to the next one up, null past a root
    step = stored(
        own.join(known, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("parent_id") == F.col("n")), "left").select(
            "tree_id", "node_id", F.col("n").alias("up"), F.lit(1).cast("long").alias("steps"), F.col("score").alias("total")
        )
    )
    parents = step.where("up IS NOT NULL").select(F.col("tree_id").alias("t"), F.col("up").alias("n")).distinct()
    leaves = step.join(parents, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("node_id") == F.col("n")), "left_anti").select(
        "tree_id", F.col("node_id").alias("leaf")
    )
    leaves = stored(leaves)
    jumps = []
    for _ in range(ROUNDS):
        going = step.where("up IS NOT NULL")  # only these are joined again: most paths are short
        if going.isEmpty():
            break
        jumps.append(going.select("tree_id", "node_id", "up"))
        far = step.select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"), F.col("up").alias("next"), F.col("steps").alias("more"), F.col("total").alias("plus"))
        further = going.join(far, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("up") == F.col("n"))).select(
            "tree_id", "node_id", F.col("next").alias("up"), (F.col("steps") + F.col("more")).alias("steps"), (F.col("total") + F.col("plus")).alias("total")
        )
        step = stored(step.where("up IS NULL").unionByName(further))
    else:
        raise ValueError(f"a path is longer than 2^{ROUNDS} messages, or replies form a circle")
    best = Window.partitionBy("tree_id").orderBy(F.col("total").desc(), F.col("leaf"))
    marked = (
        leaves.join(step.select(F.col("tree_id").alias("t"), "node_id", "total"), F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("leaf") == F.col("node_id")))
        .select("tree_id", "leaf", "total")
        .withColumn("branch", F.row_number().over(best))
        .where(F.col("branch") <= branches)
        .select("tree_id", "branch", F.col("leaf").alias("node_id"))
    )
    # from the longest jumps to the shortest: each round adds the far ends of one length
    for jump in reversed(jumps):
        ends = jump.select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"), "up")
        added = marked.join(ends, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("node_id") == F.col("n"))).select("tree_id", "branch", F.col("up").alias("node_id"))
        marked = stored(marked.unionByName(added))
    depth = step.select(F.col("tree_id").alias("dt"), F.col("node_id").alias("dn"), (F.col("steps") - 1).alias("place"))
    rows = marked.join(depth, F.col("tree_id").eqNullSafe(F.col("dt")) & (F.col("node_id") == F.col("dn"))).drop("dt", "dn")
    texts = messages.select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"), "role", "text")
    return rows.join(texts, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("node_id") == F.col("n"))).select("tree_id", "branch", "place", "role", "text")


def formatted(paths: DataFrame) -> DataFrame:
    """``tree_id, branch, formatted, loss``: one text for each branch and the spans of its assistant texts."""
    along = Window.partitionBy("tree_id", "branch").orderBy("place")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = (
        paths.select("tree_id", "branch", "place", (role == "assistant").alias("masked"), F.concat(F.lit(BEGIN), escaped(role), F.lit(HEADED)).alias("head"), escaped(text).alias("body"))
        .withColumn("ends", F.sum(F.length("head") + F.length("body") + F.lit(len(END))).over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("length", F.length("body").cast("long"))
        .withColumn("start", F.col("ends") - len(END) - F.col("length"))
    )
    turn = F.struct("place", F.concat("head", "body", F.lit(END)).alias("piece"), "masked", "start", "length")
    whole = turns.groupBy("tree_id", "branch").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    spans = F.transform(F.filter("turns", lambda x: x["masked"]), lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length")))
    return whole.select("tree_id", "branch", F.array_join("turns.piece", "").alias("formatted"), spans.alias("loss"))


def read_back(conversations: DataFrame) -> DataFrame:
    """Turns and masked text, read from ``formatted`` and ``loss`` alone."""
    bodies = F.slice(F.split("formatted", END, -1), 1, F.size(F.split("formatted", END, -1)) - 1)

    def turn(x: F.Column) -> F.Column:
        rest = F.substr(x, F.lit(len(BEGIN) + 1))
        cut = F.instr(rest, HEADED)
        return F.struct(
            unescaped(F.substr(rest, F.lit(1), cut - 1)).alias("role"),
            unescaped(F.substr(rest, cut + F.lit(len(HEADED)))).alias("text"),
        )

    masked = F.array_join(F.transform("loss", lambda s: unescaped(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
    return conversations.select("tree_id", "branch", F.transform(bodies, turn).alias("turns"), masked.alias("loss_text"), F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE = r"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
e AS (
  SELECT *, regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') AS er,
         regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') AS et FROM m
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(20 + length(er) + length(et)) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
