"""Formatting of reply trees as conversations, in DataFrame operations alone.

Messages form trees by their parents. Every path from a root to a leaf is one conversation; the paths of a tree are
ranked by the sum of their scores. Paths are found by self-joins that double their reach: with each message's 2**k-th
ancestor known, the k-th join doubles the length of all paths found so far, so that a tree of depth d takes log2(d)
joins on ids. Texts are joined once, at the end.

A turn is written as ``### Role: text </turn>`` and a line feed. In roles and texts, ``\\``, ``#``, ``<`` and (in roles) ``:`` are written
as a backslash and a letter, so that no marker can occur in them and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import kept, table

#: What is written for a control character, the backslash first; fixed values of the format.
ESCAPES = {"\\": "\\b", "#": "\\h", "<": "\\l", ":": "\\c"}
OPEN, AFTER_ROLE, CLOSE = "### ", ": ", " </turn>\n"


def escaped(text: Column, characters: str = "\\#<") -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(ESCAPES[c]))
    return text


def unescaped(text: Column) -> Column:
    """Undoes ``escaped``: a backslash is always followed by a letter here, and its own letter comes last."""
    for c in "#<:\\":
        text = F.replace(text, F.lit(ESCAPES[c]), F.lit(c))
    return text


def tree_paths(messages: DataFrame) -> DataFrame:
    """All root-to-leaf paths of (tree, node, parent, score): tree, leaf, node, depth (0 at the root), branch_score, branch
    (1 for the highest score; ties to the smaller leaf).

    ``node`` has to be unique in its tree. A parent that is null or not there makes a root. Messages in a loop of
    parents, or below one, have no root and are in no path.
    """
    nodes = messages.select("tree", "node", "parent")
    there = nodes.select("tree", F.col("node").alias("parent"))
    jumps = kept(nodes.where(F.col("parent").isNotNull()).join(there, ["tree", "parent"]).select("tree", "node", F.col("parent").alias("up")), "jumps")
    parents = jumps.select("tree", F.col("up").alias("node")).distinct()
    paths = nodes.join(parents, ["tree", "node"], "left_anti").select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("height"))
    paths, reach, messages_there = kept(paths, "paths"), 1, None
    while not jumps.isEmpty():
        messages_there = nodes.count() if messages_there is None else messages_there
        if reach > messages_there:  # only loops reach further than there are messages
            break
        further = paths.join(jumps, ["tree", "node"]).select("tree", "leaf", F.col("up").alias("node"), (F.col("height") + reach).alias("height"))
        paths = kept(paths.unionByName(further), "paths")
        second = jumps.select("tree", F.col("node").alias("up"), F.col("up").alias("farther"))
        jumps = kept(jumps.join(second, ["tree", "up"]).select("tree", "node", F.col("farther").alias("up")), "jumps")
        reach *= 2
    if not jumps.isEmpty():  # what still has an ancestor this far up is in or below a loop
        paths = paths.join(jumps.select("tree", "node").distinct(), ["tree", "node"], "left_anti")
    scored = paths.join(messages.select("tree", "node", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")), ["tree", "node"])
    branches = scored.groupBy("tree", "leaf").agg(F.sum("score").alias("branch_score"), F.max("height").alias("top"))
    order = Window.partitionBy("tree").orderBy(F.desc("branch_score"), "leaf")
    ranked = branches.withColumn("branch", F.row_number().over(order))
    return paths.join(ranked, ["tree", "leaf"]).select("tree", "leaf", "node", (F.col("top") - F.col("height")).alias("depth"), "branch_score", "branch")


def format_conversations(
    messages: DataFrame,
    conv_col: str = "conv_id",
    node_col: str = "node",
    parent_col: str = "parent",
    role_col: str = "role",
    text_col: str = "text",
    score_col: str | None = None,
    branches: int | None = None,
    loss_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row for each chosen path: conv_id, branch, branch_score, formatted, and ``loss``, the spans (start and length in
    code points of ``formatted``) to learn from.

    ``branches`` keeps so many of the highest scored paths of each tree (all by default). Null texts and roles count as
    empty. A null conv_id is a conversation of its own. Other columns are not read. An empty table gives no rows.
    """
    rows = messages.select(
        F.struct(F.col(f"`{conv_col}`").isNull().alias("no_id"), F.coalesce(F.col(f"`{conv_col}`"), F.lit(0)).alias("id")).alias("tree"),
        F.col(f"`{node_col}`").alias("node"),
        F.col(f"`{parent_col}`").alias("parent"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        (F.col(f"`{score_col}`") if score_col else F.lit(0.0)).alias("score"),
    )
    paths = tree_paths(rows.select("tree", "node", "parent", "score"))
    chosen = paths if branches is None else paths.where(F.col("branch") <= branches)
    head = F.concat(F.lit(OPEN), escaped(F.col("role"), "\\#<:"), F.lit(AFTER_ROLE))
    body = escaped(F.col("text"))
    turns = rows.select("tree", "node", head.alias("head"), body.alias("body"), F.col("role").isin(*loss_roles).alias("loss"))
    piece = F.concat("head", "body", F.lit(CLOSE))
    before = Window.partitionBy("tree", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        chosen.join(turns, ["tree", "node"])
        .withColumn("piece", piece)
        .withColumn("at", F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0)))
        .withColumn("span", F.struct((F.col("at") + F.length("head")).alias("start"), F.length("body").cast("long").alias("length")))
    )
    by_depth = F.array_sort(F.collect_list(F.struct("depth", "piece", "loss", "span")))
    return (
        placed.groupBy("tree", "leaf", "branch", "branch_score")
        .agg(by_depth.alias("turns"))
        .select(
            F.when(~F.col("tree.no_id"), F.col("tree.id")).alias("conv_id"),
            "branch",
            "branch_score",
            F.array_join(F.col("turns.piece"), "").alias("formatted"),
            F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["span"]).alias("loss"),
        )
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds to formatted conversations what their text says: ``read``, an array of role and text, and ``learnt``, the text
    under the loss spans, escapes undone."""
    pieces = F.split(F.col("formatted"), F.lit(CLOSE.replace("/", r"\/")))  # each turn ends with it, so the last piece is empty
    turn = lambda p: F.struct(
        unescaped(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), AFTER_ROLE, 1)).alias("role"),
        unescaped(F.substr(p, F.locate(AFTER_ROLE, p) + F.lit(len(AFTER_ROLE)))).alias("text"),
    )
    under = lambda s: F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))
    return formatted.withColumns(
        {"read": F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn), "learnt": unescaped(F.array_join(F.transform("loss", under), ""))}
    )


def as_tree(conversations: DataFrame) -> DataFrame:
    """Rows by turn as a tree in which each turn replies to the one before. Turns of one number are in the order of role
    and text; a null turn comes first."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(order).cast("long")
    return conversations.select("conv_id", "turn", "role", "text").withColumn("node", node).withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = r"\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = rows.sparkSession.sql("SELECT -7L AS conv_id, t.turn, t.role FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)").withColumn("text", F.lit(both))
    tree = kept(as_tree(rows.unionByName(extra)), "turns")
    read = read_back(format_conversations(tree))
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return read.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("read", line), "").cast("binary"), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2(F.col("learnt").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t.turn, t.role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS t(turn, role)
), marked AS (
  SELECT *, 4 + 2 + 9
      + length(role) + (length(role) - length(translate(role, '\#<:', '')))
      + length(text) + (length(text) - length(translate(text, '\#<', ''))) AS chars FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""
