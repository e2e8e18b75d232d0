"""Chat formatting of reply trees.

1. Iterative self-joins double the reach of every message's ancestor pointer: after k
   rounds a message knows its 2**k-th ancestor, the score of the messages up to it, and
   their number. The rounds end when every pointer has passed the root, so their number is
   the logarithm of the deepest tree.
2. Messages without replies are leaves; the paths from the root to them are the branches.
   Branches of a tree are ranked by the total score of their messages (ties: the longer
   one, then the smaller leaf), and the best ``branches`` are chosen.
3. The chosen leaves collect their ancestors through the same pointers, again in a
   logarithmic number of joins, and each path becomes one conversation.

Template: ``<|im_start|>`` role, line feed, text, ``<|im_end|>``, line feed. Inside texts
and roles ``<``, any number of backslashes, ``|`` gets one backslash more, so that no text
holds a control string, and reading back removes one. Line feeds and percent signs of roles
are written as %0A and %25. The loss mask holds the spans (code points of the formatted
text) of the texts of assistant messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def encode_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def decode_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def branch_paths(nodes: DataFrame, branches: int | None = 1) -> DataFrame:
    """(tree, leaf, rank, depth, node): the messages of the chosen root-to-leaf paths.

    ``nodes`` has (tree, node, parent, score), none null but parent; (tree, node) is
    unique. A message whose parent is null or missing is a root. Messages on a cycle reach
    no root and are on no path. ``branches=None`` chooses all paths. Depth is 0 at the root.
    """
    n = nodes.select("tree", "node", "parent", F.col("score").cast("double").alias("score"))
    known = n.select(F.col("tree").alias("t"), F.col("node").alias("p"))
    n = n.join(known, (n["tree"] == F.col("t")) & (n["parent"] == F.col("p")), "left").select(
        "tree", "node", F.col("p").alias("anc"), "score", F.lit(1).cast("bigint").alias("hops"))
    reach = materialize(n, "reach")
    parents = reach.where("anc is not null").select("tree", F.col("anc").alias("node")).distinct()
    leaves = reach.join(parents, ["tree", "node"], "left_anti").select("tree", "node")
    total = reach.count()
    levels, ended = [], reach.where("anc is null")
    open_ = reach.where("anc is not null")
    while True:
        left = open_.agg(F.count("*"), F.max("hops")).first()
        # a pointer that is open after as many hops as there are messages goes round in a cycle
        if not left[0] or left[1] > total:
            break
        levels.append(open_.select("tree", "node", "anc"))
        far = ended.unionByName(open_).select(
            F.col("tree").alias("t"), F.col("node").alias("at"), F.col("anc").alias("next"),
            F.col("score").alias("more"), F.col("hops").alias("further"))
        # only pointers that have not passed the root go on
        step = materialize(open_.join(far, (open_["tree"] == F.col("t")) & (open_["anc"] == F.col("at")), "left").select(
            "tree", "node", F.col("next").alias("anc"), (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"),
            (F.col("hops") + F.coalesce("further", F.lit(0))).alias("hops")), "reach")
        ended, open_ = ended.unionByName(step.where("anc is null")), step.where("anc is not null")
    done = ended.drop("anc")
    ends = leaves.join(done, ["tree", "node"])
    if branches == 1:
        best = ends.groupBy("tree").agg(F.min(F.struct(-F.col("score"), -F.col("hops"), F.col("node"))).alias("b"))
        chosen = best.select("tree", F.col("b.node").alias("leaf"), F.lit(1).alias("rank"))
    else:
        w = Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("hops"), "node")
        ranked = ends.withColumn("rank", F.row_number().over(w))
        chosen = (ranked if branches is None else ranked.where(F.col("rank") <= branches)).select(
            "tree", F.col("node").alias("leaf"), "rank")
    path = chosen.withColumn("node", F.col("leaf"))
    # each distance to an ancestor is one sum of powers of two; the longest jumps come first, so
    # that a level adds about as many rows as all levels before it
    for level in reversed(levels):
        up = level.select(F.col("tree").alias("t"), F.col("node").alias("at"), "anc")
        path = path.join(up, (F.col("tree") == F.col("t")) & (F.col("node") == F.col("at")), "left").select(
            "tree", "leaf", "rank", F.explode(F.filter(F.array("node", "anc"), lambda x: x.isNotNull())).alias("node"))
    depth = done.select("tree", "node", (F.col("hops") - 1).alias("depth"))
    return path.join(depth, ["tree", "node"]).select("tree", "leaf", "rank", "depth", "node")


def format_paths(paths: DataFrame, nodes: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(tree, leaf, rank, n_turns, formatted, loss_spans), one row per path."""
    said = nodes.select("tree", "node", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    t = paths.join(said, ["tree", "node"])
    head = F.concat(F.lit(START), encode_role(F.col("role")), F.lit("\n"))
    t = t.select("tree", "leaf", "rank", "depth", (F.col("role") == loss_role).alias("loss"), head.alias("head"),
                 escape(F.col("text")).alias("body"))
    tail = F.lit(f"{END}\n")
    piece = F.concat("head", "body", tail)
    w = Window.partitionBy("tree", "leaf").orderBy("depth")
    before = F.sum(F.length(piece)).over(w) - F.length(piece)
    t = t.select("*", piece.alias("piece"), (before + F.length("head")).alias("start"))
    g = t.groupBy("tree", "leaf", "rank").agg(
        F.sort_array(F.collect_list(F.struct("depth", "piece"))).alias("pieces"),
        F.sort_array(F.collect_list(F.when(F.col("loss"), F.struct(
            F.col("start"), (F.col("start") + F.length("body")).alias("end"))))).alias("loss_spans"))
    return g.select("tree", "leaf", "rank", F.size("pieces").cast("bigint").alias("n_turns"),
                    F.array_join(F.transform("pieces", lambda x: x["piece"]), "").alias("formatted"), "loss_spans")


def format_trees(nodes: DataFrame, branches: int | None = 1, loss_role: str = "assistant") -> DataFrame:
    """Conversations of the best branches of reply trees.

    ``nodes`` has (tree, node, parent, role, text, score); null texts and roles count as
    empty. See ``branch_paths`` for roots, ties and cycles. An empty table gives an empty
    table; other columns are not looked at.
    """
    return format_paths(branch_paths(nodes, branches), nodes, loss_role)


def turns_as_tree(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Conversations by turn as trees of one branch: each row replies to the row before it.

    Rows with equal turns are ordered by role, then text; a null turn comes first, and rows
    with a null id form one conversation. The tree is the id as text ('' for null), the
    score of a message its length.
    """
    t = turns.select(F.col(f"`{id_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"), "role", "text")
    w = Window.partitionBy("conv").orderBy("turn", "role", "text")
    node = F.row_number().over(w).cast("bigint")
    return t.select(F.coalesce(F.col("conv").cast("string"), F.lit("")).alias("tree"), node.alias("node"),
                    F.when(node > 1, node - 1).alias("parent"), "role", "text",
                    F.length(F.coalesce("text", F.lit(""))).alias("score"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds what the formatted text says: turns (role, text), turns_text and loss_text."""
    marked = F.slice(F.split("formatted", r"<\|im_end\|>\n"), F.lit(1),
                     F.greatest(F.size(F.split("formatted", r"<\|im_end\|>\n")) - 1, F.lit(0)))

    def turn(x: Column) -> Column:
        role = F.substring_index(x, "\n", 1)
        rest = F.substring(x, F.length(role) + 2, F.length(x))
        return F.struct(decode_role(F.substring(role, F.lit(len(START) + 1), F.length(role))).alias("role"),
                        unescape(rest).alias("text"))

    r = formatted.withColumn("turns", F.transform(marked, turn))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.transform("loss_spans", lambda s: unescape(F.substring(
        F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return r.withColumn("turns_text", F.array_join(lines, "")).withColumn("loss_text", F.array_join(loss, ""))
