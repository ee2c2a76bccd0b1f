"""Chat formatting of reply trees: root-to-leaf paths by self-joins, ranked by score, each as one conversation.

A turn is written ``<role>text</turn>`` and a line feed. Inside roles and texts, a backslash is doubled and the two
angle brackets become ``\\l`` and ``\\g`` (in roles also ``/`` becomes ``\\s``), so that brackets only ever stand in
markers and every text can be read back. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import Table, written

END = "</turn>\n"
LEARNT_ROLE = "assistant"


def escape(text: Column) -> Column:
    for plain, safe in (("\\", "\\\\"), ("<", "\\l"), (">", "\\g")):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    """Doubled backslashes are split off first, from the left, so that each other one starts a code."""

    def plain(part: Column) -> Column:
        for safe, char in (("\\l", "<"), ("\\g", ">"), ("\\s", "/")):
            part = F.replace(part, F.lit(safe), F.lit(char))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("/"), F.lit("\\s"))


def _jumps(nodes: DataFrame) -> tuple[DataFrame, list[Table]]:
    """Every node's depth and the summed score of its path; and, for each k, who stands 2^k above whom.

    ``nodes``: tree, node, parent, score; parents exist. Each round joins the jumps with themselves and doubles them;
    messages whose jump has passed the root are done and only stand as others' targets.
    A cycle, which no round ends, is cut above its smallest node.
    """
    largest = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    now = Table(nodes.select("tree", "node", F.col("parent").alias("above"), F.lit(1).cast("long").alias("steps"), "score", F.col("parent").alias("least")))
    tables = [now]
    for _ in range(max(1, largest.bit_length()) + 1):
        if now.rows.where("above IS NOT NULL").limit(1).count() == 0:
            depth = F.when(F.col("above").isNull(), F.col("steps") - 1)
            return now.rows.select("tree", "node", depth.alias("depth"), "score"), tables
        up = now.rows.select(*[F.col(c).alias(f"up_{c}") for c in now.rows.columns])
        same = (F.col("tree") == F.col("up_tree")) & (F.col("above") == F.col("up_node"))
        arrived, pending = now.rows.where("above IS NULL"), now.rows.where("above IS NOT NULL")
        doubled = pending.join(up, same, "left").select(
            "tree",
            "node",
            F.col("up_above").alias("above"),
            (F.col("steps") + F.coalesce("up_steps", F.lit(0))).alias("steps"),
            (F.col("score") + F.coalesce("up_score", F.lit(0.0))).alias("score"),
            F.least("least", "up_least").alias("least"),
        )
        now = Table(arrived.unionByName(doubled))
        tables.append(now)
    cut = now.rows.where("above IS NOT NULL AND node = least").select(F.col("tree").alias("cut_tree"), F.col("node").alias("cut_node"))
    same = (F.col("tree") == F.col("cut_tree")) & (F.col("node") == F.col("cut_node"))
    parent = F.when(F.col("cut_node").isNull(), F.col("parent")).alias("parent")
    opened = written(nodes.join(cut, same, "left").select("tree", "node", parent, "score"))
    for table in tables:
        table.drop()
    return _jumps(opened)


def _turns(messages: DataFrame, tree: str, node: str, parent: str, role: str, text: str, score: str | None) -> DataFrame:
    known = F.when(F.col(tree).isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col(tree).cast("string")))
    rows = messages.select(
        known.alias("tree"),
        F.col(tree).alias("tree_id"),
        F.col(node).alias("node"),
        F.struct(
            F.col(parent).alias("parent"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
            (F.lit(0.0) if score is None else F.coalesce(F.col(score), F.lit(0.0))).cast("double").alias("score"),
        ).alias("turn"),
    ).where("node IS NOT NULL")
    return rows.groupBy("tree", "node").agg(F.first("tree_id").alias("tree_id"), F.min("turn").alias("turn")).select("tree", "tree_id", "node", "turn.*")


def conversations(
    messages: DataFrame,
    tree: str = "conv_id",
    node: str = "node",
    parent: str = "parent",
    role: str = "role",
    text: str = "text",
    score: str | None = None,
    best: int | None = None,
    learnt: str = LEARNT_ROLE,
) -> DataFrame:
    """A row for each chosen path: tree, ``path`` (rank), ``leaf``, ``score``, ``n_turns``, ``formatted``, ``loss``.

    A path runs from a message without a parent, or whose parent is not there, to one without replies. Its score is
    the sum over its messages, a null score counting 0. Paths are ranked in their tree by score, then length, then leaf,
    and the first ``best`` are chosen (``None``: all). ``loss`` holds the spans of ``formatted`` (start and end in code
    points) with the texts of the role ``learnt``. Null texts and roles are empty. Rows without a node are no
    messages; of several rows of one node the smallest stands. A message that replies to itself over others is a root if
    it is the smallest of that circle.
    """
    turns = written(_turns(messages, tree, node, parent, role, text, score))
    known = turns.select(F.col("tree").alias("known_tree"), F.col("node").alias("known_node"))
    there = (F.col("tree") == F.col("known_tree")) & (F.col("parent") == F.col("known_node"))
    nodes = written(turns.select("tree", "node", "parent", "score").join(known, there, "left").select("tree", "node", F.col("known_node").alias("parent"), "score"))
    depths, tables = _jumps(nodes)
    jump = [table.rows.where("above IS NOT NULL").select(F.col("tree").alias("from_tree"), F.col("node").alias("from_node"), "above") for table in tables]
    inner = jump[0].select(F.col("from_tree").alias("tree"), F.col("above").alias("node")).distinct()
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.col("score").desc(), F.col("depth").desc(), "node"))
    paths = depths.join(inner, ["tree", "node"], "left_anti").withColumn("path", rank)
    if best is not None:
        paths = paths.where(F.col("path") <= best)
    steps = paths.select("tree", "path", F.col("node").alias("leaf"), F.col("score").alias("path_score"), "node", F.col("depth").alias("place"))
    for k in reversed(range(len(jump))):
        same = (F.col("tree") == F.col("from_tree")) & (F.col("node") == F.col("from_node"))
        here = F.struct("node", "place")
        higher = F.struct(F.col("above").alias("node"), (F.col("place") - (1 << k)).alias("place"))
        both = F.when(F.col("above").isNull(), F.array(here)).otherwise(F.array(here, higher))
        steps = steps.join(jump[k], same, "left").select("tree", "path", "leaf", "path_score", F.inline(both))
    spoken = steps.join(turns, ["tree", "node"])
    start = F.concat(F.lit("<"), escape_role(F.col("role")), F.lit(">"))
    piece = F.struct("place", start.alias("start"), escape(F.col("text")).alias("body"), (F.col("role") == learnt).alias("learnt"))
    spoken = spoken.select("tree", "tree_id", "path", "leaf", "path_score", "place", piece.alias("piece"))
    inside = F.length("piece.start") + F.length("piece.body")
    before = F.coalesce(
        F.sum(inside + len(END)).over(Window.partitionBy("tree", "path").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    placed = spoken.withColumn("at", before + F.length("piece.start"))
    gathered = placed.groupBy("tree", "path").agg(
        F.first("tree_id").alias(tree),
        F.first("leaf").alias("leaf"),
        F.first("path_score").alias("score"),
        F.sort_array(F.collect_list(F.struct("place", "at", "piece"))).alias("turns"),
    )
    return gathered.select(
        tree,
        "path",
        "leaf",
        "score",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["piece"]["start"], t["piece"]["body"], F.lit(END))), "").alias("formatted"),
        F.transform(
            F.filter("turns", lambda t: t["piece"]["learnt"]),
            lambda t: F.struct(t["at"].alias("start"), (t["at"] + F.length(t["piece"]["body"])).alias("end")),
        ).alias("loss"),
    )


def read_turns(formatted: str) -> Column:
    """The turns of a formatted conversation, roles and texts as they were."""
    turns = F.filter(F.split(F.col(formatted), END, -1), lambda t: t != "")

    def read(turn: Column) -> Column:
        role = F.substring_index(turn, ">", 1)
        body = F.substring(turn, F.length(role) + 2, F.length(turn))
        return F.struct(unescape(F.substring(role, F.lit(2), F.length(role))).alias("role"), unescape(body).alias("text"))

    return F.transform(turns, read)


def read_loss(formatted: str, loss: str) -> Column:
    """The texts under the loss mask, as they were."""
    return F.transform(F.col(loss), lambda s: unescape(F.substring(F.col(formatted), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))


def in_turn_order(rows: DataFrame, tree: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Linear conversations as reply trees: each row answers the one before it; equal turns go by role, then text."""
    order = F.row_number().over(Window.partitionBy(tree).orderBy(turn, role, text)).cast("long")
    numbered = rows.select(F.col(tree), F.col(role), F.col(text), order.alias("node"))
    return numbered.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))


def digests(formatted: DataFrame, tree: str = "conv_id") -> DataFrame:
    """What can be read back of each formatted conversation: counts and digests of turns and of the loss text."""
    read = formatted.select(tree, "formatted", read_turns("formatted").alias("turns"), F.array_join(read_loss("formatted", "loss"), "").alias("learnt"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        tree,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
