"""Chat formatting over reply trees, in DataFrame operations only.

Messages form trees: each names the message it answers. Pointer doubling (a
self-join a round, as many rounds as the logarithm of the deepest reply) sums the
scores of every root-to-leaf path, leaves are ranked by that sum, and the chosen
paths are enumerated by the same jump tables and written as one conversation each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonlab.llm.common import cut

START, END = "<|im_start|>", "<|im_end|>"
CONTROL = "<|"


def _escape(text: Column, *, line: bool = False) -> Column:
    """Text in which no control string is left.

    A backslash becomes ``\\s`` and ``<|`` becomes ``<\\p``; on one line (a role) a
    line feed becomes ``\\n``. Every backslash of the result starts one of these
    pairs, so _unescape gives back the text.
    """
    text = F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit(CONTROL), F.lit("<\\p"))
    return F.replace(text, F.lit("\n"), F.lit("\\n")) if line else text


def _unescape(text: Column, *, line: bool = False) -> Column:
    if line:
        text = F.replace(text, F.lit("\\n"), F.lit("\n"))
    return F.replace(F.replace(text, F.lit("\\p"), F.lit("|")), F.lit("\\s"), F.lit("\\"))


def chain(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Messages of linear conversations: each turn answers the one before it.

    Rows are ordered by turn (null first), ties by role and text, so repeated
    turns all stay. A null role or text is empty; a null conv_id is a
    conversation of its own.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("__turn"),
        F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy("__turn", "role", "text")
    rows = rows.withColumn("node", F.row_number().over(order).cast("long"))
    return rows.select(
        "conv_id", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score")
    )


def _ancestors(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Path score and depth of every node that has a root, and the jump tables: level k leads 2**k messages up."""
    own, known = nodes.select("conv_id", "node", "parent", "score").alias("l"), nodes.select("conv_id", "node").alias("r")
    at = own.join(known, F.col("l.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("l.parent") == F.col("r.node")), "left")
    at = cut(at.select(
        "l.conv_id", "l.node", F.col("r.node").alias("up"),
        F.coalesce("l.score", F.lit(0.0)).cast("double").alias("total"), F.lit(1).cast("long").alias("depth"),
    ))
    most = at.agg(F.count("*").alias("n")).first()["n"]
    levels = []
    while not at.where("up IS NOT NULL").isEmpty():
        if 2 ** len(levels) > most:  # what is left answers itself in a circle
            break
        levels.append(at.where("up IS NOT NULL").select("conv_id", "node", "up"))
        # messages that have reached their root stay as they are
        left, right = at.where("up IS NOT NULL").alias("l"), at.alias("r")
        further = left.join(right, F.col("l.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("l.up") == F.col("r.node"))).select(
            "l.conv_id", "l.node", F.col("r.up").alias("up"), (F.col("l.total") + F.col("r.total")).alias("total"), (F.col("l.depth") + F.col("r.depth")).alias("depth")
        )
        at = cut(at.where("up IS NULL").union(further))
    return at.where("up IS NULL"), levels


def reply_paths(nodes: DataFrame, branches: int | None = None) -> DataFrame:
    """``(conv_id, leaf, branch, node, up)``: the messages of each chosen root-to-leaf path.

    ``nodes`` has conv_id, node (unique within conv_id), parent, score. Leaves are
    ranked within a conversation by the path's summed score, then the longer path,
    then the smaller leaf; ``branches`` keeps the best so many (all if None). ``up``
    is the distance from the leaf. A parent that is not in the table makes its
    answer a root; messages in or below a circle of answers have no root and are
    in no path; a null score is 0; a row with a null node is left out.
    """
    nodes = nodes.where("node IS NOT NULL")
    rooted, levels = _ancestors(nodes)
    answered = nodes.where("parent IS NOT NULL").select("conv_id", "parent").distinct().alias("r")
    answers = F.col("l.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("l.node") == F.col("r.parent"))
    leaves = rooted.alias("l").join(answered, answers, "left_anti")
    best = Window.partitionBy("conv_id").orderBy(F.col("total").desc(), F.col("depth").desc(), "node")
    leaves = leaves.select("conv_id", F.col("node").alias("leaf"), F.row_number().over(best).alias("branch"))
    if branches is not None:
        leaves = leaves.where(F.col("branch") <= branches)
    paths = cut(leaves.select("conv_id", "leaf", "branch", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("up")))
    for k, level in enumerate(levels):
        left, right = paths.alias("l"), level.alias("r")
        further = left.join(right, F.col("l.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("l.node") == F.col("r.node"))).select(
            "l.conv_id", "l.leaf", "l.branch", F.col("r.up").alias("node"), (F.col("l.up") + 2**k).alias("up")
        )
        paths = cut(paths.union(further))
    return paths


def format_conversations(nodes: DataFrame, *, branches: int | None = None, trained_role: str = "assistant") -> DataFrame:
    """``(conv_id, leaf, branch, formatted, loss_mask)``: each chosen path as one conversation.

    ``nodes`` is what reply_paths takes, with role and text (null: empty). A turn
    is ``<|im_start|>role``, a line feed, the text, ``<|im_end|>`` and a line feed, with
    both parts escaped. ``loss_mask`` has a span for every turn: its number from 0,
    the code points at which the turn and its text start, the text's length and
    whether it is trained on. A conversation is one string, so its turns meet in
    one task; nothing else does.
    """
    nodes = cut(nodes)
    paths = reply_paths(nodes, branches).alias("p")
    said = nodes.select("conv_id", "node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("n")
    rows = paths.join(said, F.col("p.conv_id").eqNullSafe(F.col("n.conv_id")) & (F.col("p.node") == F.col("n.node"))).select(
        "p.conv_id", "p.leaf", "p.branch", "p.up", (F.col("n.role") == trained_role).alias("trained"),
        F.concat(F.lit(START), _escape(F.col("n.role"), line=True), F.lit("\n")).alias("head"), _escape(F.col("n.text")).alias("body"),
    )
    rows = rows.withColumn("turn_text", F.concat("head", "body", F.lit(END + "\n")))
    order = Window.partitionBy("conv_id", "leaf", "branch").orderBy(F.col("up").desc())
    before = F.coalesce(F.sum(F.length("turn_text")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.select(
        "conv_id", "leaf", "branch", "turn_text",
        F.struct(
            (F.row_number().over(order) - 1).alias("turn"), before.alias("turn_start"),
            (before + F.length("head")).alias("start"), F.length("body").cast("long").alias("length"), "trained",
        ).alias("span"),
    )
    turns = F.sort_array(F.collect_list(F.struct("span", "turn_text")))
    formatted = rows.groupBy("conv_id", "leaf", "branch").agg(turns.alias("turns"))
    return formatted.select(
        "conv_id", "leaf", "branch",
        F.array_join(F.transform("turns", lambda t: t["turn_text"]), "").alias("formatted"),
        F.transform("turns", lambda t: t["span"]).alias("loss_mask"),
    )


def _blocks(formatted: Column) -> Column:
    """The turns of a formatted conversation, without their ends."""
    parts = F.split(formatted, r"<\|im_end\|>\n", -1)
    return F.slice(parts, F.lit(1), F.size(parts) - 1)


def read_back(formatted: Column) -> Column:
    """Array of (role, text): the turns that a formatted conversation holds."""

    def turn(block: Column) -> Column:
        body = block.substr(F.lit(len(START) + 1), F.length(block))
        role = F.substring_index(body, "\n", 1)
        return F.struct(
            _unescape(role, line=True).alias("role"), _unescape(body.substr(F.length(role) + 2, F.length(body))).alias("text")
        )

    return F.transform(_blocks(formatted), turn)


def read_loss(formatted: Column, loss_mask: Column) -> Column:
    """Array of the unescaped texts under the loss mask. Each span is cut from its own turn, so this is linear."""

    def under(block: Column, span: Column) -> Column:
        text = block.substr((span["start"] - span["turn_start"] + 1).cast("int"), span["length"].cast("int"))
        return F.when(span["trained"], _unescape(text))

    return F.filter(F.zip_with(_blocks(formatted), loss_mask, under), lambda text: text.isNotNull())
