"""Chat records from reply trees.

A tree is a set of nodes (conv_id, node, parent, role, text, score); every root-to-leaf path is
a possible conversation. Iterative self-joins on the ids alone double the pointers of each node
(1, 2, 4, .. steps up) and add the scores on the way, so a chain of n turns takes log2(n)
rounds; leaves are ranked per tree by the score of their path, and only chosen paths are
spelled out, by the same pointers from the longest step to the shortest. Join keys hold the
node, so a tree with a large share of all rows is spread like any other.

A record holds the formatted text and ``loss_spans``, byte spans over its UTF-8 form that cover
exactly the escaped assistant texts. Control strings inside texts are broken by a backslash
after their first character and backslashes doubled; dropping one backslash before any
character undoes both. Roles are url-encoded. ``read_records`` gets the turns back from the text.

Everything is DataFrame code. One output row is one whole conversation, which is the record.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.common import discard, fresh_name, only, stored

START, END = "<|im_start|>", "<|im_end|>\n"
# Control strings of common chat templates; none of them is left whole inside a text.
_CONTROL = r"([<\[])(?=\|im_start\|>|\|im_end\|>|/?s>|/?INST\]|<SYS>>|</SYS>>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL, "$1\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\s\S])", "$1")


def chain_nodes(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Plain conversations as trees without branches: each turn replies to the one before.

    Repeated turn numbers are ordered by role and text; all rows stay. A null turn comes first.
    """
    rows = only(turns, conv_id=conv_id, turn=turn, role=role, text=text)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(order).cast("long")
    return rows.withColumn("node", node).select(
        "conv_id",
        "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def choose_paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """Rows (conv_id, branch, pos, node) of the ``branches`` best paths of every tree.

    The score of a path is the sum over its nodes (null counts 0); ties go to the smaller leaf.
    A node whose parent does not exist starts a path; nodes on a cycle are on no path.
    """
    ids = stored(
        nodes.select(
            F.struct("conv_id").alias("tree"), "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score")
        ),
        "tree",
    )
    known = ids.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    jump = stored(
        ids.join(known, ["tree", "parent"], "left").select(
            "tree",
            "node",
            F.when(F.col("known"), F.col("parent")).alias("up"),
            F.lit(1).cast("long").alias("steps"),
            "score",
        ),
        "jump",
    )
    parents = ids.select("tree", F.col("parent").alias("node")).dropna(subset=["node"]).distinct()
    rounds = [jump]
    # After k rounds ``up`` is 2^k steps above and ``score`` the sum of the nodes below it. A round
    # takes only the nodes that have not reached their root; the others are known in full.
    limit = max(1, ids.count()).bit_length()
    while len(rounds) <= limit and not rounds[-1].where("up IS NOT NULL").isEmpty():
        ended = reduce(DataFrame.unionByName, [r.where("up IS NULL") for r in rounds])
        going = rounds[-1].where("up IS NOT NULL")
        above = ended.unionByName(going).select(
            "tree",
            F.col("node").alias("up"),
            F.col("up").alias("up2"),
            F.col("steps").alias("steps2"),
            F.col("score").alias("score2"),
        )
        met = going.join(above, ["tree", "up"]).select(
            "tree",
            "node",
            F.col("up2").alias("up"),
            (F.col("steps") + F.col("steps2")).alias("steps"),
            (F.col("score") + F.col("score2")).alias("score"),
        )
        rounds.append(stored(met, "jump"))
    # Where ``up`` is null, ``steps`` is the length of the whole path; on cycles it never is.
    leaves = (
        reduce(DataFrame.unionByName, [r.where("up IS NULL") for r in rounds])
        .join(parents, ["tree", "node"], "left_anti")
        .withColumn(
            "branch",
            F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), F.asc("node"))),
        )
        .where(F.col("branch") <= branches)
    )
    path = leaves.select("tree", "branch", "node", F.col("steps").alias("pos"))
    for k in range(len(rounds) - 2, -1, -1):
        up = rounds[k].where(F.col("up").isNotNull()).select("tree", "node", "up")
        higher = path.join(up, ["tree", "node"]).select(
            "tree", "branch", F.col("up").alias("node"), (F.col("pos") - (1 << k)).alias("pos")
        )
        # Stored each time: as a plan alone it would double with every step.
        shorter, path = path, stored(path.unionByName(higher), "paths")
        if k < len(rounds) - 2:
            discard(shorter)
    chosen = stored(path.select("tree.conv_id", "branch", "pos", "node"), "paths")
    discard(ids, *rounds)
    return chosen


def format_records(nodes: DataFrame, branches: int = 1, loss_role: str = "assistant") -> DataFrame:
    """One record per chosen path: conv_id, branch, formatted, loss_spans.

    Null texts and roles count as empty. ``nodes`` needs conv_id, node, parent, role, text and
    score; (conv_id, node) is unique, conv_id may be null. Extra columns are ignored; an empty
    table gives no record.
    """
    names = ("conv_id", "node", "parent", "role", "text", "score")
    nodes = stored(only(nodes, **{n: n for n in names}), "nodes")
    texts = nodes.select(F.struct("conv_id").alias("tree"), "node", "role", "text")
    paths = choose_paths(nodes, branches).select(
        F.struct("conv_id").alias("tree"), "branch", "pos", "node"
    )
    head = F.concat(
        F.lit(START), F.url_encode(F.coalesce("role", F.lit(""))), F.lit("\n")
    )
    body = escape(F.coalesce("text", F.lit("")))
    spelled = paths.join(texts, ["tree", "node"]).select(
        "tree",
        "branch",
        "pos",
        head.alias("head"),
        body.alias("body"),
        (F.col("role") == loss_role).alias("loss"),
    )
    before = Window.partitionBy("tree", "branch").orderBy("pos")
    size = F.octet_length(F.concat("head", "body")) + len(END)
    placed = spelled.withColumn("after", F.sum(size.cast("long")).over(before))
    length = F.octet_length("body").cast("long")
    span = F.struct(
        (F.col("after") - len(END) - length).alias("start"), length.alias("length")
    )
    turn = F.struct(
        "pos",
        F.concat("head", "body", F.lit(END)).alias("piece"),
        F.when(F.col("loss"), span).alias("span"),
    )
    grouped = placed.groupBy("tree", "branch").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    spans = F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull())
    return grouped.select(
        "tree.conv_id",
        "branch",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        spans.alias("loss_spans"),
    )


def read_records(records: DataFrame) -> DataFrame:
    """Records with ``turns`` (role, text) and ``loss_text``, both from the text and its spans.

    An empty or null ``formatted`` has no turns and no text under the loss; repeated records are
    read each; an added name that clashes gets underscores; an empty table stays empty.
    """
    taken = records.columns
    turns, loss = fresh_name(taken, "turns"), fresh_name(taken, "loss_text")
    pieces = F.filter(F.split("formatted", r"<\|im_start\|>"), lambda p: p != "")

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        body = F.substring(
            piece, F.length(role) + 2, F.length(piece) - F.length(role) - (1 + len(END))
        )
        return F.struct(F.url_decode(role).alias("role"), unescape(body).alias("text"))

    raw = F.encode("formatted", "UTF-8")
    covered = F.transform(
        "loss_spans",
        lambda s: F.decode(
            F.substring(raw, (s["start"] + 1).cast("int"), s["length"].cast("int")), "UTF-8"
        ),
    )
    return records.withColumns(
        {turns: F.transform(pieces, turn), loss: unescape(F.array_join(covered, ""))}
    )
