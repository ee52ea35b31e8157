"""Chat formatting over reply trees, in DataFrame operations only.

A reply tree is walked by self-joins that double their reach each round: they sum the scores from
the root down, rank each tree's leaves by that sum, and mark the messages on the chosen paths. Each
chosen path becomes one conversation in a template whose control strings are escaped in texts.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postsift.session import staged

# The template's control strings, a turn being open, role, body, text, close.
OPEN, BODY, CLOSE = "[INST]", "[/INST]", "</s>"
CONTROLS = ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>")
MARK = "\\"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Double each mark, and put one inside each control string, after its first character."""
    out = F.replace(text, F.lit(MARK), F.lit(MARK * 2))
    for control in sorted(CONTROLS, key=len, reverse=True):
        out = F.replace(out, F.lit(control), F.lit(control[0] + MARK + control[1:]))
    return out


def unescape(text: Column) -> Column:
    """The reverse: of two marks one stays, a single one goes."""
    return F.regexp_replace(text, "\\\\(\\\\?)", "$1")


def _keyed(messages: DataFrame) -> DataFrame:
    """Tree and node as structs, which a join compares also where the id inside is null."""
    return messages.withColumns({
        "tree": F.struct(F.col("tree").alias("id")), "node": F.struct(F.col("node").alias("id")),
        "parent": F.when(F.col("parent").isNotNull(), F.struct(F.col("parent").alias("id"))),
        "score": F.coalesce("score", F.lit(0.0)).cast("double")})


def _once(keyed: DataFrame, *more: str) -> DataFrame:
    """One row per message: of rows with the same tree and node the smallest by parent, score and ``more``, nulls first."""
    kept = ("parent", "score", *more)
    return keyed.groupBy("tree", "node").agg(F.min(F.struct(*kept)).alias("row")).select(
        "tree", "node", *[F.col(f"row.{c}").alias(c) for c in kept])


def _climb(nodes: DataFrame, largest: int):
    """Sums from the root down, the jumps made on the way, and what turned out to be on a cycle.

    The last is None, or the smallest message of each cycle: after more steps than a tree has messages
    a message is still on its way only on or below a cycle, and the messages above it are those
    of the cycle. One that is itself the smallest of them lies on it.
    """
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    step = nodes.join(known, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("known"), F.col("parent")).alias("up"), "score", F.lit(1).alias("steps"))
    step = step.withColumn("least", F.col("up"))
    jumps = []
    while True:
        step = staged(step, "jumps")
        # Messages that have reached their root stand aside; only the others look further up.
        on_the_way = step.where("up is not null")
        if on_the_way.isEmpty():
            return step, jumps, None
        if 1 << len(jumps) >= largest:
            return step, jumps, on_the_way.where("least = node").select("tree", "node")
        jumps.append(on_the_way)
        above = step.select(
            "tree", F.col("node").alias("up"), F.col("up").alias("next"), F.col("score").alias("more"),
            F.col("steps").alias("further"), F.col("least").alias("least_above"))
        further = on_the_way.join(above, ["tree", "up"]).select(
            "tree", "node", F.col("next").alias("up"), (F.col("score") + F.col("more")).alias("score"),
            (F.col("steps") + F.col("further")).alias("steps"), F.least("least", "least_above").alias("least"))
        step = further.union(step.where("up is null").select(further.columns))


def _paths(nodes: DataFrame, per_tree: int) -> DataFrame:
    """``paths`` over keyed messages, one row each."""
    nodes = staged(nodes.select("tree", "node", "parent", "score"), "nodes")
    largest = nodes.groupBy("tree").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    step, jumps, cut = _climb(nodes, largest)
    if cut is not None:
        free = nodes.join(cut.withColumn("cut", F.lit(True)), ["tree", "node"], "left")
        nodes = staged(free.select("tree", "node", F.when(F.col("cut").isNull(), F.col("parent")).alias("parent"), "score"), "nodes")
        step, jumps, _ = _climb(nodes, largest)
    depth = step.select("tree", "node", (F.col("steps") - 1).alias("depth"), "score")
    parents = nodes.select("tree", F.col("parent").alias("node")).where("node is not null").distinct()
    leaves = depth.join(parents, ["tree", "node"], "left_anti")
    best = leaves.withColumn("path_rank", F.row_number().over(
        Window.partitionBy("tree").orderBy(F.desc("score"), "node"))).where(F.col("path_rank") <= per_tree)
    chosen = best.select("tree", F.col("node").alias("leaf"), "path_rank", "node")
    for jump in reversed(jumps):
        chosen = staged(chosen, "chosen")
        up = chosen.join(jump.select("tree", "node", "up"), ["tree", "node"])
        chosen = chosen.union(up.select("tree", "leaf", "path_rank", F.col("up").alias("node")))
    return chosen.join(depth.select("tree", "node", "depth"), ["tree", "node"])


def paths(messages: DataFrame, per_tree: int = 1) -> DataFrame:
    """The messages on each tree's ``per_tree`` best root-to-leaf paths.

    ``messages``: tree, node, parent (null for a root), score. A path scores the sum of its
    messages; null scores count as 0. Ties go to the smaller leaf. Returns tree, leaf, path_rank, node,
    depth (0 at the root). A message whose parent is missing is a root, and a tree with several
    roots has the paths of all. Reach doubles each round, so a path of n messages takes log2(n)
    rounds, of one narrow self-join each.

    A null tree is a tree, a null node a message that nobody replies to. A message given more than
    once counts once, with its smallest parent and score (nulls first). Messages that reply to one another in a
    circle, or to themselves, are cut above the smallest of the circle, which becomes a root.
    """
    return _paths(_once(_keyed(messages)), per_tree).select(
        F.col("tree.id").alias("tree"), F.col("node.id").alias("node"), F.col("leaf.id").alias("leaf"), "path_rank", "depth")


def formatted(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_mask.

    ``turns``: conv_id, place, role, text; null roles and texts count as empty. Turns stand in order
    of place. ``loss_mask`` has, for each turn in order, where its trained text starts inside
    that turn and how long it is (code points; length 0 for other roles).
    """
    head = F.concat(F.lit(OPEN), escape(F.coalesce("role", F.lit(""))), F.lit(BODY))
    text = escape(F.coalesce("text", F.lit("")))
    loss = F.when(F.col("role") == LOSS_ROLE, F.length(text)).otherwise(0)
    turn = F.struct("place", F.concat(head, text, F.lit(CLOSE)).alias("turn"),
                    F.length(head).alias("start"), loss.alias("length"))
    ordered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return ordered.select(
        "conv_id", F.array_join(F.col("turns.turn"), "").alias("formatted"),
        F.transform("turns", lambda t: F.struct(t["start"], t["length"])).alias("loss_mask"))


def parsed(chats: DataFrame) -> DataFrame:
    """``formatted`` read back: adds turns (role, text) and loss_text, what the mask covers, unescaped."""
    turns = F.filter(F.split("formatted", F.lit("\\Q" + CLOSE + "\\E"), -1), lambda t: t != "")

    def read(turn):
        parts = F.split(turn, F.lit("\\Q" + BODY + "\\E"), -1)
        role = F.substring(F.get(parts, F.lit(0)), len(OPEN) + 1, 1 << 30)
        return F.struct(unescape(role).alias("role"), unescape(F.get(parts, F.lit(1))).alias("text"))

    under = F.zip_with(turns, "loss_mask", lambda t, m: t.substr(m["start"] + 1, m["length"]))
    return chats.withColumns({
        "turns": F.transform(turns, read),
        "loss_text": F.array_join(F.transform(under, unescape), "")})


def chat(messages: DataFrame, per_tree: int = 1, unique: bool = False) -> DataFrame:
    """Reply trees to formatted conversations: tree, leaf, path_rank, formatted, loss_mask.

    ``messages``: tree, node, parent, score, role, text. The result is keyed by the struct
    conv_id (tree, leaf, path_rank). Repeated messages and circles are as in ``paths``; of rows of one message that
    differ in role or text the smallest stands. ``unique``: the caller knows that there is one row per message.
    """
    keyed = _keyed(messages.select("tree", "node", "parent", "score", "role", "text"))
    keyed = keyed if unique else staged(_once(keyed, "role", "text"), "messages")
    turns = _paths(keyed, per_tree).join(keyed.select("tree", "node", "role", "text"), ["tree", "node"])
    name = F.struct(F.col("tree.id").alias("tree"), F.col("leaf.id").alias("leaf"), "path_rank")
    return formatted(turns.select(name.alias("conv_id"), F.col("depth").alias("place"), "role", "text"))


def chains(turns: DataFrame) -> DataFrame:
    """Flat turns (conv_id, turn, role, text) as trees: each turn replies to the one before.

    Rows of one turn number, also repeated rows, follow one another by role and text; a null
    turn comes first. A tree is named by a struct, so that a null conv_id is a conversation too. Other columns are ignored.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    at = F.row_number().over(order)
    return turns.select(
        F.struct("conv_id").alias("tree"), at.alias("node"), F.when(at > 1, at - 1).alias("parent"),
        F.lit(0.0).alias("score"), "role", "text")


def digests(turns: DataFrame) -> DataFrame:
    """All of each conversation, formatted and read back: digests of turns and of trained text."""
    back = parsed(chat(staged(chains(turns), "chains"), unique=True))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        F.col("conv_id.tree.conv_id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
