r"""Chat formatting with budgeted windows (DataFrame functions only).

Template: ``<|im_start|>role\ntext<|im_end|>\n`` per turn.  A control string
inside a role or text gets one backslash after its first character (strings that
already look so get one more), so no control string is left inside and the
original comes back exactly.

Windows.  A turn costs its tokens (runs of letters or digits, single other
marks) plus ``TURN_COST``.  Prefix sums of the costs cut a conversation at
multiples of the span budget: turns between two multiples make a span, a turn
across a multiple is a span of its own.  So spans are turn-aligned, are known
from prefix sums alone, and a window (system turn, history, span) exceeds
``max_tokens`` only if a single turn does.  The system turn (a system row that
is first) is retained in every window; of the ``history_turns`` turns before a
span those within ``history_tokens`` are repeated.  The loss mask covers the
texts of a window's own assistant turns; repeated ones are masked out, so each
assistant text is a target once.

Scale.  Conversations are cut into blocks of ``BLOCK`` turn numbers and spans
start anew in each block, so a conversation of any length is spread over tasks;
a block is sent the few turns before it (history) and the system turn.  Texts
are shuffled once; prefix sums, spans, history and windows are all computed
inside the (conversation, block) partitioning.

Defined results: null text or role is empty; rows are ordered by turn (null
first), then the retained system row, role and text; repeated rows stay turns of
their own; a null conversation id is one conversation; a conversation of only a
system turn is one window; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import key_of

START, END = "<|im_start|>", "<|im_end|>"
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
TURN_COST, BLOCK = 4, 256
_TAILS = "|".join(t[1:].replace("|", r"\|").replace("[", r"\[").replace("]", r"\]") for t in CONTROL)
TOKEN = r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"


def escape(text) -> F.Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)(?={_TAILS})", r"$1$2\\")


def unescape(text) -> F.Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)\\(?={_TAILS})", "$1$2")


def escape_role(role) -> F.Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role) -> F.Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _render(t) -> F.Column:
    return F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"), escape(t["text"]), F.lit(END + "\n"))


def _placed_rows(conv: DataFrame, cost, id_col: str, turn_col: str, role_col: str, text_col: str,
                 history_turns: int) -> DataFrame:
    """(conv_id, ck, block, kind, turn, role, text, cost): own rows (kind 2) with
    the system row marked (0), copies of the turns before a block (1) and of the
    system row (-1)."""
    turn = F.coalesce(F.col(turn_col).cast("bigint"), F.lit(-(2**62)))
    rows = conv.select(F.col(id_col).alias("conv_id"), key_of("ck", F.col(id_col)), turn.alias("turn"),
                       F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("block", F.floor(F.col("turn") / BLOCK).cast("bigint"))
    light = rows.groupBy("ck", "block").agg(F.min("turn").alias("first"))
    of_conv = Window.partitionBy("ck")
    blocks = light.select("ck", "block", F.min("first").over(of_conv).alias("first"),
                          F.count(F.lit(1)).over(of_conv).alias("n_blocks"))
    # only system rows are joined: the one at the smallest turn is retained
    is_sys = F.col("role") == "system"
    sys_rows = rows.filter(is_sys).join(blocks.select("ck", "block", "first"), ["ck", "block"])
    nth = F.row_number().over(Window.partitionBy("ck").orderBy("turn", "text"))
    sys_rows = (sys_rows.withColumn("n", nth)
                .withColumn("kind", F.when((F.col("turn") == F.col("first")) & (F.col("n") == 1), 0).otherwise(2))
                .drop("first", "n"))
    own = rows.filter(~is_sys).withColumn("kind", F.lit(2)).unionByName(sys_rows)
    before = (own.filter((F.pmod("turn", F.lit(BLOCK)) >= BLOCK - history_turns) & (F.col("kind") == 2))
              .withColumn("block", F.col("block") + 1).withColumn("kind", F.lit(1))) if history_turns else own.limit(0)
    later = blocks.filter("n_blocks > 1").select("ck", F.col("block").alias("to"))
    repeated = (sys_rows.filter("kind = 0").join(later, "ck").filter("to != block")
                .withColumn("block", F.col("to")).drop("to").withColumn("kind", F.lit(-1)))
    placed = own.unionByName(before).unionByName(repeated)
    return placed.withColumn("cost", cost(F.col("text"))), blocks


def chat_windows(conversations: DataFrame, max_tokens: int = 1024, history_turns: int = 4, history_tokens: int = 256,
                 id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 target: str = "assistant", cost=None) -> DataFrame:
    """One row per window: (conv_id, ck, block, span, n_blocks, n_context,
    n_turns, formatted, loss array<struct<start,length>>).  ``ck`` is the id as
    a never-null key; the first ``n_context`` turns of ``formatted`` are
    repeated ones; ``loss`` is in code points of ``formatted`` (from 1)."""
    if cost is None:
        def cost(text):
            return (F.regexp_count(text, F.lit(TOKEN)) + TURN_COST).cast("bigint")
    rows, blocks = _placed_rows(conversations, cost, id_col, turn_col, role_col, text_col, history_turns)
    part = Window.partitionBy("ck", "block")
    order = part.orderBy(F.when(F.col("kind") < 2, F.col("kind")).otherwise(2), "turn", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.col("kind") == 2
    sys = F.when(F.col("kind") < 1, F.struct("role", "text", "cost", F.col("kind").alias("k")))
    rows = (rows.withColumn("sys", F.max(sys).over(part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
            .withColumn("n", F.row_number().over(order))
            .withColumn("run", F.sum(F.when(F.col("kind") >= 1, F.col("cost")).otherwise(0)).over(upto))
            .withColumn("e", F.sum(F.when(own, F.col("cost")).otherwise(0)).over(upto)))
    rows = rows.withColumn("s", F.col("e") - F.col("cost"))
    budget = F.greatest(F.lit(max_tokens - (history_tokens if history_turns else 0)) - F.coalesce(F.col("sys.cost"), F.lit(0)),
                        F.lit(1))
    k1, k2 = F.floor(F.col("s") / budget), F.floor((F.col("e") - 1) / budget)
    span = F.when(F.col("s") == 0, 0).when(k1 == k2, 2 * k1).otherwise(2 * k2 - 1).cast("bigint")
    rows = rows.withColumn("span", F.when(own, span))
    # a row is history of the span that starts at one of the next rows, if near enough
    opens = own & (F.col("span") != F.coalesce(F.lag("span").over(order), F.lit(-1)))
    rows = rows.withColumn("opens", F.when(opens, F.struct("span", (F.col("run") - F.col("cost")).alias("at"))))
    ahead = [F.lead("opens", j).over(order) for j in range(1, history_turns + 1)]
    rows = rows.withColumn("ahead", F.array(*ahead) if ahead else F.array().cast("array<struct<span:bigint,at:bigint>>"))
    near = F.filter("ahead", lambda o: o.isNotNull() & (o["at"] - (F.col("run") - F.col("cost")) <= history_tokens))
    as_history = F.when(F.col("kind") >= 1, F.transform(near, lambda o: F.struct(o["span"].alias("span"), F.lit(False).alias("new"))))
    as_own = F.when(own, F.array(F.struct(F.col("span").alias("span"), F.lit(True).alias("new"))))
    empty = F.array().cast("array<struct<span:bigint,new:boolean>>")
    # a conversation of only a system turn still needs its window
    alone = F.when((F.col("kind") == 0) & F.lead("n").over(order).isNull(),
                   F.array(F.struct(F.lit(0).cast("bigint").alias("span"), F.lit(True).alias("new"))))
    rows = rows.withColumn("to", F.concat(F.coalesce(as_own, empty), F.coalesce(as_history, empty), F.coalesce(alone, empty)))
    rows = rows.select("conv_id", "ck", "block", "sys", "kind", "n", "role", "text", F.explode("to").alias("t"))
    first_span = F.min("t.span").over(part)
    rows = rows.withColumn("first_span", first_span)
    turn = F.struct("n", F.col("t.new").alias("new"), "role", "text")
    spans = rows.groupBy("ck", "block", F.col("t.span").alias("span")).agg(     # bounded by the budget
        F.max("conv_id").alias("conv_id"), F.max("sys").alias("sys"), F.max("first_span").alias("first_span"),
        F.array_sort(F.collect_list(F.when(F.col("kind") >= 1, turn))).alias("turns"))
    sys_new = (F.col("sys.k") == 0) & (F.col("span") == F.col("first_span"))
    head = F.when(F.col("sys").isNotNull(), F.array(F.struct(
        F.lit(0).alias("n"), sys_new.alias("new"), F.col("sys.role").alias("role"), F.col("sys.text").alias("text"))))
    # context first: a new system turn never stands after repeated turns, as its window has no history
    spans = spans.withColumn("turns", F.concat(F.coalesce(head, F.array().cast("array<struct<n:int,new:boolean,role:string,text:string>>")),
                                               "turns"))
    spans = spans.withColumn("parts", F.transform("turns", lambda t: F.struct(
        _render(t).alias("r"), (t["new"] & (t["role"] == target)).alias("hot"),
        (F.char_length(escape_role(t["role"])) + len(START) + 1).alias("skip"), F.char_length(escape(t["text"])).alias("len"))))
    zero = F.struct(F.lit(1).cast("int").alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("loss"))
    masked = F.aggregate("parts", zero, lambda a, p: F.struct(
        (a["at"] + F.char_length(p["r"])).cast("int").alias("at"),
        F.when(p["hot"], F.concat(a["loss"], F.array(F.struct((a["at"] + p["skip"]).cast("int").alias("start"),
                                                             p["len"].cast("int").alias("length")))))
        .otherwise(a["loss"]).alias("loss")), lambda a: a["loss"])
    out = spans.select("ck", "block", "span", "conv_id", F.size(F.filter("turns", lambda t: ~t["new"])).alias("n_context"),
                       F.size("turns").alias("n_turns"), F.concat_ws("", F.transform("parts", lambda p: p["r"])).alias("formatted"),
                       masked.alias("loss"))
    return out.join(blocks.select("ck", "block", "n_blocks"), ["ck", "block"])


def read_turns(formatted, n_context) -> F.Column:
    """array<struct<role,text>> of a formatted window's own turns."""
    parts = F.split(formatted, r"<\|im_end\|>\n")
    own = F.slice(parts, n_context + 1, F.greatest(F.size(parts) - 1 - n_context, F.lit(0)))
    return F.transform(own, lambda p: F.struct(
        unescape_role(F.substr(F.substring_index(p, "\n", 1), F.lit(len(START) + 1))).alias("role"),
        unescape(F.substr(p, F.instr(p, F.lit("\n")) + 1)).alias("text")))


def read_loss(formatted, loss) -> F.Column:
    """The texts under the loss mask, unescaped and joined."""
    return F.concat_ws("", F.transform(loss, lambda s: unescape(F.substr(formatted, s["start"], s["length"]))))
