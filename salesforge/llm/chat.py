"""Chat examples by prefix-target expansion.

Every assistant turn of a conversation becomes an example of its own: all turns before
it are context and only that reply is trained on.  What follows the last assistant turn
(or a conversation without one) is an example with no target, so no turn is lost.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` for each turn.  In texts and roles a
backslash is doubled and ``<|`` becomes ``<\\|``; in roles a line feed becomes ``\\n`` as
well.  So a control string in a text is never a mark, and reading turns it back.

Scale: one shuffle by conversation of the turns; turns are escaped before it, one by one,
and an example is a prefix of its conversation's formatted text.  The examples of a
conversation are as long as the square of its turns: that is what the expansion means.

Edge cases: turns in order of ``turn``, null last, ties by role and text; null text or
role is empty; a null ``conv_id`` is a conversation of its own.  Only the four named
columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the public ChatML layout.
START, END = "<|im_start|>", "<|im_end|>"


def _escaped(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def _plain(c: Column) -> Column:
    """Backslash pairs stand for one backslash; between them a lone one is an escape."""
    parts = F.transform(F.split(c, r"\\\\", -1), lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\|"), F.lit("|")))
    return F.when(F.instr(c, "\\") > 0, F.array_join(parts, "\\")).otherwise(c)


def examples(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text", target: str = "assistant") -> DataFrame:
    """(conv_id, example, target, text, loss_start, loss_length): ``target`` is the place
    of the trained turn (null: none), the loss mask covers ``loss_length`` characters of
    ``text`` from ``loss_start`` (from 0)."""
    role = F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(""))
    body = _escaped(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    head = F.concat(F.lit(START), F.replace(_escaped(role), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
    one = turns.select(
        F.col(f"`{conv_col}`").alias("conv_id"),
        F.struct(F.col(f"`{turn_col}`").isNull().alias("none"), F.col(f"`{turn_col}`").alias("turn"),
                 role.alias("role"), body.alias("body"), F.concat(head, body, F.lit(END + "\n")).alias("all"),
                 F.char_length(head).alias("head")).alias("t"))
    convs = one.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    n = F.size("t")
    wanted = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (F.get("t", i)["role"] == target) | (i == n - 1))
    each = convs.select("conv_id", "t", F.posexplode(wanted).alias("example", "last"))
    turn = F.get("t", F.col("last"))
    context = F.array_join(F.transform(F.slice("t", F.lit(1), F.col("last")), lambda x: x["all"]), "")
    each = each.select("conv_id", "example", "last", context.alias("context"), turn.alias("turn"))
    trained = F.col("turn.role") == target
    return each.select(
        "conv_id", "example", F.when(trained, F.col("last")).alias("target"),
        F.concat("context", "turn.all").alias("text"),
        F.when(trained, F.char_length("context") + F.col("turn.head")).otherwise(F.lit(0)).alias("loss_start"),
        F.when(trained, F.char_length("turn.body")).otherwise(F.lit(0)).alias("loss_length"))


def turns_of(text: Column) -> Column:
    """The turns (role, text) of a formatted text."""
    parts = F.filter(F.split(text, r"<\|im_end\|>\n", -1), lambda p: p != "")
    inner = F.transform(parts, lambda p: F.substring(p, len(START) + 1, 1 << 30))
    return F.transform(inner, lambda p: F.struct(
        _plain(F.substring_index(p, "\n", 1)).alias("role"),
        _plain(_after_line(p)).alias("text")))


def _after_line(p: Column) -> Column:
    return F.substr(p, F.instr(p, "\n") + 1)


def loss_of(text: Column, start: Column, length: Column) -> Column:
    """The trained text, as it was before escaping."""
    return _plain(F.substr(text, start + 1, length))
