"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example: all turns before it as context, then
the reply, of which only the text is trainable. A conversation that ends with
other turns, or has no reply, gets one more example without a target, so that
no turn is lost.

A turn is written <s>[ROLE]role[/ROLE]text</s>. Inside roles and texts '&', '<'
and '[' become '&amp;', '&lt;' and '&lsqb;', so that no control string can
occur in them; unescape() reverses that.

Rows of a conversation are put in order of turn (null first), then role and
text. Null roles and texts count as empty, repeated rows are repeated turns, and
no rows give no examples. Rows without a conv_id are conversations of one turn
each, told apart by the column own, which is null for all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import pick

OPEN, ROLE, ROLE_END, CLOSE = "<s>", "[ROLE]", "[/ROLE]", "</s>"
TARGET_ROLE = "assistant"
#: Applied in this order; reversed to read back.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;"))


def escape(c: Column) -> Column:
    for plain, code in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def examples(conversations: DataFrame) -> DataFrame:
    """conv_id, own long, example int (from 0), formatted string, loss_start and loss_length in code points (null: no target)."""
    turns = pick(conversations, conv_id="long", turn="long", role="string", text="string")
    turns = turns.withColumn("own", F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id()))
    head = F.concat(F.lit(OPEN + ROLE), escape(F.coalesce("role", F.lit(""))), F.lit(ROLE_END))
    body = escape(F.coalesce("text", F.lit("")))
    turn = F.struct(
        F.coalesce("turn", F.lit(-(2**63))).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        body.alias("body"),
        head.alias("head"),
    )
    whole = turns.groupBy("conv_id", "own").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    whole = whole.select(
        "conv_id",
        "own",
        F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))).alias("written"),
        F.transform("turns", lambda t: F.struct(F.length(t["head"]).alias("head"), F.length(t["body"]).alias("body"))).alias("lengths"),
        F.filter(
            F.transform("turns", lambda t, i: F.when((t["role"] == TARGET_ROLE) | (i == F.size("turns") - 1), F.struct((i + 1).alias("upto"), (t["role"] == TARGET_ROLE).alias("target")))),
            lambda x: x.isNotNull(),
        ).alias("ends"),
    )
    each = whole.select("conv_id", "own", "written", "lengths", F.posexplode("ends").alias("example", "end"))
    last = F.element_at("lengths", F.col("end.upto"))
    size = F.length("formatted")
    return each.withColumn("formatted", F.array_join(F.slice("written", 1, F.col("end.upto")), "")).select(
        "conv_id",
        "own",
        "example",
        "formatted",
        F.when(F.col("end.target"), size - len(CLOSE) - last["body"]).cast("long").alias("loss_start"),
        F.when(F.col("end.target"), last["body"]).cast("long").alias("loss_length"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted example, as an array of (role, text)."""
    parts = F.split(formatted, CLOSE)
    return F.transform(
        F.slice(parts, 1, F.size(parts) - 1),
        lambda p: F.struct(
            unescape(F.substring_index(F.substring_index(p, ROLE_END, 1), ROLE, -1)).alias("role"),
            unescape(F.substring_index(p, ROLE_END, -1)).alias("text"),
        ),
    )


def digests(formatted_examples: DataFrame) -> DataFrame:
    """One row per conversation, all of it read back from the formatted examples."""
    loss = F.when(F.col("loss_length").isNotNull(), unescape(F.substring(F.col("formatted"), F.col("loss_start") + 1, F.col("loss_length"))))
    seen = formatted_examples.select("conv_id", "own", "example", "formatted", loss.alias("loss"), F.length("formatted").cast("long").alias("chars"))
    got = seen.groupBy("conv_id", "own").agg(
        F.max_by("formatted", "example").alias("whole"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "").alias("loss"),
        F.sum("chars").alias("formatted_chars"),
        F.count("*").alias("n_examples"),
    )
    got = got.withColumn("turns", read_turns(F.col("whole")))
    rebuilt = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return got.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(rebuilt, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
        "n_examples",
    )
