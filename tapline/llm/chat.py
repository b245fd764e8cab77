"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all turns up to it as context, its reply as the only
trainable text. A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside texts and roles every
run of bars after a ``<`` gets one bar more, so no text can hold a control string, and taking the bar away
gives the text back. A line feed in a role is written as ``<|nl|>``, which no escaped text can hold either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, ROLE_BREAK = "<|im_start|>", "<|im_end|>\n", "<|nl|>"


def escape_text(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescape_text(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape_text(role), F.lit("\n"), F.lit(ROLE_BREAK))


def unescape_role(role: Column) -> Column:
    return unescape_text(F.replace(role, F.lit(ROLE_BREAK), F.lit("\n")))


def expand(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", target: str = "assistant", tail: bool = False) -> DataFrame:
    """One row per turn of role ``target``: the conversation's id, ``example`` (the turn's place, from 1),
    ``formatted``, ``loss_start`` (from 1) and ``loss_chars`` of the trainable span, and ``last``.

    With ``tail``, a conversation that does not end with a target turn gets one more row with all its turns and
    an empty span. Turns are ordered by turn, then role, then text (null turns first), so ties have one order;
    repeated rows are turns of their own. Null role or text counts as empty; a null id is a conversation too.
    An empty table gives no row; other columns are ignored.

    One shuffle by conversation. A conversation of n turns gives up to n prefixes: that growth is the format's.
    """
    turn = F.struct(F.col(turn_col).alias("turn"),
                    F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    turns = df.select(F.col(conv_col).alias(conv_col), turn.alias("t")).groupBy(conv_col).agg(
        F.sort_array(F.collect_list("t")).alias("turns"))
    written = F.transform("turns", lambda t: F.struct(
        (t["role"] == target).alias("hit"), escape_text(t["text"]).alias("body"),
        F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n")).alias("head")))
    places = F.sequence(F.lit(1), F.size("turns"))
    ends = F.filter(places, lambda i: F.get(F.col("turns"), i - 1)["hit"] | (F.lit(tail) & (i == F.size("turns"))))
    rows = turns.select(conv_col, written.alias("turns")).select(conv_col, "turns", F.explode(ends).alias("example"))
    own = F.get(F.col("turns"), F.col("example") - 1)
    text = F.concat_ws("", F.transform(F.slice("turns", 1, F.col("example")),
                                       lambda t: F.concat(t["head"], t["body"], F.lit(END))))
    size = F.when(own["hit"], F.length(own["body"])).otherwise(0)
    return rows.select(conv_col, "example", (F.col("example") == F.size("turns")).alias("last"),
                       size.cast("long").alias("loss_chars"), text.alias("formatted")).withColumn(
        "loss_start", (F.length("formatted") - len(END) - F.col("loss_chars") + 1).cast("long"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text): the inverse of the template."""
    parts = F.split(formatted, r"<\|im_end\|>\n")

    def turn(part):
        head = F.substring_index(part, "\n", 1)
        return F.struct(unescape_role(F.substr(head, F.lit(len(START) + 1))).alias("role"),
                        unescape_text(F.substr(part, F.length(head) + 2)).alias("text"))

    return F.transform(F.slice(parts, 1, F.size(parts) - 1), turn)


def read_loss(formatted: Column, start: Column, chars: Column) -> Column:
    """The trainable text of an example, unescaped."""
    return unescape_text(F.substr(formatted, start.cast("int"), chars.cast("int")))


def conversation_digests(examples: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, read back from examples made with ``tail=True``: counts and digests of turns and loss."""
    loss = F.struct("example", read_loss(F.col("formatted"), F.col("loss_start"), F.col("loss_chars")).alias("text"))
    whole = examples.groupBy(conv_col).agg(
        F.max(F.when(F.col("last"), F.col("formatted"))).alias("whole"),
        F.sort_array(F.collect_list(F.when(F.col("loss_chars") > 0, loss))).alias("losses"))
    read = whole.select(conv_col, F.length("whole").cast("long").alias("formatted_chars"), read_turns(F.col("whole")).alias("turns"),
                        F.concat_ws("", F.transform("losses", lambda x: x["text"])).alias("loss"))
    joined = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read.select(conv_col, F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"),
                       F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
                       "formatted_chars")
