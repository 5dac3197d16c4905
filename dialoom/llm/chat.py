"""Chat formatting with a grammar that round-trips. Only DataFrame functions: no Python runs on the executors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the template.
TURN_START = "<|turn|>"
TURN_END = "<|end|>\n"
LOSS_ROLE = "assistant"
PROBE_ID = -1
PROBE_TEXT = "</s>[INST] ok [/INST]"


def escape_text(text: Column) -> Column:
    """One more backslash in every '<', backslashes, '|': no control string is left, and the step can be undone."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role stands on one line: its line feeds become '<n', after '<', backslashes, '|' or 'n' got a backslash."""
    return F.replace(F.regexp_replace(role, r"<(\\*)([|n])", r"<\\$1$2"), F.lit("\n"), F.lit("<n"))


def unescape_role(role: Column) -> Column:
    return F.regexp_replace(F.replace(role, F.lit("<n"), F.lit("\n")), r"<\\(\\*)([|n])", r"<$1$2")


def render(turns: Column, escaped: bool) -> Column:
    """turns: array<struct<role, text>>. Each turn: start, role, line feed, text, end."""

    def one(t: Column) -> Column:
        role, text = (escape_role(t["role"]), escape_text(t["text"])) if escaped else (t["role"], t["text"])
        return F.concat(F.lit(TURN_START), role, F.lit("\n"), text, F.lit(TURN_END))

    return F.array_join(F.transform(turns, one), "")


def parse(formatted: Column) -> Column:
    """The turns of a rendering: cut at each start, role up to the first line feed, text up to the turn's end."""
    pieces = F.split(formatted, r"<\|turn\|>", -1)
    pieces = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))

    def one(piece: Column) -> Column:
        cut = F.locate("\n", piece)
        body = F.substr(piece, cut + 1, F.greatest(F.char_length(piece) - cut - len(TURN_END), F.lit(0)))
        return F.struct(unescape_role(F.substr(piece, F.lit(1), F.greatest(cut - 1, F.lit(0)))).alias("role"), unescape_text(body).alias("text"))

    return F.transform(pieces, one)


def format_chats(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: its rendering, and what the parser reads back from it.

    A conversation is first rendered as it is, then parsed; if the recovered turns are not the source's, its texts
    and roles are escaped, and rendered and parsed again. If they still differ the job fails: nothing is dropped.
    Turns are ordered by turn, then role and text (ties and repeated rows stay, each as a turn; a null turn comes
    first). Null role or text: empty. Rows with null conv_id form one conversation. An empty table gives no rows.
    Clashing extra columns are not read.
    Columns: conv_id, formatted, escaped (boolean), turns (array<struct<role, text>>, as read back).
    """
    row = F.struct(F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    chats = conversations.select(F.col(conv_id).alias("conv_id"), row.alias("row")).groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    source = F.transform("rows", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    chats = chats.select("conv_id", source.alias("source"))
    chats = chats.withColumn("formatted", render(F.col("source"), False))
    chats = chats.withColumn("escaped", parse(F.col("formatted")) != F.col("source"))
    chats = chats.withColumn("formatted", F.when(F.col("escaped"), render(F.col("source"), True)).otherwise(F.col("formatted")))
    chats = chats.withColumn("turns", parse(F.col("formatted")))
    same = F.when(F.col("turns") == F.col("source"), F.col("turns")).otherwise(F.raise_error(F.lit("a rendering does not read back")))
    return chats.select("conv_id", "formatted", "escaped", same.alias("turns"))


def chat_digests(chats: DataFrame) -> DataFrame:
    """Digest columns of formatted conversations, all read back from the rendering."""
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"] == LOSS_ROLE), lambda t: t["text"]), "")
    return chats.withColumn("loss", loss).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations and one that says the control strings of another template."""
    turn = F.col("id")
    probe = conversations.sparkSession.range(2).select(F.lit(PROBE_ID).cast("long").alias("conv_id"), turn.alias("turn"), F.when(turn == 0, "user").otherwise(LOSS_ROLE).alias("role"), F.lit(PROBE_TEXT).alias("text"))
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
