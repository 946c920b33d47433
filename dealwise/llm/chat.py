"""Chat formatting checked by a grammar round trip, DataFrame functions only.

    conversation := turn*
    turn         := '<s>[INST]' role '[/INST]' text '</s>'

``<s>``, ``</s>``, ``[INST]`` and ``[/INST]`` are control strings.  Escaping puts one
more backslash behind the first character of a control string or of one that has
backslashes there already (``</s>`` -> ``<\\/s>`` -> ``<\\\\/s>``); the parser takes one
away.  A turn is first rendered as it is and parsed again; only if that does not
give back its role and text are they escaped.  The parser is the same in both
cases: it splits at ``</s>``, reads the role up to the first ``[/INST]``, refuses a
turn whose role or text holds a bare control string, and removes one backslash.
The whole conversation is parsed again at the end (``identical``).

Null roles and texts are empty ones.  Turns are ordered by turn number (null
first), ties by role and text; repeated rows are turns of their own.  Rows with a
null conversation id form one conversation.  A formatted conversation is one value,
so one conversation has to fit into one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<s>[INST]", "[/INST]", "</s>"


def escape(c: Column) -> Column:
    c = F.regexp_replace(c, r"<(\\*)(/?s>)", r"<\\$1$2")
    return F.regexp_replace(c, r"\[(\\*)(/?INST\])", r"[\\$1$2")


def unescape(c: Column) -> Column:
    c = F.regexp_replace(c, r"<\\(\\*)(/?s>)", r"<$1$2")
    return F.regexp_replace(c, r"\[\\(\\*)(/?INST\])", r"[$1$2")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(MIDDLE), text, F.lit(CLOSE))


def raw_text(segment: Column) -> Column:
    """The text of one rendered turn without its '</s>', still escaped."""
    at = F.instr(segment, MIDDLE)
    return F.when(at > 0, F.substring(segment, at + len(MIDDLE), F.length(segment)))


def bare(c: Column) -> Column:
    """Whether a control string other than '</s>', where turns are split, stands in ``c``."""
    return c.contains("<s>") | c.contains("[INST]") | c.contains(MIDDLE)


def parse_turn(segment: Column) -> Column:
    """struct<role, text> of one rendered turn without its '</s>'; null if it is no turn."""
    role = F.substring(segment, F.lit(len(OPEN) + 1), F.instr(segment, MIDDLE) - len(OPEN) - 1)
    good = (segment.startswith(OPEN) & (F.instr(segment, MIDDLE) > len(OPEN))
            & ~bare(role) & ~bare(raw_text(segment)))
    return F.when(good, F.struct(unescape(role).alias("role"), unescape(raw_text(segment)).alias("text")))


def segments(formatted: Column) -> Column:
    """Rendered turns without their '</s>'."""
    parts = F.split(formatted, CLOSE, -1)
    return F.slice(parts, F.lit(1), F.size(parts) - 1)


def parse(formatted: Column) -> Column:
    """array<struct<role, text>>: the turns of a formatted conversation."""
    return F.transform(segments(formatted), parse_turn)


def format_chats(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: the id, ``formatted``, ``spans`` and ``identical``.

    ``spans`` has for each turn where it starts in ``formatted`` (code points from 0)
    and the range ``[loss_start, loss_end)`` of its text under the loss mask, empty
    for roles not in ``learn``.
    """
    source = F.struct(F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                      F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = df.select(F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), source.alias("src"))
    plain = render(F.col("src.role"), F.col("src.text"))
    back = parse(plain)
    clean = (F.size(back) == 1) & F.coalesce(back[0] == F.col("src"), F.lit(False))
    rows = rows.withColumn("out", F.when(clean, plain).otherwise(render(escape(F.col("src.role")),
                                                                        escape(F.col("src.text")))))
    order = W.partitionBy("conv").orderBy("turn", "src.role", "src.text")
    length = F.length("out").cast("bigint")
    rows = (rows.withColumn("n", F.row_number().over(order))
            .withColumn("end", F.sum(length).over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
            .withColumn("start", F.col("end") - length))
    stop = F.col("end") - len(CLOSE)
    begin = F.when(F.col("src.role").isin(*learn), F.col("start") + F.instr("out", MIDDLE) - 1 + len(MIDDLE)).otherwise(stop)
    turns = F.array_sort(F.collect_list(F.struct("n", "out", "src", F.struct(
        "start", begin.alias("loss_start"), stop.alias("loss_end")).alias("span"))))
    chats = rows.groupBy("conv").agg(turns.alias("turns"))
    formatted = F.array_join(F.col("turns.out"), "")
    return (chats.select("conv", formatted.alias("formatted"), F.col("turns.span").alias("spans"),
                         F.col("turns.src").alias("source"))
            .select(F.col("conv").alias(conv_id), "formatted", "spans",
                    (parse(F.col("formatted")) == F.col("source")).alias("identical")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, read from the formatted conversation.

    A span is cut from its own turn, so the work is linear in the conversation.
    """
    cut = F.zip_with(segments(formatted), spans, lambda seg, s: unescape(F.substring(
        seg, (s["loss_start"] - s["start"] + 1).cast("int"), (s["loss_end"] - s["loss_start"]).cast("int"))))
    return F.array_join(cut, "")
