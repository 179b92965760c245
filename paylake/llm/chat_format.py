"""Chat formatting from an event log.

A log holds, per conversation and in sequence, messages and what happened to them: streamed deltas, edits,
regenerations. Folding gives the final messages; rendering joins them by a template whose control strings cannot occur
inside a text, and marks the assistant's text for the loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
#: Control strings of common templates, without their first character. In a text, a backslash follows that character.
CONTROLS = r"\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|</?SYS>>|/?INST\]"
_ESCAPE = r"([<\[])(\\*(?:" + CONTROLS + "))"
_UNESCAPE = r"([<\[])\\(\\*(?:" + CONTROLS + "))"


def escape(text: Column) -> Column:
    """One more backslash after the first character of every control string, escaped ones included: reversible."""
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1$2")


def _escape_role(role: Column) -> Column:
    """Roles end at a line break, so they hold none."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    marked = F.replace(unescape(role), F.lit("\\\\"), F.lit("\\\x00"))
    return F.replace(F.replace(marked, F.lit("\\n"), F.lit("\n")), F.lit("\\\x00"), F.lit("\\"))


def fold(events: DataFrame) -> DataFrame:
    """conv_id, message, role, text: the final messages of a log.

    Events have conv_id, seq, message, kind, role, text. `message` and `edit` set the text, `regenerate` starts it anew,
    `delta` appends; they apply in the order of seq (ties: kind, then text). The role is the first one given. Null
    texts and roles count as empty; a null conv_id or message is a value like another.
    """
    event = F.struct("seq", "kind", "text", "role")
    log = events.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(event)).alias("log"))
    last = F.array_max(F.transform("log", lambda e, i: F.when(e["kind"] == "delta", 0).otherwise(i)))
    alive = F.slice("log", last + 1, F.size("log"))
    roles = F.filter(F.transform("log", lambda e: e["role"]), lambda r: r.isNotNull())
    return log.select("conv_id", "message", F.coalesce(F.get(roles, F.lit(0)), F.lit("")).alias("role"),
                      F.array_join(F.transform(alive, lambda e: F.coalesce(e["text"], F.lit(""))), "").alias("text"))


def render(messages: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """conv_id, formatted and loss: the messages of each conversation in the order of `message`.

    loss lists the spans of the loss_role's texts: turn (from 0), start (code point in formatted), begin (code point
    in that turn) and length.
    """
    head = F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n"))
    parts = messages.select("conv_id", "message", (F.col("role") == loss_role).alias("loss"), head.alias("head"),
                            escape(F.col("text")).alias("body"))
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "conv_id", "message", "loss", F.concat("head", "body", F.lit(END + "\n")).alias("block"),
        F.length("head").cast("long").alias("begin"), F.length("body").cast("long").alias("length"),
    ).withColumn("start", F.coalesce(F.sum(F.length("block")).over(before), F.lit(0)) + F.col("begin"))
    turns = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("message", "block", "loss", "start", "begin", "length"))).alias("turns"))
    spans = F.filter(F.transform("turns", lambda t, i: F.struct(
        t["loss"].alias("loss"), F.struct(i.alias("turn"), t["start"].alias("start"), t["begin"].alias("begin"),
                                          t["length"].alias("length")).alias("span"))), lambda x: x["loss"])
    return turns.select("conv_id", F.array_join(F.transform("turns", lambda t: t["block"]), "").alias("formatted"),
                        F.transform(spans, lambda x: x["span"]).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, turns (role, text) and loss_texts, parsed from what render() returned, and n_turns,
    formatted_chars and loss_chars, counted on what was parsed."""
    blocks = formatted.withColumn("__blocks", F.split("formatted", r"\Q" + END + "\n" + r"\E"))
    role_end = lambda b: F.locate("\n", b)
    one = lambda b: F.struct(
        _unescape_role(F.substring(b, F.lit(len(START) + 1), role_end(b) - len(START) - 1)).alias("role"),
        unescape(F.substring(b, role_end(b) + 1, F.length(b))).alias("text"))
    parsed = blocks.select(
        "conv_id", "formatted",
        F.transform(F.slice("__blocks", 1, F.size("__blocks") - 1), one).alias("turns"),
        F.transform("loss", lambda s: unescape(F.substring(
            F.get("__blocks", s["turn"]), (s["begin"] + 1).cast("int"), s["length"].cast("int")))).alias("loss_texts"))
    said = F.aggregate("loss_texts", F.lit(0).cast("long"), lambda total, t: total + F.length(t))
    return parsed.select("*", F.size("turns").cast("long").alias("n_turns"),
                         F.length("formatted").cast("long").alias("formatted_chars"), said.alias("loss_chars"))


def event_log(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text") -> DataFrame:
    """A table of finished turns as the log a chat service would have written.

    Turns go by number, ties by role and text, nulls first; repeated rows are turns of their own. The loss role's turns
    are streamed: an empty message, then its text in two deltas.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"),
                        F.coalesce(F.col(text), F.lit("")).alias("text"))
    turns = turns.withColumn("message", F.row_number().over(order).cast("long"))
    half = F.floor(F.length("text") / 2).cast("int")

    def event(step: int, kind: str, said: Column) -> Column:
        return F.struct((F.col("message") * 4 + step).alias("seq"), F.lit(kind).alias("kind"), said.alias("text"))

    streamed = F.array(event(0, "message", F.lit("")), event(1, "delta", F.substring(F.col("text"), F.lit(1), half)),
                       event(2, "delta", F.substring(F.col("text"), half + 1, F.length("text"))))
    whole = F.array(event(0, "message", F.col("text")))
    return turns.select("conv_id", "message", "role", F.explode(
        F.when(F.col("role") == LOSS_ROLE, streamed).otherwise(whole)).alias("e")).select(
        "conv_id", "e.seq", "message", "e.kind", "role", "e.text")


def format_chats(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """What render() gives for a table of turns, through its event log.

    Null texts and roles count as empty, rows with a null conv_id are one conversation, a null turn comes first;
    an empty table gives an empty result; other columns are not read. A conversation is one value in the end, so it is
    limited to 2 GB.
    """
    return render(fold(event_log(rows, conv_id, turn, role, text)))
