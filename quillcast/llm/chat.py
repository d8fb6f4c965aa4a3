"""Chat formatting from event logs (DataFrame expressions only).

An event is a row (conv_id, seq, msg, op, role, text). ``op`` is one of
``message`` (a whole text), ``delta`` (append to the message), ``edit`` (replace what was there) and
``regenerate`` (drop what was there; later deltas fill the message anew). ``msg`` numbers the message in its
conversation. Reconstruction partitions the log by conversation, once; inside a partition the events of each message
are sorted by seq and folded, the messages ordered, each rendered by the template and a conversation's segments joined.

The template: ``<|turn|>role<|say|>text<|end|>`` for each turn. In roles and texts a backslash is doubled, and one is
put after the first character of every control string (``<|``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``), so that no control string is
left and ``unescape`` gives back the text exactly. The output is a list of segments with a loss flag; their
texts joined are the formatted string, and the flagged ones (assistant texts) are the loss mask.

Folding holds one message's events at a time; only the rendered segments of a conversation meet in one row, as the formatted string
itself must, so a conversation's formatted text (below 2 GB) bounds what one task holds.

Defined results: null text is empty, null role is empty, a null conv_id is a conversation of its own; ties in
seq are ordered by op, role and text; rows of one turn are ordered by role and text; repeated rows count as further turns; very long texts are
kept whole; empty input gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillcast.llm.common import let

#: Control strings of this and of well-known templates.
CONTROLS = ("<|", "<s>", "</s>", "[INST]", "[/INST]")
TURN, SAY, END = "<|turn|>", "<|say|>", "<|end|>"
LOSS_ROLE = "assistant"
_CONTROL_REGEX = r"(<(?=\||/?s>)|\[(?=/?INST\]))"


def escape(text: Column) -> Column:
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _CONTROL_REGEX, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def from_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A plain table of turns as the log a chat service would have streamed, dealt by conversation.

    Every turn gives five events: its second half as a delta, a regenerate that drops it, the second half again, an edit that
    puts the first half in its place, and the second half as a delta. Folding any of them wrongly changes the text.
    """
    t = F.coalesce("text", F.lit(""))
    cut = F.floor(F.length(t) / 2).cast("int")
    head, tail = F.substring(t, F.lit(1), cut), F.substring(t, cut + 1, F.length(t))
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    numbered = rows.withColumn("msg", F.row_number().over(w).cast("long"))
    ops = [("delta", "role", tail), ("regenerate", None, None), ("delta", None, tail), ("edit", None, head), ("delta", None, tail)]
    events = [
        F.struct((F.col("msg") * len(ops) + i).alias("seq"), F.lit(op).alias("op"), (F.col(r) if r else F.lit(None).cast("string")).alias("role"), (F.lit(None).cast("string") if x is None else x).alias("text"))
        for i, (op, r, x) in enumerate(ops)
    ]
    return numbered.select("conv_id", "msg", F.inline(F.array(*events))).select("conv_id", "seq", "msg", "op", "role", "text")


def reconstruct(events: DataFrame) -> DataFrame:
    """(conv_id, msg, role, text): each message after all its events, folded in order of seq.

    The last ``message``, ``edit`` or ``regenerate`` event starts the final text; the deltas after it are appended.
    A message's role is the last one that is not null.
    """
    event = F.struct("seq", "op", "role", F.coalesce("text", F.lit("")).alias("text"))
    folded = events.groupBy("conv_id", "msg").agg(F.sort_array(F.collect_list(event)).alias("log"))

    def body(log: Column) -> Column:
        starts = F.transform(log, lambda e, i: F.when(e["op"] != "delta", i).otherwise(F.lit(-1)))
        first = F.greatest(F.array_max(starts), F.lit(0))
        tail = F.slice(log, first + 1, F.size(log))
        pieces = F.transform(tail, lambda e: F.when(e["op"] == "regenerate", F.lit("")).otherwise(e["text"]))
        roles = F.filter(F.transform(log, lambda e: e["role"]), lambda r: r.isNotNull())
        return F.struct(F.when(F.size(roles) > 0, F.element_at(roles, -1)).alias("role"), F.array_join(pieces, "").alias("text"))

    return folded.select("conv_id", "msg", let(F.col("log"), body).alias("m")).select("conv_id", "msg", "m.role", "m.text")


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, segments): the formatted conversation as (text, loss) runs, in order of msg."""
    role = F.coalesce("role", F.lit(""))
    rendered = messages.select(
        "conv_id",
        F.struct(
            "msg",
            F.concat(F.lit(TURN), escape(role), F.lit(SAY)).alias("head"),
            escape(F.col("text")).alias("body"),
            (role == LOSS_ROLE).alias("loss"),
        ).alias("t"),
    )
    whole = rendered.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    segments = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                F.struct(t["head"].alias("text"), F.lit(False).alias("loss")),
                F.struct(t["body"].alias("text"), t["loss"].alias("loss")),
                F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )
    return whole.select("conv_id", segments.alias("segments")).select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments",
    )


def format_events(events: DataFrame, dealt: bool = False) -> DataFrame:
    """(conv_id, formatted, segments) for every conversation of an event log (``dealt``: already partitioned by conv_id)."""
    return render(reconstruct(events if dealt else events.repartition("conv_id")))


def digest(formatted: DataFrame) -> DataFrame:
    """What can be read back from the output: turns from the string, loss texts from the mask."""
    turns = F.filter(F.split("formatted", r"<\|turn\|>", -1), lambda x: x != "")

    def read(t: Column) -> Column:
        body = F.regexp_replace(t, r"<\|end\|>$", "")
        return let(
            F.split(body, r"<\|say\|>", 2),
            lambda p: F.concat(unescape(F.get(p, F.lit(0))), F.lit("\n"), unescape(F.get(p, F.lit(1))), F.lit("\n")),
        )

    loss = unescape(F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: s["text"]), ""))
    parsed = formatted.select(
        "conv_id",
        let(turns, lambda x: F.struct(F.size(x).cast("long").alias("n"), F.sha2(F.array_join(F.transform(x, read), ""), 256).alias("sha"))).alias("t"),
        let(loss, lambda x: F.struct(F.length(x).cast("long").alias("n"), F.sha2(x, 256).alias("sha"))).alias("l"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    return parsed.select(
        "conv_id",
        F.col("t.n").alias("n_turns"),
        F.col("t.sha").alias("turns_sha256"),
        F.col("l.n").alias("loss_chars"),
        F.col("l.sha").alias("loss_sha256"),
        "formatted_chars",
    )
