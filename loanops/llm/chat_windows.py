"""Chat formatting: conversations cut into windows of whole turns under a token budget, with a loss mask.

Prefix sums of the turns' tokens place every turn on its conversation's token line. The line is cut into blocks of ``BLOCK`` budgets; in a
block, a window takes turns while the difference of two prefix sums fits into what the budget leaves beside the system turn and the
history. A window shows the system turn (a first turn of role system), then as repeated context the turns that lie
wholly in the last ``history`` tokens before it, then its own turns. Own assistant texts are the targets; what is repeated is masked.

The prefix sums are not computed in one task per conversation: turns are sorted by range, each range sums its part of a conversation, and
the parts, few for any conversation, get their offsets. From there on a task sees one block at most, so one conversation may hold most
rows. Everything is a DataFrame expression.

A turn is written ``<s>role``, line end, text, ``</s>``, line end. Control strings inside a text get a backslash behind their first
character, and one more if they have some there already, which ``unescape`` takes away. Roles are URL-encoded; a null role is ``?``.

Cases: a null text is empty; rows of null conversation are one conversation; a null turn number comes first; rows of equal turn number go by
role, then by a hash of their text, and equal rows stay rows. A turn that is longer than the room of a window has a window of its own, whole,
and ``n_tokens`` tells that it is over the budget; likewise a long system turn is repeated whole, and windows keep at least a quarter
of the budget beside it.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored

BUDGET, HISTORY, BLOCK = 2048, 256, 32


@dataclass(frozen=True)
class Template:
    """Marks of a turn, and the control strings that a text must not hold unescaped (the marks among them)."""

    open: str = "<s>"
    close: str = "</s>"
    controls: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

    def __post_init__(self):
        for a in self.controls:
            inner = [a[i:] for i in range(1, len(a))]
            if len(a) < 2 or "\\" in a or any(b.startswith(x) or x.startswith(b) for x in inner for b in self.controls):
                raise ValueError(f"control string {a!r}")
        if not {self.open, self.close} <= set(self.controls):
            raise ValueError("the marks are control strings")

    def _parts(self) -> list[tuple[str, str]]:
        firsts = sorted({c[0] for c in self.controls})
        return [(re.escape(f), "|".join(re.escape(c[1:]) for c in self.controls if c[0] == f)) for f in firsts]

    def escape(self, text: Column) -> Column:
        pattern = "|".join(rf"{first}\\*(?={rest})" for first, rest in self._parts())
        return F.regexp_replace(text, F.lit(pattern), F.lit(r"$0\\"))

    def unescape(self, text: Column) -> Column:
        pattern = "|".join(rf"(?:({first}\\*)\\(?={rest}))" for first, rest in self._parts())
        return F.regexp_replace(text, F.lit(pattern), F.lit("".join(f"${k + 1}" for k in range(len(self._parts())))))

    def head(self, role: Column) -> Column:
        return F.concat(F.lit(self.open), F.coalesce(F.url_encode(role), F.lit("?")), F.lit("\n"))

    def write(self, role: Column, text: Column) -> Column:
        return F.concat(self.head(role), self.escape(text), F.lit(self.close + "\n"))

    def read(self, formatted: Column) -> Column:
        """The turns of a formatted window: array of (role, text)."""
        pieces = F.split(formatted, re.escape(self.close + "\n"))
        pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

        def turn(piece: Column) -> Column:
            head = F.substring_index(piece, "\n", 1)
            role = head.substr(F.lit(len(self.open) + 1), F.char_length(head))
            text = piece.substr(F.char_length(head) + 2, F.char_length(piece))
            return F.struct(F.when(role != "?", F.url_decode(role)).alias("role"), self.unescape(text).alias("text"))

        return F.transform(pieces, turn)


def quarter_bytes(text: Column) -> Column:
    """Four bytes a token, the usual estimate where no tokenizer runs."""
    return F.ceil(F.octet_length(text) / 4)


def chat_windows(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = BUDGET,
    history: int = HISTORY,
    template: Template = Template(),
    tokens: Callable[[Column], Column] = quarter_bytes,
) -> DataFrame:
    """(conversation, start, n_context, n_turns, n_tokens, formatted, loss), one row for each window.

    ``start``: tokens of the conversation before the window's own turns. The first ``n_context`` turns of ``formatted`` are repeated.
    ``loss``: spans (begin, length) in code points from 0 that are trained on.
    """
    if not 0 <= history < budget:
        raise ValueError((budget, history))
    span = BLOCK * budget
    lined = token_line(turns, conversation, turn, role, text, template, tokens)
    begin = F.col("begin")
    block = F.floor(begin / span)
    is_system = (begin == 0) & F.col("system")
    # A block needs its own turns, the turns in reach of its first window, and the system turn.
    reach = F.when((block + 1) * span - begin <= history, F.array(block, block + 1)).otherwise(F.array(block))
    every = F.sequence(F.lit(0).cast("long"), F.floor((F.col("total") - 1) / span))
    dealt = lined.withColumn("block", F.explode(F.when(is_system, every).otherwise(reach)))
    own = F.floor(begin / span) == F.col("block")
    seen = dealt.groupBy("key", "block").agg(
        F.array_sort(
            F.collect_list(F.struct("begin", "cost", "piece", "chars", "head", "length", own.alias("own"), is_system.alias("first"), "target"))
        ).alias("turns")
    )
    windows = seen.withColumn("window", F.explode(_windows(F.col("turns"), budget, history)))
    shown, context = F.col("window.turns"), F.size("window.context")
    everything = F.concat(F.col("window.context"), shown)
    return windows.select(
        F.col("key.id").alias(conversation),
        F.col("window.start").alias("start"),
        context.alias("n_context"),
        F.size(shown).alias("n_turns"),
        _sum(everything, "cost").alias("n_tokens"),
        F.array_join(F.transform(everything, lambda t: t["piece"]), "").alias("formatted"),
        _loss(F.col("window.context"), shown).alias("loss"),
    )


def token_line(turns, conversation, turn, role, text, template, tokens) -> DataFrame:
    """Every turn with ``begin``, the tokens before it in its conversation, and ``total``, the conversation's tokens."""
    who, said = F.col(f"`{role}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = turns.select(
        F.struct(F.col(f"`{conversation}`").alias("id")).alias("key"),
        F.col(f"`{turn}`").alias("turn"),
        who.alias("role"),
        template.write(who, said).alias("piece"),
        F.char_length(template.head(who)).alias("head"),
    )
    # The last key deals equal rows out over several ranges.
    ranged = rows.orderBy("key", F.asc_nulls_first("turn"), "role", F.xxhash64("piece"), F.xxhash64(F.spark_partition_id(), F.monotonically_increasing_id()))
    placed = stored(
        ranged.select(
            "key",
            F.monotonically_increasing_id().alias("at"),
            "piece",
            "head",
            F.char_length("piece").alias("chars"),
            (F.char_length("piece") - F.col("head") - len(template.close) - 1).alias("length"),
            F.greatest(tokens(F.col("piece")), F.lit(1)).cast("long").alias("cost"),
            F.coalesce(F.col("role") == "assistant", F.lit(False)).alias("target"),
            F.coalesce(F.col("role") == "system", F.lit(False)).alias("system"),
        )
    ).withColumn("part", F.shiftright("at", 33))
    parts = placed.groupBy("key", "part").agg(F.sum("cost").alias("cost"))
    line = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "key", "part", F.coalesce(F.sum("cost").over(line), F.lit(0)).alias("before"), F.sum("cost").over(Window.partitionBy("key")).alias("total")
    )
    inside = Window.partitionBy("key", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    joined = placed.join(offsets, ["key", "part"])
    return joined.withColumn("begin", F.col("before") + F.coalesce(F.sum("cost").over(inside), F.lit(0))).drop("before", "at", "part")


def _sum(turns: Column, name: str) -> Column:
    return F.aggregate(turns, F.lit(0).cast("long"), lambda total, t: total + t[name])


def _windows(turns: Column, budget: int, history: int) -> Column:
    """The windows of one block: their start, repeated context and own turns."""
    own = F.filter(turns, lambda t: t["own"])
    system = F.filter(turns, lambda t: t["first"])
    room = F.greatest(budget - history - _sum(system, "cost"), F.lit(budget // 4))
    nothing = F.array().cast("array<bigint>")

    def take(starts: Column, t: Column) -> Column:
        full = (F.size(starts) == 0) | (t["begin"] + t["cost"] - F.element_at(starts, -1) > room)
        return F.when(full, F.concat(starts, F.array(t["begin"]))).otherwise(starts)

    starts = F.aggregate(own, nothing, take)
    ends = F.concat(F.slice(starts, F.lit(2), F.greatest(F.size(starts) - 1, F.lit(0))), F.array(F.lit(2**63 - 1)))

    def window(pair: Column) -> Column:
        start, until = pair["0"], pair["1"]
        before = F.filter(turns, lambda t: t["first"] & (t["begin"] < start) | ~t["first"] & (t["begin"] < start) & (t["begin"] >= start - history))
        return F.struct(start.alias("start"), before.alias("context"), F.filter(own, lambda t: (t["begin"] >= start) & (t["begin"] < until)).alias("turns"))

    pairs = F.slice(F.arrays_zip(starts.alias("0"), ends.alias("1")), F.lit(1), F.size(starts))
    return F.transform(pairs, window)


def _loss(context: Column, shown: Column) -> Column:
    """Where the own assistant texts lie."""
    begin = F.struct(_sum(context, "chars").cast("int").alias("at"), F.array().cast("array<struct<begin:int,length:int>>").alias("spans"))

    def add(state: Column, t: Column) -> Column:
        span = F.array(F.struct((state["at"] + t["head"]).alias("begin"), t["length"].alias("length")))
        return F.struct((state["at"] + t["chars"]).alias("at"), F.when(t["target"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(shown, begin, add)["spans"]
