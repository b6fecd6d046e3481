"""Chat formatting: a finite-state machine over roles and a declarative template.

The template says how a turn opens and closes and which roles count for the loss.  Each
conversation becomes an array of segments ``struct<text, loss>``; their concatenation is
the formatted text.  Control strings inside texts are escaped, so the formatted text can
be read back without doubt.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilth.llm.common import let

START = "start"


@dataclass(frozen=True)
class ChatTemplate:
    """``{role}`` in ``opening`` is the turn's role.  ``moves``: from a state, on a role, to
    a state; a role without a move is out of order and leaves the state as it is."""
    opening: str = "<|im_start|>{role}\n"
    closing: str = "<|im_end|>\n"
    guard: str = "<|"           # every control string begins with it
    loss_roles: tuple[str, ...] = ("assistant",)
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: {
        (START, "system"): "instructed", (START, "user"): "asked",
        ("instructed", "user"): "asked", ("asked", "assistant"): "answered",
        ("answered", "user"): "asked"})
    final: tuple[str, ...] = ("answered",)

    @property
    def open_head(self) -> str:
        return self.opening.partition("{role}")[0]

    @property
    def open_tail(self) -> str:
        return self.opening.partition("{role}")[2]


CHATML = ChatTemplate()


def escape(c: Column, guard: str = "<|") -> Column:
    """Double each backslash, then put one inside each guard: ``<|`` becomes ``<\\|``.  A
    single backslash between the guard's characters can then only come from here."""
    doubled = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit(guard), F.lit(guard[0] + "\\" + guard[1:]))


def unescape(c: Column, guard: str = "<|") -> Column:
    plain = F.replace(c, F.lit(guard[0] + "\\" + guard[1:]), F.lit(guard))
    return F.replace(plain, F.lit("\\\\"), F.lit("\\"))


def escape_role(c: Column, guard: str = "<|") -> Column:
    """A role stands on one line: its line breaks become ``<\\n>``, guarded like the rest."""
    return F.replace(escape(c, guard), F.lit("\n"), F.lit("<\\n>"))


def unescape_role(c: Column, guard: str = "<|") -> Column:
    return unescape(F.replace(c, F.lit("<\\n>"), F.lit("\n")), guard)


def _run_machine(roles: Column, t: ChatTemplate) -> Column:
    """The machine over an array of roles: struct<state, errors> at its end, where
    ``errors`` has the places of turns out of order."""
    table = F.map_from_entries(F.array(*[
        F.struct(F.struct(F.lit(s).alias("s"), F.lit(r).alias("r")), F.lit(to)) for (s, r), to in t.moves.items()]))
    begin = F.struct(F.lit(START).alias("state"), F.lit(0).alias("i"), F.array().cast("array<int>").alias("errors"))

    def step(acc: Column, role: Column) -> Column:
        return let(F.try_element_at(table, F.struct(acc["state"].alias("s"), role.alias("r"))), lambda to: F.struct(
            F.coalesce(to, acc["state"]).alias("state"), (acc["i"] + 1).alias("i"),
            F.when(to.isNull(), F.concat(acc["errors"], F.array(acc["i"]))).otherwise(acc["errors"]).alias("errors")))

    return F.aggregate(roles, begin, step)


def format_chats(turns: DataFrame, template: ChatTemplate = CHATML) -> DataFrame:
    """One row per conv_id: ``n_turns``, ``segments`` array<struct<text, loss>>,
    ``formatted``, ``valid_order`` and ``order_errors`` (places of turns out of order).

    Each text is one segment of its own; it carries loss if its role is in
    ``loss_roles``.  Turns are never dropped: a conversation out of order is formatted
    and flagged.

    Defined results: rows stand by turn (null first), then role, then text, so ties and
    repeated rows have one order and all stay; null text and null role are empty; rows
    without conv_id are one conversation; an empty table gives an empty table; other
    columns are ignored.  A conversation is one output row, so it is gathered whole: its
    length, not the number of conversations, bounds a task."""
    t, text = template, F.coalesce(F.col("text"), F.lit(""))
    role = F.coalesce(F.col("role"), F.lit(""))
    gathered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        F.col("turn").alias("turn"), role.alias("role"), text.alias("text")))).alias("__turns"))

    def segments(x: Column) -> Column:
        head = F.concat(F.lit(t.open_head), escape_role(x["role"], t.guard), F.lit(t.open_tail))
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(x["text"], t.guard).alias("text"), x["role"].isin(*t.loss_roles).alias("loss")),
            F.struct(F.lit(t.closing).alias("text"), F.lit(False).alias("loss")))

    turns_ = F.col("__turns")
    shaped = gathered.select(
        "conv_id", F.size(turns_).cast("long").alias("n_turns"),
        F.flatten(F.transform(turns_, segments)).alias("segments"),
        _run_machine(F.transform(turns_, lambda x: x["role"]), t).alias("__end"))
    return shaped.select(
        "conv_id", "n_turns", "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        ((F.size("__end.errors") == 0) & F.col("__end.state").isin(*t.final)).alias("valid_order"),
        F.col("__end.errors").alias("order_errors"))


def read_turns(formatted: Column, template: ChatTemplate = CHATML) -> Column:
    """The turns array<struct<role, text>> read back from a formatted text alone."""
    t = template
    pieces = F.split(formatted, _literal(t.open_head))

    def turn(piece: Column) -> Column:
        at = F.instr(piece, t.open_tail)
        body = F.substring(piece, at + len(t.open_tail), F.char_length(piece))
        return F.struct(
            unescape_role(F.substring(piece, F.lit(1), at - 1), t.guard).alias("role"),
            unescape(F.substring(body, F.lit(1), F.char_length(body) - len(t.closing)), t.guard).alias("text"))

    return let(pieces, lambda p: F.transform(F.slice(p, F.lit(2), F.size(p)), turn))


def _literal(s: str) -> str:
    return reduce(lambda out, ch: out + ("\\" + ch if not ch.isalnum() else ch), s, "")


def loss_text(segments: Column, template: ChatTemplate = CHATML) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]),
                                    lambda s: unescape(s["text"], template.guard)), "")
