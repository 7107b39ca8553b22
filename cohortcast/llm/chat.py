"""Operator 6: chat formatting by a finite-state machine over roles, DataFrame functions only.

A declarative template names each role's opening and closing text, whether its text is under the loss mask, and which
roles may follow a state.  A conversation's rows, in order of (turn, role, text), become text segments with a loss flag: opening,
escaped text, closing.  The machine folds over the roles; ``valid`` tells whether it accepts, ``error_turn`` the index of
the first turn it refuses.  Refused conversations are formatted all the same.  Control strings inside texts are escaped
reversibly: ``\\`` becomes ``\\5C`` and ``<|`` becomes ``\\3C|`` (in roles also newline, ``\\0A``), so a reader can split at the
markers alone.

Edge cases: null text is empty; null role is the empty role (never valid); a null conv_id is a conversation of its own; a
null turn sorts first; rows that repeat are turns of their own; further columns are ignored; an empty table gives no rows.
A conversation is one row of the result, so its turns meet in one task; nothing larger does.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    open: str = "<|im_start|>"
    header_end: str = "\n"
    close: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: state (the role before, "" at the start) -> roles that may come next
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple[str, ...] = ("assistant", "user")


CHATML = Template()


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\5C")), F.lit("<|"), F.lit("\\3C|"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\0A"), F.lit("\n")), F.lit("\\3C"), F.lit("<")), F.lit("\\5C"),
                     F.lit("\\"))


def format_chats(turns: DataFrame, t: Template = CHATML) -> DataFrame:
    """conv_id, segments array<struct<text, loss>>, formatted, valid, error_turn."""
    rows = turns.select(
        "conv_id", F.struct(F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("x"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("x"))
    moves = F.create_map(*[F.lit(v) for s, to in t.follows.items() for r in to for v in (f"{s}>{r}", r)])
    steps = F.transform(
        "x", lambda x, i: F.struct(i.alias("i"), x.role.alias("role"),
                                   F.when(i == 0, F.lit("")).otherwise(F.get("x", i - 1).role).alias("before")))
    refused = F.filter(steps, lambda s: moves[F.concat(s.before, F.lit(">"), s.role)].isNull())
    header = lambda r: F.concat(F.lit(t.open), F.replace(escape(r), F.lit("\n"), F.lit("\\0A")),
                                F.lit(t.header_end))
    segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    segments = F.flatten(F.transform("x", lambda x: F.array(
        segment(header(x.role), F.lit(False)), segment(escape(x.text), x.role.isin(*t.loss_roles)),
        segment(F.lit(t.close), F.lit(False)))))
    out = chats.select("conv_id", F.get(F.transform(refused, lambda s: s.i), F.lit(0)).alias("error_turn"),
                       F.element_at("x", -1).role.alias("last"), segments.alias("segments"))
    return out.select(
        "conv_id", "segments", F.array_join(F.transform("segments", lambda s: s.text), "").alias("formatted"),
        (F.col("error_turn").isNull() & F.col("last").isin(*t.final)).alias("valid"),
        F.col("error_turn").cast("int").alias("error_turn"))


def read_back(chats: DataFrame, t: Template = CHATML) -> DataFrame:
    """The turns parsed from ``formatted`` and the text under the loss mask, unescaped: adds turns
    array<struct<role, text>> and loss_text."""
    pieces = F.split("formatted", r"\Q" + t.close + r"\E")
    heads = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))
    cut = F.transform(heads, lambda p: F.substr(p, F.lit(len(t.open) + 1)))
    turns = F.transform(cut, lambda p: F.struct(
        unescape(F.substring_index(p, t.header_end, 1)).alias("role"),
        unescape(F.substr(p, F.instr(p, t.header_end) + len(t.header_end))).alias("text")))
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s.loss), lambda s: unescape(s.text)), "")
    return chats.withColumns({"turns": turns, "loss_text": loss})
