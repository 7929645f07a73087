"""Chat formatting by a declarative template and a finite-state machine over roles; column functions only."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    """What stands before and after a role's text, and whether the text counts for the loss."""

    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Control strings per role, and the machine that says which role may follow.

    A role that has no entry in ``turns`` is written between ``role`` and its text closed by ``close``.
    Control strings must differ from each other after their first character, must not contain a
    backslash, and their first characters must not occur later in any of them.
    """

    begin: str = "<s>"
    turns: dict[str, Turn] = field(
        default_factory=lambda: {
            "system": Turn("[SYS]", "[/SYS]"),
            "user": Turn("[INST]", "[/INST]"),
            "assistant": Turn("[OUT]", "</s>", loss=True),
        }
    )
    role: Turn = Turn("[ROLE]", "[/ROLE]")
    close: str = "[/TURN]"
    start: str = "start"
    #: (state, role) to the next state; a pair that is missing is an error.
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "told",
            ("start", "user"): "asked",
            ("told", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    accepting: tuple[str, ...] = ("answered",)

    @property
    def controls(self) -> list[str]:
        marks = [self.begin, self.role.open, self.role.close, self.close]
        return marks + [x for t in self.turns.values() for x in (t.open, t.close)]

    def _guarded(self, slashes: str) -> str:
        """The first character of a control string whose rest follows after this many backslashes."""
        by_first: dict[str, list[str]] = {}
        for c in sorted(set(self.controls)):
            by_first.setdefault(c[0], []).append(re.escape(c[1:]))
        return "|".join(rf"{re.escape(a)}(?={slashes}(?:{'|'.join(rest)}))" for a, rest in by_first.items())

    def escape(self, text: Column) -> Column:
        r"""``<s>`` in a text becomes ``<\s>``, ``<\s>`` becomes ``<\\s>``, and so on."""
        return F.regexp_replace(text, self._guarded(r"\\*"), r"$0\\")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, rf"({self._guarded(r'\\+')})\\", "$1")

    def segments(self, role: Column, text: Column) -> Column:
        """The array of (text, loss) that a turn is written as."""
        plain = lambda x: F.struct(x.alias("text"), F.lit(False).alias("loss"))
        named = F.concat(F.lit(self.role.open), self.escape(role), F.lit(self.role.close))
        out = F.array(plain(named), plain(self.escape(text)), plain(F.lit(self.close)))
        for name, turn in self.turns.items():
            own = F.struct(self.escape(text).alias("text"), F.lit(turn.loss).alias("loss"))
            out = F.when(role == name, F.array(plain(F.lit(turn.open)), own, plain(F.lit(turn.close)))).otherwise(out)
        return out

    def step(self, state: Column, role: Column) -> Column:
        """The next state, empty for an error, from which nothing leads on."""
        out = F.lit("")
        for (at, name), to in self.moves.items():
            out = F.when((state == at) & (role == name), F.lit(to)).otherwise(out)
        return out

    def parse(self, formatted: Column) -> Column:
        """The turns (role, text) of a formatted conversation.

        Texts hold no control string, so each turn ends at the first closing mark after its opening mark.
        """
        q = re.escape
        ways = [f"{q(t.open)}.*?{q(t.close)}" for t in self.turns.values()]
        ways.append(f"{q(self.role.open)}.*?{q(self.role.close)}.*?{q(self.close)}")
        turns = F.regexp_extract_all(formatted, F.lit("(?s)" + "|".join(ways)), F.lit(0))

        def inside(x: Column, before: Column, after: int) -> Column:
            return x.substr(before + 1, F.length(x) - before - after)

        def read(x: Column) -> Column:
            ends = F.locate(self.role.close, x)
            role = inside(x, F.lit(len(self.role.open)), 0).substr(F.lit(1), ends - len(self.role.open) - 1)
            text = inside(x, ends + (len(self.role.close) - 1), len(self.close))
            for name, t in self.turns.items():
                own = F.startswith(x, F.lit(t.open))
                role = F.when(own, F.lit(name)).otherwise(role)
                text = F.when(own, inside(x, F.lit(len(t.open)), len(t.close))).otherwise(text)
            return F.struct(self.unescape(role).alias("role"), self.unescape(text).alias("text"))

        return F.transform(turns, read)


def format_chats(
    rows: DataFrame, template: Template | None = None, conv: str = "conv_id", turn: str = "turn"
) -> DataFrame:
    """One row per conversation: conv_id, formatted, segments of (text, loss), valid, error_turn.

    ``rows`` has a row per turn with role and text. Turns go by ``turn``, then role, then text, null turns
    first; a null role or text is empty; repeated rows are turns of their own; rows with null ``conv`` are one
    conversation; other columns are left out. ``valid``: the machine took every role and stopped in an
    accepting state; ``error_turn`` is the first turn (from 0) that it refused, else null. Conversations that
    are not valid are written all the same. The formatted text is one value by nature, so a
    conversation must fit in a row (2 GB); nothing larger than one conversation is held together.
    """
    template = template or Template()
    one = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    chats = rows.groupBy(F.col(conv).alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    empty = F.struct(
        F.lit(template.start).alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("wrong")
    )

    def walk(so_far: Column, x: Column) -> Column:
        after = template.step(so_far.state, x.role)
        refused = F.when(so_far.wrong.isNull() & (after == ""), so_far["at"]).otherwise(so_far.wrong)
        return F.struct(after.alias("state"), (so_far["at"] + 1).alias("at"), refused.alias("wrong"))

    begin = F.array(F.struct(F.lit(template.begin).alias("text"), F.lit(False).alias("loss")))
    chats = chats.select(
        "conv_id",
        F.aggregate("turns", empty, walk).alias("end"),
        F.concat(begin, F.flatten(F.transform("turns", lambda x: template.segments(x.role, x.text)))).alias("segments"),
    )
    return chats.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda x: x.text), "").alias("formatted"),
        "segments",
        F.col("end.state").isin(*template.accepting).alias("valid"),
        F.col("end.wrong").alias("error_turn"),
    )


def loss_text(segments: Column, template: Template | None = None) -> Column:
    """All text under the loss mask, as it was before escaping."""
    marked = F.filter(segments, lambda x: x.loss)
    return F.array_join(F.transform(marked, lambda x: (template or Template()).unescape(x.text)), "")
