"""Chat formatting: turns checked by a finite-state machine and written by a declarative template.

A template names the strings around a turn's role and text. Inside roles and texts an escape
character stands for the first characters of the control strings, so no control string can occur in
them and the output can be read back without loss. The machine is a table (state, role) -> state.

A conversation is one output row, so its turns meet in one task by nature of the format; they are
gathered by a hash of the conversation and sorted there.

Defined cases: NULL text and NULL role are empty; turns with the same number are ordered by role and
text, a NULL number comes first; a NULL conv_id is one conversation; every conversation is formatted,
``valid`` says whether the machine accepts it; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    opening: str = "<s>[INST]"
    after_role: str = "[/INST]"
    closing: str = "</s>"
    #: First characters of the control strings and the escape itself, each with its replacement.
    escapes: tuple[tuple[str, str], ...] = (("~", "~0"), ("<", "~1"), ("[", "~2"))
    learned_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    accepting: tuple[str, ...] = ("assistant",)
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
        }
    )


def _escape(text: Column, template: Template) -> Column:
    return reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), template.escapes, text)


def _unescape(text: Column, template: Template) -> Column:
    return reduce(lambda c, e: F.replace(c, F.lit(e[1]), F.lit(e[0])), reversed(template.escapes), text)


def _accepted(turns: Column, template: Template) -> Column:
    def move(state, turn):
        to = F.lit("failed")
        for (source, role), target in template.moves.items():
            to = F.when((state == source) & (turn["role"] == role), F.lit(target)).otherwise(to)
        return to

    return F.aggregate(turns, F.lit(template.start), move).isin(*template.accepting)


def format_conversations(rows: DataFrame, template: Template | None = None) -> DataFrame:
    """Per conversation: conv_id, valid, segments (text, loss) in order, and formatted, their concatenation."""
    t = template or Template()
    turn = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )

    def segments(x):
        head = F.concat(F.lit(t.opening), _escape(x["role"], t), F.lit(t.after_role))
        learned = x["role"].isin(*t.learned_roles)
        return F.array(
            F.struct(head.alias("text"), F.lit(False).alias("loss")),
            F.struct(_escape(x["text"], t).alias("text"), learned.alias("loss")),
            F.struct(F.lit(t.closing).alias("text"), F.lit(False).alias("loss")),
        )

    grouped = rows.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    written = grouped.select("conv_id", _accepted(F.col("turns"), t).alias("valid"), F.flatten(F.transform("turns", segments)).alias("segments"))
    return written.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """Adds ``turns`` (role, text), parsed from the formatted string, and ``learned``, the text under the loss mask."""
    t = template or Template()

    def turn(piece):
        body = F.substr(piece, F.lit(len(t.opening) + 1))
        cut = F.instr(body, F.lit(t.after_role))
        return F.struct(
            _unescape(F.substr(body, F.lit(1), cut - 1), t).alias("role"),
            _unescape(F.substr(body, cut + len(t.after_role)), t).alias("text"),
        )

    pieces = F.filter(F.split("formatted", F.lit("\\Q" + t.closing + "\\E")), lambda p: p != "")
    learned = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: _unescape(s["text"], t))
    return formatted.withColumn("turns", F.transform(pieces, turn)).withColumn("learned", F.array_join(learned, ""))
