"""Conversations as training text, escaped until a parser gives back what went in.

A formatted conversation is a row of units: an opening mark, a body and the closing mark of the same
kind, with nothing between units. Four kinds of units are marked by two fixed strings each. A turn of a
user, an assistant or the system is a unit of its kind; a turn of any other role is a unit that
holds the role and one that holds the text. Bodies never hold a mark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, let

# fixed values: the marks of each kind of unit
MARKS = {
    "system": ("<<SYS>>", "<</SYS>>"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("<s>", "</s>"),
    "role": ("[ROLE]", "[/ROLE]"),
    "turn": ("[TURN]", "[/TURN]"),
}
#: kinds that are roles
ROLES = ("system", "user", "assistant")
# fixed values: any mark, for splitting
MARK = r"<</?SYS>>|\[/?(?:INST|ROLE|TURN)\]|</?s>"
#: a mark's first character, backslashes, and the rest of the mark; no two matches overlap, as no
#: rest holds the beginning of another match
_LOOKALIKE = r"([<\[])(\\*)(</?SYS>>|/?(?:INST|ROLE|TURN)\]|/?s>)"
_ESCAPED = r"([<\[])\\(\\*)(</?SYS>>|/?(?:INST|ROLE|TURN)\]|/?s>)"


def escape(text: Column) -> Column:
    """``text`` with one backslash more in everything that is a mark but for backslashes."""
    return F.regexp_replace(text, _LOOKALIKE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    """What :func:`escape` was given."""
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _unit(kind: str, body: Column) -> Column:
    opening, closing = MARKS[kind]
    return F.concat(F.lit(opening), body, F.lit(closing))


def render(turns: Column) -> Column:
    """The text of an array of turns, ``role`` and ``text``, as they are."""

    def turn(t: Column) -> Column:
        text = F.concat(_unit("role", t["role"]), _unit("turn", t["text"]))
        for role in ROLES:
            text = F.when(t["role"] == role, _unit(role, t["text"])).otherwise(text)
        return text

    return F.array_join(F.transform(turns, turn), "")


def _units(text: Column) -> Column:
    """Units as ``kind``, ``body``, ``start`` and ``end`` of the body; null where the text is none."""
    kinds = F.create_map(*(F.lit(x) for kind, (opening, _) in MARKS.items() for x in (opening, kind)))
    closing = F.create_map(*(F.lit(x) for pair in MARKS.values() for x in pair))

    def of(marks: Column, parts: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.size(marks)), lambda i: (i % 2 == 0) & (i < F.size(marks)))
        units = F.transform(
            places,
            lambda i: F.struct(
                F.element_at(kinds, F.get(marks, i)).alias("kind"),
                F.get(parts, i + 1).alias("body"),
                # marks must come in pairs and units follow each other at once
                ((F.get(marks, i + 1) == F.element_at(closing, F.get(marks, i))) & (F.get(parts, i) == "")).alias("sound"),
                (F.char_length(F.get(marks, i))).alias("opening"),
                (F.char_length(F.get(marks, i + 1))).alias("closing"),
            ),
        )
        good = F.forall(units, lambda u: F.coalesce(u["sound"], F.lit(False))) & (F.element_at(parts, -1) == "")
        return F.when(good, units)

    return let(
        F.regexp_extract_all(text, F.lit(MARK), F.lit(0)),
        lambda marks: let(F.split(text, MARK, -1), lambda parts: of(marks, parts)),
    )


def parse(text: Column) -> Column:
    """The turns of a formatted conversation, or null if the text breaks the grammar.

    An array of ``role``, ``text`` (unescaped) and ``start``, ``end``: where the turn's escaped text lies, in
    code points, end exclusive.
    """

    def turns(units: Column) -> Column:
        start = F.struct(
            F.lit(0).alias("at"),
            F.array().cast("array<struct<start:int,end:int>>").alias("spans"),
        )

        def step(state: Column, u: Column) -> Column:
            first = state["at"] + u["opening"]
            return let(
                F.struct(first.alias("start"), (first + F.char_length(u["body"])).alias("end")),
                lambda span: F.struct((span["end"] + u["closing"]).alias("at"), F.array_append(state["spans"], span).alias("spans")),
            )

        def placed(spans: Column) -> Column:
            numbered = F.filter(
                F.transform(units, lambda u, i: F.struct(u.alias("unit"), F.get(spans, i).alias("span"), F.get(units, i - 1).alias("before"))),
                lambda x: x["unit"]["kind"] != "role",
            )
            return F.transform(
                numbered,
                lambda x: F.struct(
                    F.when(x["unit"]["kind"] == "turn", unescape(x["before"]["body"])).otherwise(x["unit"]["kind"]).alias("role"),
                    unescape(x["unit"]["body"]).alias("text"),
                    x["span"]["start"].alias("start"),
                    x["span"]["end"].alias("end"),
                ),
            )

        # a role is followed by its turn, and a turn preceded by its role
        paired = F.forall(
            F.transform(units, lambda u, i: (F.get(units, i + 1)["kind"].eqNullSafe(F.lit("turn")) == (u["kind"] == "role")) & ((i > 0) | (u["kind"] != "turn"))),
            lambda x: x,
        )
        return F.when(paired, let(F.aggregate(units, start, step, lambda s: s["spans"]), placed))

    return let(_units(text), lambda units: F.when(units.isNotNull(), turns(units)))


def _same(parsed: Column, turns: Column) -> Column:
    plain = F.transform(parsed, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return F.coalesce(plain == turns, F.lit(False))


def round_trip(turns: Column) -> Column:
    """``text``, ``parsed`` and ``identical`` for an array of turns.

    Turns are rendered as they are, parsed, and compared. Where the parser doesn't give back the same turns, as some text
    or role holds a mark or what looks like an escaped one, texts and roles are escaped, rendered and parsed again.
    """

    def attempt(text: Column) -> Column:
        return let(text, lambda x: F.struct(x.alias("text"), parse(x).alias("parsed")))

    escaped = F.transform(turns, lambda t: F.struct(escape(t["role"]).alias("role"), escape(t["text"]).alias("text")))
    # a role that is changed isn't one of the known ones, so that it stays a role of its own
    return let(
        attempt(render(turns)),
        lambda first: let(
            F.when(_same(first["parsed"], turns), first).otherwise(attempt(render(escaped))),
            lambda last: F.struct(last["text"].alias("text"), last["parsed"].alias("parsed"), _same(last["parsed"], turns).alias("identical")),
        ),
    )


def format_chats(
    rows: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learn: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """A row per conversation: key, ``formatted``, ``n_turns``, ``loss`` and ``identical``.

    ``rows`` has a row per turn; they are put in order by ``turn``, ties by role and text, nulls first. Null
    roles and texts count as empty; repeated rows are turns each; rows without a key are one conversation;
    other columns are left out; an empty table gives no rows. ``loss`` has ``start`` and ``end`` (code points of ``formatted``,
    end exclusive) of the texts of the roles in ``learn``; marks are no part of it. ``identical`` says that
    parsing ``formatted`` gives back the turns; it holds for any text, since escaped texts hold no mark.

    A conversation is one text in the end, so its turns meet in one task; conversations are dealt by key.
    """
    said = F.struct(
        col(turn).alias("turn"), F.coalesce(col(role), F.lit("")).alias("role"), F.coalesce(col(text), F.lit("")).alias("text")
    )
    turns = rows.groupBy(col(key)).agg(F.sort_array(F.collect_list(said)).alias("turns"))
    plain = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    made = turns.select(col(key), let(plain, round_trip).alias("made"))
    learnt = F.filter("made.parsed", lambda t: t["role"].isin(*learn))
    return made.select(
        col(key),
        F.col("made.text").alias("formatted"),
        F.size("made.parsed").alias("n_turns"),
        F.transform(learnt, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"))).alias("loss"),
        F.col("made.identical").alias("identical"),
    )


def under_mask(formatted: Column, spans: Column) -> Column:
    """The unescaped texts at ``spans``, one after another."""
    cut = F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"])))
    return F.array_join(cut, "")


def turns_text(parsed: Column) -> Column:
    """Role, line end, text, line end of each turn."""
    return F.array_join(F.transform(parsed, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
