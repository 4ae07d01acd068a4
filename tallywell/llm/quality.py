"""Line-first cleaning: bad lines go, then documents that lose too much."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, col, fresh, let

# fixed values
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»«›‹•·"
BLANK = r"[\x09-\x0D\x20]"
INK = r"[^\x09-\x0D\x20]"
SENTENCE_END = r"""[.!?…。！？؟।:;]["'”’»)\]]*([\x09-\x0D\x20]|\z)"""
# what a notice says, and what invites to do something; whole words, in lower case
NOTICES = (
    r"\bcopyright (?:©|\(c\))|\b(?:all rights reserved|copyright [0-9]{4}|terms (?:of|and) (?:use|service|conditions)"
    r"|privacy policy|cookie (?:policy|settings|notice)|(?:use|accept|uses) (?:of )?cookies|enable javascript"
    r"|lorem ipsum|skip to (?:main )?content|(?:licensed|released) under(?: [a-z0-9.-]+){0,5} licen[cs]e)\b"
)
PROMPTS = (
    r"\b(?:click here|read more|sign (?:up|in)|log ?in|subscribe|share (?:this|on)|follow us|powered by)\b"
)
#: three characters of those that the density rules count
_SOME_MARKS = r"[|»«›‹•·#*$%&<>!](?:[^|»«›‹•·#*$%&<>!]*[|»«›‹•·#*$%&<>!]){2}"


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules, as counts for 100 characters that are not white space.

    ``boilerplate_chars`` is the length up to which a line is looked at for phrases, ``notices`` and ``prompts``
    how much of it those of a kind make up at least; ``lost`` is the percentage of its characters a
    document may lose.
    """

    separators: int = 5
    symbols: int = 10
    exclamations: int = 8
    boilerplate_chars: int = 200
    notices: int = 20
    prompts: int = 50
    capitals_chars: int = 20
    lost: int = 50


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _ink(text: Column) -> Column:
    """Characters that are not white space."""
    return F.char_length(_without(text, SPACES))


def _number_of(text: Column, characters: str) -> Column:
    return F.char_length(text) - F.char_length(_without(text, characters))


def words(text: Column) -> Column:
    """The words of a text; null and blank texts have none."""
    return F.when(text.rlike(INK), F.split(F.trim(text, F.lit(SPACES)), f"{BLANK}+")).otherwise(F.array().cast("array<string>"))


def repeated_words(w: Column) -> Column:
    """Words in windows of three words that the text has at least twice.

    Windows are compared by a 64-bit hash. Equal windows become neighbours by sorting.
    """
    ends = F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0)))
    hashes = F.transform(ends, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(ordered, lambda s: _covered(_repeats(s)))

    some = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    return F.when(F.size(w) < 4, F.lit(0)).otherwise(some)


def _repeats(s: Column) -> Column:
    """Sorted places of the windows that have an equal neighbour."""
    equal = F.filter(
        s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])
    )
    return F.sort_array(F.transform(equal, lambda x: x["i"]))


def _covered(places: Column) -> Column:
    """How many words windows at these places cover."""
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(
        places,
        start,
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
        lambda a: a["n"],
    )


def bad_line(line: Column, rules: LineRules) -> Column:
    """Whether a line fails a rule; blank lines never do.

    Punctuation: nothing ends a sentence in it, symbols or exclamation marks are too
    dense, or it is all capitals. Navigation: separators are too dense. Boilerplate: known phrases make up
    much of a short line. What few lines pass comes first; most lines are searched three times.
    """

    def dense(characters: str, limit: int) -> Column:
        n = _number_of(line, characters)
        return (n >= 3) & (n * 100 >= _ink(line) * limit)

    def phrases(pattern: str, share: int) -> Column:
        low = F.lower(line)
        rest = F.char_length(F.regexp_replace(F.regexp_replace(low, pattern, ""), BLANK, ""))
        return low.rlike(pattern) & ((_ink(line) - rest) * 100 >= _ink(line) * share)

    crowded = line.rlike(_SOME_MARKS) & (
        dense(SEPARATORS, rules.separators) | dense(SYMBOLS, rules.symbols) | dense("!", rules.exclamations)
    )
    capitals = ~line.rlike("[a-z]") & (_ink(line) >= rules.capitals_chars) & (F.upper(line) == line) & (F.lower(line) != line)
    boilerplate = (F.char_length(line) <= rules.boilerplate_chars) & (
        phrases(NOTICES, rules.notices) | phrases(PROMPTS, rules.prompts)
    )
    return line.rlike(INK) & (~line.rlike(SENTENCE_END) | capitals | crowded | boilerplate)


def quality(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> DataFrame:
    """All rows and columns with measures, ``clean_text`` and the verdict ``kept``.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``lines_removed`` (long); ``base_failed``: under 50 words, or more than half of them in
    repeated windows; ``clean_text``: the lines that pass, null for null; ``kept``:
    not ``base_failed``, and at most ``rules.lost`` percent of the characters lost.

    Null texts count as empty and, like all under 50 words, are not kept. Columns of
    these names are replaced. One projection, so rows of any size and number pass
    through where they are read.
    """
    names = [
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "lines_removed", "base_failed", "clean_text", "kept",
    ]
    docs = docs.drop(*names)
    by_word, by_line = fresh(docs, "by_word", "by_line")
    body = F.coalesce(col(text), F.lit(""))

    def word_measures(w: Column) -> Column:
        ink = F.char_length(F.array_join(w, ""))
        return F.struct(F.size(w).alias("n"), ink.alias("ink"), repeated_words(w).alias("repeated"))

    def line_measures(lines: Column) -> Column:
        wordy = F.filter(lines, lambda x: x.rlike(INK))
        good = F.filter(lines, lambda x: ~bad_line(x, rules))
        return F.struct(
            let(wordy, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("copies"),
            F.size(lines).alias("n"),
            let(good, lambda x: F.struct(F.size(x).alias("n"), F.array_join(x, "\n").alias("text"))).alias("good"),
        )

    measured = docs.withColumns(
        {by_word: let(words(body), word_measures), by_line: let(F.split(body, "\n", -1), line_measures)}
    )
    n, repeated = F.col(by_word)["n"], F.col(by_word)["repeated"]
    ink, removed = F.col(by_word)["ink"], F.col(by_line)["n"] - F.col(by_line)["good"]["n"]
    left = F.when(removed == 0, ink).otherwise(_ink(F.col(by_line)["good"]["text"]))
    failed = (n < 50) | (repeated * 100 > n * 50)
    columns = {
        "n_words": n,
        "word_chars": ink,
        "n_symbols": F.regexp_count(body, F.lit(f"[{SYMBOLS}]")),
        "n_dup_lines": F.col(by_line)["copies"],
        "n_repeat_words": repeated,
        "lines_removed": removed,
    }
    return measured.withColumns(
        {name: value.cast("long") for name, value in columns.items()}
        | {
            "base_failed": failed,
            "clean_text": F.when(col(text).isNotNull(), F.col(by_line)["good"]["text"]),
            "kept": ~failed & ((ink - left) * 100 <= ink * rules.lost),
        }
    ).drop(by_word, by_line)
