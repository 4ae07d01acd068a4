"""Secrets in texts: known shapes, and strings that pass for random in a battery of tests."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialize
from .common import col, let

# fixed values: the known shapes
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = (
    "assign", "access", "hex", "random_hex", "random_base32", "random_base36", "random_base52", "random_base62",
    "random_base64", "random_letters",
)

#: strings the battery looks at, unless they are short for their encoding
CANDIDATE = r"[A-Za-z0-9+/_-]{16,}={0,2}"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Alphabet:
    """The digits of an encoding, classes of characters one after another; ``classes`` are their sizes.

    ``least`` is the length from which the battery tells words from noise, as measured.
    """

    digits: str
    classes: tuple[int, ...]
    least: int


ALPHABETS = {
    "random_hex": Alphabet("0123456789abcdef", (10, 6), 16),
    "random_base32": Alphabet(_UPPER + "234567", (26, 6), 18),
    "random_base36": Alphabet("0123456789" + _LOWER, (10, 26), 18),
    "random_base52": Alphabet(_UPPER + _LOWER, (26, 26), 32),
    "random_base62": Alphabet(_UPPER + _LOWER + "0123456789", (26, 26, 10), 18),
    "random_base64": Alphabet(_UPPER + _LOWER + "0123456789+/", (26, 26, 12), 20),
    "random_letters": Alphabet("aeioubcdfghjklmnpqrstvwxyz", (5, 21), 48),
}
#: p-values are sorted into so many bins for each power of ten, down to 10^-_LEAST
_BINS, _LEAST = 20, 12
#: matches that are placed at a time
_PLACED = 64
#: strings of a larger p are never called structured
SIGNIFICANCE = 0.05


def _normal_tail(z: Column) -> Column:
    """P(Z > z), to seven digits."""
    # fixed values: the usual rational approximation
    t = 1 / (1 + F.abs(z) * 0.2316419)
    powers = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
    polynomial = F.lit(0.0)
    for c in reversed(powers):
        polynomial = (polynomial + c) * t
    tail = F.exp(-z * z / 2) * 0.3989422804014327 * polynomial
    return F.when(z >= 0, tail).otherwise(1 - tail)


def located(text: Column, pattern: str) -> Column:
    """``start``, ``end`` (code points) and ``text`` of the leftmost non-overlapping matches."""

    spans = "array<struct<start:int,end:int,text:string>>"

    def place(found: Column, between: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            match = F.get(found, i)
            first = state["at"] + F.char_length(F.get(between, i))
            return let(
                F.struct(first.alias("start"), (first + F.char_length(match)).alias("end"), match.alias("text")),
                lambda m: F.struct(m["end"].alias("at"), F.array_append(state["out"], m).alias("out")),
            )

        # appending copies an array, so matches are placed in blocks
        def block(state: Column, j: Column) -> Column:
            places = F.sequence(j * _PLACED, F.least((j + 1) * _PLACED, F.size(found)) - 1)
            start = F.struct(state["at"].alias("at"), F.array().cast(spans).alias("out"))
            return let(
                F.aggregate(places, start, step),
                lambda done: F.struct(done["at"].alias("at"), F.array_append(state["out"], done["out"]).alias("out")),
            )

        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{spans}>").alias("out"))
        blocks = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _PLACED).cast("int"))
        return F.aggregate(blocks, start, block, lambda s: F.flatten(s["out"]))

    matches = let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: let(F.split(text, pattern, -1), lambda between: place(found, between)),
    )
    return F.when(text.rlike(pattern), matches).otherwise(F.array().cast(spans))


# --- the battery ------------------------------------------------------------------------


def encoding(token: Column) -> Column:
    """``kind`` and ``plain``: what a string would encode, from the characters it has, and its digits.

    Strings of one case are looked at without ``+/_-``, in lower case but for base32. Null if the string is
    too short for its encoding, or a number.
    """

    def of(body: Column) -> Column:
        bare = F.regexp_replace(body, "[+/_-]", "")
        one_case = ~(body.rlike("[a-z]") & body.rlike("[A-Z]"))
        digit, letter, mark = body.rlike("[0-9]"), body.rlike("[A-Za-z]"), body.rlike("[+/_-]")
        kind = (
            F.when(~letter, F.lit(None))
            .when(one_case & digit & bare.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "random_hex")
            .when(one_case & digit & bare.rlike("^[A-Z2-7]+$"), "random_base32")
            .when(one_case & digit, "random_base36")
            .when(one_case, "random_letters")
            .when(mark, "random_base64")
            .when(digit, "random_base62")
            .otherwise("random_base52")
        )
        return let(
            kind,
            lambda k: F.struct(
                k.alias("kind"),
                F.when(k == "random_base32", bare)
                .when(one_case, F.lower(bare))
                .otherwise(F.translate(body, "-_", "+/"))
                .alias("plain"),
            ),
        )

    least = F.create_map(*(F.lit(x) for kind, a in ALPHABETS.items() for x in (kind, a.least)))
    return let(
        let(F.rtrim(token, F.lit("=")), of),
        lambda e: F.when(F.char_length(e["plain"]) >= F.element_at(least, e["kind"]), e),
    )


def _parameters() -> Column:
    """What the battery needs to know of each encoding: its digits, where classes end, and how often
    characters next to each other differ in class if they are drawn at random: mean and variance."""
    found = []
    for kind, a in ALPHABETS.items():
        k = len(a.digits)
        shares = [n / k for n in a.classes]
        change = 1 - sum(q * q for q in shares)
        both = sum(q * (1 - q) ** 2 for q in shares)
        first, second = a.classes[0], sum(a.classes[:2])
        numbers = {"k": k, "first": first, "second": second, "change": change, "own": change * (1 - change), "next": 2 * (both - change * change)}
        found += [F.lit(kind), F.struct(F.lit(a.digits).alias("digits"), *(F.lit(float(v)).alias(n) for n, v in numbers.items()))]
    return F.create_map(*found)


def battery(plain: Column, kind: Column) -> Column:
    """The p-value of three tests of randomness together, under which random strings are spread evenly.

    Uniformity: chi-squared of the characters' counts, by the cube-root approximation.
    Runs: how often classes of characters (cases and digits, vowels) change. Serial correlation: of
    digits next to each other. Small values say the string is not random. The characters are
    gone through once in order and once sorted.
    """
    zero = F.lit(0.0)

    def tests(a: Column) -> Column:
        def of_class(x: Column) -> Column:
            return F.when(x < a["first"], zero).when(x < a["second"], F.lit(1.0)).otherwise(F.lit(2.0))

        def step(s: Column, x: Column) -> Column:
            own, later = of_class(x), s["n"] > 0
            return F.struct(
                (s["n"] + 1).alias("n"),
                (s["sum"] + x).alias("sum"),
                (s["squares"] + x * x).alias("squares"),
                (s["lagged"] + F.when(later, s["last"] * x).otherwise(zero)).alias("lagged"),
                (s["changes"] + F.when(later & (s["class"] != own), F.lit(1.0)).otherwise(zero)).alias("changes"),
                F.when(later, s["start"]).otherwise(x).alias("start"),
                x.alias("last"),
                own.alias("class"),
            )

        names = ("n", "sum", "squares", "lagged", "changes", "start", "last", "class")

        def judged(s: Column, equal: Column) -> Column:
            n, k = s["n"], a["k"]
            chi = F.greatest(equal * k / n - n, zero)
            spread = F.lit(2.0 / 9) / (k - 1)
            uniformity = _normal_tail((F.pow(chi / (k - 1), 1 / 3) - (1 - spread)) / F.sqrt(spread))
            variance = (n - 1) * a["own"] + (n - 2) * a["next"]
            runs = 2 * _normal_tail(F.abs(s["changes"] - (n - 1) * a["change"]) / F.sqrt(variance))
            mean = s["sum"] / n
            power = s["squares"] - s["sum"] * mean
            lagged = s["lagged"] - mean * (2 * s["sum"] - s["start"] - s["last"]) + (n - 1) * mean * mean
            serial = F.when(power > 0, 2 * _normal_tail(F.abs(lagged / power * F.sqrt(n)))).otherwise(zero)
            return let(F.least(uniformity, runs, serial, F.lit(1.0)), lambda p: 1 - (1 - p) * (1 - p) * (1 - p))

        def pairs(d: Column) -> Column:
            """Sum of squared counts: a run of equal digits adds 1, 3, 5, ..."""
            start = F.struct(F.lit(-1.0).alias("last"), zero.alias("run"), zero.alias("total"))
            return F.aggregate(
                F.sort_array(d),
                start,
                lambda s, x: let(
                    F.when(x == s["last"], s["run"] + 1).otherwise(F.lit(1.0)),
                    lambda run: F.struct(x.alias("last"), run.alias("run"), (s["total"] + 2 * run - 1).alias("total")),
                ),
                lambda s: s["total"],
            )

        digits = F.transform(F.split(plain, ""), lambda c: (F.instr(a["digits"], c) - 1).cast("double"))
        return let(
            digits,
            lambda d: let(
                F.aggregate(d, F.struct(*(zero.alias(n) for n in names)), step),
                lambda s: let(pairs(d), lambda equal: judged(s, equal)),
            ),
        )

    return let(F.element_at(_parameters(), kind), tests)


def random_thresholds(scanned: DataFrame, rate: float) -> dict[tuple[str, int], float]:
    """For each encoding and length, as a power of two, up to which p a string is called structured.

    Random strings have evenly spread p, and few others one above a tenth; so ten ninths of those above are how
    many there are, and what is more than that among the strings above a limit is structured. The limit is the smallest that
    leaves at most ``rate`` of those, and :data:`SIGNIFICANCE` if none does. Only counts by bin of p
    reach the driver, a bounded number whatever the input.
    """
    p = F.greatest(F.col("c.p"), F.lit(10.0**-_LEAST))
    bins = (
        scanned.select(F.explode("candidates").alias("c"))
        .groupBy("c.kind", "c.band", F.floor(-F.log10(p) * _BINS).cast("int").alias("bin"))
        .agg(F.count("*").alias("n"))
        .collect()
    )
    strata: dict[tuple[str, int], dict[int, int]] = defaultdict(dict)
    for row in bins:
        strata[row.kind, row.band][row.bin] = row.n
    return {stratum: limit_of(counts, rate) for stratum, counts in strata.items()}


def limit_of(counts: Mapping[int, int], rate: float) -> float:
    """The limit of one stratum, from its counts by bin; the larger the bin, the smaller p."""
    # bins below the first power of ten are those of p above a tenth
    random = sum(n for b, n in counts.items() if b < _BINS) / 0.9
    above, limit = sum(counts.values()), 0.0
    for b in [*sorted(counts, reverse=True), -1]:
        structured = above - random * (1 - limit)
        if structured <= rate * above:
            return limit
        # next, all of this bin are called structured; its largest p is the limit
        limit = 10 ** (-b / _BINS)
        above -= counts.get(b, 0)
        if limit >= SIGNIFICANCE:
            break
    return SIGNIFICANCE


# --- the scan -------------------------------------------------------------------------


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", rate: float = 0.02) -> DataFrame:
    """``key`` and ``found``: an array of ``start``, ``place``, ``end``, ``kind``, in order.

    ``place`` is the place of ``kind`` in :data:`KINDS`. The three known shapes are always
    found. The others are strings of 16 characters and more (32 if letters of both cases only, 48 of one case,
    18 to 20 in other encodings than hexadecimal) that the battery does not call structured; of those reported, the false-discovery
    ``rate`` bounds how many are expected to be, as far as the battery can tell; numbers are not looked
    at. Whole texts are read, once; what is found in them is written and looked at again with the counts of all documents.

    Null texts count as empty and have an empty array, as have all texts without a match. Repeated rows are
    reported and counted each; an empty table stays empty.
    """
    body = F.coalesce(col(text), F.lit(""))

    def spans(matches: Column, kind: str) -> Column:
        return F.transform(
            matches,
            lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("place"), m["end"].alias("end"), F.lit(kind).alias("kind")),
        )

    long_enough = F.filter(located(body, ASSIGN), lambda m: F.char_length(F.regexp_extract(m["text"], ASSIGN, 2)) >= 12)
    known = F.concat(spans(long_enough, "assign"), spans(located(body, ACCESS), "access"), spans(located(body, HEX), "hex"))

    def judged(m: Column) -> Column:
        return F.struct(
            m["start"].alias("start"), m["end"].alias("end"), m["of"]["kind"].alias("kind"),
            F.floor(F.log2(F.char_length(m["of"]["plain"]).cast("double"))).cast("int").alias("band"),
            battery(m["of"]["plain"], m["of"]["kind"]).alias("p"),
        )

    encoded = F.filter(
        F.transform(
            located(body, CANDIDATE),
            lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), encoding(m["text"]).alias("of")),
        ),
        lambda m: m["of"]["kind"].isNotNull(),
    )
    scanned = materialize(
        docs.select(col(key), known.alias("known"), F.transform(encoded, judged).alias("candidates")), "secrets"
    )
    limits = random_thresholds(scanned, rate)

    def random(c: Column) -> Column:
        limit = F.lit(0.0)
        for (kind, band), edge in limits.items():
            limit = F.when((c["kind"] == kind) & (c["band"] == band), F.lit(edge)).otherwise(limit)
        return c["p"] > limit

    def span(c: Column) -> Column:
        place = F.array_position(F.array(*(F.lit(k) for k in KINDS)), c["kind"]).cast("int") - 1
        return F.struct(c["start"].alias("start"), place.alias("place"), c["end"].alias("end"), c["kind"].alias("kind"))

    added = F.transform(F.filter("candidates", random), span)
    return scanned.select(col(key), F.sort_array(F.concat("known", added)).alias("found"))


def span_text(found: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(found, lambda m: F.concat_ws(":", m["kind"], m["start"], m["end"])), ",")
