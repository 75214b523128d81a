"""Secret scans: known shapes of secrets, and candidate strings of high entropy, as spans of code points.

A candidate is a long run of key characters with letters and digits.  A window slides over it; its Shannon entropy follows
from the counts of its characters, which change by one at each end per step: ``H = log2(w) - sum(c * log2(c)) / w``.

Times grow in proportion to a text, however many matches it holds: places are sums over chunks of a list, spans are merged in
order, and what is between them is cut out of short parts of the text.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from tillhouse.llm.common import let


@dataclass(frozen=True)
class Shape:
    """Matches of ``pattern``; those whose last characters of class ``tail`` are fewer than ``least`` fail."""

    kind: str
    pattern: str
    value: str | None = None
    least: int = 0


ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?"""
VALUE = r"[A-Za-z0-9+/_.=-]+"

# A run of n or more characters of a class is found by {n,}: shorter maximal runs hold no longer match.
SHAPES = (
    Shape("assign", ASSIGN + VALUE, ASSIGN + f"({VALUE})", 6),
    Shape("access", r"AKIA[A-Z0-9]{16,}"),
    Shape("hex", r"[0-9a-f]{24,}"),
)


@dataclass(frozen=True)
class Alphabet:
    """Candidates made of these characters only, and the entropy in bits from which a window is suspicious."""

    name: str
    pattern: str
    bits: float


CANDIDATE = r"[A-Za-z0-9+/_-]{20,}+"
CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"  # of a candidate
LIKELY = r"^(?=.*[0-9])(?=.*[A-Za-z])"
ALPHABETS = (Alphabet("hex", r"^[0-9a-fA-F]+$", 3.0), Alphabet("base64", r"^[A-Za-z0-9+/_-]+$", 3.7))
WINDOW = 20
RUN = r"(.)\1{7,}"
# No secrets: placeholders, runs of one character, slugs and paths of words with a number.  Patterns from ^ to $ allow a
# whole candidate; matches of the others allow the windows that touch them, whatever else the candidate holds.
ALLOWED = (
    r"(?i)example|sample|placeholder|dummy|changeme|your[-_]?key",
    RUN,
    r"(?i)0123456789|abcdefghij",
    r"^[A-Za-z]*+(?:[/_-][A-Za-z]++)++[/_-]?[0-9]{0,8}$",
    r"^[A-Z]?[a-z]+[0-9]{1,6}$",
    r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
)
HELD = {RUN: 8}  # characters of a match that a window must hold to be allowed, where touching it isn't enough
ENTROPY = "entropy"


CHUNK = 128  # entries of a list whose sums are kept


def _before(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each number of a list what ``combine`` makes of 0 and all before it.

    An aggregate copies its state in each step, so none here holds a list: the chunks of a list are combined first, then
    those before each chunk, and each number adds what stands before it in its own chunk.
    """
    zero = F.lit(0)

    def of_chunks(numbers: Column) -> Column:
        places = F.sequence(zero, F.floor((F.size(numbers) - 1) / CHUNK).cast("int"))
        each = F.transform(places, lambda k: F.aggregate(F.slice(numbers, k * CHUNK + 1, CHUNK), zero, combine))
        return let(each, lambda found: F.transform(found, lambda _, k: F.aggregate(F.slice(found, 1, k), zero, combine)))

    def of_numbers(numbers: Column, chunks: Column) -> Column:
        def one(k: Column) -> Column:
            first = F.floor(k / CHUNK).cast("int")
            own = F.aggregate(F.slice(numbers, first * CHUNK + 1, k - first * CHUNK), zero, combine)
            return combine(F.get(chunks, first), own)

        return F.transform(numbers, lambda _, k: one(k))

    none = F.array().cast("array<int>")
    return let(
        values,
        lambda numbers: F.when(F.size(numbers) == 0, none).otherwise(
            let(of_chunks(numbers), lambda chunks: of_numbers(numbers, chunks))
        ),
    )


def _greater(one: Column, other: Column) -> Column:
    return F.greatest(one, other)


def _matches(text: Column, pattern: str) -> Column:
    """Leftmost matches that don't overlap, as (start, text) in code points; nothing is cut out where nothing matches."""

    def place(found: Column, gaps: Column) -> Column:
        widths = F.transform(found, lambda match, k: F.length(F.get(gaps, k)) + F.length(match))
        return let(
            _before(widths, add),
            lambda before: F.transform(
                found,
                lambda match, k: F.struct((F.get(before, k) + F.length(F.get(gaps, k))).alias("start"), match.alias("text")),
            ),
        )

    hits = let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: let(F.split(text, pattern, -1), lambda gaps: place(found, gaps)),
    )
    return F.when(text.rlike(pattern), hits).otherwise(F.array().cast("array<struct<start:int,text:string>>"))


def _span(start: Column, end: Column, kind: str, rank: int) -> Column:
    return F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"))


def _shape_spans(text: Column, shape: Shape, rank: int) -> Column:
    found = _matches(text, shape.pattern)
    if shape.value is not None:
        value = shape.value
        found = F.filter(found, lambda hit: F.length(F.regexp_extract(hit["text"], value, 1)) >= shape.least)
    return F.transform(found, lambda hit: _span(hit["start"], hit["start"] + F.length(hit["text"]), shape.kind, rank))


def _allowed_ends(candidate: Column, window: int, patterns: Sequence[str]) -> Column:
    """For each match the first and last position at which a window that it allows can end, in order."""

    def ends(pattern: str) -> Column:
        held = HELD.get(pattern, 0)
        return F.transform(
            _matches(candidate, pattern),
            lambda hit: F.struct(
                (hit["start"] + held).alias("first"),
                (hit["start"] + F.length(hit["text"]) - held + window).alias("last"),
            ),
        )

    return F.array_sort(F.concat(F.array().cast("array<struct<first:int,last:int>>"), *map(ends, patterns)))


def _suspicious(candidate: Column, window: int, bits: Column, allowed: Column) -> Column:
    """First and last position (exclusive) of the windows of at least so many bits; null if there is none.

    Windows that end where ``allowed`` says are passed over.  The counts of the characters in the window are kept, several
    to a number.
    """
    weigh = F.array(*(F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 2)))
    width = (window + 1).bit_length()
    each = 62 // width  # counts to a number
    none = F.array(*(F.lit(0).cast("long") for _ in range(-(-len(CHARACTERS) // each))))

    def place(char: Column) -> Column:
        return F.instr(F.lit(CHARACTERS), char) - 1

    def change(counts: Column, total: Column, at: Column, by: int) -> tuple[Column, Column]:
        """The counts and the total of the weights, with one more or less of the character at that place; none if it is -1."""
        shift = (at % each) * width
        count = F.call_function("shiftright", F.get(counts, F.floor(at / each).cast("int")), shift).bitwiseAND((1 << width) - 1).cast("int")
        one = F.call_function("shiftleft", F.lit(by).cast("long"), shift)
        changed = F.transform(counts, lambda number, k: F.when(k == F.floor(at / each), number + one).otherwise(number))
        new = total + F.get(weigh, count + by) - F.get(weigh, count)
        return F.when(at < 0, counts).otherwise(changed), F.when(at < 0, total).otherwise(new)

    def slide(chars: Column) -> Column:
        def step(state: Column, char: Column) -> Column:
            left = F.when(state["at"] >= window, place(F.get(chars, state["at"] - window))).otherwise(-1)

            def without(rest: Column) -> Column:
                counts, total = change(rest["counts"], rest["total"], rest["enters"], 1)
                at = state["at"] + 1
                match = F.get(allowed, state["taken"])
                reached = F.coalesce(match["first"] <= at, F.lit(False))
                until = F.when(reached, F.greatest(state["until"], match["last"])).otherwise(state["until"])

                def judged(total: Column) -> Column:
                    hit = (at >= window) & (at > until) & (F.lit(math.log2(window)) - total / window >= bits)
                    return F.struct(
                        counts.alias("counts"),
                        total.alias("total"),
                        at.alias("at"),
                        (state["taken"] + F.when(reached, 1).otherwise(0)).alias("taken"),
                        until.alias("until"),
                        F.coalesce(state["first"], F.when(hit, at - window)).alias("first"),
                        F.when(hit, at).otherwise(state["last"]).alias("last"),
                    )

                return let(total, judged)

            def leave(at: Column) -> Column:
                counts, total = change(state["counts"], state["total"], at, -1)
                return F.struct(counts.alias("counts"), total.alias("total"), place(char).alias("enters"))

            return let(let(left, leave), without)

        nothing = F.lit(None).cast("int")
        first = F.struct(
            none.alias("counts"),
            F.lit(0.0).alias("total"),
            F.lit(0).alias("at"),
            F.lit(0).alias("taken"),
            F.lit(0).alias("until"),
            nothing.alias("first"),
            nothing.alias("last"),
        )
        return F.aggregate(chars, first, step)

    return let(F.filter(F.split(candidate, "", -1), lambda char: char != ""), slide)


def _entropy_spans(text: Column, rank: int, window: int, alphabets: Sequence[Alphabet], allowed: Sequence[str]) -> Column:
    whole = [pattern for pattern in allowed if pattern.startswith("^")]
    inside = [pattern for pattern in allowed if pattern not in whole]

    def wanted(hit: Column) -> Column:
        keep = hit["text"].rlike(LIKELY)
        for pattern in whole:
            keep = keep & ~hit["text"].rlike(pattern)
        return keep

    def judge(hit: Column) -> Column:
        bits = F.coalesce(*(F.when(hit["text"].rlike(a.pattern), F.lit(a.bits)) for a in alphabets), F.lit(math.inf))
        return let(
            let(_allowed_ends(hit["text"], window, inside), lambda ends: _suspicious(hit["text"], window, bits, ends)),
            lambda state: F.when(
                state["first"].isNotNull(),
                _span(hit["start"] + state["first"], hit["start"] + state["last"], ENTROPY, rank),
            ),
        )

    found = F.transform(F.filter(_matches(text, CANDIDATE), wanted), judge)
    return F.filter(found, lambda span: span.isNotNull())


def secret_spans(
    text: Column,
    shapes: Sequence[Shape] = SHAPES,
    window: int = WINDOW,
    alphabets: Sequence[Alphabet] = ALPHABETS,
    allowed: Sequence[str] = ALLOWED,
) -> Column:
    """Spans (start, rank, end, kind) in order; entropy spans inside a span of a known shape are left out."""
    text = F.coalesce(text, F.lit(""))
    known = F.concat(*(_shape_spans(text, shape, rank) for rank, shape in enumerate(shapes)))
    added = _entropy_spans(text, len(shapes), window, alphabets, allowed)

    def merged(spans: Column) -> Column:  # at one start those of known shapes come first
        ends = F.transform(spans, lambda span: F.when(span["rank"] < len(shapes), span["end"]).otherwise(0))
        return let(
            _before(ends, _greater),
            lambda reach: F.filter(spans, lambda span, k: (span["rank"] < len(shapes)) | (span["end"] > F.get(reach, k))),
        )

    return let(F.array_sort(F.concat(known, added)), merged)


def scan_secrets(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """Each row as ``row`` with its ``spans``.

    Rows are judged alone, without shuffle: repeated rows have equal spans, null and empty texts none, an empty table gives
    an empty one.  Columns of ``docs`` stay inside ``row``.
    """
    row = F.struct(*(docs[name] for name in docs.columns)).alias("row")
    return docs.select(row, secret_spans(docs[text], **options).alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


PART = 1024  # code points of the parts that a text is cut into to copy what lies between spans


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with each span, or run of overlapping spans, replaced by ``mark``; null stays null."""

    def cut(parts: Column, gap: Column) -> Column:
        first = F.floor(gap["start"] / PART).cast("int")
        count = F.floor((gap["end"] - 1) / PART).cast("int") - first + 1
        near = F.array_join(F.slice(parts, first + 1, count), "")
        return F.when(gap["end"] <= gap["start"], "").otherwise(
            F.substr(near, gap["start"] - first * PART + 1, gap["end"] - gap["start"])
        )

    end = F.struct(F.length(text).alias("start"), F.lit(0).alias("rank"), F.length(text).alias("end"), F.lit("").alias("kind"))

    def joined_gaps(parts: Column, all_spans: Column, done: Column) -> Column:
        gaps = F.transform(all_spans, lambda span, k: F.struct(F.get(done, k).alias("start"), span["start"].alias("end")))
        kept = F.filter(gaps, lambda gap: gap["start"] <= gap["end"])
        return F.array_join(F.transform(kept, lambda gap: cut(parts, gap)), mark)

    def between(parts: Column, all_spans: Column) -> Column:
        ends = F.transform(all_spans, lambda span: span["end"])
        return let(_before(ends, _greater), lambda done: joined_gaps(parts, all_spans, done))

    clean = let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PART}}}"), F.lit(0)), lambda parts: let(F.array_append(spans, end), lambda x: between(parts, x)))
    return F.when(F.size(spans) == 0, text).otherwise(clean)


def redact_secrets(docs: DataFrame, text: str = "text", length: str | None = None, **options) -> DataFrame:
    """The rows of ``docs`` with secrets replaced in ``text``; ``length`` names a column of its length to bring up to date."""
    found = scan_secrets(docs, text, **options)
    clean = found.withColumn("clean", redact(F.col("row")[text], F.col("spans")))
    changed = {text: F.col("clean")}
    if length in docs.columns:
        kind = docs.schema[length].dataType
        changed[length] = F.when(F.size("spans") == 0, F.col("row")[length]).otherwise(F.length("clean").cast(kind))
    return clean.select(*(changed.get(name, F.col("row")[name]).alias(name) for name in docs.columns))
