"""Places of matches in texts, and texts with places replaced, by DataFrame functions.

Offsets are code points, ends exclusive. Work grows in proportion to a text and (but for
a logarithm) to its matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCATED = "array<struct<start:int,end:int,value:string>>"
BLOCK = 2048


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def running_sum(numbers: Column) -> Column:
    """Prefix sums of an array, by adding it to itself at distances 1, 2, 4, ..."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(numbers) + 1)).cast("int"))

    def step(sums: Column, k: Column) -> Column:
        behind = F.slice(F.concat(F.array_repeat(F.lit(0), F.call_function("shiftleft", F.lit(1), k)), sums),
                         F.lit(1), F.size(sums))
        return F.zip_with(sums, behind, lambda a, b: a + b)

    return F.aggregate(rounds, numbers, step)


def located(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of the matches, in order.

    The text between matches, by which it is split, and the matches give the offsets.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), 0)

    def offsets(x: Column) -> Column:
        lengths = F.zip_with(F.slice(x["gaps"], F.lit(1), F.size(x["matches"])), x["matches"],
                             lambda gap, match: F.length(gap) + F.length(match))
        return F.zip_with(x["matches"], running_sum(lengths), lambda match, end: F.struct(
            (end - F.length(match)).alias("start"), end.alias("end"), match.alias("value")))

    both = F.struct(F.split(text, pattern, -1).alias("gaps"), matches.alias("matches"))
    # No match, no offsets to work out.
    return F.when(F.regexp_like(text, F.lit(pattern)), let(both, offsets)).otherwise(F.array()).cast(LOCATED)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def number_of(kind: str, spans: Column) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def replaced(text: Column, spans: Column, name: Callable[[Column], Column]) -> Column:
    """The text with spans (in order of their starts) replaced by their ``name``.

    Spans that overlap are replaced together, under the name of the first. The text is cut
    into blocks, so that no piece is looked for from the beginning.
    """
    def pieces(x: Column) -> Column:
        def between(start: Column, end: Column) -> Column:
            first, last = F.floor(start / BLOCK).cast("int"), F.floor(end / BLOCK).cast("int")
            at = lambda k: F.coalesce(F.get(x["blocks"], k), F.lit(""))
            inside = F.substring(at(first), start % BLOCK + 1, end - start)
            across = F.concat(F.substring(at(first), start % BLOCK + 1, F.lit(BLOCK)),
                              F.array_join(F.slice(x["blocks"], first + 2, F.greatest(F.lit(0), last - first - 1)), ""),
                              F.substring(at(last), F.lit(1), end % BLOCK))
            return F.when(end <= start, "").when(first == last, inside).otherwise(across)

        # The gap before each span begins where all earlier spans have ended.
        gaps = F.zip_with(x["spans"], x["reached"], lambda s, r: F.when(
            r > s["start"], "").otherwise(F.concat(between(r, s["start"]), name(s))))
        return F.concat(F.array_join(gaps, ""), between(x["reached"][F.size(x["reached"]) - 1], x["size"]))

    def reached(found: Column) -> Column:
        """0 and the largest end up to each span."""
        return F.concat(F.array(F.lit(0)), running_most(F.transform(found, lambda s: s["end"])))

    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.length(text) / BLOCK).cast("int")),
                         lambda k: F.substring(text, k * BLOCK + 1, F.lit(BLOCK)))
    parts = let(spans, lambda found: F.struct(
        found.alias("spans"), reached(found).alias("reached"), blocks.alias("blocks"),
        F.length(text).alias("size")))
    return F.when(F.size(spans) > 0, let(parts, pieces)).otherwise(text)


def running_most(numbers: Column) -> Column:
    """Prefix maxima of an array of numbers that are not negative."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(numbers) + 1)).cast("int"))

    def step(most: Column, k: Column) -> Column:
        behind = F.slice(F.concat(F.array_repeat(F.lit(0), F.call_function("shiftleft", F.lit(1), k)), most),
                         F.lit(1), F.size(most))
        return F.zip_with(most, behind, lambda a, b: F.greatest(a, b))

    return F.aggregate(rounds, numbers, step)
