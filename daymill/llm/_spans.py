"""Regular expression matches with their places, from SQL functions alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: An empty array of matches.
NONE = "cast(array() AS array<struct<at: int, until: int, hit: string>>)"


def hits(text: str, pattern: str) -> Column:
    """All leftmost, non-overlapping matches of the pattern in a column, as strings."""
    return F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))


def _chunks(array: str) -> str:
    """An array that isn't empty in chunks of about the square root of its size.

    An array that grows by one is copied each time; so running sums and texts are built chunk by chunk, and many matches
    in one text cost little more than few.
    """
    size = f"cast(ceil(sqrt(size({array}))) AS int)"
    return f"transform(sequence(0, (size({array}) - 1) div {size}), k -> slice({array}, k * {size} + 1, {size}))"


def _let(value: str, name: str, body: str) -> str:
    """body with name for a value that is evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def placed(text: str, pattern: str, found: str) -> Column:
    """The matches in column found as structs (at, until, hit), counted in code points; until is exclusive.

    What stands between matches comes from splitting by the same pattern, so places are running sums of lengths.
    """
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    pairs = f"zip_with(`{found}`, slice(split(`{text}`, '{quoted}', -1), 1, size(`{found}`)), (h, g) -> struct(length(g) AS g, length(h) AS n, h AS hit))"
    starts = """aggregate(c, struct(0 AS pos, cast(array() AS array<int>) AS out),
        (a, y) -> struct(a.pos + aggregate(y, 0, (b, p) -> b + p.g + p.n) AS pos, concat(a.out, array(a.pos)) AS out), a -> a.out)"""
    chunk = f"""aggregate(y, struct(s AS pos, {NONE} AS out),
        (a, p) -> struct(a.pos + p.g + p.n AS pos, concat(a.out, array(struct(a.pos + p.g AS at, a.pos + p.g + p.n AS until, p.hit AS hit))) AS out), a -> a.out)"""
    places = _let(pairs, "x", _let(_chunks("x"), "c", f"flatten(zip_with(c, {starts}, (y, s) -> {chunk}))"))
    return F.when(F.size(found) > 0, F.expr(places)).otherwise(F.expr(NONE))


#: Texts are cut into pieces of so many code points, so that what stands around a match is found near it.
PIECE = 2048


def pieces(text: str) -> Column:
    return F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def part(cut: str, at: Column, length: Column) -> Column:
    """At most PIECE code points of a text in pieces from a place on."""
    i = F.floor(at / PIECE).cast("int")
    two = F.concat(F.coalesce(F.get(cut, i), F.lit("")), F.coalesce(F.get(cut, i + 1), F.lit("")))
    return F.substring(two, at - i * PIECE + 1, length)


def replaced(text: str, found: str) -> Column:
    """The text with <kind> for each of the spans (at, place, until, kind); overlapping ones become one, named by the first."""
    ends = """aggregate(c, struct(0 AS pos, cast(array() AS array<int>) AS out),
        (a, y) -> struct(greatest(a.pos, array_max(transform(y, s -> s.until))) AS pos, concat(a.out, array(a.pos)) AS out), a -> concat(a.out, array(a.pos)))"""
    chunk = f"""aggregate(y, struct(0 AS pos, '' AS out), (a, s) -> struct(greatest(a.pos, s.until - e[i]) AS pos,
        if(s.at - e[i] < a.pos, a.out, concat(a.out, substring(t, a.pos + 1, s.at - e[i] - a.pos), '<', s.kind, '>')) AS out), a -> a.out)"""
    own = _let(f"substring(`{text}`, e[i] + 1, e[i + 1] - e[i])", "t", chunk)
    whole = f"concat(array_join(transform(c, (y, i) -> {own}), ''), substring(`{text}`, element_at(e, -1) + 1))"
    return F.when(F.size(found) > 0, F.expr(_let(f"array_sort(`{found}`)", "x", _let(_chunks("x"), "c", _let(ends, "e", whole))))).otherwise(F.col(f"`{text}`"))


def listed(spans: Column) -> Column:
    """An array of structs (at, place, until, kind) as kind:start:end, by start and place of kind, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["at"].cast("string"), s["until"].cast("string"))), ",")


def count_if(spans: Column | str, kind: str) -> Column:
    """How many spans are of a kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
