"""Positions of regex segments, computed inside the row.

Spark has no function that returns all matches of a regex together with their
offsets.  Both helpers here get the offsets as a running sum of lengths inside
one row, so finding spans in a text needs no window and no shuffle.

They take and return SQL fragments: nested lambdas read better as SQL, and a
fragment goes to the JVM in one call where a tree of columns takes hundreds.
"""

# The six blanks of \s, spelled out because regex engines differ on \v.
BLANK = r"[ \t\n\x0B\f\r]"

_NO_SPANS = "CAST(array() AS array<struct<start:bigint,end:bigint,text:string>>)"


def quoted(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def without_blanks_behind(text: str) -> str:
    return f"trim(TRAILING ' \\t\\n\\u000B\\u000C\\r' FROM {text})"


def _all(text: str, pattern: str) -> str:
    return f"regexp_extract_all({text}, {quoted(pattern)}, 0)"


def _sums(values: str) -> str:
    """Running sums of an array of numbers.

    Every round reaches twice as far back, so an array takes a logarithm of rounds over it; appending
    to an array instead copies it for each of its elements.
    """
    return let("values", values, "aggregate(sequence(0, length(bin(size(values) - 1)) - 1), values, (sums, k) ->"
               " transform(sums, (x, at) -> IF(at < shiftleft(1, k), x, x + get(sums, at - shiftleft(1, k)))))")


def segments(text: str, pattern: str, drop: str | None = None, base: str = "0L",
             keep: str = "piece") -> str:
    """Array of ``{start,end,text}`` for the pieces ``pattern`` cuts ``text`` into.

    The alternatives of ``pattern`` must cover every character.  ``drop`` is a
    predicate on ``piece``; dropped pieces still count for the offsets.  ``keep``
    is the front part of ``piece`` that makes the span.
    """
    body = f"struct({{start}} AS `start`, {{start}} + length({keep}) AS `end`, {keep} AS `text`)"
    if keep != "piece":
        body = let("kept", keep, "struct({start} AS `start`, {start} + length(kept) AS `end`, kept AS `text`)")
    if drop is not None:
        body = f"IF({drop}, NULL, {body})"
    start = f"{base} + get(ends, i) - length(piece)"
    found = f"transform(pieces, (piece, i) -> {body.format(start=start)})"
    if drop is not None:
        found = f"filter({found}, s -> s IS NOT NULL)"
    return let("pieces", _all(text, pattern), let("ends", _sums("transform(pieces, piece -> length(piece))"), found))


def matches(text: str, pattern: str) -> str:
    """Array of ``{start,end,text}`` for all matches of ``pattern`` in ``text``.

    The text between the matches gives the offsets.  ``pattern`` must not match
    the empty string.
    """
    pairs = (f"zip_with(split({text}, {quoted(pattern)}, -1), {_all(text, pattern)},"
             f" (gap, hit) -> struct(gap AS gap, hit AS hit))")
    # The gap behind the last match has no hit.
    return (f"aggregate({pairs}, struct(0L AS at, {_NO_SPANS} AS spans), (acc, pair) ->"
            f" IF(pair.hit IS NULL, acc, struct("
            f"acc.at + length(pair.gap) + length(pair.hit) AS at,"
            f" array_append(acc.spans, struct(acc.at + length(pair.gap) AS `start`,"
            f" acc.at + length(pair.gap) + length(pair.hit) AS `end`, pair.hit AS `text`)) AS spans)),"
            f" acc -> acc.spans)")
