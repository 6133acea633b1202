"""Column functions over text: trimming, line cleaning, entities, layouts."""

from __future__ import annotations

from dataclasses import dataclass
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space when a line is stripped.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def strip_text(col: Column) -> Column:
    """Trim all Unicode white space from both ends (``trim`` alone takes blanks)."""
    return F.trim(col, F.lit(WHITESPACE))


def clean_lines(lines: Column) -> Column:
    """Per array entry: drop newlines, trim; then drop the entries left empty."""
    stripped = F.transform(
        lines, lambda x: strip_text(F.replace(x, F.lit("\n"), F.lit("")))
    )
    return F.filter(stripped, lambda x: x != "")


def join_paragraphs(paragraphs: Column) -> Column:
    """Each paragraph followed by a newline, the last one included.

    No paragraphs, or no array at all, gives ``''``.
    """
    joined = F.array_join(
        F.transform(paragraphs, lambda x: F.concat(x, F.lit("\n"))), ""
    )
    return F.coalesce(joined, F.lit(""))


@dataclass(frozen=True)
class Layout:
    """Which array lengths are understood, and where each field then sits.

    Positions are 1-based; negative ones count from the end.
    """

    sizes: tuple[int, ...]
    positions: tuple[tuple[str, int], ...]


def map_by_layout(lines: Column, layout: Layout) -> Column:
    """Struct of fields picked by position; an unknown length gives ``''``."""
    known = F.size(lines).isin(*layout.sizes)
    return F.struct(
        *(
            F.when(known, F.try_element_at(lines, F.lit(position)))
            .otherwise(F.lit(""))
            .alias(name)
            for name, position in layout.positions
        )
    )


def nth_or_empty(values: Column, index: int) -> Column:
    """Array entry ``index`` (from 0), or ``''`` when there is none."""
    return F.coalesce(F.get(values, F.lit(index)), F.lit(""))


# Reference at the start of a piece that followed an ampersand. The four basic
# names and numbers may lack the semicolon, all other names need it.
_REFERENCE = (
    r"^(#[0-9]{1,7};?|#[xX][0-9a-fA-F]{1,6};?|(?:amp|lt|gt|quot);?"
    r"|[A-Za-z][A-Za-z0-9]*;)"
)


def decode_entities(col: Column) -> Column:
    """Replace character references without leaving the JVM.

    Values without an ampersand, which are nearly all, skip the work.
    """
    names = F.str_to_map(
        F.lit("\x1e".join(f"{n}\x1f{chr(cp)}" for n, cp in name2codepoint.items())
              + "\x1eapos\x1f'"),
        F.lit("\x1e"),
        F.lit("\x1f"),
    )

    def split_piece(part: Column) -> Column:
        found = F.regexp_extract(part, _REFERENCE, 1)
        return F.struct(
            part.alias("part"),
            F.rtrim(found, F.lit(";")).alias("name"),
            F.substring(part, F.length(found) + 1, F.length(part)).alias("rest"),
        )

    def decode_piece(piece: Column) -> Column:
        name = piece["name"]
        number = F.when(
            F.lower(F.substring(name, 2, 1)) == "x",
            F.conv(F.substring(name, 3, 10), 16, 10),
        ).otherwise(F.substring(name, 2, 10)).try_cast("bigint")
        # A number that is no character's code point is left as it stands.
        from_number = F.when(
            number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF),
            F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"),
        )
        value = F.when(name.startswith("#"), from_number).when(
            name != "", F.element_at(names, name)
        )
        return F.coalesce(
            F.concat(value, piece["rest"]), F.concat(F.lit("&"), piece["part"])
        )

    parts = F.split(col, "&")
    rest = F.slice(parts, 2, F.size(parts))
    decoded = F.concat(
        F.get(parts, F.lit(0)),
        F.array_join(F.transform(F.transform(rest, split_piece), decode_piece), ""),
    )
    return F.when(F.contains(col, F.lit("&")), decoded).otherwise(col)
