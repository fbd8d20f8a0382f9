"""Column functions of the reference's string semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The Unicode white space that is stripped.
WHITE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Column | str) -> Column:
    """Without Unicode white space at both ends."""
    return F.btrim(col(x), F.lit(WHITE))


def lstrip(x: Column | str) -> Column:
    return F.ltrim(col(x), F.lit(WHITE))


def rstrip(x: Column | str) -> Column:
    return F.rtrim(col(x), F.lit(WHITE))


def any_of(x: Column, patterns: list[str]) -> Column:
    """Whether one of the patterns is found (anchors are theirs)."""
    out = F.lit(False)
    for p in patterns:
        out = out | x.rlike(p)
    return out


def truncate(x: Column, most: int = 60, suffix: str = "...") -> Column:
    return F.when(F.length(x) > most, F.concat(F.substring(x, 1, most - len(suffix)), F.lit(suffix))).otherwise(x)


def squeeze(x: Column) -> Column:
    """LF line ends, runs of blanks and tabs as one space, at most one empty line in a row, stripped."""
    x = F.regexp_replace(F.regexp_replace(x, "\r\n?", "\n"), r"[ \t]+", " ")
    return strip(F.regexp_replace(x, r"\n{3,}", "\n\n"))


def without_mark(x: Column) -> Column:
    """Without one trailing # or section sign."""
    return rstrip(F.regexp_replace(strip(x), "[#§]$", ""))


def basename(x: Column) -> Column:
    return F.element_at(F.split(x, "/"), -1)


def after_output(x: Column) -> Column:
    """What follows the first /output/; null if nothing does."""
    at = F.instr(x, "/output/")
    return F.when(at > 0, F.substr(x, at + F.lit(8)))


_WORD = r"[\p{L}\p{N}_]"


def normalised(x: Column) -> Column:
    """Numbers of up to four digits and Roman numerals, as whole words, by their kind."""
    x = F.regexp_replace(x, rf"(?<!{_WORD})[0-9]{{1,4}}(?!{_WORD})", "{NUM}")
    return F.regexp_replace(x, rf"(?<!{_WORD})[ivxlcdmIVXLCDM]+(?!{_WORD})", "{ROMAN}")


def count_chars(x: Column, chars: str) -> Column:
    return F.length(x) - F.length(F.translate(x, chars, ""))
