"""Text functions: tokens, captions, metadata keys and repair of doubly encoded text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PUNCTUATION = r"[\p{Punct}\x08]+"
EDGES = r"^[\x00-\x20]+|[\x00-\x20]+$"
#: UTF-8 read as Latin-1 leaves pairs that begin with one of these.
MOJIBAKE = "Ã[\u0080-\u00bf]|Â[\u0080-\u00bf]"


def strip(c: Column) -> Column:
    """Without control characters and spaces at both ends."""
    return F.regexp_replace(c, EDGES, "")


def clean_punctuation(c: Column) -> Column:
    """Runs of ASCII punctuation become one space; those at the end vanish."""
    return F.regexp_replace(F.regexp_replace(c, PUNCTUATION + "$", ""), PUNCTUATION, " ")


def image_metadata(title: Column, alt: Column, caption: Column) -> Column:
    """What identifies a reference within a group."""
    return strip(F.concat_ws(" ", strip(title), strip(alt), strip(caption)))


def page_metadata(tokens: Column) -> Column:
    return strip(tokens)


def trim_caption(c: Column, most: int = 250) -> Column:
    """A caption over `most` characters keeps its first and its last half, each cut at a space, on two lines."""
    half = most // 2
    head = F.substring(c, 1, half)
    space = F.locate(" ", F.reverse(head))
    head = F.when(space > 0, F.substring(head, F.lit(1), F.lit(half) - space)).otherwise(head)
    tail = F.right(c, F.lit(half))
    first = F.locate(" ", tail)
    tail = F.when(first > 0, F.substring(tail, first, F.lit(half))).otherwise(F.right(c, F.lit(half + 1)))
    return F.when(F.length(c) > most, F.concat(strip(head), F.lit("\n"), strip(tail))).otherwise(c)


def fix_mojibake(c: Column) -> Column:
    """Repairs text decoded as Latin-1 instead of UTF-8, if that leaves no marker of it."""
    repaired = F.decode(F.encode(c, "ISO-8859-1"), "UTF-8")
    possible = c.rlike(MOJIBAKE) & ~c.rlike("[^\u0000-\u00ff]")
    return F.when(possible & F.is_valid_utf8(F.encode(c, "ISO-8859-1").cast("string")), F.when(~repaired.rlike(MOJIBAKE), repaired).otherwise(c)).otherwise(c)
