"""Column expressions on text that the operators share. A null text counts as empty everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
#: what stands between the letters and digits of decontamination (all else in ASCII)
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_of(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z only. ``lower`` does that for pure ASCII and is much faster; other letters must stay."""
    text = text_of(text)
    return F.when(F.char_length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def split_words(text: Column, between: str = BLANK) -> Column:
    return F.array_remove(F.split(text_of(text), between), "")


def runs(words: Column, width: int, make) -> Column:
    """``make`` of each ``width`` consecutive words; an empty array if there are fewer."""
    made = F.transform(words, lambda w, i: make([w, *(F.get(words, i + k) for k in range(1, width))]))
    return F.slice(made, 1, F.greatest(F.size(words) - F.lit(width - 1), F.lit(0)))


def columns_apart(df, *names: str) -> list[str]:
    """Names for working columns that clash with none of the frame's own, whatever their case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
