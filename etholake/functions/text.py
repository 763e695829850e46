"""Small string and colour functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def colorscale(hexstr: Column, factor: float) -> Column:
    """A hex colour scaled by a factor, each part cut to 0..255: '#' and lower case. With a negative factor, or a length
    other than six, the text without its '#' comes back."""
    plain = F.btrim(hexstr, F.lit("#"))
    if factor < 0:
        return plain
    part = lambda i: F.lpad(F.lower(F.hex(F.greatest(F.lit(0), F.least(F.lit(255), F.floor(F.conv(F.substring(plain, i, 2), 16, 10).cast("double") * factor))).cast("long"))), 2, "0")
    return F.when(F.length(plain) != 6, plain).otherwise(F.concat(F.lit("#"), part(1), part(3), part(5)))


def display_label(label: Column, number: Column) -> Column:
    """'label - number', or the number alone where the label is empty."""
    return F.when(F.length(label) > 0, F.format_string("%s - %s", label, number.cast("string"))).otherwise(number.cast("string"))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    return F.regexp_replace(basename(path), r"\.[^.]*$", "")


def with_extension(path: Column, extension: str) -> Column:
    return F.concat(F.regexp_replace(path, r"\.[^./]*$", ""), F.lit(extension))


def movie_ids(path: Column) -> tuple[Column, Column, Column]:
    """(sorted id, kind of sorting, original id) from a file name like syllable_sorted-id-003 (usage)_original-id-017.mp4."""
    pattern = r"sorted-id-(\d+).\((\w+)\)_original-id-(\d+)"
    number = lambda i: F.nullif(F.regexp_extract(path, pattern, i), F.lit("")).cast("int")
    return number(1), F.nullif(F.regexp_extract(path, pattern, 2), F.lit("")), number(3)
