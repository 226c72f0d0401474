"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: texts that mean NULL
NULL_TEXTS = ("None", "NaN", "nan", "<NA>", "")
# fixed values: what separates the first credited artist from the others (case-sensitive)
CREDIT_DELIMITERS = (",", "feat.", "[", "(", " & ")
MARK = "|"


def null_if_placeholder(col: Column) -> Column:
    return F.when(~col.isin(*NULL_TEXTS), col)


def mark_credits(name: Column) -> Column:
    """Each delimiter replaced by one mark."""
    for delimiter in CREDIT_DELIMITERS:
        name = F.replace(name, F.lit(delimiter), F.lit(MARK))
    return name


def first_credit(name: Column) -> Column:
    return F.trim(F.substring_index(mark_credits(name), MARK, 1))


def title_words(col: Column) -> Column:
    """Upper-case the first character after any that is no letter or digit ('bar-baz' gives
    'Bar-Baz', '2nd' stays)."""
    parts = F.regexp_extract_all(F.lower(col), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    return F.array_join(F.transform(parts, F.initcap), "")


def without_word(col: Column, word: str) -> Column:
    """Values that contain the word in any case: lower-cased, first occurrence out, title case."""
    low = F.lower(col)
    cut = F.trim(F.regexp_replace(low, f"(?s)^(.*?){word}", "$1"))
    return F.when(low.contains(word), title_words(cut)).otherwise(col)
