"""Column functions on text and on keyword arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.constants import LANGUAGE_NAMES
from tidewatch.schemas import STORED_KEYWORDS

TOKEN = r"[\p{L}\p{N}_]{2,}"


def tokens(text: Column) -> Column:
    """Lower-case words of two or more letters, digits or underscores; null text has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))


def letters(text: Column) -> Column:
    """Lower-case letters only, every other run of characters turned into one space."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+", " "))


def text_array(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]).cast("array<string>")


def count_in(words: Column, wanted: Sequence[str]) -> Column:
    """How many entries of an array are in a fixed list."""
    if not wanted:
        return F.lit(0)
    return F.size(F.filter(words, lambda w: w.isin(list(wanted))))


def language_name(code: Column) -> Column:
    pairs = [F.lit(x) for pair in LANGUAGE_NAMES.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), code)


def keywords_to_json(phrases: Column) -> Column:
    """``array<struct<keyword,score>>`` → ``[["phrase", 1.5], ...]`` with the score as a JSON number."""
    entry = lambda p: F.concat(
        F.regexp_replace(F.to_json(F.array(p["keyword"])), r"\]$", ", "), p["score"].cast("string"), F.lit("]")
    )
    return F.concat(F.lit("["), F.array_join(F.transform(phrases, entry), ", "), F.lit("]"))


def stored_keywords(json_text: Column) -> Column:
    """Stored keyword JSON → array of names; null for null or malformed JSON."""
    pairs = F.from_json(json_text.cast("string"), STORED_KEYWORDS)
    return F.transform(pairs, lambda kv: F.get(kv, F.lit(0)))


def counted(names: Column) -> Column:
    """Array → distinct entries with their number of occurrences, ``array<struct<name,n>>``. For short arrays."""
    return F.transform(
        F.array_distinct(names),
        lambda name: F.struct(name.alias("name"), F.size(F.filter(names, lambda x: x.eqNullSafe(name))).alias("n")),
    )
