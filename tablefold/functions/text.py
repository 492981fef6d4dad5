"""Scalar text expressions: labels, headers, topics, URLs. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a header token may hold besides letters and digits.
TOKEN_PUNCTUATION = ',."#!$%^&*;:{}=\\-_`~()\\n\\t'
# Word with a capital, run of capitals, or run of lower case, digits and punctuation.
TOKEN = "[A-Z][a-z]+|[A-Z]+|[\\p{Nd}a-z" + TOKEN_PUNCTUATION + "]+"
# A capital that starts a new word after a run of capitals.
WORD_EDGE = "([A-Z])([A-Z][a-z])"

# Words that mark data taken from a social platform.
SOCIAL_WORDS = ["twitter", "tweet", "facebook", "reddit"]

UNNAMED = "Unnamed:"


def split_case(label: Column) -> Column:
    """``firstName`` -> ``first name``; characters outside the token set separate words."""
    spaced = F.regexp_replace(label, WORD_EDGE, "$1 $2")
    return F.lower(F.array_join(F.regexp_extract_all(spaced, F.lit(TOKEN), F.lit(0)), " "))


def clean_header(header: Column, collapse_spaces: bool = False) -> Column:
    """Words of a column header in lower case, with ``_`` and ``-`` read as spaces."""
    cleaned = F.regexp_replace(split_case(header), "[_-]", " ")
    return F.trim(F.regexp_replace(cleaned, " +", " ")) if collapse_spaces else cleaned


def eligible_header(header: Column) -> Column:
    """Headers fit for matching by meaning: named by the file and free of digits."""
    return ~header.startswith(UNNAMED) & ~header.rlike("\\p{N}")


def social_header(header: Column) -> Column:
    return header.rlike("|".join(SOCIAL_WORDS))


def words(text: Column) -> Column:
    """Whitespace-separated words, no empty ones."""
    return F.filter(F.split(text, "\\s+"), lambda w: w != "")


def last_segment(uri: Column) -> Column:
    """Text after the last ``/``, ``#`` or ``:``."""
    return F.element_at(F.split(uri, "[/#:]"), -1)


def in_namespace(uri: Column, prefix: str) -> Column:
    return uri.startswith(prefix)


def lemma_topic(lemma: Column) -> Column:
    return F.lower(F.replace(lemma, F.lit("_"), F.lit(" ")))


def topic_key(topic: Column) -> Column:
    """Topic as a directory or partition key."""
    return F.replace(topic, F.lit(" "), F.lit("_"))


def raw_url(url: Column) -> Column:
    return F.concat(url, F.lit("?raw=true"))


def url_file_name(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def repo_key(url: Column) -> Column:
    """``struct(owner, repo)``: the last two path parts before ``blob``."""
    parts = F.split(F.get(F.split(url, "blob"), 0), "/")
    return F.struct(
        F.try_element_at(parts, F.lit(-3)).alias("owner"),
        F.try_element_at(parts, F.lit(-2)).alias("repo"),
    )


def strip_extension(file_name: Column) -> Column:
    """File name without its last four characters (``.csv``)."""
    return F.substring(file_name, F.lit(1), F.greatest(F.length(file_name) - 4, F.lit(0)))
