"""Text expressions. All of them are JVM-side columns; there is no UDF here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fv


def strip_urls(col: Column) -> Column:
    """The plain substring tests spare most texts the regex."""
    may_match = F.contains(col, F.lit("http")) | F.contains(col, F.lit("www."))
    return F.when(may_match, F.regexp_replace(col, fv.URL_PATTERN, " ")).otherwise(col)


def strip_tags(col: Column) -> Column:
    return F.when(F.contains(col, F.lit("<")), F.regexp_replace(col, fv.TAG_PATTERN, " ")).otherwise(col)


def normalize_whitespace(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, f"{fv.SPACE_CLASS}+", " "))


def clean_text(col: Column) -> Column:
    """URLs, then tags, then whitespace.

    The order is part of the result: a URL inside a tag swallows everything up
    to the next whitespace before tags are looked at.
    """
    return normalize_whitespace(strip_tags(strip_urls(col)))


def null_to_empty(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def model_text(title: Column, text: Column) -> Column:
    """Title first, so that short-window encoders see the subject."""
    return F.trim(F.concat(title, F.lit(". "), text))


def excerpt(col: Column, chars: int = fv.EXCERPT_CHARS) -> Column:
    return F.concat(F.substring(null_to_empty(col), 1, chars), F.lit("..."))


def tokenize(col: Column) -> Column:
    """Lower-cased maximal word runs of two or more characters."""
    return F.regexp_extract_all(F.lower(null_to_empty(col)), F.lit(fv.TOKEN_PATTERN), F.lit(0))


def is_stopword(term: Column, language: str = "pt") -> Column:
    return term.isin(fv.STOPWORDS[language])


def remove_stopwords(tokens: Column, language: str = "pt") -> Column:
    return F.filter(tokens, lambda t: ~is_stopword(t, language))


def join_ranked(rank: Column, term: Column, sep: str = ", ") -> Column:
    """Aggregate: the group's terms joined in rank order.

    Meant for groups already cut to a top-n, whose size n bounds.
    """
    ranked = F.sort_array(F.collect_list(F.struct(rank.alias("rank"), term.alias("term"))))
    return F.array_join(F.transform(ranked, lambda r: r["term"]), sep)


def parse_keyword_list(col: Column) -> Column:
    """Items of a list-literal string such as ``['a', "it's"]``.

    The text is matched, never evaluated.
    """
    quoted = F.regexp_extract_all(col, F.lit(r"""'[^']*'|"[^"]*\""""), F.lit(0))
    return F.transform(quoted, lambda q: F.substring(q, F.lit(2), F.length(q) - 2))
