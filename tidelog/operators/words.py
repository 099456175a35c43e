"""Splitting text into words and counting them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def word_tokens(text: Column) -> Column:
    """Lower-cased text between runs of non-word characters."""
    return F.split(F.lower(text), r"\W+")


def space_tokens(text: Column) -> Column:
    """Text between single spaces, as it stands. Inner empty tokens count, trailing ones do
    not; an empty text is one empty token."""
    kept = F.rtrim(text)
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(kept == "", F.array().cast("array<string>"))
        .otherwise(F.split(kept, " "))
    )


TOKENS = {"word": word_tokens, "space": space_tokens}


def words(df: DataFrame, text: str = "value", split: str = "word") -> DataFrame:
    """One row per token. Empty tokens next to non-word characters are dropped as rows, which
    stays in generated code where filtering the arrays would not."""
    tokens = df.select(F.explode(TOKENS[split](F.col(text))).alias("word"))
    return tokens.where("word <> ''") if split == "word" else tokens


def word_count(df: DataFrame, text: str = "value", split: str = "word") -> DataFrame:
    """Occurrences per word. Counts combine in the map tasks, so a frequent word is cheap."""
    return words(df, text, split).groupBy("word").agg(F.count("*").alias("n"))
