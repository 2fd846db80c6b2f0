"""Words of lines of text."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import words


def tokenize(df: DataFrame, column: str = "value") -> DataFrame:
    """One row per word, in ``value``."""
    return df.select(F.explode(words(column)).alias("value"))


def word_count(df: DataFrame, column: str = "value") -> DataFrame:
    """Number of times each word occurs. Words are counted within each task before the shuffle."""
    return tokenize(df, column).groupBy("value").agg(F.count("*").alias("count"))
