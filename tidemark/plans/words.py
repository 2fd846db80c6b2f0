"""Words of ``documents``."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import word_count as count_words
from tidemark.sources import FILES_PER_BATCH, read_lines, read_table, read_table_stream
from tidemark.streaming import latest_per_key, run_to_result, run_to_table, scratch_folder, word_count_per_batch as count_each_batch


def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return count_words(read_table(spark, folder, "documents"), "text")


def word_count_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The whole result in the end; each batch writes what it changed."""
    documents = read_table_stream(spark, folder, "documents", FILES_PER_BATCH)
    return run_to_result(count_words(documents, "text"), ["value"], scratch_folder(spark, "words"))


def word_count_update(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table_stream(spark, folder, "documents", FILES_PER_BATCH)
    return latest_per_key(run_to_table(count_words(documents, "text"), "update"), ["value"])


def word_count_per_batch(spark: SparkSession, folder: str) -> DataFrame:
    return count_each_batch(read_table_stream(spark, folder, "documents"), "text")


def line_word_count_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Words of the lines of text files, which the texts are written to first, as a stream of these files."""
    base = scratch_folder(spark, "lines")
    lines = read_table(spark, folder, "documents").select(F.explode(F.split("text", "\r\n|\r|\n", -1)).alias("value"))
    lines.write.text(f"{base}/files")
    counts = count_words(read_lines(spark, f"{base}/files", FILES_PER_BATCH))
    return run_to_result(counts, ["value"], f"{base}/counts")
