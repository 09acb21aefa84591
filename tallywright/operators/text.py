"""Words, term counts and inverse document frequency."""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, IDF, StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.functions import tokens
from tallywright.operators.linear import filled_entries
from tallywright.operators.lookup import attach_lookup
from tallywright.sources.scratch import materialize


def with_words(df: DataFrame, text: str, output: str) -> DataFrame:
    return df.withColumn(output, tokens.tokenize(F.col(text)))


def with_filtered_words(df: DataFrame, text: str, output: str) -> DataFrame:
    """Words of the text without English stop words."""
    return df.withColumn(output, tokens.without_stop_words(tokens.tokenize(F.col(text)), lower_case=True))


def ml_words(df: DataFrame, text: str, output: str) -> DataFrame:
    """The same through the transformers of ``pyspark.ml``."""
    split = Tokenizer(inputCol=text, outputCol="_words").transform(df)
    return StopWordsRemover(inputCol="_words", outputCol=output).transform(split).drop("_words")


def hashing_tf(words: str, output: str, buckets: int = 2000) -> HashingTF:
    return HashingTF(inputCol=words, outputCol=output, numFeatures=buckets)


def idf(counts: str, output: str) -> IDF:
    return IDF(inputCol=counts, outputCol=output)


def term_frequency(df: DataFrame, key: str, words: str) -> DataFrame:
    """How often each non-empty word occurs in each document.

    The words of a document are sorted inside its own row and every run of equal
    words is counted there: nothing is shuffled, and the work is n log n in the
    length of the document.
    """
    ordered = df.select(key, F.sort_array(tokens.without_empty(F.col(words))).alias("_w"))
    size = F.size("_w")
    # No filter on the size: pushed to the scan, it would split the text twice.
    places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
    first_of_run = F.filter(places, lambda i: (i == 0) | (F.get("_w", i) != F.get("_w", i - 1)))
    starts = ordered.withColumn("_starts", first_of_run)
    runs = F.transform(
        "_starts",
        lambda start, j: F.struct(
            F.get("_w", start).alias("term"),
            (F.coalesce(F.get("_starts", j + 1), size) - start).cast("bigint").alias("tf"),
        ),
    )
    return starts.select(key, F.inline(runs))


def document_frequency(df: DataFrame, words: str) -> DataFrame:
    """Number of documents per term.

    Words are made distinct within their document, so one shuffle is enough and
    each task sends one partial count per term.
    """
    terms = df.select(F.explode(F.array_distinct(tokens.without_empty(F.col(words)))).alias("term"))
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"))


def idf_weights(df: DataFrame, words: str) -> DataFrame:
    """ln((N + 1) / (df + 1)) per term, N being the number of documents."""
    n_docs = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    weight = F.log((n_docs + 1) / (F.col("doc_freq") + 1))
    return document_frequency(df, words).withColumn("idf", weight)


def tf_idf(df: DataFrame, key: str, words: str) -> DataFrame:
    """Term count times idf for each term of each document.

    Terms are counted once and stored; the number of documents of a term is the
    number of its counts.
    """
    counts = materialize(term_frequency(df, key, words), "term_counts")
    n_docs = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    found = counts.groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"))
    weights = materialize(found.withColumn("idf", F.log((n_docs + 1) / (F.col("doc_freq") + 1))), "idf")
    joined = attach_lookup(counts, weights, "term", "doc_freq", key)
    return joined.select(key, "term", "tf", "doc_freq", "idf", (F.col("tf") * F.col("idf")).alias("tf_idf"))


def filled_buckets(df: DataFrame, key: str, counts: str) -> DataFrame:
    """(key, bucket, tf) of the buckets of a count vector that are not empty, as the vector
    stores them: no row grows to its number of buckets."""
    entries = F.filter(filled_entries(F.col(counts)), lambda e: e["value"] != 0)
    return df.select(key, F.inline(F.transform(entries, lambda e: F.struct(e["index"].alias("bucket"), e["value"].alias("tf")))))
