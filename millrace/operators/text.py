"""Tokens, corpora and term statistics.  Every lexicon is a DataFrame argument."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators.relational import share_of_total

WORD = r"[\p{L}\p{N}']+"
SENTENCE_END = r"(?<=[.!?])\s+"

#: rows of a word list that every task may hold
SMALL_LEXICON = 200_000


def escape_newlines(c: str) -> Column:
    """Text with backslash, CR and LF written as two-character escapes."""
    out = F.replace(F.col(c), F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(out, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def unescape_newlines(c: str) -> Column:
    # a private-use character holds the place of an escaped backslash meanwhile
    hold = ""
    out = F.replace(F.col(c), F.lit("\\\\"), F.lit(hold))
    out = F.replace(F.replace(out, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    return F.replace(out, F.lit(hold), F.lit("\\"))


def words(c: str | Column) -> Column:
    """Lower-cased words as an array."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))


def _grams(w: Column, n: int) -> Column:
    starts = F.sequence(F.lit(1), F.size(w) - (n - 1))
    grams = F.transform(starts, lambda i: F.array_join(F.slice(w, i, n), " "))
    return F.when(F.size(w) >= n, grams).otherwise(F.array().cast("array<string>"))


def split_units(c: str | Column, unit: str, pattern: str | None = None, n: int = 2) -> Column:
    """Array of tokens.

    ``unit`` is one of words, characters, ngrams, sentences, lines, paragraphs
    and regex (split by ``pattern``).
    """
    c = F.col(c) if isinstance(c, str) else c
    if unit == "words":
        return words(c)
    if unit == "characters":
        return F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}]"), F.lit(0))
    if unit == "ngrams":
        # the outer one-element transform binds the word list once per text
        return F.transform(F.array(words(c)), lambda w: _grams(w, n))[0]
    by = {"sentences": SENTENCE_END, "lines": "\n", "paragraphs": r"\n\s*\n", "regex": pattern}[unit]
    return F.split(c, by, -1)


def tokenize(df: DataFrame, text: str, unit: str = "words", pattern: str | None = None, n: int = 2, name: str = "word", position: str | None = None) -> DataFrame:
    """One token per row, the other columns kept; empty tokens are dropped."""
    keep = [c for c in df.columns if c != text]
    units = split_units(text, unit, pattern, n)
    if position:
        out = df.select(*keep, F.posexplode(units).alias(position, name))
    else:
        out = df.select(*keep, F.explode(units).alias(name))
    return out.where(F.col(name) != "")


def lines(df: DataFrame, text: str, name: str = "line", position: str = "line_no") -> DataFrame:
    """One line per row, numbered from 1 in text order (empty lines included)."""
    keep = [c for c in df.columns if c != text]
    out = df.select(*keep, F.posexplode(F.split(F.col(text), "\n", -1)).alias("__i", name))
    return out.withColumn(position, (F.col("__i") + 1).cast("int")).drop("__i")


def remove_stop_words(tokens: DataFrame, stop: DataFrame, on: Sequence[str] = ("word",)) -> DataFrame:
    """Anti join; a stop list under the broadcast threshold costs no shuffle."""
    return tokens.join(stop, list(on), "left_anti")


def stop_words(spark, languages: dict[str, str], extra: Sequence[str] = ()) -> DataFrame:
    """Stop lists by language code, ``{"en": "english", ..}``, plus extra words for all of them."""
    from pyspark.ml.feature import StopWordsRemover

    rows = sorted(
        {(code, w.lower()) for code, lang in languages.items() for w in [*StopWordsRemover.loadDefaultStopWords(lang), *extra]}
    )
    return spark.createDataFrame(rows, "lang string, word string")


def clean(c: str | Column, stop: Sequence[str] = ()) -> Column:
    """URLs, case, non-ASCII characters, stop words, punctuation, digits, extra space - in that order.

    URLs go first (later steps would break their pattern) and stop words go
    before punctuation (some of them contain an apostrophe).
    """
    out = S.keep_ascii(F.lower(S.remove_urls(c)))
    if stop:
        listed = "|".join(re.escape(w) for w in sorted(stop))
        out = F.regexp_replace(out, rf"\b({listed})\b", " ")
    out = S.remove_digits(S.remove_punctuation(out))
    return F.trim(F.regexp_replace(out, r"[ \t\r\n\f]+", " "))


def is_retweet(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.rlike(r"^(RT|MT)\b")


def term_counts(tokens: DataFrame, doc: str, term: str = "word", min_length: int = 3) -> DataFrame:
    """Document-term matrix in long form ``(doc, term, n)``."""
    kept = tokens.where(F.length(term) >= min_length)
    return kept.groupBy(doc, F.col(term).alias("term")).agg(F.count(F.lit(1)).alias("n"))


def term_totals(dtm: DataFrame) -> DataFrame:
    return dtm.groupBy("term").agg(F.sum("n").alias("n"))


def associations(dtm: DataFrame, doc: str, term: str, n_docs: int, min_corr: float) -> DataFrame:
    """Terms whose counts correlate with ``term`` over all documents, absent ones as zero.

    Cross products are taken only on documents that hold ``term``, so the work
    is linear in the matrix.
    """
    n = F.lit(float(n_docs))
    mine = dtm.where(F.col("term") == term).select(doc, F.col("n").alias("__t"))
    base = mine.agg(F.sum("__t"), F.sum(F.col("__t") * F.col("__t"))).first()
    if base[0] is None:
        raise ValueError(f"{term!r} does not occur")
    st, stt = float(base[0]), float(base[1])
    own = dtm.groupBy("term").agg(F.sum("n").alias("s"), F.sum(F.col("n") * F.col("n")).alias("ss"))
    cross = dtm.join(mine, doc).groupBy("term").agg(F.sum(F.col("n") * F.col("__t")).alias("sx"))
    top = n * F.col("sx") - F.col("s") * st
    bottom = F.sqrt((n * F.col("ss") - F.col("s") * F.col("s")) * F.lit(n_docs * stt - st * st))
    return (
        cross.join(own, "term")
        .where(F.col("term") != term)
        .select("term", F.try_divide(top, bottom).alias("corr"))
        .where(F.col("corr") >= min_corr)
    )


def shares(tokens: DataFrame, corpus: str, term: str = "word") -> DataFrame:
    """Share of each term among the words of its corpus."""
    counts = tokens.groupBy(corpus, term).agg(F.count(F.lit(1)).alias("n"))
    return share_of_total(counts, [corpus], "n").drop("n")


def lexicon_counts(tokens: DataFrame, lexicon: DataFrame, keys: Sequence[str], classes: Sequence[str]) -> DataFrame:
    """Words per key and sentiment class, one column per class, absent ones 0.

    A word list of at most ``SMALL_LEXICON`` rows goes to the tokens, and only
    the hits are counted; beyond that words are counted before they meet it.
    """
    lexicon = lexicon.select("word", "sentiment")
    if lexicon.limit(SMALL_LEXICON + 1).count() <= SMALL_LEXICON:
        hits = tokens.select(*keys, "word").join(F.broadcast(lexicon), "word").withColumn("__n", F.lit(1))
    else:
        hits = tokens.groupBy(*keys, "word").agg(F.count(F.lit(1)).alias("__n")).join(lexicon, "word")
    hits = hits.where(F.col("sentiment").isin(list(classes)))
    one = [F.coalesce(F.sum(F.when(F.col("sentiment") == c, F.col("__n"))), F.lit(0)).cast("bigint").alias(c) for c in classes]
    return hits.groupBy(*keys).agg(*one)


def block_sentiment(tokens: DataFrame, lexicon: DataFrame, keys: Sequence[str], line: str, size: int = 80) -> DataFrame:
    """Positive minus negative words per block of ``size`` lines."""
    blocked = tokens.withColumn("block", F.floor(F.col(line) / size))
    out = lexicon_counts(blocked, lexicon, [*keys, "block"], ["negative", "positive"])
    return out.withColumn("sentiment", F.col("positive") - F.col("negative"))
