"""Benchmark passages in training documents, found by winnowed fingerprints.

A fingerprint is the hash of ``k`` consecutive words; of every ``w``
consecutive fingerprints the smallest is kept.  Two texts that share
``k + w - 1`` words keep a common fingerprint there, so with
``k + w - 1`` set to the shortest benchmark window no shared window is missed.
Kept fingerprints are joined; a hit is then extended to the windows of words
around it, which are compared as words.  All of it is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import NOT_ALNUM, ascii_lower, few_rows, set_apart, word_array
from millrace.session import stable

#: words hashed together, at most
GRAM = 6


def _slid(df: DataFrame, column: str, width: int, both: Callable[[Column, Column], Column]) -> DataFrame:
    """``column`` with ``both`` folded over every ``width`` consecutive values, by doubling.

    Every step is a projection of its own, so that none is computed twice.
    """
    have = 1
    while have < width:
        step = min(have, width - have)
        left = F.greatest(F.size(column) - step, F.lit(0))
        df = df.withColumn(column, F.zip_with(F.slice(column, F.lit(1), left), F.slice(column, F.lit(step + 1), left), both))
        have += step
    return df


def with_grams(df: DataFrame, k: int) -> DataFrame:
    """``grams``: for every position of ``words`` the hash of the ``k`` words from there."""
    df = df.withColumn("grams", F.transform("words", lambda x: F.xxhash64(x)))
    return _slid(df, "grams", k, lambda a, b: F.xxhash64(a, b))


def winnowed(df: DataFrame, w: int) -> DataFrame:
    """``kept``: the distinct smallest hashes of every ``w`` consecutive ``grams``."""
    df = _slid(df.withColumn("kept", F.col("grams")), "kept", w, lambda a, b: F.least(a, b))
    return df.withColumn("kept", F.array_distinct("kept"))


def benchmark_windows(items: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """``item``, ``width``, ``phrase``: the distinct windows of each item.

    An item of fewer words than ``window`` is one window; one without words has none.
    """
    words = items.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"),
                         word_array(ascii_lower(F.col(text)), NOT_ALNUM).alias("words")).where("size(words) > 0")
    width = F.least(F.size("words"), F.lit(window))
    at = F.explode(F.sequence(F.lit(1), F.size("words") - width + 1)).alias("at")
    spread = words.select("item", "words", width.alias("width"), at)
    return spread.select("item", "width", F.array_join(F.slice("words", F.col("at"), F.col("width")), " ").alias("phrase")).distinct()


def hits(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = 10,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scan of all documents, benchmark windows found in them, and windows by item.

    The scan has key, ``__h``, ``n_words`` and ``flagged`` for every distinct
    document; the text's hash ``__h`` tells rows of one key apart.  The second
    table has key, ``__h``, ``at``, ``width``, ``phrase`` for every occurrence of
    a window, the third is :func:`benchmark_windows`.
    """
    windows = stable(benchmark_windows(items, item, item_text, window))
    phrases = windows.select("phrase", "width").distinct()
    widths = sorted(r["width"] for r in windows.select("width").distinct().collect())  # at most `window` numbers
    raw = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    raw = raw.withColumn("__h", F.xxhash64("__text"))
    words = word_array(ascii_lower(F.col("__text")), NOT_ALNUM)
    base = raw.select(key, "__h", words.alias("words"))
    n_words = F.size("words").cast("long").alias("n_words")
    if not widths:
        scan = base.select(key, "__h", n_words, F.lit(False).alias("flagged")).distinct()
        none = scan.where("false").select(key, "__h", F.lit(0).alias("at"), F.lit(0).alias("width"), F.lit("").alias("phrase"))
        return scan, none, windows
    k = min(GRAM, widths[0])
    w = widths[0] - k + 1
    prints = winnowed(with_grams(phrases.select(F.split("phrase", " ").alias("words")), k), w)
    # explode would filter empty arrays by computing each of them a second time, step within step
    prints = stable(prints.select(F.explode_outer("kept").alias("print")).where("print is not null").distinct())
    known = few_rows(prints.withColumn("known", F.lit(True)))
    marked = winnowed(with_grams(base, k), w).select(key, "__h", n_words, F.explode_outer("kept").alias("print"))
    found = marked.join(known, "print", "left")
    scan = stable(found.groupBy(key, "__h", "n_words").agg(F.max(F.coalesce("known", F.lit(False))).alias("flagged")))

    # each hit with the words around it, as far as a window that holds it can reach
    reach = widths[-1] - k
    flagged = few_rows(scan.where("flagged").select(F.col(key).alias("__k"), F.col("__h").alias("__hh")))
    same = F.col(key).eqNullSafe(F.col("__k")) & (F.col("__h") == F.col("__hh"))
    spots = with_grams(raw.join(flagged, same, "left_semi").select(key, "__h", words.alias("words")), k)

    def around(i: Column) -> Column:
        first = F.greatest(i - reach, F.lit(0))
        return F.struct(
            i.alias("spot"), F.get("grams", i).alias("print"), first.alias("first"),
            F.slice("words", first + 1, i - first + widths[-1]).alias("near"),
        )

    at = F.when(F.size("grams") > 0, F.sequence(F.lit(0), F.size("grams") - 1)).otherwise(F.array().cast("array<int>"))
    spots = spots.select(key, "__h", F.explode_outer(F.transform(at, around)).alias("s")).select(key, "__h", "s.*")
    spots = spots.join(known.drop("known"), "print", "left_semi")
    tried = None
    for width in widths:
        start = F.explode(F.sequence(F.greatest(F.col("spot") - (width - k), F.lit(0)), F.col("spot"))).alias("at")
        one = spots.select(key, "__h", "first", "near", start).where(F.col("at") - F.col("first") + width <= F.size("near"))
        phrase = F.array_join(F.slice("near", F.col("at") - F.col("first") + 1, width), " ")
        one = one.select(key, "__h", "at", F.lit(width).alias("width"), phrase.alias("phrase"))
        tried = one if tried is None else tried.unionByName(one)
    tried = tried.distinct().join(few_rows(phrases), ["phrase", "width"], "left_semi")
    return scan, stable(tried.select(key, "__h", "at", "width", "phrase")), windows


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = 10,
) -> DataFrame:
    """Per row of ``docs``: key, ``n_words``, ``n_hit``, ``n_items``, ``items``, ``contaminated``.

    A word is hit inside any occurrence of ``window`` consecutive words of an
    item, or of a whole shorter item.  ``items`` lists the item keys as
    strings, sorted.  Null texts have no words; a null item key counts as the
    empty string; rows that repeat key and text get equal results; without
    benchmark words nothing is contaminated.  Other columns are not read.
    """
    name, docs = key, docs.select(F.col(key).alias("__key"), F.col(text).alias("__body"))
    key, text = "__key", "__body"
    scan, found, windows = hits(docs, items, key, text, item, item_text, window)
    covered = found.select(key, "__h", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("width") - 1)).alias("spot"))
    covered = covered.distinct().groupBy(key, "__h").agg(F.count(F.lit(1)).alias("n_hit"))
    held = found.select(key, "__h", "phrase", "width").distinct().join(few_rows(windows), ["phrase", "width"])
    held = held.select(key, "__h", "item").distinct().groupBy(key, "__h")
    held = held.agg(F.sort_array(F.collect_list("item")).alias("items"))

    def named(df: DataFrame) -> DataFrame:
        return df.withColumnsRenamed({key: "__k", "__h": "__hh"})

    same = F.col(key).eqNullSafe(F.col("__k")) & (F.col("__h") == F.col("__hh"))
    verdicts = named(covered).join(
        held.withColumnsRenamed({key: "__k2", "__h": "__h2"}),
        F.col("__k").eqNullSafe(F.col("__k2")) & (F.col("__hh") == F.col("__h2")),
    )
    verdicts = few_rows(stable(verdicts.select("__k", "__hh", "n_hit", "items")))
    sizes = scan.select(F.col(key).alias("__k"), F.col("__h").alias("__hh"), "n_words")
    rows = docs.select(F.col(key), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("__h"))
    rows = rows.join(sizes, same).drop("__k", "__hh").join(verdicts, same, "left")
    return rows.select(
        F.col(key).alias(name),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def without_benchmark(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = 10
) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, with all their columns, whatever their names."""
    docs, (key, text), back = set_apart(docs, key, text)
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__body"))
    _, found, _ = hits(rows, items, "__key", "__body", item, item_text, window)
    bad = few_rows(found.select(F.col("__key").alias("__k"), F.col("__h").alias("__hh")).distinct())
    text_hash = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    return back(docs.join(bad, F.col(key).eqNullSafe(F.col("__k")) & (text_hash == F.col("__hh")), "left_anti"))
