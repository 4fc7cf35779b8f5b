"""Toxicity by compression distance: two zstandard dictionaries, one of toxic text.

A dictionary is trained on windows of ordinary text and another on windows of
toxic text.  A third has the words that stand out in toxic text before the
ordinary one.  Every window of a document is compressed with each; what the
toxic dictionary and the words save beyond as much ordinary text are the
window's distances.  Shares of windows above calibrated
thresholds and the mean saving go through a logistic curve fitted on labelled
documents that the dictionaries did not see.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.texts import SPACE, byte_slices, byte_table, set_apart
from millrace.session import fetch_small

#: words in a window, and from one window to the next
WINDOW, STEP = 8, 4
#: bytes of a trained dictionary
DICTIONARY_BYTES = 16_384
#: saved bytes from which a window counts, one share for each
THRESHOLDS = (1, 2, 3, 4, 6)
#: how far a word's count in toxic documents must exceed chance, in standard deviations, and its least count
STANDS_OUT, LEAST = 5.0, 3
#: labelled documents of each class that the model is fitted on, at most
SAMPLE = 3_000
_TABLE = byte_table(SPACE)


def windows(text: bytes) -> list[bytes]:
    """Overlapping runs of words, with a space before and behind."""
    words = text.translate(_TABLE).split()
    if not words:
        return []
    return [b" " + b" ".join(words[i : i + WINDOW]) + b" " for i in range(0, max(1, len(words) - WINDOW + STEP), STEP)]


@dataclass(frozen=True)
class Dictionaries:
    """Raw dictionary content; ``words`` and ``usual`` end in the same ordinary text, so that it is found at the same distance."""

    ordinary: bytes
    toxic: bytes
    usual: bytes
    words: bytes

    def savings(self):
        """A function from a text to the bytes that the toxic dictionary and the words save in each of its windows."""
        contents = (self.ordinary, self.toxic, self.usual, self.words)
        reach = max(16, max(map(len, contents)).bit_length())  # no part out of reach
        packs = [_compressor(c, reach).compress for c in contents]

        def run(text: bytes) -> np.ndarray:
            sizes = np.array([[len(pack(w)) for pack in packs] for w in windows(text)], np.int64).reshape(-1, len(packs))
            return sizes[:, ::2] - sizes[:, 1::2]

        return run


def _compressor(content: bytes, reach: int) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters(
        window_log=reach, chain_log=reach, hash_log=reach - 1, search_log=5, min_match=4, target_length=16,
        strategy=zstandard.STRATEGY_GREEDY, write_content_size=0, write_checksum=0, write_dict_id=0,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=params)


def _trained(samples: list[bytes], size: int) -> bytes:
    """Content of a trained zstandard dictionary, or the samples themselves where there are too few to train on."""
    try:
        made = zstandard.train_dictionary(size, samples, level=3).as_bytes()
        return made[-size * 9 // 10 :]  # the tables in front of the content go
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _unlike(texts: Sequence[bytes], width: int = 5) -> list[bytes]:
    """One text of each group of copies: those whose smallest shingle hash is the same."""
    kept: dict[int, bytes] = {}
    for t in texts:
        words = t.translate(_TABLE).split()
        shingles = zip(*(words[i:] for i in range(width))) if len(words) > width else [words]
        kept.setdefault(min(xxhash.xxh64_intdigest(b" ".join(s)) for s in shingles), t)
    return list(kept.values())


def train(ordinary: Sequence[bytes], toxic: Sequence[bytes]) -> Dictionaries:
    """Dictionaries from whole texts of either class."""
    common: Counter[bytes] = Counter()
    marked: Counter[bytes] = Counter()
    for texts, counts in ((ordinary, common), (toxic, marked)):
        for t in texts:
            counts.update(set(t.translate(_TABLE).split()))
    n, m = len(ordinary), len(toxic)
    surplus = {}
    for word, k in marked.items():
        share = (k + common[word]) / (n + m)
        spread = math.sqrt(m * share * (1 - share) * n / (n + m))
        if k >= LEAST and k - m * share > STANDS_OUT * spread:
            surplus[word] = (k - m * share) / max(spread, 1e-9)
    # what stands out most lies next to the shared text, at the shortest distance
    chosen = sorted(surplus, key=lambda w: (-surplus[w], w))
    words = b" " + b" ".join(reversed(chosen)) + b" "
    usual = sorted((w for w, k in common.items() if k >= 2 and w not in surplus), key=lambda w: (common[w], w))
    filler = (b" " + b" ".join(usual))[: len(words)]
    shared, marks = (_trained([w for t in texts for w in windows(t)], DICTIONARY_BYTES) for texts in (ordinary, toxic))
    return Dictionaries(shared, marks, filler + shared, words + shared)


def features(saved: np.ndarray) -> np.ndarray:
    """Of either distance: mean saving, shares of windows above each threshold, their number, and the largest saving."""
    out = []
    for x in saved.T:
        if not len(x):
            out += [0.0] * (len(THRESHOLDS) + 3)
            continue
        out += [x.mean(), *[(x >= t).mean() for t in THRESHOLDS], math.log1p((x >= THRESHOLDS[2]).sum()), min(x.max(), 12)]
    return np.array(out, float)


@dataclass(frozen=True)
class Model:
    """Dictionaries and a logistic curve; a model without dictionaries gives one score to all."""

    dictionaries: Dictionaries | None
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    offset: float

    def scorer(self):
        if self.dictionaries is None:
            return lambda text: 1 / (1 + math.exp(-self.offset))
        savings = self.dictionaries.savings()

        def run(text: bytes) -> float:
            x = (features(savings(text)) - self.mean) / self.scale
            return 1 / (1 + math.exp(-float(np.clip(x @ self.weights + self.offset, -30, 30))))

        return run


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights and, last, the offset, by Newton steps."""
    a = np.hstack([x, np.ones((len(x), 1))])
    b = np.zeros(a.shape[1])
    hold = np.eye(a.shape[1]) * ridge
    hold[-1, -1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + hold, a.T @ (weight * (y - p)) - hold @ b)
        b = b + step
        if np.abs(step).max() < 1e-8:
            break
    return b


def _model(ordinary: list[bytes], toxic: list[bytes], n_ordinary: int, n_toxic: int) -> Model:
    """Fit on a sample of each class that stands for ``n_ordinary`` and ``n_toxic`` documents."""
    none = np.zeros(0)
    if not ordinary or not toxic:
        share = (n_toxic + 0.5) / (n_ordinary + n_toxic + 1) if n_ordinary + n_toxic else 0.01
        return Model(None, none, none, none, math.log(share / (1 - share)))
    rows, labels = [], []
    for half in (0, 1):  # each half is judged by dictionaries of the other
        savings = train(ordinary[1 - half :: 2] or ordinary, toxic[1 - half :: 2] or toxic).savings()
        for y, texts in ((0, ordinary[half::2]), (1, toxic[half::2])):
            rows += [features(savings(t)) for t in texts]
            labels += [y] * len(texts)
    x, y = np.array(rows), np.array(labels, float)
    mean, scale = x.mean(0), x.std(0) + 1e-9
    weight = np.where(y == 1, n_toxic / len(toxic), n_ordinary / len(ordinary))
    b = _logistic((x - mean) / scale, y, weight)
    return Model(train(ordinary, toxic), mean, scale, b[:-1], float(b[-1]))


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", learn: Column | None = None, sample: int = SAMPLE
) -> Model:
    """A model from at most ``sample`` labelled documents of each class, picked by a hash of their keys.

    ``learn`` restricts the labels that may be used.  A key labelled more than
    once is toxic if any row says so; null keys and labels are ignored.  Without
    both classes the model gives every text the share of toxic labels.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    known = known.where(learn) if learn is not None else known
    known = known.groupBy(F.col(key).alias("__k")).agg((F.max(label) > 0).alias("__y"))
    sizes = {r["__y"]: r["n"] for r in known.groupBy("__y").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = [known.where(F.col("__y") == y).orderBy(F.xxhash64("__k"), "__k").limit(sample) for y in (False, True)]
    picked = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * sample rows
    rows = docs.select(F.col(key).alias("__k"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__t"))
    rows = rows.join(picked, "__k").groupBy("__k", "__y").agg(F.max("__t").alias("__t"))
    got = sorted(fetch_small(rows, 2 * sample, "labelled sample"), key=lambda r: str(r["__k"]))
    # words of one text copied many times must not stand out
    ordinary, toxic = (_unlike([r["__t"].encode() for r in got if r["__y"] == y]) for y in (False, True))
    return _model(ordinary, toxic, sizes.get(False, 0), sizes.get(True, 0))


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with every whole text's score between 0 and 1; null counts as empty, no row is dropped."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries and a few numbers
    rows = docs.drop(name)
    at = rows.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = held.value.scorer()
        for batch in byte_slices(batches, at):
            texts = batch.column(at).cast(pa.large_binary())
            scores = [judge(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, name])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, T.DoubleType())]))


def without_toxic(docs: DataFrame, model: Model, text: str = "text", cut: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``cut``, with all their columns, whatever their names."""
    docs, (text,), back = set_apart(docs, text)
    return back(score(docs, model, text, "__score").where(F.col("__score") < cut).drop("__score"))
