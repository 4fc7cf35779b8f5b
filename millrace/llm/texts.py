"""Words of whole texts, as columns and as Arrow arrays, and size-checked broadcasts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: what stands between words: white space, or all ASCII but digits and letters
SPACE = r"[\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: rows of a table that is broadcast; beyond it the same join shuffles
BROADCAST_ROWS = 200_000


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z only; ``lower`` does that by itself where all is ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def set_apart(docs: DataFrame, *names: str) -> tuple[DataFrame, list[str], Callable[[DataFrame], DataFrame]]:
    """``docs`` without columns that begin with two underscores, the new names of ``names``, and a function that restores them.

    Operators name their own columns with two underscores; columns of the
    caller that do so too get another name meanwhile.
    """
    taken, new = set(docs.columns), {}
    for c in docs.columns:
        if c.startswith("__"):
            name = f"own_{c.strip('_') or 'column'}"
            while name in taken:
                name += "_"
            taken.add(name)
            new[c] = name
    back = {v: k for k, v in new.items()}
    return docs.withColumnsRenamed(new), [new.get(n, n) for n in names], lambda df: df.withColumnsRenamed(back)


def word_array(text: Column, between: str) -> Column:
    """The words of a text in order; null and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), between), lambda w: w != "")


def few_rows(df: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, which is cheap to count, marked for broadcast if it has at most ``bound`` rows."""
    return F.broadcast(df) if df.limit(bound + 1).count() <= bound else df


def byte_table(between: str) -> bytes:
    """For ``bytes.translate``: A-Z lower-cased and every separator a space."""
    import re

    apart = re.compile(between.encode("ascii"))
    return bytes(
        0x20 if apart.fullmatch(bytes([b + 32 * (0x41 <= b <= 0x5A)])) else b + 32 * (0x41 <= b <= 0x5A)
        for b in range(256)
    )


def translated(texts: pa.Array, table: bytes) -> pa.Array:
    """Every text with its bytes replaced; the table must leave bytes from 0x80 on alone."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    data = pa.py_buffer((data.to_pybytes() if data is not None else b"").translate(table))
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, data], offset=texts.offset)


def split_words(texts: pa.Array, table: bytes) -> tuple[np.ndarray, pa.Array]:
    """Offsets (one more than texts) and all words of the texts, one after the other."""
    lists = pc.ascii_split_whitespace(translated(texts, table))
    words, at = lists.flatten(), lists.offsets.to_numpy()
    at = at - at[0] if len(at) else np.zeros(1, np.int64)
    real = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    before = np.concatenate([[0], np.cumsum(real)])
    return before[at], words.filter(pa.array(real))


def byte_slices(batches: Iterator[pa.RecordBatch], column: str | int, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text, at least one row each."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(size.tolist()):
            if held and held + n > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)
