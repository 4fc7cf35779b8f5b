"""URL rules and block lists looked up in a cascade of Bloom filters.

The first filter holds the listed keys.  Keys of the universe that are not
listed but pass it go into the second, listed keys that pass the second go
into the third, and so on until a level lets nothing wrong through.  A key of
the universe is then listed exactly when the first level that rejects it is an
odd one.  The bits travel inside the query as a constant, so no page is joined
with or shuffled to anything.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import set_apart
from millrace.session import fetch_small, stable

#: most bits of one level, 64 of them in a number: 8 MB; about six million listed keys at the default bits a key
MOST_BITS = 1 << 26


@dataclass(frozen=True)
class Level:
    """One Bloom filter: its bits as 64-bit numbers, and how many hashes set them."""

    words: tuple[int, ...]
    hashes: int
    number: int

    def holds(self, key: Column) -> Column:
        """Whether all bits of ``key`` are set; the constant is folded once, not built per row."""
        table = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")
        out = F.lit(True)
        for bit in _bits(key, self.hashes, len(self.words) * 64, self.number):
            at = F.shiftright(bit, 6).cast("int")
            out = out & (F.getbit(F.get(table, at), F.pmod(bit, F.lit(64)).cast("int")) == 1)
        return out


def _bits(key: Column, hashes: int, size: int, number: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(f"{number}.{i}"), key), F.lit(size).cast("long")) for i in range(hashes)]


def _level(keys: DataFrame, n: int, number: int, bits_per_key: int) -> Level:
    size = 64 * max(1, math.ceil(n * bits_per_key / 64))
    if size > MOST_BITS:
        raise ValueError(f"a level of {size} bits is more than a constant should hold ({MOST_BITS}); split the list")
    hashes = max(1, round(bits_per_key * math.log(2)))
    spread = keys.select(F.explode(F.array(*_bits(F.col("key"), hashes, size, number))).alias("bit"))
    spread = spread.groupBy(F.shiftright("bit", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(bit, 64) as int))")).alias("word"))
    words = [0] * (size // 64)
    for r in fetch_small(spread, size // 64, "words of a Bloom filter"):
        words[r["at"]] = r["word"]
    return Level(tuple(words), hashes, number)


def cascade(listed: DataFrame, universe: DataFrame, bits_per_key: int = 8, most_levels: int = 64) -> list[Level]:
    """Levels that tell the ``key`` values of ``listed`` from all others in ``universe``.

    Null keys are no keys.  Only keys of the universe are told apart exactly;
    listed keys outside it cost bits and are left out.  An empty list gives no level.
    """
    universe = universe.where("key is not null").distinct()
    marked = stable(
        universe.join(listed.where("key is not null").distinct().withColumn("in_list", F.lit(True)), "key", "left").select(
            "key", F.coalesce("in_list", F.lit(False)).alias("in_list")
        )
    )
    inside, outside = marked.where("in_list"), marked.where("not in_list")
    levels: list[Level] = []
    mine, other = inside, outside
    while n := mine.count():
        if len(levels) >= most_levels:
            raise ValueError(f"the cascade does not end within {most_levels} levels")
        levels.append(_level(mine, n, len(levels), bits_per_key))
        passed = other.where(levels[-1].holds(F.col("key")))
        mine, other = passed, mine
    return levels


def in_cascade(levels: Sequence[Level], key: Column) -> Column:
    """Exact membership for keys of the universe; false for null."""
    out = F.lit(False)
    for i, level in reversed(list(enumerate(levels))):
        out = F.when(level.holds(key), out if i + 1 < len(levels) else F.lit(i % 2 == 0)).otherwise(F.lit(i % 2 == 1))
    return F.coalesce(out, F.lit(False)) & key.isNotNull()


def with_url_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host`` (A-Z lower-cased) and ``path``; both empty without a ``://``."""
    u = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.locate("://", u) > 0, F.expr(f"substring(coalesce(`{url}`, ''), locate('://', coalesce(`{url}`, '')) + 3)")).otherwise("")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), upper, upper.lower())
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return pages.withColumns({"host": host, "path": path})


def _suffixes(host: Column) -> Column:
    """The host and everything behind each of its dots."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    blocked_hosts: Sequence[str] | DataFrame = (),
    url: str = "url",
    bits_per_key: int = 8,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` are (action, ``host/path``) with action ``block`` or ``allow``; a
    rule fits its host and all below it where the path starts with the
    rule's.  Of several the longest counts, among equally long ones that of the
    longest host; a rule given as both is a block.  Without a rule a page is
    blocked if its host, or a host above it, is in ``blocked_hosts`` (hosts, or
    a table with a column ``host``), and allowed otherwise.

    Every host suffix of a page with every prefix of its path that is as long
    as a rule's path is a key; the distinct keys of all pages are the universe
    of the rules' cascades, the distinct suffixes that of the host list's.
    Null urls have empty host and path and fit no rule.  Columns named like a
    result are replaced, others pass through whatever their names; an empty
    table stays empty.
    """
    spark = pages.sparkSession
    pages, (url,), back = set_apart(pages, url)
    at = with_url_parts(pages.drop("host", "path", "rule", "verdict"), url)
    actions: dict[str, str] = {}
    for action, rule in rules:
        if action not in ("block", "allow") or "/" not in rule:
            raise ValueError(f"not a rule: {action} {rule}")
        actions[rule] = "block" if "block" in (action, actions.get(rule)) else "allow"
    lengths = sorted({len(r) - r.index("/") for r in actions}, reverse=True)

    # a key holds a slash between host and path only through the path, which begins with one
    starts = [F.when(F.char_length("path") >= n, F.substring("path", 1, n)) for n in lengths]
    starts = F.filter(F.array(*starts), lambda p: p.startswith("/")) if lengths else F.array().cast("array<string>")
    keys = F.flatten(F.transform(F.col("__up"), lambda h: F.transform(F.col("__starts"), lambda p: F.concat(h, p))))
    at = at.withColumn("__up", _suffixes(F.col("host"))).withColumn("__starts", starts)
    universe = stable(at.select("__up", keys.alias("__keys")).select("__up", "__keys").distinct())
    pairs = universe.select(F.explode("__keys").alias("key")).distinct()
    hosts = universe.select(F.explode("__up").alias("key")).distinct()

    def listed(values: Sequence[str]) -> DataFrame:
        return spark.createDataFrame([(v,) for v in values], "key string")

    block = cascade(listed([r for r, a in actions.items() if a == "block"]), pairs, bits_per_key)
    allow = cascade(listed([r for r, a in actions.items() if a == "allow"]), pairs, bits_per_key)
    spam_hosts = blocked_hosts if isinstance(blocked_hosts, DataFrame) else listed(blocked_hosts).toDF("host")
    lower = F.translate("host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    host_list = cascade(spam_hosts.select(lower.alias("key")), hosts, bits_per_key)

    def judged(h: Column, p: Column) -> Column:
        key = F.concat(h, p)
        action = F.when(in_cascade(block, key), "block").when(in_cascade(allow, key), "allow")
        return F.struct(F.char_length(key).alias("n"), F.char_length(h).alias("h"), key.alias("rule"), action.alias("verdict"))

    fits = F.flatten(F.transform("__up", lambda h: F.transform("__starts", lambda p: judged(h, p))))
    best = F.array_max(F.filter(fits, lambda f: f["verdict"].isNotNull()))
    out = at.withColumn("__best", best)
    spam = F.exists("__up", lambda h: in_cascade(host_list, h))
    out = out.withColumns(
        {
            "rule": F.col("__best.rule"),
            "verdict": F.coalesce(F.col("__best.verdict"), F.when(spam, "block").otherwise("allow")),
        }
    )
    return back(out.drop("__up", "__starts", "__best"))
