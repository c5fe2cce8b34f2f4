"""URL filtering by exact set membership through a cascade of Bloom filters."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Most bits of one level; a list that needs more is refused rather than broadcast.
MAX_LEVEL_BITS = 1 << 27
#: False-positive rate from the second level on; lower than a half, as that saves levels at a few bits a key.
LATER_RATE = 1 / 16


def host_of(url: Column) -> Column:
    """After the first '://' up to '/', '?', '#' or the end, A-Z lower-cased; empty without '://'."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to '?', '#' or the end; empty without '://'."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _position(key: Column, i: int, level: int, bits: int) -> Column:
    """The i-th bit of a key at a level: double hashing of two 64-bit hashes."""
    first, second = F.xxhash64(F.lit(level), key), F.xxhash64(F.lit(-1 - level), key)
    return F.pmod(F.shiftright(first, 3) + F.shiftright(second, 8) * F.lit(i), F.lit(bits))


@dataclass(frozen=True)
class Level:
    """One Bloom filter: its number, bits, hash functions, and words of 63 used bits."""

    number: int
    bits: int
    hashes: int
    words: tuple[int, ...]

    def holds(self, key: Column) -> Column:
        """All bits of the key; the words are written once in the expression, as plans and their descriptions carry them."""
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")

        def bit(at: Column) -> Column:
            word = F.element_at(words, (F.floor(at / 63) + 1).cast("int"))
            return F.expr("1L").bitwiseAND(F.call_function("shiftright", word, F.pmod(at, F.lit(63)).cast("int"))) == 1

        return F.forall(F.array(*[_position(key, i, self.number, self.bits) for i in range(self.hashes)]), bit)


def _level(keys: DataFrame, n: int, rate: float, number: int) -> Level:
    """A filter over the n keys of a one-column table with about this false-positive rate.

    The bits are set by a grouped bit_or; what comes to the driver has the size
    of the filter, which is refused above MAX_LEVEL_BITS.
    """
    bits = max(63, math.ceil(-n * math.log(rate) / math.log(2) ** 2))
    bits += -bits % 63
    if bits > MAX_LEVEL_BITS:
        raise ValueError(f"the list needs {bits} bits at one level; at most {MAX_LEVEL_BITS} are allowed")
    hashes = max(1, min(30, round(bits / max(n, 1) * math.log(2))))
    at = F.explode(F.array(*[_position(F.col("key"), i, number, bits) for i in range(hashes)])).alias("at")
    word = F.call_function("shiftleft", F.expr("1L"), F.pmod("at", F.lit(63)).cast("int"))
    rows = keys.select(at).groupBy(F.floor(F.col("at") / 63).alias("w")).agg(F.bit_or(word).alias("v")).collect()
    words = [0] * (bits // 63)
    for r in rows:
        words[r["w"]] = r["v"]
    return Level(number, bits, hashes, tuple(words))


@dataclass(frozen=True)
class Cascade:
    """Levels whose alternation answers membership exactly for every key of the universe."""

    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        """A key is listed where the first level that misses it has an even number (from 1)."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for k in range(len(self.levels), 0, -1):
            answer = F.when(self.levels[k - 1].holds(key), answer).otherwise(F.lit(k % 2 == 0))
        return answer


def build_cascade(universe: DataFrame, listed: DataFrame, name: str = "cascade", max_levels: int = 40) -> Cascade:
    """Encode `listed` (key) so that every key of `universe` (key) is answered exactly.

    Level 1 holds the listed keys; level 2 those keys of the universe that level 1
    passes though they aren't listed; level 3 the listed keys that level 2 passes;
    and so on until nothing is passed wrongly. The first rate is chosen from both
    counts so that level 2 is no larger than level 1: all levels together grow
    with the list and the logarithm of the universe, not with the universe.
    Duplicate and null keys count once and never. An empty list gives no levels.
    """
    spark = universe.sparkSession
    scratch = Scratch(spark, name)
    listed = scratch.table(listed.select("key").filter("key is not null").distinct(), "listed")
    n = listed.count()
    if n == 0:
        return Cascade(())
    size = max(universe.count(), 2 * n)
    levels: list[Level] = []
    inside, outside, count = listed, None, n
    for k in range(1, max_levels + 1):
        rate = min(0.5, n * math.sqrt(0.5) / size) if k == 1 else LATER_RATE
        levels.append(_level(inside, count, rate, k))
        passed = levels[-1].holds(F.col("key"))
        if outside is None:
            wrong = universe.select("key").filter(passed).distinct().join(listed, "key", "left_anti")
        else:
            wrong = outside.filter(passed)
        wrong = scratch.table(wrong, f"level{k}")
        count = wrong.count()
        if count == 0:
            return Cascade(tuple(levels))
        outside, inside = inside, wrong
    raise RuntimeError("the cascade did not end; its hashes repeat")


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    unlisted: str = "allow",
) -> DataFrame:
    """Judge every url: (id_col, host, path, rule, verdict).

    `rules` has host, path and verdict ('allow' or 'block'). A rule fits its host
    and all subdomains of it where the url's path starts with the rule's path; of
    those that fit the longest wins (host and path together, then the host; a rule
    listed with both verdicts blocks). Every (host suffix, path prefix) which a
    page could match is a key; the keys of all pages are the universe of two
    cascades, one of the allow list and one of the block list. A page whose keys
    are in neither list gets `unlisted`.

    Path prefixes are taken at the lengths that occur in `rules`, so a page has at
    most (labels of its host) x (different lengths) keys; nothing is joined.

    Defined cases: a null url or one without '://' has empty host and path and no
    rule; an empty path matches no rule that has a path; rows that repeat are
    judged each; an empty table or empty rules give no levels and `unlisted`.
    """
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect() if r[0] is not None)
    base = pages.select(F.col(id_col), F.col(url_col).alias("_url"))
    base = base.select(id_col, host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))
    labels = F.split("host", r"\.", -1)
    count = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), count), lambda k: F.array_join(F.slice(labels, k, count), "."))
    prefixes = F.array_compact(
        F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths] or [F.lit(None).cast("string")])
    )
    pairs = F.flatten(
        F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.struct((F.length(s) + F.length(p)).alias("n"), F.length(s).alias("h"), F.concat(s, p).alias("key"))))
    )
    keyed = base.withColumn("keys", F.when(F.col("host") == "", F.array().cast("array<struct<n:int,h:int,key:string>>")).otherwise(pairs))
    universe = keyed.select(F.explode("keys.key").alias("key"))
    lists = {v: rules.filter(F.col("verdict") == v).select(F.concat("host", "path").alias("key")) for v in ("block", "allow")}
    block, allow = (build_cascade(universe, lists[v], f"urls-{v}") for v in ("block", "allow"))
    marked = F.transform(
        F.col("keys"),
        lambda k: F.struct(k["n"].alias("n"), k["h"].alias("h"), k["key"].alias("key"), F.when(block.holds(k["key"]), "block").when(allow.holds(k["key"]), "allow").alias("verdict")),
    )
    best = F.array_max(F.filter(marked, lambda k: k["verdict"].isNotNull()))
    return keyed.withColumn("best", best).select(
        id_col, "host", "path", F.col("best.key").alias("rule"), F.coalesce(F.col("best.verdict"), F.lit(unlisted)).alias("verdict")
    )
