"""URL rules and a block list of hosts in a Bloom filter cascade, in DataFrame expressions alone.

The first filter encodes the listed keys; the second those other keys of the corpus that the first takes for listed; the third
the listed keys that the second takes for others; and so on until no key is mistaken. As the keys of the
whole corpus went in, the cascade answers exactly for each of them, without a join: the first level that doesn't know a key decides.
Its size follows the number of listed keys: the first filter's error is set to the ratio of listed keys to all, the
others' to a half.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinlake.llm.common import stage

#: The most bytes of all levels together; beyond, listed keys are looked up by a shuffled join instead, with the same result.
MAX_BYTES = 32 << 20

# The rules of the query, (verdict, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
# Words that list a host when one of its labels has them between hyphens.
LISTED_WORDS = ["adult", "ads", "bets", "casino", "pills", "spam"]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffixes(name: Column) -> Column:
    """A host and all domains above it, longest first; none of an empty host."""
    labels = F.split(name, r"\.")
    every = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.when(name == "", F.array().cast("array<string>")).otherwise(every)


def rule_of(host_column: str, path_column: str, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; null where none fits. Rules are a stated list, so they are a chain of conditions."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((F.col(host_column) == h) | F.col(host_column).endswith("." + h)) & F.col(path_column).startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


@dataclass
class Level:
    """One Bloom filter: words of 64 bits, and how many hashes a key has."""

    words: list[int]
    hashes: int
    seed: int

    def places(self, key: str) -> str:
        return _places(key, self.hashes, self.seed)

    def has(self, key: str) -> str:
        """SQL: whether the filter takes the key for a member. The words are a constant array."""
        words = f"cast(split('{','.join(map(str, self.words))}', ',') as array<bigint>)"
        word = f"{words}[cast(pmod(h, {len(self.words)}) as int)]"
        return f"forall({self.places(key)}, h -> shiftrightunsigned({word}, cast(shiftrightunsigned(h, 58) as int)) & 1L = 1L)"


def _places(key: str, hashes: int, seed: int) -> str:
    return f"transform(sequence({seed}, {seed + hashes - 1}), n -> xxhash64({key}, n))"


def _level(members: DataFrame, count: int, error: float, seed: int) -> Level:
    hashes = max(1, round(math.log2(1 / error)))
    size = max(1, math.ceil(count * hashes / math.log(2) / 64))
    at = members.select(F.explode(F.expr(_places("key", hashes, seed))).alias("h"))
    at = at.selectExpr(f"cast(pmod(h, {size}) as int) as word", "shiftleft(1L, cast(shiftrightunsigned(h, 58) as int)) as bit")
    words = [0] * size
    for row in at.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():  # at most `size` rows, which `build` has checked
        words[row["word"]] = row["bits"]
    return Level(words, hashes, seed)


def build(listed: DataFrame, universe: DataFrame, max_bytes: int = MAX_BYTES) -> list[Level] | None:
    """The levels of a cascade that is exact for all keys (key) of both tables; null keys are left out. None if it would exceed max_bytes."""
    marked = listed.select("key", F.lit(True).alias("listed")).union(universe.select("key", F.lit(False).alias("listed")))
    marked = stage(marked.where("key is not null").groupBy("key").agg(F.max("listed").alias("listed")), "keys")
    members, others = marked.where("listed").select("key"), marked.where("not listed").select("key")
    count, rest = members.count(), others.count()
    if not count:
        return []
    error = min(0.5, count / max(1, rest) / math.sqrt(2))
    # The first level, and twice as much again for the ever smaller ones after it.
    if count * (math.log2(1 / error) + 4) / math.log(2) / 8 > max_bytes:
        return None
    levels: list[Level] = []
    while count:
        levels.append(_level(members, count, error, 1000 * len(levels)))
        mistaken = stage(others.where(levels[-1].has("key")), "mistaken")
        members, others, count = mistaken, members, mistaken.count()
        error = 0.5 if count > 10_000 else 1 / 64  # few keys: fewer levels rather than fewer bits
    return levels


def listed_in(levels: list[Level], key: str) -> str:
    """SQL: whether a key of the universe is listed. The first level without it decides; the last level has mistaken no one."""
    said = str(len(levels) % 2 == 1).lower()
    for i in reversed(range(len(levels))):
        said = f"case when not ({levels[i].has(key)}) then {str(i % 2 == 1).lower()} else {said} end"
    return said


def judge(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]] = RULES, max_bytes: int = MAX_BYTES) -> DataFrame:
    """page_id, host, path, rule, verdict, listed: one row per page (page_id, url).

    The longest rule whose host is the url's or above it, and whose path the url's path begins with, gives the verdict. Without one a url is blocked
    if its host or a domain above it is listed (key), and allowed otherwise. Null urls and urls without `://` have an empty host and
    path, which nothing lists. Repeated rows give repeated rows, null ids stay null, an empty table gives no rows, an empty list blocks
    nothing; further columns are left out.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"))
    rows = rows.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    universe = domains(pages)
    levels = build(listed, universe, max_bytes)
    if levels is None:
        above = rows.select("host").distinct().select("host", F.explode(suffixes(F.col("host"))).alias("key"))
        hit = above.join(listed.select("key"), "key", "left_semi").select("host").distinct().withColumn("listed", F.lit(True))
        rows = rows.join(hit, "host", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    else:
        rows = rows.withColumn("above", suffixes(F.col("host"))).withColumn("listed", F.expr(f"exists(above, k -> {listed_in(levels, 'k')})"))
    rule, verdict = rule_of("host", "path", rules)
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "listed")


def domains(pages: DataFrame) -> DataFrame:
    """key: every host of the pages and every domain above one, once."""
    hosts = pages.select(host(F.col("url").cast("string")).alias("host")).distinct()
    return hosts.select(F.explode(suffixes(F.col("host"))).alias("key")).distinct()


def listed_by_words(keys: DataFrame, words: list[str] = LISTED_WORDS) -> DataFrame:
    """The keys whose first label has one of the words, alone or between hyphens."""
    return keys.where(F.col("key").rlike(rf"^([^.]*-)?({'|'.join(words)})(-[^.]*)?(\.|$)"))
