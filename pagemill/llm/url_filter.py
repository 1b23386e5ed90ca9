"""URL filters: longest-match rules, then a Bloom filter cascade over host names.

The cascade holds the listed keys exactly with respect to the complete set of keys that
occur: level 1 encodes the listed keys, level 2 the other keys that level 1 takes for
listed, level 3 the listed keys that level 2 takes for those, and so on until no key is
mistaken. Whoever asks for a key of that set gets the true answer from the levels alone,
which travel as literals in the plan; no row is joined. Levels are as small as the whole
cascade allows: the first mistakes about as many other keys as keys are listed, each further
one half of what it is asked.
"""

from __future__ import annotations

import math
import struct
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pagemill.lineage import broadcast_if_small, cut_lineage
from pagemill.llm.rows import shielded

# Verdict and place of each rule, a host with its path.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
# Words that list a host if one of its labels has them between hyphens.
LISTED_WORDS = ("ads", "adult", "bets", "casino", "pills", "spam")
# Share of the keys not in it that a level behind the first mistakes.
MISTAKEN = 0.5
# Bits of one block of a bitmap, fixed by the bitmap functions.
BLOCK_BITS = 32_768
# Keys that a level may hold, at most 46 MB of bits; a longer list is joined instead.
MAX_KEYS = 16_000_000
# Least share of mistaken keys at the first level.
LEAST_MISTAKEN = 1e-7
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Up to the first "://", the host, the path.
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """Place and verdict of the longest rule that fits, or nulls."""
    place, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at = rule.index("/")
        fits = ((host == rule[:at]) | F.endswith(host, F.lit(f".{rule[:at]}"))) & F.startswith(path, F.lit(rule[at:]))
        place, verdict = F.when(fits, rule).otherwise(place), F.when(fits, says).otherwise(verdict)
    return place, verdict


def suffixes(host: Column) -> Column:
    """A host and the domains above it."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )


@dataclass(frozen=True)
class Level:
    """One Bloom filter: its bits as the text of 64-bit numbers, and how keys are hashed."""

    seed: int
    bits: int
    hashes: int
    words: str

    def positions(self, key: Column) -> Column:
        """Places of a key's bits, counted from 1 as the bitmap functions do."""
        return F.transform(
            F.sequence(F.lit(1), F.lit(self.hashes)),
            lambda i: F.pmod(F.xxhash64(key, F.lit(self.seed), i), F.lit(self.bits)) + 1,
        )

    def has(self, key: Column) -> Column:
        # Folded into one array literal when the plan is optimised.
        words = F.split(F.lit(self.words), ",").cast("array<bigint>")
        return F.forall(
            self.positions(key),
            lambda p: F.getbit(F.get(words, F.shiftright(p - 1, 6).cast("int")), F.pmod(p - 1, F.lit(64)).cast("int")) == 1,
        )


def build_level(keys: DataFrame, n: int, seed: int, mistaken: float = MISTAKEN) -> Level:
    """The filter of ``n`` keys that takes about ``mistaken`` of the others for one of them: blocks
    of bits are set where the keys are, and then laid end to end."""
    hashes = max(1, round(-math.log2(mistaken)))
    bits = max(1, math.ceil(n * -math.log(mistaken) / math.log(2) ** 2))
    empty = Level(seed, bits, hashes, "")
    places = keys.select(F.explode(empty.positions(F.col("key"))).alias("p"))
    blocks = places.groupBy(F.bitmap_bucket_number("p").alias("at")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")
    )
    size = BLOCK_BITS // 8
    out = bytearray(math.ceil(bits / BLOCK_BITS) * size)
    for at, part in blocks.collect():  # the bits of at most MAX_KEYS keys
        out[(at - 1) * size : at * size] = part
    words = math.ceil(bits / 64)
    return Level(seed, bits, hashes, ",".join(map(str, struct.unpack(f"<{words}q", bytes(out[: 8 * words])))))


def first_mistaken(n_listed: int, n_other: int) -> float:
    """Share of the other keys that the first level may take for listed ones: as many, about, as
    there are listed keys (Larisch et al., 2017, give the root of a half of that ratio)."""
    return min(MISTAKEN, max(LEAST_MISTAKEN, math.sqrt(MISTAKEN) * n_listed / max(1, n_other)))


def build_cascade(universe: DataFrame, bits_per_key: float | None = None) -> list[Level]:
    """Levels that tell the listed from the other keys of ``key, listed``, which are distinct.

    ``bits_per_key`` sets the size of all levels, which else is fitted to the keys.
    """
    n_listed, n_all = universe.agg(F.count_if("listed"), F.count(F.lit(1))).first()
    fixed = None if bits_per_key is None else math.exp(-bits_per_key * math.log(2) ** 2)
    first = fixed or first_mistaken(n_listed, n_all - n_listed)
    levels: list[Level] = []
    passing = universe
    while True:
        coded = passing.where(F.col("listed") == (len(levels) % 2 == 0))
        n = coded.count()
        if not n:
            return levels
        share = first if not levels else fixed or MISTAKEN
        levels.append(build_level(coded, n, seed=len(levels) + 1, mistaken=share))
        passing = passing.where(levels[-1].has(F.col("key")))


def listed_by(levels: list[Level], key: Column) -> Column:
    """Whether a key of the universe is listed: decided by the first level without it."""
    answer = F.lit(len(levels) % 2 == 1)
    for i, level in reversed(list(enumerate(levels))):
        answer = F.when(level.has(key), answer).otherwise(F.lit(i % 2 == 1))
    return answer


def listed_words(key: Column, words: tuple = LISTED_WORDS) -> Column:
    """Whether the first label of a domain is listed."""
    return F.arrays_overlap(F.split(F.substring_index(key, ".", 1), "-"), F.array(*map(F.lit, words)))


@shielded("url")
def url_filter(pages: DataFrame, rules: tuple = RULES, words: tuple = LISTED_WORDS, max_keys: int = MAX_KEYS) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``.

    The longest rule that fits decides; else a page is blocked if its host, or a domain above
    it, is listed. A null url, or one without ``://``, has an empty host and path, fits no
    rule and is allowed. Repeated rows are judged alike; an empty table stays empty; columns
    of ``pages`` named like the added ones are replaced.
    """
    parts = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    keys = parts.select("host").distinct().select(F.explode(suffixes(F.col("host"))).alias("key")).distinct()
    universe = cut_lineage(keys.select("key", listed_words(F.col("key"), words).alias("listed")))
    place, says = longest_rule(F.col("host"), F.col("path"), rules)
    if universe.where("listed").count() <= max_keys:
        levels = build_cascade(universe)
        listed = F.exists(suffixes(F.col("host")), lambda key: listed_by(levels, key))
        judged = parts.withColumn("_listed", listed)
    else:
        hosts = parts.select(F.col("host").alias("_host")).distinct()
        found = hosts.select("_host", F.explode(suffixes(F.col("_host"))).alias("key"))
        found = found.join(universe.where("listed"), "key", "left_semi").select("_host", F.lit(True).alias("_listed"))
        table, _ = broadcast_if_small(cut_lineage(found.distinct()))
        judged = parts.join(table, F.col("host") == F.col("_host"), "left").drop("_host")
        judged = judged.withColumn("_listed", F.coalesce("_listed", F.lit(False)))
    verdict = F.coalesce(says, F.when(F.col("_listed"), "block").otherwise("allow"))
    return judged.withColumns({"rule": place, "verdict": verdict}).drop("_listed")
