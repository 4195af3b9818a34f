"""URL filtering by (host, path) rules held in a Bloom filter cascade.

A rule ``host/path`` fits a URL if the URL's host is the rule's host or one of
its subdomains and the URL's path starts with the rule's.  So the rules that
could fit a URL are its *keys*: every host suffix that has as many labels as
some rule, joined with every path prefix that is as long as some rule's path.
A URL's verdict is that of its longest key that is a listed rule.

Membership of a key is decided by a cascade over the corpus's complete key
universe: level 0 encodes the listed keys, level 1 those unlisted keys of the
universe that level 0 passes wrongly, level 2 the listed keys that level 1 passes,
and so on until a level passes nothing wrongly.  A key is listed if the first
level that does not hold it has an odd number.  For keys of the universe the
answer is exact, and no join is needed: the levels (a few bits per listed key)
go to every task.  Building costs one scan of the URLs and a scan of the
distinct keys per level.

A second cascade holds the block rules among the listed keys.  It answers the
verdict of a listed key; a URL without a listed key gets the method's answer for
a key on no list: ``allow``.

Size of what is broadcast: level 0 takes 8 bits for a listed key, later levels
shrink geometrically.  ``MAX_BROADCAST_BYTES`` is checked, and a list beyond it is
refused with an error that names the size.

Defined cases
- a null URL or one without ``://`` has empty host and path and fits no rule;
- repeated rows are judged alike; a null id is carried through;
- an empty URL table or an empty rule list gives a cascade without levels;
- a rule listed as both allow and block is an error;
- only (id, url) are read, so extra columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.llm.common import materialize, mix64
from faultline.session import ship_package

BITS_PER_KEY = 8
HASHES = 4
MAX_LEVELS = 64
MAX_BROADCAST_BYTES = 256 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str  # "allow" or "block"
    rule: str  # host + path, e.g. "example.com/en/"

    @property
    def host(self) -> str:
        return self.rule.split("/", 1)[0]

    @property
    def path(self) -> str:
        return self.rule[len(self.host) :]


# -- the cascade -------------------------------------------------------------------
@dataclass(frozen=True)
class Level:
    n_bits: int
    words: np.ndarray  # uint64


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, n_bits: int) -> np.ndarray:
    """(HASHES, n) bit positions; levels are independent of one another."""
    salt = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    a, b = mix64(h1 + salt), mix64(h2 ^ salt) | np.uint64(1)
    k = np.arange(HASHES, dtype=np.uint64)[:, None]
    return (a[None, :] + k * b[None, :]) % np.uint64(n_bits)


def _holds(level: Level, number: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    pos = _positions(h1, h2, number, level.n_bits)
    bits = (level.words[(pos >> np.uint64(6)).astype(np.int64)] >> (pos & np.uint64(63))) & np.uint64(1)
    return bits.all(axis=0)


def listed(levels: Sequence[Level], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Which keys (by their two 64-bit hashes) are listed."""
    alive = np.arange(len(h1))
    out = np.zeros(len(h1), dtype=bool)
    for number, level in enumerate(levels):
        hit = _holds(level, number, h1[alive], h2[alive])
        out[alive[~hit]] = number % 2 == 1  # left at an odd level: a listed key
        alive = alive[hit]
        if not len(alive):
            return out
    out[alive] = len(levels) % 2 == 1  # held by the last level, which passes nothing wrongly
    return out


def _u64(s) -> np.ndarray:
    return np.asarray(s, dtype=np.int64).view(np.uint64)


def _with_hashes(df: DataFrame, key: str = "key") -> DataFrame:
    return df.withColumn("h1", F.xxhash64(F.lit(1), key)).withColumn("h2", F.xxhash64(F.lit(2), key))


def build_cascade(members: DataFrame, universe: DataFrame) -> list[Level]:
    """Cascade of ``members`` over ``universe`` (both: distinct ``key``; members
    outside the universe are encoded as well)."""
    spark = universe.sparkSession
    ship_package(spark)
    # two candidate sets, each narrowed level by level: what is yet to be told apart
    yes = materialize(_with_hashes(members.select("key")).select("h1", "h2"), "listed")
    no = materialize(
        _with_hashes(universe.join(members.select("key"), "key", "left_anti").select("key")).select("h1", "h2"), "unlisted"
    )
    levels: list[Level] = []
    encode, other = yes, no
    while True:
        n = encode.count()
        if n == 0:
            return levels
        if len(levels) == MAX_LEVELS:
            raise RuntimeError("keys with equal 128-bit hashes on both sides; change the hash seeds")
        n_bits = -(-max(64, n * BITS_PER_KEY) // 64) * 64
        size = sum(x.words.nbytes for x in levels) + n_bits // 8
        if size > MAX_BROADCAST_BYTES:
            raise ValueError(f"the cascade takes {size} bytes, more than {MAX_BROADCAST_BYTES}")
        levels.append(Level(n_bits, _bits(encode, len(levels), n_bits)))
        passed = _passed(other, levels[-1], len(levels) - 1)
        encode, other = materialize(passed, "passed"), encode


def _bits(keys: DataFrame, number: int, n_bits: int) -> np.ndarray:
    """Words of the level's bit array: set bits or-ed together by word."""

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            pos = _positions(_u64(b["h1"]), _u64(b["h2"]), number, n_bits).ravel()
            word, inverse = np.unique(pos >> np.uint64(6), return_inverse=True)
            bits = np.zeros(len(word), dtype=np.uint64)
            np.bitwise_or.at(bits, inverse, np.uint64(1) << (pos & np.uint64(63)))
            yield pd.DataFrame({"word": word.astype(np.int64), "bits": bits.view(np.int64)})

    out = np.zeros(n_bits // 64, dtype=np.uint64)
    rows = keys.mapInPandas(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    out[rows["word"].to_numpy(dtype=np.int64)] = _u64(rows["bits"])  # size checked by the caller
    return out


def _passed(keys: DataFrame, level: Level, number: int) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def test(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[_holds(shared.value, number, _u64(b["h1"]), _u64(b["h2"]))]

    return keys.mapInPandas(test, "h1 long, h2 long")


# -- URLs ------------------------------------------------------------------------------
def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def candidate_keys(host: Column, path: Column, rules: Iterable[Rule]) -> Column:
    """A URL's keys, longest first (equal lengths: the longer host first).

    Only host suffixes with a rule's number of labels and path prefixes of a
    rule's length are made, so their number does not depend on the URL."""
    labels = sorted({r.host.count(".") + 1 for r in rules}, reverse=True)
    lengths = sorted({len(r.path) for r in rules}, reverse=True)
    parts = F.split(host, r"\.", -1)
    keys = []
    for n in labels:
        suffix = F.concat_ws(".", F.slice(parts, F.greatest(F.size(parts) - n + 1, F.lit(1)), n))
        for m in lengths:
            fits = (F.size(parts) >= n) & (F.length(path) >= m) & (F.length(host) > 0)
            keys.append(F.when(fits, F.struct((F.length(suffix) + m).alias("n"), F.length(suffix).alias("hn"), F.concat(suffix, F.substr(path, F.lit(1), F.lit(m))).alias("key"))))
    found = F.filter(F.array(*keys), lambda k: k.isNotNull())
    return F.transform(F.sort_array(found, asc=False), lambda k: k["key"])


def judge_urls(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: id, ``host``, ``path``, ``rule`` (null if none fits), ``verdict``."""
    spark: SparkSession = pages.sparkSession
    ship_package(spark)
    by_rule: dict[str, str] = {}
    for r in rules:
        if by_rule.setdefault(r.rule, r.verdict) != r.verdict:
            raise ValueError(f"{r.rule} is listed as allow and as block")
    host, path = host_and_path(pages[url_col])
    parsed = pages.select(pages[id_col].alias(id_col), host.alias("host"), path.alias("path"))
    if not rules:
        return parsed.select("*", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    parsed = materialize(parsed.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), rules)), "urls")
    universe = materialize(parsed.select(F.explode("keys").alias("key")).distinct(), "universe")
    table = spark.createDataFrame(sorted(by_rule.items()), "key string, verdict string")
    any_rule = spark.sparkContext.broadcast(build_cascade(table.select("key"), universe))
    blocked = spark.sparkContext.broadcast(
        build_cascade(table.filter("verdict = 'block'").select("key"), table.select("key"))
    )
    schema = T.StructType([*parsed.drop("keys", "hashes").schema.fields]).add("rule", T.StringType()).add("verdict", T.StringType())

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            counts = b["keys"].str.len().to_numpy(dtype=np.int64)
            keys = [k for ks in b["keys"] for k in ks]
            h1 = _u64([h for hs in b["h1s"] for h in hs])
            h2 = _u64([h for hs in b["h2s"] for h in hs])
            hit = np.flatnonzero(listed(any_rule.value, h1, h2))
            row = np.repeat(np.arange(len(b)), counts)[hit]
            rows, first = np.unique(row, return_index=True)  # keys come longest first
            best = hit[first]
            rule = np.full(len(b), None, dtype=object)
            verdict = np.full(len(b), "allow", dtype=object)
            rule[rows] = [keys[i] for i in best]
            verdict[rows] = np.where(listed(blocked.value, h1[best], h2[best]), "block", "allow")
            yield b.drop(columns=["keys", "h1s", "h2s"]).assign(rule=rule, verdict=verdict)

    hashes = parsed.withColumn("h1s", F.transform("keys", lambda k: F.xxhash64(F.lit(1), k))).withColumn(
        "h2s", F.transform("keys", lambda k: F.xxhash64(F.lit(2), k))
    )
    return hashes.mapInPandas(judge, schema)
