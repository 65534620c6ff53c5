"""Page filter: host and path rules, and exact list membership by a Bloom filter cascade.

The cascade knows its whole universe of keys (every host of the corpus). Level 1
is a Bloom filter of the listed keys; some other keys pass it by chance. Level 2
encodes exactly those, level 3 the listed keys that pass level 2, and so on,
until a level lets nothing wrong through. The first level that a key fails tells
on which side it is: exact, and in a few bits a key instead of the keys.

The cascade is cut into shards by the key's hash, with about ``KEYS_A_SHARD``
listed keys each, so a shard's bits are one row of short arrays. A page finds
its shard's row by number, never by comparing keys with the list; Spark
broadcasts those rows only while they are small and splits a hot host's pages
otherwise. All is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import Scratch

#: The rules (host, path prefix, verdict). A rule holds for its host and all subdomains.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

#: Host name parts that put a host on the block list.
LISTED_PARTS = ("cheap-pills", "adult-x", "free-bets", "casino", "lottery", "warez")

KEYS_A_SHARD = 4096
#: Bits for each key of a level, and probes of each key.
BITS_A_KEY = 4
PROBES = 2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    fit = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, prefix, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        here = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(prefix))
        fit = F.when(here, F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(fit)
    return fit


def _bits(key: Column, level: int, size: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(size)) for i in range(PROBES)]


def _passes(key: Column, level: int, size: int) -> Column:
    """Whether all bits of a key are set in its shard's array ``level_<level>``; a shard without one has none set."""
    found = F.lit(True)
    for bit in _bits(key, level, size):
        word = F.element_at(F.col(f"level_{level}"), (F.floor(bit / 64) + 1).cast("int"))
        found = found & (F.call_function("shiftright", word, F.pmod(bit, F.lit(64)).cast("int")).bitwiseAND(F.lit(1)) == 1)
    return F.coalesce(found, F.lit(False))


def _encoded(keys: DataFrame, level: int, size: int) -> DataFrame:
    """(shard, level_<level>): each shard's bits as an array of longs."""
    word = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("bit", F.lit(64)).cast("int"))
    words = (keys.select("shard", F.explode(F.array(*_bits(F.col("key"), level, size))).alias("bit"))
             .groupBy("shard", F.floor(F.col("bit") / 64).cast("int").alias("at")).agg(F.bit_or(word).alias("word")))
    full = F.transform(F.sequence(F.lit(0), F.lit(size // 64 - 1)),
                       lambda i: F.coalesce(F.element_at("words", i), F.lit(0).cast("long")))
    return (words.groupBy("shard").agg(F.map_from_entries(F.collect_list(F.struct("at", "word"))).alias("words"))
            .select("shard", full.alias(f"level_{level}")))


def build_cascade(universe: DataFrame, scratch: Scratch) -> tuple[DataFrame, list[int], int]:
    """The cascade of a table (key, listed) of distinct keys.

    Returns the rows (shard, level_1, level_2, ...), the number of bits of each
    level, and the number of shards. The driver sees counts only.
    """
    shards = max(1, -(-universe.where("listed").count() // KEYS_A_SHARD))
    numbered = universe.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
    encoded = scratch.save(numbered.where("listed").select("key", "shard"), "listed")
    others = scratch.save(numbered.where("not listed").select("key", "shard"), "others")
    table, sizes = None, []
    while True:
        level = len(sizes) + 1
        most = encoded.groupBy("shard").count().agg(F.max("count")).first()[0] or 1
        size = 64 * -(-most * (BITS_A_KEY + level // 8) // 64)  # a little more, the longer it takes
        made = scratch.save(_encoded(encoded, level, size), f"level-{level}")
        sizes.append(size)
        table = made if table is None else scratch.save(table.join(made, "shard", "left"), f"levels-{level}")
        wrong = scratch.save(others.join(made, "shard").where(_passes(F.col("key"), level, size))
                             .select("key", "shard"), "wrong")
        scratch.drop(others)
        if wrong.isEmpty():
            return table, sizes, shards
        # the next level holds what passed wrongly; it must keep out the keys this level holds
        encoded, others = wrong, encoded


def is_listed(key: Column, sizes: list[int]) -> Column:
    """Membership of a key of the universe, beside its shard's levels."""
    answer = F.lit(len(sizes) % 2 == 1)
    for level in range(len(sizes), 0, -1):
        answer = F.when(_passes(key, level, sizes[level - 1]), answer).otherwise(F.lit(level % 2 == 0))
    return answer


def filter_pages(pages: DataFrame, listed: Column | None = None, id_col: str = "page_id", url_col: str = "url",
                 rules=RULES) -> DataFrame:
    """Host, path, rule and verdict of every page.

    ``listed`` is a condition on the column ``key`` (a host) that defines the
    block list; by default hosts with one of ``LISTED_PARTS`` in the name. The
    verdict is the longest fitting rule's, else ``block`` for listed hosts and
    ``allow`` for others, as the cascade over all hosts of ``pages`` says.

    Null urls and urls without ``://`` have an empty host and path, no rule and
    are allowed unless the empty host is listed. Repeated rows give a row each.
    Other columns of ``pages`` are not read. An empty table gives an empty one.
    """
    scratch = Scratch(pages.sparkSession, "url-filter")
    if listed is None:
        listed = F.lit(False)
        for part in LISTED_PARTS:
            listed = listed | F.contains(F.col("key"), F.lit(part))
    rows = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    hosts = rows.select(F.col("host").alias("key")).distinct()
    universe = scratch.save(hosts.select("key", listed.alias("listed")), "universe")
    table, sizes, shards = build_cascade(universe, scratch)
    judged = (rows.withColumn("shard", F.pmod(F.xxhash64("host"), F.lit(shards)).cast("int")).join(table, "shard", "left")
              .withColumn("fit", rule_of(F.col("host"), F.col("path"), rules)))
    by_list = F.when(is_listed(F.col("host"), sizes), "block").otherwise("allow")
    return judged.select(F.col("id").alias(id_col), "host", "path", F.col("fit.rule").alias("rule"),
                         F.coalesce("fit.verdict", by_list).alias("verdict"))


#: DuckDB SQL of the same rows: the cascade must agree with plain membership.
SQL = r"""
WITH p AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r(name, prefix, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fit AS (
  SELECT page_id, host, path, arg_max(name || prefix, length(name || prefix)) AS rule,
         arg_max(verdict, length(name || prefix)) AS verdict
  FROM (SELECT DISTINCT page_id, host, path FROM p) q
  JOIN r ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, prefix)
  GROUP BY ALL)
SELECT p.page_id, p.host, p.path, fit.rule,
  coalesce(fit.verdict, CASE WHEN contains(p.host, 'cheap-pills') OR contains(p.host, 'adult-x')
    OR contains(p.host, 'free-bets') OR contains(p.host, 'casino') OR contains(p.host, 'lottery')
    OR contains(p.host, 'warez') THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fit ON p.page_id IS NOT DISTINCT FROM fit.page_id AND p.host = fit.host AND p.path = fit.path
"""
