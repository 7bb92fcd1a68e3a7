"""URL filter: host and path rules, then a blocked Bloom filter with an exact join behind it.

Canonical URLs of a block list are hashed into blocks of 256 bits (four 64-bit words, two bits set
in each), so one URL touches one row of the filter. The filter never has more than ``MAX_BLOCKS``
rows, which bounds the broadcast whatever the list holds: a longer list makes it denser, it lets
more URLs pass, and the hash join of what passed with the list itself stays exact.

Defined cases: a NULL URL or one without ``://`` has an empty host and path, fits no rule and is
allowed unless its canonical form, the empty text, is listed (it never is); repeated rows are
judged alike; an empty list blocks nothing; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.staging import ascii_lower, staged

#: Fixed rules of the contract: action and host with path. The longest that fits decides.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))
#: Words in host names by which the registered query builds its block list.
LISTED_HOST_WORDS = ("casino", "pills", "bets", "spam", "ads-")
MAX_BLOCKS, BITS_PER_URL = 1 << 17, 16


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host (A to Z lower-cased), path and query string."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    after = F.substr(rest, F.length(host) + 1)
    path = F.regexp_extract(after, "^[^?#]*", 0)
    query = F.regexp_extract(after, r"^[^?#]*\?([^#]*)", 1)
    return ascii_lower(host), path, query


def canonical_url(host: Column, path: Column, query: Column) -> Column:
    """Without scheme, leading ``www.``, closing slash, fragment and tracking parameters."""
    tracked = r"(^|&)(utm_[^=&]*|ref)=[^&]*"
    left = F.regexp_replace(F.regexp_replace(query, tracked, ""), "^&", "")
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, "/+$", ""),
                    F.when(left != "", F.concat(F.lit("?"), left)).otherwise(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Rule and action of the longest fitting rule, both NULL without one."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda x: (len(x[1]), x[1])):
        of_host, slash, start = text.partition("/")
        fits = ((host == of_host) | host.endswith("." + of_host)) & path.startswith(slash + start)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        action = F.when(fits, F.lit(what)).otherwise(action)
    return rule, action


def _masks(url: Column) -> list[Column]:
    """Bits of one URL in the four words of its block."""
    bits = F.xxhash64(F.lit(1), url)
    one = F.lit(1).cast("long")

    def bit(i: int) -> Column:
        place = F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", one, place)

    return [bit(2 * i).bitwiseOR(bit(2 * i + 1)) for i in range(4)]


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``block`` and four words from distinct ``canonical`` URLs."""
    masks = _masks(F.col("canonical"))
    return (listed.select(F.pmod(F.xxhash64("canonical"), F.lit(blocks)).alias("block"),
                          *[m.alias(f"m{i}") for i, m in enumerate(masks)])
            .groupBy("block").agg(*[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(4)]))


def filter_blocks(n_listed: int, max_blocks: int = MAX_BLOCKS) -> int:
    """Blocks for a list of this length, at most ``max_blocks``."""
    return min(max_blocks, max(1, math.ceil(n_listed * BITS_PER_URL / 256)))


def listed_urls(urls: DataFrame, listed: DataFrame, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``urls`` with ``listed`` (boolean): is its ``canonical`` among those of ``listed``?

    Only URLs that pass the filter are shuffled. The list holds each URL once, so a URL that a
    third of all rows share stays one row on its side, and adaptive execution splits the other.
    """
    names = staged(listed.select("canonical").filter("canonical <> ''").distinct(), "listed")
    blocks = filter_blocks(names.count(), max_blocks)
    table = bloom_filter(names, blocks).withColumnRenamed("block", "_block")
    passes = F.lit(True)
    for i, mask in enumerate(_masks(F.col("canonical"))):
        passes = passes & (F.col(f"w{i}").bitwiseAND(mask) == mask)
    probed = (urls.join(F.broadcast(table),
                        F.pmod(F.xxhash64("canonical"), F.lit(blocks)) == F.col("_block"), "left")
              .withColumn("_maybe", F.coalesce(passes, F.lit(False)))
              .select(*urls.columns, "_maybe"))
    exact = names.select("canonical", F.lit(True).alias("_is"))
    hits = (probed.filter("_maybe").join(exact, "canonical", "left")
            .withColumn("listed", F.coalesce("_is", F.lit(False))).select(*urls.columns, "listed"))
    return hits.unionByName(probed.filter("NOT _maybe").select(*urls.columns,
                                                               F.lit(False).alias("listed")))


def judged_urls(pages: DataFrame, listed: DataFrame, rules=RULES,
                max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``page_id, host, path, rule, verdict``: a fitting rule decides, else the block list."""
    host, path, query = url_parts(F.col("url"))
    rule, action = fitting_rule(F.col("host"), F.col("path"), rules)
    parts = pages.select("page_id", host.alias("host"), path.alias("path"), query.alias("query"))
    urls = parts.select("page_id", "host", "path", rule.alias("rule"), action.alias("action"),
                        canonical_url(F.col("host"), F.col("path"), F.col("query"))
                        .alias("canonical"))
    verdict = F.coalesce("action", F.when(F.col("listed"), "block").otherwise("allow"))
    return listed_urls(urls, listed, max_blocks).select("page_id", "host", "path", "rule",
                                                        verdict.alias("verdict"))


def host_word_list(pages: DataFrame, words=LISTED_HOST_WORDS) -> DataFrame:
    """The registered query's block list: canonical URLs of hosts with one of the words."""
    host, path, query = url_parts(F.col("url"))
    parts = pages.select(host.alias("host"), path.alias("path"), query.alias("query"))
    return (parts.filter(F.col("host").rlike("|".join(words)))
            .select(canonical_url(F.col("host"), F.col("path"), F.col("query"))
                    .alias("canonical")))
