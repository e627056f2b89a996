"""URL filter: host and path rules, then a list of URLs behind a blocked Bloom filter.

Only DataFrame functions are used. The list may be large: its filter is a table of 256-bit blocks, and a URL is looked
up in the list itself only if its block holds all its bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.functions.names import fresh
from recspark.sources.scratch import counted

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Blocks of the filter that are still sent to every executor: 2**16 rows of 40 bytes, 2.6 MB. Larger filters are joined by shuffle.
BROADCAST_BLOCKS = 2**16
BITS_PER_URL, BLOCK_BITS, HASHES = 16, 256, 6
#: Tasks that the rows of one listed URL are dealt to in the exact join.
SPREAD = 8


def url_host(url: Column) -> Column:
    """From after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.`` and path without a closing slash, then the query without ``utm_`` parameters; null stays null.

    Scheme and fragment go. A URL without ``://`` has no canonical form and gives null.
    """
    rest = F.regexp_replace(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*[^?#]*(\?[^#]*)?", 1), r"(?<=[?&])utm_[^&]*(&|$)", "")
    whole = F.concat(
        F.regexp_replace(url_host(url), r"^www\.", ""),
        F.regexp_replace(url_path(url), r"/+$", ""),
        F.regexp_replace(rest, r"[?&]+$", ""),
    )
    return F.when(url.contains("://"), whole)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest fitting rule of (verdict, host, path) as a struct(rule, verdict); null if none fits.

    A rule fits its host and all subdomains if the path starts with the rule's path. Of rules of one length the first
    given wins. The rules are configuration, a list that people write; a list of URLs belongs in ``listed_urls``.
    """
    out = None
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(n_blocks))


def _mask(key: Column) -> list[Column]:
    """The four 64-bit words of the bits that a URL sets in its block."""
    h = F.xxhash64(key, F.lit(2))
    bits = [F.shiftrightunsigned(h, 8 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(HASHES)]
    words = []
    for w in range(BLOCK_BITS // 64):
        word = F.lit(0).cast("long")
        for b in bits:
            # the shift count of a long uses its low six bits
            one = F.call_function("shiftleft", F.lit(1).cast("long"), b.bitwiseAND(F.lit(63)).cast("int"))
            word = word.bitwiseOR(F.when(F.shiftrightunsigned(b, 6) == w, one).otherwise(F.lit(0).cast("long")))
        words.append(word)
    return words


def bloom_blocks(listed: DataFrame, key: str, n_blocks: int) -> DataFrame:
    """(block, w0..w3) of the listed keys; blocks without a key have no row."""
    words = [m.alias(f"w{i}") for i, m in enumerate(_mask(F.col(key)))]
    marked = listed.where(F.col(key).isNotNull()).select(_block(F.col(key), n_blocks).alias("block"), *words)
    return marked.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(len(words))])


def in_list(rows: DataFrame, key: str, listed: DataFrame, out: str) -> DataFrame:
    """``rows`` with the boolean ``out``: whether ``key`` is in ``listed`` (a DataFrame with the same key column).

    The filter passes possible hits; an exact hash join of those with the list removes false positives. A null key is
    in no list; repeated rows stay; an empty list gives false everywhere. Extra columns of ``rows`` stay, those of
    ``listed`` are not used.
    """
    names = rows.columns
    key_, block, probe_, spread_, hit, *words = fresh([*names, out], "key", "block", "probe", "spread", "hit", "w0", "w1", "w2", "w3")
    listed, n = counted(listed.select(F.col(key).alias(key_)).where(F.col(key_).isNotNull()).distinct(), "listed")
    n_blocks = max(1, -(-n * BITS_PER_URL // BLOCK_BITS))
    blocks = bloom_blocks(listed, key_, n_blocks)
    if n_blocks <= BROADCAST_BLOCKS:
        blocks = F.broadcast(blocks)
    # what matches nothing, null keys and rows that the filter turns away, is spread by the rows' own hash
    spread = F.xxhash64(*[F.col(f"`{c}`") for c, kind in rows.dtypes if "map<" not in kind])
    rows = rows.withColumn(key_, F.col(key))
    probe = rows.withColumn(block, F.when(F.col(key_).isNull(), -1 - F.pmod(spread, F.lit(2**31))).otherwise(_block(F.col(key_), n_blocks)))
    blocks = blocks.select(F.col("block").cast("long").alias(block), *[F.col(f"w{i}").alias(w) for i, w in enumerate(words)])
    held = F.lit(True)
    for w, m in zip(words, _mask(F.col(key_)), strict=True):
        held = held & (F.col(w).bitwiseAND(m) == m)
    maybe = F.coalesce(F.col(key_).isNotNull() & held, F.lit(False))
    probed = probe.join(blocks, block, "left").select(
        *[F.col(f"`{c}`") for c in names], F.when(maybe, F.col(key_)).otherwise("").alias(probe_), F.when(maybe, F.pmod(spread, F.lit(SPREAD))).otherwise(spread).alias(spread_)
    )
    # each listed key is there SPREAD times, so that the rows of a popular one are dealt to as many tasks
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))).alias(spread_)
    hits = listed.select(F.col(key_).alias(probe_), copies, F.lit(True).alias(hit))
    return probed.join(hits, [probe_, spread_], "left").select(*[F.col(f"`{c}`") for c in names if c != out], F.coalesce(hit, F.lit(False)).alias(out))


def filter_urls(pages: DataFrame, listed_urls: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """One row per page: page_id, host, path, canonical_url, rule, listed, verdict.

    ``listed_urls`` has a column canonical_url. A rule that fits decides; else a listed URL is blocked and any other
    allowed. Null or malformed URLs have empty host and path, no rule, and are allowed. Repeated rows are judged each.
    """
    rows = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), canonical(F.col("url")).alias("canonical_url"))
    judged = in_list(rows, "canonical_url", listed_urls, "listed").withColumn("__r", rule_for(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col("__r.verdict"), F.when(F.col("listed"), "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", "canonical_url", F.col("__r.rule").alias("rule"), "listed", verdict.alias("verdict"))


#: The rules of the query: verdict, host, path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

#: Host labels whose pages make up the query's list of URLs.
LISTED_LABELS = "(^|\\.)(ads-track|adult-x|casino-win)\\."


def listed_from(pages: DataFrame) -> DataFrame:
    """The query's list: canonical URLs of the pages on hosts with a listed label."""
    return pages.where(url_host(F.col("url")).rlike(LISTED_LABELS)).select(canonical(F.col("url")).alias("canonical_url"))
