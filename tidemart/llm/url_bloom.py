"""URL filters: a blocked Bloom filter in front of an exact hash join (op 9).

Hand-written rules on host and path decide first. The other URLs are brought
to a canonical form and looked up in a list of canonical URLs: a blocked Bloom
filter, built with ``bit_or`` per block, passes the possible hits, and an exact
hash join of only these rows with the list removes the false positives. DataFrame functions only.

Defined results: a NULL url (or one without ``://``) has empty host and path,
matches no rule, is never listed and is allowed. Repeated rows are judged row
by row. An empty list blocks nothing. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, hash128, write_and_reread

BITS_PER_URL = 16
WORDS = 4  # 64-bit words in a block; each URL sets two bits in each word
BROADCAST_MAX_BYTES = 64 << 20


@dataclass(frozen=True)
class Rule:
    """``action`` for URLs whose host is ``host`` or a subdomain of it and whose
    path starts with ``path``."""

    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


_AFTER = r"(?s)^.*?://"  # up to the first "://"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path of a URL; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    return (ascii_lower(F.regexp_extract(url, _AFTER + r"([^/?#]*)", 1)),
            F.regexp_extract(url, _AFTER + r"[^/?#]*([^?#]*)", 1))


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, fragment, a closing ``/`` and tracking
    parameters (``utm_*``, ``ref``); the remaining query is kept as it stands.
    NULL where the URL has no ``://``."""
    host, path = host_and_path(url)
    query = F.regexp_extract(url, _AFTER + r"[^?#]*(\?[^#]*)", 1)
    # every parameter is led by its own mark, so that each can go alone
    kept = F.regexp_replace(F.regexp_replace(query, r"[?&]+", "&"),
                            r"&(utm_[^&=]*|ref)(=[^&]*)?(?=&|$)|&$", "")
    return F.when(F.instr(url, "://") > 0, F.concat(host, F.regexp_replace(path, "/+$", ""), kept))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and action of the longest rule that fits (NULL if none does)."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):  # the longest is tested first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, F.lit(r.name)).otherwise(name)
        action = F.when(fits, F.lit(r.action)).otherwise(action)
    return name, action


def _block_and_masks(canon: Column, n_blocks: int) -> tuple[Column, list[Column]]:
    h, g = hash128(canon)
    one = F.lit(1).cast("bigint")

    def bit(k: int) -> Column:
        place = F.shiftrightunsigned(g, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", one, place)

    return (F.pmod(h, F.lit(n_blocks)),
            [bit(2 * w).bitwiseOR(bit(2 * w + 1)) for w in range(WORDS)])


def bloom_blocks(listed: DataFrame, canon: str, n_blocks: int) -> DataFrame:
    """The filter as a table: one row per non-empty block, ``WORDS`` words."""
    block, masks = _block_and_masks(F.col(canon), n_blocks)
    rows = listed.select(block.alias("_block"), *[m.alias(f"_w{i}") for i, m in enumerate(masks)])
    return rows.groupBy("_block").agg(*[F.bit_or(f"_w{i}").alias(f"_w{i}") for i in range(WORDS)])


def url_verdicts(pages: DataFrame, listed: DataFrame, rules: list[Rule], *, page_id: str = "page_id",
                 url: str = "url", listed_url: str = "url", listed_canonical: str | None = None,
                 bits_per_url: int = BITS_PER_URL) -> DataFrame:
    """``page_id, host, path, rule, verdict, listed`` for every row of ``pages``.

    ``listed``: URLs (any form) to block, or with ``listed_canonical`` a column
    of canonical ones, which are taken as they are. The rule's action wins; without a
    rule a listed URL is blocked and any other allowed. The filter has
    ``bits_per_url`` bits per distinct listed URL; it is broadcast only while
    its blocks fit ``BROADCAST_MAX_BYTES``, else the same join shuffles.
    """
    canon = F.col(listed_canonical) if listed_canonical else canonical_url(F.col(listed_url))
    canon_list = write_and_reread(
        listed.select(canon.alias("_canon"))
        .filter("_canon is not null").distinct(), "listed-urls")
    n_blocks = max(1, -(-canon_list.count() * bits_per_url // (64 * WORDS)))
    blocks = bloom_blocks(canon_list, "_canon", n_blocks)
    if n_blocks * 8 * (WORDS + 1) <= BROADCAST_MAX_BYTES:
        blocks = F.broadcast(blocks)

    host, path = host_and_path(F.col(url))
    name, action = rule_of(F.col("host"), F.col("path"), rules)
    judged = (pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"),
                           canonical_url(F.col(url)).alias("_canon"))
              .fillna("", ["host", "path"])
              .withColumn("rule", name).withColumn("_action", action))
    block, masks = _block_and_masks(F.col("_canon"), n_blocks)
    probed = judged.withColumn("_block", F.when(F.col("rule").isNull(), block))
    possible = F.lit(True)
    for i, m in enumerate(masks):
        possible = possible & (F.col(f"_w{i}").bitwiseAND(m) == m)
    open_rows = (probed.filter("_block is not null").join(blocks, "_block", "left")
                 .withColumn("_possible", F.coalesce(possible, F.lit(False))))
    settled = (probed.filter("_block is null").withColumn("listed", F.lit(False))
               .unionByName(open_rows.filter("not _possible").withColumn("listed", F.lit(False)),
                            allowMissingColumns=True))
    exact = canon_list.withColumn("listed", F.lit(True)).hint("shuffle_hash")
    hits = (open_rows.filter("_possible").join(exact, "_canon", "left")
            .withColumn("listed", F.coalesce("listed", F.lit(False))))
    verdict = F.coalesce("_action", F.when(F.col("listed"), "block").otherwise("allow"))
    return (settled.unionByName(hits, allowMissingColumns=True)
            .select("page_id", "host", "path", "rule", verdict.alias("verdict"), "listed"))
