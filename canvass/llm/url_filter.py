"""URL filter (operator 2): blocked Bloom filter, then an exact hash join.

A rule is a canonical URL: a host and a path prefix, with a verdict. It fits a
url if the url's host is the rule's host or a subdomain of it, and the url's
path starts with the rule's path. The longest fitting rule wins; of equally
long ones the smaller rule text; of one rule listed with several verdicts,
``block``. A url that no rule fits gets the default verdict ``allow``.

How: every listed rule sets four bits in one 256-bit block of a Bloom filter
held as rows (block, four words). A url yields one key per *shape* of rule (so
many host labels, so many path characters); keys whose bits are all set pass
to a hash join on the full key, which removes false positives. Keys are made
for distinct (host, path) pairs, so a page repeated a million times is judged
once. Everything is built-in Column code.

Defined cases: a null url, or one without ``://``, has empty host and path; an
empty rule list allows everything; repeated input rows each get their result;
input columns named like the result's (host, path, rule, verdict) are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.llm.common import ascii_lower, read_table

WORDS = 4                    # 64-bit words of a block
KEYS_PER_BLOCK = 8           # 32 bits a key
BROADCAST_BLOCKS = 1 << 17   # blocks of at most 6 MB go to every task
BROADCAST_RULES = 100_000    # texts of at most 100,000 rules, some 20 MB
MAX_SHAPES = 4096

# The query's rules: fixed values.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"),
         ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def url_host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _key(host: Column, path: Column) -> Column:
    # labels and path lengths are fixed by the shape, so the joint text is unambiguous within one
    return F.concat(host, path)


def _bits(key: Column) -> list[Column]:
    h = F.xxhash64(F.lit("bits"), key)
    # variable shifts have no function-API form for a column amount
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"),
                            F.shiftrightunsigned(h, 8 * i).bitwiseAND(F.lit(63)).cast("int"))
            for i in range(WORDS)]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks).cast("bigint"))


def blocked_bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """Filter rows (block, w0..w3) of a column ``key``."""
    return (keys.select(_block(F.col("key"), blocks).alias("block"),
                        *[b.alias(f"b{i}") for i, b in enumerate(_bits(F.col("key")))])
            .groupBy("block").agg(*[F.bit_or(f"b{i}").alias(f"w{i}") for i in range(WORDS)]))


def judge_urls(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``df`` with host, path, rule and verdict. ``rules``: host, path, verdict (texts)."""
    out = ("host", "path", "rule", "verdict")
    rows = df.withColumns({"__url": F.col(f"`{url}`")})
    rows = rows.drop(*[c for c in df.columns if c in out]).withColumns(
        {"host": url_host(F.col("__url")), "path": url_path(F.col("__url"))}).drop("__url")

    rules = (rules.select(ascii_lower(F.col("host")).alias("rhost"), F.col("path").alias("rpath"), "verdict").dropna()
             .groupBy("rhost", "rpath").agg(F.max("verdict").alias("verdict"))  # block > allow
             .select(_key(F.col("rhost"), F.col("rpath")).alias("key"),
                     (F.length("rhost") - F.length(F.translate("rhost", ".", "")) + 1).alias("labels"),
                     F.length("rpath").alias("plen"), "verdict"))
    shapes = sorted(tuple(r) for r in rules.select("labels", "plen").distinct().limit(MAX_SHAPES + 1).collect())
    if len(shapes) > MAX_SHAPES:
        raise ValueError(f"over {MAX_SHAPES} shapes (host labels, path length) of rules: split the list")
    if not shapes:
        return rows.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    n = rules.count()
    blocks = max(1, -(-n // KEYS_PER_BLOCK))

    urls = rows.select("host", "path").distinct()
    keyed = urls.select("host", "path", F.explode(F.array(*[
        F.struct(F.lit(k).alias("labels"), F.lit(p).alias("plen"),
                 F.when(F.length("path") >= p, _key(F.substring_index("host", ".", -k), F.substring("path", 1, p)))
                 .alias("key")) for k, p in shapes])).alias("c")).select("host", "path", "c.*").where("key is not null")
    probe = keyed.select("*", _block(F.col("key"), blocks).alias("block"),
                         *[b.alias(f"b{i}") for i, b in enumerate(_bits(F.col("key")))])
    bloom = blocked_bloom(rules, blocks)
    possible = probe.join(F.broadcast(bloom) if blocks <= BROADCAST_BLOCKS else bloom, "block").where(
        F.expr(" and ".join(f"(b{i} & w{i}) = b{i}" for i in range(WORDS)))).select("host", "path", "labels", "plen", "key")
    exact = possible.join(F.broadcast(rules) if n <= BROADCAST_RULES else rules, ["labels", "plen", "key"])
    # longest first, then the smaller text: least (-length, text)
    won = (exact.groupBy("host", "path")
           .agg(F.min(F.struct((-F.length("key")).alias("short"), F.col("key"), F.col("verdict"))).alias("won"))
           .select("host", "path", F.col("won.key").alias("rule"), F.col("won.verdict").alias("verdict")))
    return (rows.join(won, ["host", "path"], "left")
            .withColumn("verdict", F.coalesce("verdict", F.lit(default)))
            .select(*[c for c in rows.columns if c not in ("host", "path")], *out))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the four listed rules."""
    rules = spark.range(1).select(F.inline(F.array(*[
        F.struct(*[F.lit(x).alias(n) for n, x in zip(("host", "path", "verdict"), r)]) for r in RULES])))
    return judge_urls(read_table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


OP2_SQL = r"""
with u as (
  select page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
r(rhost, rpath, v) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                              ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow'))
select page_id, host, path,
       (select rhost || rpath from r where (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
        order by length(rhost || rpath) desc, rhost || rpath limit 1) as rule,
       coalesce((select v from r where (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
        order by length(rhost || rpath) desc, rhost || rpath limit 1), 'allow') as verdict
from u
"""
