"""URL filtering by association rules, behind a list of fixed host and path rules.

The tokens of a URL (host labels, path segments, query keys) form a basket. Spark's
FP-growth mines the token combinations of labelled URLs together with the marker of a bad
page; combinations that meet the marker with enough support and confidence become rules.
Rules are matched by an inverted index: each rule is listed under its rarest token, the
tokens of a URL look up their postings, and a rule fires where the URL holds all its tokens.

FP-growth runs on the baskets with their labels sampled to at most ``SAMPLE`` rows, lowest
hashes first, with all frequent tokens of a URL. Tokens that are in the very same baskets are
mined as one and listed one by one again in the rules. A rule that contains another one of at
least its confidence is left out, since only the highest confidence counts; all others are kept
as a table, which is joined with the tokens. The fixed rules win over mined ones.

Defined cases: a missing URL, or one without ``://``, has an empty host and path, no tokens
and is allowed; missing labels are not learned from, of several labels for one id the bad
one counts; equal rows are judged alike; without bad labels there are no rules; an empty
table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.session import durable

#: (verdict, host, path prefix): fits the host and all its subdomains; the longest wins.
FIXED = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
SAMPLE = 200_000
MIN_SUPPORT = 0.0005
MIN_ROWS = 20
MIN_CONFIDENCE = 0.5
MAX_TOKENS = 3
BAD = " bad"  # no token holds a space

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fixed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = FIXED) -> tuple[Column, Column]:
    """Name and verdict of the longest fixed rule that fits, else NULL."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, domain, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(prefix)
        name, verdict = F.when(fits, domain + prefix).otherwise(name), F.when(fits, decision).otherwise(verdict)
    return name, verdict


def tokens_of(url: Column) -> Column:
    """Distinct tokens: each host label and domain, each path segment, each query key."""
    host, path = host_of(url), path_of(url)
    query = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(""))
    labels = F.transform(F.split(host, r"\."), lambda t: F.concat(F.lit("host:"), t))
    segments = F.transform(F.split(path, "/"), lambda t: F.concat(F.lit("path:"), t))
    keys = F.transform(F.split(query, "&"), lambda t: F.concat(F.lit("key:"), F.substring_index(t, "=", 1)))
    full = F.array(F.concat(F.lit("site:"), host))
    every = F.transform(F.array_distinct(F.concat(full, labels, segments, keys)), lambda t: F.regexp_replace(t, r"\s", "%20"))
    return F.filter(every, lambda t: ~t.endswith(":"))


def mine(
    pages: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE, sample: int = SAMPLE
) -> DataFrame:
    """tokens, confidence and support (rows of the sample) of the rules that mark bad pages."""
    judged = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when((F.col("quality") == 1) | (F.col("toxic") == 0), 0)
    marked = labels.groupBy(F.col("doc_id").alias("page_id")).agg(F.max(judged).alias("bad")).where("bad is not null")
    named = pages.join(marked, "page_id").select("page_id", "url", tokens_of(F.col("url")).alias("tokens"), "bad").where(F.size("tokens") > 0)
    picked = named.orderBy(F.xxhash64("page_id"), "page_id", "url").limit(sample)
    baskets = durable(picked.select(F.monotonically_increasing_id().alias("id"), "bad", "tokens"))
    n = baskets.count()
    least = max(int(min_support * n), MIN_ROWS)
    if n < least:  # no rule can have the support
        return pages.sparkSession.createDataFrame([], "tokens array<string>, confidence double, support long")
    # Tokens below the support cannot be in a rule.
    common = baskets.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") >= least)
    counted = baskets.select("id", "bad", F.explode("tokens").alias("t")).join(common.select("t"), "t")
    # Tokens of the very same baskets have one name, or a long URL alone would give 2 ** tokens combinations.
    where = [F.count(F.lit(1)).alias("times"), F.bit_xor(F.xxhash64("id")).alias("one"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("other")]
    alike = counted.groupBy("t").agg(*where).groupBy("times", "one", "other").agg(F.min("t").alias("name"), F.collect_list("t").alias("same"))
    alike = durable(alike.select("name", "same"))
    named = counted.join(alike.select("name", F.explode("same").alias("t")), "t")
    held = named.groupBy("id", "bad").agg(F.collect_set("name").alias("items"))
    small = durable(held.select(F.when(F.col("bad") == 1, F.array_append("items", F.lit(BAD))).otherwise(F.col("items")).alias("items")))
    model = FPGrowth(itemsCol="items", minSupport=least / n, minConfidence=min_confidence).fit(small)
    frequent = model.freqItemsets.where(F.size("items") <= MAX_TOKENS + 1)
    with_bad = frequent.where(F.array_contains("items", BAD) & (F.size("items") > 1)).select(
        F.array_sort(F.array_remove("items", BAD)).alias("tokens"), F.col("freq").alias("support")
    )
    alone = frequent.where(~F.array_contains("items", BAD)).select(F.array_sort("items").alias("tokens"), F.col("freq").alias("seen"))
    scored = with_bad.join(alone, "tokens").select("tokens", (F.col("support") / F.col("seen")).alias("confidence"), "support")
    rules = durable(scored.where(F.col("confidence") >= min_confidence))
    return durable(_each_token(_least(rules), alike))


def _least(rules: DataFrame) -> DataFrame:
    """The rules that contain no other rule of at least their confidence."""
    parts = F.concat(F.transform("tokens", lambda t: F.array(t)), F.transform("tokens", lambda t: F.array_remove("tokens", t)))
    smaller = rules.where(F.size("tokens") > 1).select(F.col("tokens").alias("whole"), "confidence", F.explode(F.array_distinct(parts)).alias("part"))
    known = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("of_part"))
    redundant = smaller.join(known, "part").where(F.col("of_part") >= F.col("confidence")).select(F.col("whole").alias("tokens")).distinct()
    return rules.join(redundant, "tokens", "left_anti")


def _each_token(rules: DataFrame, alike: DataFrame) -> DataFrame:
    """The rules with each of the tokens that a name stands for."""
    out = rules.select("tokens", F.array().cast("array<string>").alias("done"), "confidence", "support")
    for place in range(MAX_TOKENS):
        name = F.get("tokens", F.lit(place)).alias("name")
        listed = out.select("*", name).join(alike, "name", "left")
        same = F.coalesce("same", F.array(F.lit(None).cast("string")))
        step = listed.select("tokens", "done", "confidence", "support", F.explode(same).alias("t"))
        out = step.select("tokens", F.array_compact(F.array_append("done", F.col("t"))).alias("done"), "confidence", "support")
    return out.select(F.array_sort("done").alias("tokens"), "confidence", "support")


def matched(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """url, and the confidence of the best rule that fires there, for distinct URLs."""
    tokens = pages.select("url", tokens_of(F.col("url")).alias("held"))
    postings = rules.select(F.explode("tokens").alias("token"), "tokens", "confidence")
    frequency = postings.groupBy("token").agg(F.count(F.lit(1)).alias("listed"))
    # Listed under the token that the fewest rules hold; a rule has one posting.
    index = postings.join(frequency, "token").groupBy("tokens", "confidence").agg(F.min_by("token", F.struct("listed", "token")).alias("key"))
    hits = tokens.select("url", "held", F.explode("held").alias("key")).join(index, "key")
    fired = hits.where(F.size(F.array_except("tokens", "held")) == 0)
    return fired.groupBy("url").agg(F.max("confidence").alias("confidence"))


def judge(pages: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict and the confidence of a mined rule, per page."""
    plain = pages.select("page_id", "url")
    rules = mine(plain, labels, min_support, min_confidence)
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    name, verdict = fixed_rule(F.col("host"), F.col("path"))
    # Mined rules are matched for distinct URLs, so a repeated URL is looked up once.
    best = matched(plain.where("url is not null").select("url").distinct(), rules)
    parts = plain.join(best, "url", "left").select("page_id", host.alias("host"), path.alias("path"), "confidence")
    mined = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return parts.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, mined).alias("verdict"), "confidence")


def report(pages: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(pages, labels)
