"""URL filters: a fixed rule list, and association rules that FP-growth mines from labelled URLs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyops.llm.common import ascii_lower, sized, stored

# (host, start of the path, verdict)
RULES = (
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.5
# A rule rests on at least this many bad pages, and its confidence is this many standard errors above the share of bad pages.
MIN_PAGES = 5
MIN_ERRORS = 3.0
_BAD = "label=block"


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; both null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for at, start, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        rule, verdict = F.when(fits, at + start).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def url_tokens(url: Column) -> Column:
    """Distinct tokens of a URL: host labels, path segments, file ending, query keys, each with its kind."""
    host, path = host_of(url), path_of(url)
    query = F.coalesce(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit(""))
    kinds = [
        F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("host="), x)),
        F.transform(F.split(path, "/"), lambda x: F.concat(F.lit("path="), x)),
        F.array(F.concat(F.lit("ending="), F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1))),
        F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("query="), F.substring_index(x, "=", 1))),
    ]
    return F.array_distinct(F.filter(F.concat(*kinds), lambda x: ~x.endswith("=")))


def mined_rules(
    pages: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
    min_pages: int = MIN_PAGES, min_errors: float = MIN_ERRORS,
) -> DataFrame:
    """``rule_id, tokens, n_tokens, confidence, support`` of the rules that lead from URL tokens to a bad label.

    Every labelled page counts (``labels.doc_id`` names the page; quality 0 is bad; a page that has several labels counts
    with each, rows with a null label or id with none). Supported token sets come from FP-growth, which Spark shards by
    item. A rule needs the support and at least ``min_pages`` bad pages, so that no rule rests on a page or two where labels are
    few, and the confidence, which must be ``min_errors`` standard errors above the share of bad pages: the error of a share among
    as many pages drawn from all. Where all labels are bad no token tells more than the share does, and there is no rule. A rule whose
    tokens include those of another kept rule adds nothing and goes; rules may have any number of tokens.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select("doc_id", (F.col("quality") == 0).alias("bad"))
    urls = pages.select(F.col("page_id").alias("doc_id"), url_tokens(F.col("url")).alias("tokens"))
    rows = known.join(urls, "doc_id").where(F.size("tokens") > 0)
    baskets = rows.select("bad", F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(_BAD)))).otherwise(F.col("tokens")).alias("items"))
    baskets = stored(baskets, "url-baskets")
    total, base = baskets.agg(F.count(F.lit(1)), F.avg(F.col("bad").cast("double"))).first()
    if not base:
        schema = "rule_id long, tokens array<string>, n_tokens int, confidence double, support double"
        return pages.sparkSession.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(min_support, min_pages / total)), minConfidence=0.0).fit(baskets)
    sets = stored(model.freqItemsets.select(F.sort_array("items").alias("items"), F.col("freq").alias("n")), "url-sets")
    bad = sets.where(F.array_contains("items", _BAD)).select(F.array_remove("items", _BAD).alias("items"), F.col("n").alias("n_bad"))
    share = F.col("n_bad") / F.col("n")
    error = F.sqrt(F.lit(base * (1 - base)) / F.col("n"))
    sets = bad.where(F.size("items") > 0).join(sets, "items").select(
        F.xxhash64("items").alias("rule_id"), F.col("items").alias("tokens"), F.size("items").alias("n_tokens"),
        share.alias("confidence"), (F.col("n_bad") / F.lit(total)).alias("support"),
        ((F.col("n_bad") >= min_pages) & (share >= min_confidence) & (share > base) & (share - base >= error * min_errors)).alias("fits"),
    )
    return _shortest(stored(sets, "url-rules"))


def _shortest(sets: DataFrame) -> DataFrame:
    """The sets that fit and of whose proper subsets none does. Subsets of a supported set are supported, so a set is covered
    if one of those a token smaller fits or is covered: one round per length, up to the tokens of the longest URL pattern."""
    longest = sets.agg(F.max("n_tokens")).first()[0] or 0
    covering, kept = None, sets.where("fits AND n_tokens = 1")
    for length in range(2, longest + 1):
        below = sets.where((F.col("n_tokens") == length - 1) & F.col("fits")).select("tokens")
        below = below if covering is None else below.unionByName(covering).distinct()
        level = sets.where(F.col("n_tokens") == length)
        parts = level.select(F.col("tokens").alias("whole"), F.explode(F.transform("tokens", lambda t: F.array_remove("tokens", t))).alias("tokens"))
        covering = stored(parts.join(below, "tokens", "left_semi").select(F.col("whole").alias("tokens")).distinct(), "url-covered")
        kept = kept.unionByName(level.where("fits").join(covering, "tokens", "left_anti").select(*sets.columns))
    return kept.drop("fits")


def matches(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``page_id, url`` and the number of mined rules ``n_rules`` that fit, for the pages that some rule fits.

    Inverted index from token to rules: a page's tokens fetch the rules they belong to, and a rule fits when all its tokens
    have met. The work follows the tokens of the pages; distinct URLs are matched once.
    """
    index = rules.select("rule_id", "n_tokens", F.explode("tokens").alias("token"))
    urls = pages.select("url").where("url IS NOT NULL").distinct()
    tokens = urls.select("url", F.explode(url_tokens(F.col("url"))).alias("token"))
    met = tokens.join(sized(index), "token").groupBy("url", "rule_id", "n_tokens").agg(F.count(F.lit(1)).alias("n"))
    return met.where("n = n_tokens").groupBy("url").agg(F.count(F.lit(1)).alias("n_rules"))


def judge_urls(
    pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, **mining: float
) -> DataFrame:
    """One row per row of ``pages`` (``page_id`` and ``url`` are read): ``page_id, host, path, rule, verdict, n_rules``.

    A listed rule decides if one fits, the longest first. Otherwise the page is blocked if a mined rule fits (``n_rules``
    says how many do) and allowed if none does. A null or relative url has an empty host and path and no tokens, and is
    allowed. Repeated pages are judged each. With no labels there are no mined rules.
    """
    found = matches(pages, mined_rules(pages, labels, **mining)).withColumnRenamed("url", "_url")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, says = listed(host, path, rules)
    joined = pages.select("page_id", "url").join(found, F.col("url") == F.col("_url"), "left")
    mined = F.when(F.col("n_rules") > 0, "block").otherwise("allow")
    return joined.select(
        "page_id", host.alias("host"), path.alias("path"), rule.alias("rule"), F.coalesce(says, mined).alias("verdict"),
        F.coalesce("n_rules", F.lit(0)).alias("n_rules"),
    )
