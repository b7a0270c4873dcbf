"""URL filter: rules first, then logistic regression on hashed character
n-grams of host and path. DataFrame functions only.

The model is trained on a small labelled URL table (a parameter; the default
below is a fixed list). Its weights are one array of ``DIM`` doubles, whatever
the number of pages, and pages are judged row by row without a shuffle."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise
from .logistic import sigmoid, train

DIM = 4096
SIZES = (3, 4)
URL = "(?s)^.*?://([^/?#]*+)([^?#]*+)"
MAX_LABELLED = 1000                       # bound of the labelled table (rows)
# (verdict, host, path); fixed values of the contract
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
# Hosts of the default labelled table.
BLOCKED_HOSTS = (
    "cheap-pills", "spam-farm", "casino-bonus", "free-pills", "adult-videos", "best-casino", "link-farm", "spam-links",
    "win-prizes", "cheap-watches", "hot-singles", "payday-loans", "viagra-cheap", "porn-tube", "poker-bets",
    "cracked-warez", "malware-exe", "phishing-login", "clickbait-ads", "seo-spam", "casino-win", "ads-track",
    "free-bets", "track-ads", "online-casino", "bets-bonus", "pills-shop", "free-win", "xxx-videos", "banner-ads")
ALLOWED_HOSTS = (
    "library", "garden", "news", "docs", "weather", "museum", "history", "travel", "school", "science", "recipes",
    "maths", "health", "forum", "theatre", "research", "other", "thenews", "nature", "theocean", "thread", "therapy",
    "ether", "leather", "thesis", "gather", "northern", "anthem", "thinker", "weathering")
LANGS, PREFIXES, ENDINGS = ("en", "de", "fr", "es"), ("", "www.", "blog.", "m."), ("com", "org", "net")


def labelled_table(spark: SparkSession) -> DataFrame:
    """The default labelled URLs: both classes have the same prefixes, endings and
    paths, so that only the host's own name tells them apart."""
    rows = [(f"http://{PREFIXES[(i + j) % 4]}{host}.example.{ENDINGS[(i + j) % 3]}/{LANGS[(i // 3 + j) % 4]}/{137 * i + j}",
             blocked)
            for blocked, hosts in ((1, BLOCKED_HOSTS), (0, ALLOWED_HOSTS))
            for i, host in enumerate(hosts) for j in range(1)]
    return spark.createDataFrame(rows, "url string, blocked int")


def with_parts(df: DataFrame) -> DataFrame:
    """Add host (A-Z lower-cased) and path; both empty without ``://``."""
    url = F.coalesce("url", F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return (df.withColumn("host", F.translate(F.regexp_extract(url, URL, 1), upper, lower))
            .withColumn("path", F.regexp_extract(url, URL, 2)))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """(verdict, rule) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<verdict: string, rule: string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):     # longest last: outermost
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))).otherwise(out)
    return out


def gram_buckets(chars: Column, part: str) -> Column:
    """Hashed n-grams of an array of characters, as feature numbers."""
    def grams(n):
        last = F.size(chars) - n
        return F.when(last >= 0, F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.pmod(F.xxhash64(F.lit(part), *[F.get(chars, i + j) for j in range(n)]),
                             F.lit(DIM)).cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.concat(*[grams(n) for n in SIZES])


def with_features(df: DataFrame) -> DataFrame:
    """Add ``grams`` from host and path; an n-gram never crosses the two."""
    d = (df.withColumn("_h", F.split(F.concat(F.lit("^"), "host", F.lit("$")), ""))
         .withColumn("_p", F.split(F.col("path"), "")))
    return d.withColumn("grams", F.concat(gram_buckets(F.col("_h"), "h"), gram_buckets(F.col("_p"), "p"))
                        ).drop("_h", "_p")


def train_weights(labelled: DataFrame) -> DataFrame:
    """One row: ``weights``, an array of DIM doubles and the bias at its end."""
    rows = (with_features(with_parts(labelled.select("url", "blocked").filter("blocked is not null").distinct()
                                     .orderBy(F.xxhash64("url", "blocked")).limit(MAX_LABELLED)))
            .select(F.xxhash64("url", "blocked").alias("row"), F.col("blocked").cast("double").alias("target"),
                    F.lit(1.0).alias("weight"), "grams"))
    value = F.lit(1.0) / F.sqrt(F.greatest(F.size("grams"), F.lit(1)).cast("double"))
    feats = rows.select("row", F.explode(F.concat("grams", F.array(F.lit(DIM)))).alias("feature"),
                        value.alias("value"))
    w = train(rows.drop("grams"), feats, epochs=250, rate=8.0, decay=0.0005)
    return w.groupBy().agg(F.map_from_entries(F.collect_list(F.struct("feature", "w"))).alias("m")).select(
        F.transform(F.sequence(F.lit(0), F.lit(DIM)),
                    lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0))).alias("weights"))


def filter_urls(pages: DataFrame, labelled: DataFrame | None = None, rules=RULES) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule (null where none
    fits), verdict (allow or block: the rule's, else the model's) and score (the
    model's probability of block).

    A null url, or one without ``://``, has an empty host and path; no rule fits
    it and the model judges it by its bias. URLs of any length are read whole.
    Repeated rows each give a row; an empty table gives none; other columns are
    not read."""
    spark = pages.sparkSession
    weights = materialise(train_weights(labelled if labelled is not None else labelled_table(spark)), "url-weights")
    d = with_features(with_parts(pages.select("page_id", "url")))
    d = d.withColumn("_w", weights.select("weights").scalar())
    n = F.sqrt(F.greatest(F.size("grams"), F.lit(1)).cast("double"))
    logit = F.aggregate(F.col("grams"), F.get("_w", F.lit(DIM)),
                        lambda s, g: s + F.get(F.col("_w"), g)) / n
    d = d.withColumn("score", sigmoid(logit)).withColumn("_r", rule_of(F.col("host"), F.col("path"), rules))
    return d.select("page_id", "host", "path", F.col("_r.rule").alias("rule"),
                    F.coalesce("_r.verdict", F.when(F.col("score") > 0.5, "block").otherwise("allow")).alias("verdict"),
                    "score")
