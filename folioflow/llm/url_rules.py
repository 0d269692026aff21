"""URL filters: stated host rules, and association rules mined from labels.

A URL becomes a set of tokens: labels of the host, parts of the path with their
numbers masked, and keys of the query. FP-growth finds token combinations that
are frequent among labelled URLs; those that imply a bad label with enough
support and confidence are rules, less those that say no more than a rule of
fewer tokens. Enough support is a share and a number of URLs; enough confidence is
more than chance gives at the share of bad labels. Tokens that stand in the very
same URLs, as the parts of a template do, are one item for mining, or each of their
combinations would be a set of its own; a URL has the item if it has any of them.
An inverted index leads from a rule's rarest token to the rule, so
a URL meets only rules that it may fit, and each distinct URL is judged once.

Tokens in nearly all URLs tell nothing and would double every combination; they
take no part. All of it is DataFrame work and Spark's own FP-growth.

Defined results: a NULL url, or one without ``://``, has an empty host and path,
no tokens, no rule and the verdict allow; repeated rows are judged alike; labels
that are NULL count as not bad; without labelled rows no rule is mined.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.session import new_run_folder

BAD = "label:bad"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"


@dataclass(frozen=True)
class Settings:
    support: float = 0.002  # share of labelled URLs with the tokens and a bad label
    least_urls: int = 20  # and at least so many of them, however few are labelled
    confidence: float = 0.5
    sigmas: float = 4.0  # standard deviations of the confidence over the share of bad labels
    common: float = 0.9  # tokens in at least this share of URLs are left out


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL, sorted."""
    named = lambda prefix, parts: F.transform(parts, lambda p: F.concat(F.lit(prefix), p))
    labels = named("host:", F.split(host_of(url), r"\."))
    path = named("path:", F.split(F.regexp_replace(path_of(url), r"\d+", "0"), "/"))
    query = F.coalesce(F.regexp_extract(url, PARTS, 3), F.lit(""))
    keys = named("query:", F.transform(F.split(query, "&"), lambda q: F.substring_index(q, "=", 1)))
    found = F.filter(F.concat(labels, path, keys), lambda t: ~t.endswith(":"))
    return F.array_sort(F.array_distinct(found))


def stated_rule(url: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest stated rule that fits; NULL where none does.

    For a short list: it becomes one expression.
    """
    host, path = host_of(url), path_of(url)
    rule = verdict = F.lit(None).cast("string")
    for text, said in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def token_items(sets: DataFrame, settings: Settings, total: int) -> DataFrame:
    """(token, item, count) of the telling tokens; tokens of the same URLs share an item.

    That they stand in the same rows is read off the sums of two hashes of the rows.
    """
    seen = sets.select(F.explode("tokens").alias("token"), "row")
    sums = [F.sum(F.xxhash64("row", F.lit(seed)).cast("decimal(38,0)")).alias(f"_{seed}") for seed in (1, 2)]
    counts = seen.groupBy("token").agg(F.count(F.lit(1)).alias("count"), *sums)
    least = max(settings.support * total, settings.least_urls)
    telling = counts.filter((F.col("count") >= least) & (F.col("count") < settings.common * total))
    alike = telling.groupBy("count", "_1", "_2").agg(F.min("token").alias("item"))
    return telling.join(alike, ["count", "_1", "_2"]).select("token", "item", "count")


RULES = "antecedent ARRAY<STRING>, members ARRAY<ARRAY<STRING>>, anchor STRING, confidence DOUBLE, support DOUBLE"


def mine_rules(labelled: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(antecedent, members, anchor, confidence, support) from (url, bad).

    An antecedent is a list of items, and members are the tokens of each of them.
    Written to the shared folder, so that mining is done once.
    """
    spark = labelled.sparkSession
    folder = new_run_folder(spark, "url-rules")
    labelled.select(tokens_of(F.col("url")).alias("tokens"), F.coalesce("bad", F.lit(False)).alias("bad")).filter(
        F.size("tokens") > 0
    ).withColumn("row", F.monotonically_increasing_id()).write.parquet(f"{folder}/sets")
    sets = spark.read.parquet(f"{folder}/sets")
    total, bad = sets.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("bad").cast("int")), F.lit(0))).first()
    token_items(sets, settings, total).write.parquet(f"{folder}/items")
    items = spark.read.schema("token STRING, item STRING, count BIGINT").parquet(f"{folder}/items")
    if items.isEmpty():
        return spark.createDataFrame([], RULES)
    # At most average tokens / support of them, so this is a short table.
    baskets = (
        sets.select("row", "bad", F.explode("tokens").alias("token"))
        .join(items, "token")
        .groupBy("row", "bad")
        .agg(F.collect_set("item").alias("own"))
        .select(F.when(F.col("bad"), F.array_append("own", F.lit(BAD))).otherwise(F.col("own")).alias("items"))
    )
    least = min(1.0, max(settings.support, settings.least_urls / total))
    # Rows without a telling token are not mined, but count in every share.
    baskets = baskets.unionByName(
        sets.join(sets.select("row", F.explode("tokens").alias("token")).join(items, "token"), "row", "left_anti").select(
            F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>")).alias("items")
        )
    )
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=settings.confidence).fit(baskets)
    base = bad / total
    # The confidence of a rule over n URLs varies by sqrt(base * (1 - base) / n) by chance.
    urls = F.col("support") * total / F.col("confidence")
    sure = F.col("confidence") >= F.lit(base) + settings.sigmas * F.sqrt(base * (1 - base) / urls)
    model.associationRules.filter(F.col("consequent") == F.array(F.lit(BAD))).filter(sure).select(
        F.array_sort("antecedent").alias("antecedent"), "confidence", "support"
    ).write.parquet(f"{folder}/mined")
    mined = spark.read.schema("antecedent ARRAY<STRING>, confidence DOUBLE, support DOUBLE").parquet(f"{folder}/mined")
    # A rule is idle if one with an item less is as sure; so are those above it.
    shorter = mined.select(
        "antecedent", "confidence", F.explode("antecedent").alias("item")
    ).select(
        "antecedent", F.col("confidence").alias("own"), F.array_except("antecedent", F.array("item")).alias("less")
    )
    fewer = mined.select(F.col("antecedent").alias("less"), F.col("confidence").alias("base"))
    idle = shorter.join(fewer, "less").filter(F.col("base") >= F.col("own")).select("antecedent").distinct()
    kept = mined.join(idle, "antecedent", "left_anti")
    tokens = items.groupBy("item").agg(F.array_sort(F.collect_list("token")).alias("tokens"), F.max("count").alias("count"))
    parts = (
        kept.select("antecedent", F.explode("antecedent").alias("item"))
        .join(tokens, "item")
        .groupBy("antecedent")
        .agg(
            F.min(F.struct("count", "item")).alias("t"),
            F.array_sort(F.collect_list(F.struct("item", "tokens"))).alias("_parts"),
        )
        .select("antecedent", F.col("t.item").alias("anchor"), F.col("_parts.tokens").alias("members"))
    )
    columns = ["antecedent", "members", "anchor", "confidence", "support"]
    kept.join(parts, "antecedent").select(*columns).write.parquet(f"{folder}/rules")
    return spark.read.schema(RULES).parquet(f"{folder}/rules")


def fitting_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, confidence, antecedent) of the surest rule for each distinct url that fits one."""
    part = F.explode(F.arrays_zip(F.col("antecedent").alias("item"), F.col("members").alias("tokens"))).alias("p")
    items = rules.select(part).select("p.item", F.explode("p.tokens").alias("token")).distinct()
    tokens = urls.select("url").filter(F.col("url").isNotNull()).distinct().withColumn("tokens", tokens_of(F.col("url")))
    own = (
        tokens.select("url", F.explode("tokens").alias("token"))
        .join(items, "token")
        .groupBy("url")
        .agg(F.collect_set("item").alias("items"))
    )
    met = own.select("url", "items", F.explode("items").alias("anchor")).join(rules.drop("members"), "anchor")
    fits = met.filter(F.size(F.array_except("antecedent", "items")) == 0)
    return (
        fits.groupBy("url")
        .agg(F.max(F.struct("confidence", F.array_join("antecedent", " ").alias("antecedent"))).alias("r"))
        .select("url", "r.confidence", "r.antecedent")
    )


def judge_urls(
    pages: DataFrame, labelled: DataFrame, stated: Sequence[tuple[str, str]] = (), settings: Settings = Settings()
) -> DataFrame:
    """(page_id, host, path, rule, verdict, confidence, mined) of every page.

    ``verdict`` is the stated rule's, else block where a mined rule fits.
    """
    found = fitting_rules(pages, mine_rules(labelled, settings)).withColumnRenamed("antecedent", "mined")
    rule, verdict = stated_rule(F.col("url"), stated)
    return (
        pages.select("page_id", "url")
        .join(found, "url", "left")
        .select(
            "page_id",
            host_of(F.col("url")).alias("host"),
            path_of(F.col("url")).alias("path"),
            rule.alias("rule"),
            F.coalesce(verdict, F.when(F.col("mined").isNotNull(), "block").otherwise("allow")).alias("verdict"),
            "confidence",
            "mined",
        )
    )
