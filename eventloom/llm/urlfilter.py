"""URL verdicts: host and path rules, and boosted trees on lexical features.

Rules decide the urls they fit; these are also the labelled urls that the trees
learn from. All others get the trees' verdict. The features are lexical: lengths,
depth, ratios of digits and letters, entropy of the characters, counts of
parameters and signs, and statistics of the host's suffix (its last two labels,
and its last one): how many urls it has, over all urls, and the share of blocked
ones among the labelled urls of other hosts, smoothed. A rule speaks of a host or a
domain, so the labels there repeat it: a row's own host counts nothing for the share of its
domain, and its own domain nothing for that of its last label. Otherwise the trees
would learn the rules' names and nothing of the urls.

Expressions stay in SQL. Statistics are aggregated per suffix before they are
joined, so the join's other side has one row per suffix, and a suffix with most
urls is split by the join. The trees are trained by Spark on a sample of about
``sample_rows`` labelled rows, a documented bound.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import sampled
from eventloom.staging import stage

#: Pseudo counts of a suffix without labelled urls.
PRIOR = 5.0
LEXICAL = ("length", "host_length", "path_length", "depth", "labels", "digit_ratio", "letter_ratio", "entropy", "parameters", "equals", "hyphens", "percents", "longest_digits", "secure", "fragment", "has_port")
SUFFIX = ("domain_urls", "domain_blocked", "top_urls", "top_blocked")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased. Else empty."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule (``host/path``) that fits, or null; ties in alphabetical order.

    A rule fits its host and the host's subdomains, if the path starts with the
    rule's path. ``rules`` is a short list of the caller's.
    """
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r), r), reverse=True):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def with_features(pages: DataFrame) -> DataFrame:
    """``pages`` (with ``url``, ``host``, ``path``) with the lexical features; a null url is empty."""
    url = F.coalesce("url", F.lit(""))
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    digits = F.length(F.regexp_replace(url, "[^0-9]", ""))
    letters = F.length(F.regexp_replace(url, "[^A-Za-z]", ""))
    counts = F.transform(F.array_distinct(F.split(url, "")), lambda c: F.when(c == "", F.lit(0)).otherwise(F.length(url) - F.length(F.replace(url, c, F.lit("")))).cast("double"))
    sums = F.aggregate(counts, F.lit(0.0), lambda total, c: total + F.when(c > 0, c * F.log2(c)).otherwise(F.lit(0.0)))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    parts = {
        "length": F.length(url),
        "host_length": F.length("host"),
        "path_length": F.length("path"),
        "depth": _count(F.col("path"), "/"),
        "labels": _count(F.col("host"), "."),
        "digit_ratio": digits / n,
        "letter_ratio": letters / n,
        "entropy": F.log2(n) - sums / n,
        "parameters": F.when(query == "", F.lit(0)).otherwise(_count(query, "&") + 1),
        "equals": _count(query, "="),
        "hyphens": _count(url, "-"),
        "percents": _count(url, "%"),
        "longest_digits": F.array_max(F.transform(F.split(url, "[^0-9]+"), lambda r: F.length(r))),
        "secure": url.startswith("https").cast("int"),
        "fragment": F.contains(url, F.lit("#")).cast("int"),
        "has_port": F.contains(F.col("host"), F.lit(":")).cast("int"),
    }
    return pages.withColumns({name: value.cast("double") for name, value in parts.items()})


def _domain() -> Column:
    return F.regexp_extract("host", r"([^.]*(?:\.[^.]*)?)$", 1)


def _top(domain: str) -> Column:
    return F.regexp_extract(domain, r"([^.]*)$", 1)


def suffix_statistics(ruled: DataFrame) -> DataFrame:
    """One staged row for each ``host``: counts of its domain and last label, and smoothed shares of blocked urls elsewhere in them."""
    labelled, blocked = F.count("label"), F.coalesce(F.sum("label"), F.lit(0.0))
    hosts = stage(ruled.groupBy("host", "domain").agg(F.count(F.lit(1)).alias("urls"), labelled.alias("labelled"), blocked.alias("blocked")), "hosts")
    sums = ("urls", "labelled", "blocked")
    domains = stage(hosts.groupBy("domain").agg(*[F.sum(c).alias(f"domain_{c}") for c in sums]), "domains").withColumn("top", _top("domain"))
    tops = stage(domains.groupBy("top").agg(*[F.sum(f"domain_{c}").alias(f"top_{c}") for c in sums]), "tops")

    def share(all_of: str, but: str) -> Column:
        return (F.col(f"{all_of}_blocked") - F.col(f"{but}blocked") + PRIOR / 2) / (F.col(f"{all_of}_labelled") - F.col(f"{but}labelled") + PRIOR)

    both = hosts.join(domains, "domain").join(tops, "top")
    shares = [share("domain", "").alias("domain_blocked"), share("top", "domain_").alias("top_blocked")]
    return stage(both.select("host", F.log1p("domain_urls").alias("domain_urls"), F.log1p("top_urls").alias("top_urls"), *shares), "suffixes")


def judge_urls(
    pages: DataFrame, rules: dict[str, str], sample_rows: int = 200_000, seed: int = 19, trees: int = 12, depth: int = 4,
    features: tuple[str, ...] = (*LEXICAL, *SUFFIX), left_out: Column | None = None,
) -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``score``.

    ``verdict`` is the rule's, else ``block`` where the trees' ``score`` is 0.5
    or more. Without labelled urls the score is 0, with labels of one kind it is
    that kind's. A null url, or one without ``://``, has an empty host and path,
    which fits no rule, and is judged by its features. Equal urls are judged
    alike; other columns are not read. ``left_out`` (over ``host``) names urls whose
    labels are not learned from, to measure the trees on them.
    """
    url = F.col("url")
    parsed = pages.select("page_id", "url").select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    verdict_of = F.create_map(*[F.lit(x) for pair in sorted(rules.items()) for x in pair]) if rules else F.create_map().cast("map<string,string>")
    ruled = parsed.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("domain", _domain())
    by_rule = F.try_element_at(verdict_of, F.col("rule"))
    ruled = ruled.withColumn("by_rule", F.when(F.col("rule").isNotNull(), by_rule)).withColumn("label", F.when(F.col("by_rule").isNotNull(), (F.col("by_rule") == "block").cast("double")))
    if left_out is not None:
        ruled = ruled.withColumn("label", F.when(~left_out, F.col("label")))
    ruled = stage(ruled, "ruled-urls")
    joined = with_features(ruled.join(suffix_statistics(ruled), "host"))
    kinds = {r.label: r["count"] for r in ruled.where("label is not null").groupBy("label").count().collect()}
    if len(kinds) < 2:
        scored = joined.withColumn("score", F.lit(float(next(iter(kinds), 0.0))))
    else:
        names = list(features)
        fraction = min(1.0, sample_rows / sum(kinds.values()))
        sample = stage(joined.where(F.col("label").isNotNull() & sampled(["page_id", "url"], fraction, seed)).select("label", *names), "url-sample")
        together = VectorAssembler(inputCols=names, outputCol="features")
        trained = GBTClassifier(featuresCol="features", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.3, maxBins=32, seed=seed).fit(together.transform(sample))
        scored = trained.transform(together.transform(joined)).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    verdict = F.coalesce("by_rule", F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow")))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
