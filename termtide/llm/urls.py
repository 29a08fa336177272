"""URL filters: host and path rules, and gradient-boosted trees on lexical features for the rest.

DataFrame operations and Spark's own tree ensembles only. URLs that a rule judges are the labelled rows;
the trees learn from at most `sample` of them (the bound on training, in hash order) and judge the URLs
that no rule fits. Suffix statistics are taken over all labelled rows.

Null URLs and URLs without `://` have an empty host and path and are judged by the trees like any other;
URLs of any length are read whole; of rules that fit with names of one length the first by name counts; repeated rows
get equal verdicts; an empty table gives no rows; other columns, whatever their names, are ignored. Where the
labelled rows hold a single verdict (or none), the rest get that verdict (or `allow`).
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termtide.llm.common import cut


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)
FEATURES = (
    "length", "host_length", "path_length", "depth", "labels", "digits", "digit_ratio", "hyphens", "params",
    "query_length", "has_fragment", "is_https", "entropy", "longest_label", "tld_rate", "suffix_rate", "suffix_rows",
)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lowered, and path; both empty for null or without `://`."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return tuple(F.coalesce(c, F.lit("")) for c in (F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path))


def judge(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, or null."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    pick = lambda value: F.coalesce(*(F.when(r.fits(host, path), F.lit(value(r))) for r in ordered))
    return pick(lambda r: r.name), pick(lambda r: r.verdict)


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _features(pages: DataFrame) -> DataFrame:
    url = F.coalesce(F.col("url"), F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    labels = F.split("host", r"\.")
    chars = F.split(url, "")
    share = lambda c: F.size(F.filter(chars, lambda x: x == c)) / F.greatest(F.length(url), F.lit(1))
    entropy = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda s, c: s - F.when(c == "", 0.0).otherwise(share(c) * F.log2(F.greatest(share(c), F.lit(1e-9)))))
    return pages.withColumns({
        "length": F.length(url), "host_length": F.length("host"), "path_length": F.length("path"),
        "depth": _count(F.col("path"), "/"), "labels": F.size(labels), "digits": _count(url, "[0-9]"),
        "hyphens": _count(F.col("host"), "-"), "query_length": F.length(query),
        "params": F.when(query == "", 0).otherwise(_count(query, "&") + 1), "has_fragment": url.contains("#").cast("int"),
        "is_https": url.startswith("https").cast("int"), "entropy": entropy,
        "longest_label": F.array_max(F.transform(labels, F.length)),
        "tld": F.element_at(labels, -1), "suffix": F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2)),
    }).withColumn("digit_ratio", F.col("digits") / F.greatest("length", F.lit(1)))


def _rates(labelled: DataFrame, key: str) -> DataFrame:
    blocked = (F.col("verdict") == "block").cast("int")
    rate = (F.sum(blocked) + 1) / (F.count(F.lit(1)) + 2)
    return labelled.groupBy(key).agg(rate.alias(f"{key}_rate"), F.log1p(F.count(F.lit(1)).cast("double")).alias(f"{key}_rows"))


def filter_urls(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[Rule, ...] = RULES,
    sample: int = 10_000, trees: int = 12, depth: int = 3, seed: int = 7,
) -> DataFrame:
    """(id, host, path, rule, verdict) of each row."""
    host, path = split_url(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = judge(F.col("host"), F.col("path"), rules)
    known = cut(_features(parts.withColumns({"rule": rule, "verdict": verdict})))
    labelled = known.where(F.col("verdict").isNotNull())
    tld = _rates(labelled, "tld")
    suffix = _rates(labelled, "suffix")
    full = known.join(tld, "tld", "left").join(suffix, "suffix", "left").na.fill(0.5, ["tld_rate", "suffix_rate"]).na.fill(0.0, ["suffix_rows"])
    classes = [r[0] for r in labelled.select("verdict").distinct().collect()]
    if len(classes) < 2:
        return known.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", F.lit(classes[0] if classes else "allow")).alias("verdict"))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    taught = full.where(F.col("verdict").isNotNull()).orderBy(F.xxhash64("url"), "url", "id").limit(sample)
    taught = taught.withColumn("label", (F.col("verdict") == "block").cast("double"))
    model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed).fit(cut(vectors.transform(taught).select("features", "label")))
    scored = model.transform(vectors.transform(full))
    learned = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
    return scored.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", learned).alias("verdict"))
