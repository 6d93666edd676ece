"""URL filters: rules by host and path, and gradient-boosted trees on lexical features for what no rule decides.

Features are built-in expressions on the url: lengths, depth, digit ratio, entropy of the host's characters, hyphens,
parameter counts, and how often urls whose host ends in the same labels were labelled to block. The trees are fitted
on at most `max_rows` labelled urls of each class, the first by hash, so the sample is bounded and the same each time.
Suffix counts come from all distinct labelled urls; they are joined to the distinct hosts and these to the urls, without
a broadcast of our own. The urls that the trees are fitted on get theirs from the other folds only, so that a rate does
not hold its own label. All urls are then judged. If one class has no labelled url, the method allows everything.

A null url, or one without "://", has an empty host and path and is judged on its features like any other. Of rules
that fit, the longest text wins; equal ones are the same rule. Rows that repeat are judged alike; an empty table gives
an empty result. Input columns named host, path, rule or verdict are replaced, all others pass unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linemart.llm.shared import checkpointed, renamed, restored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["url_chars", "host_chars", "path_chars", "depth", "digit_ratio", "host_entropy", "host_hyphens", "host_labels", "n_params", "longest_label", "rate1", "rate2", "rate3"]


@dataclass(frozen=True)
class UrlRule:
    """`text` is host and path, like `example.net/en/`; it fits the host and its subdomains and paths that start so."""

    action: str
    text: str

    def fits(self, host: Column, path: Column) -> Column:
        own, slash, rest = self.text.partition("/")
        return ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(rules: list[UrlRule], host: Column, path: Column) -> Column:
    """The longest rule that fits, as a struct of text and action, or null."""
    out = F.lit(None).cast("struct<text:string,action:string>")
    for r in sorted(rules, key=lambda r: len(r.text)):
        out = F.when(r.fits(host, path), F.struct(F.lit(r.text).alias("text"), F.lit(r.action).alias("action"))).otherwise(out)
    return out


def suffix(host: Column, labels: int) -> Column:
    """The last labels of a host; the host itself if it has fewer."""
    return F.substring_index(host, ".", -labels)


def with_lexical(df: DataFrame, url_col: str = "url") -> DataFrame:
    """df with the features that need nothing but the url."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    host, path = host_of(url), path_of(url)
    kinds = F.array(*[F.lit(c) for c in LOWER + "0123456789-."])
    n = F.greatest(F.length("_host"), F.lit(1))
    shares = F.transform(kinds, lambda c: (F.length("_host") - F.length(F.replace(F.col("_host"), c, F.lit("")))) / n)
    entropy = F.aggregate(shares, F.lit(0.0), lambda acc, p: acc - F.when(p > 0, p * F.log2(F.greatest(p, F.lit(1e-12)))).otherwise(0.0))
    labels = F.split(F.col("_host"), r"\.")
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    digits = F.length(url) - F.length(F.regexp_replace(url, "[0-9]", ""))
    out = df.withColumn("_host", host).withColumn("_path", path)
    return out.withColumns({
        "url_chars": F.length(url).cast("double"), "host_chars": F.length("_host").cast("double"), "path_chars": F.length("_path").cast("double"),
        "depth": F.size(F.filter(F.split("_path", "/"), lambda x: x != "")).cast("double"),
        "digit_ratio": digits / F.greatest(F.length(url), F.lit(1)), "host_entropy": entropy,
        "host_hyphens": (F.length("_host") - F.length(F.replace(F.col("_host"), F.lit("-"), F.lit("")))).cast("double"),
        "host_labels": F.size(labels).cast("double"),
        "n_params": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "[&;]")).cast("double")),
        "longest_label": F.array_max(F.transform(labels, lambda x: F.length(x))).cast("double"),
    })


FOLDS = 5


def fold_of(url: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("fold"), url), F.lit(FOLDS))


@dataclass
class UrlModel:
    trees: GBTClassificationModel | None
    suffixes: list[DataFrame]
    prior: float

    def features(self, lexical: DataFrame) -> DataFrame:
        hosts = lexical.select("_host").distinct()
        for k, rates in enumerate(self.suffixes, 1):
            known = rates.select(F.col("suffix").alias(f"_s{k}"), F.col("rate").alias(f"rate{k}"))
            hosts = hosts.join(known, suffix(F.col("_host"), k) == F.col(f"_s{k}"), "left").drop(f"_s{k}")
        return assembled(lexical.join(hosts, "_host", "left"), self.prior)

    def blocks(self, df: DataFrame, url_col: str = "url", out_col: str = "blocks") -> DataFrame:
        """df with a boolean: whether the trees put the url among those to block."""
        if self.trees is None:
            return df.withColumn(out_col, F.lit(False))
        own, name = renamed(df)
        made = self.trees.transform(self.features(with_lexical(own, name[url_col])))
        return made.select(*restored({c: x for c, x in name.items() if c != out_col}), (F.col("_prediction") > 0.5).alias(out_col))


def assembled(lexical: DataFrame, prior: float) -> DataFrame:
    known = lexical.fillna(prior, ["rate1", "rate2", "rate3"])
    return VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(known)


def fit(labelled: DataFrame, url_col: str = "url", label_col: str = "label", max_rows: int = 5000, rounds: int = 12, depth: int = 3, weight: float = 10.0) -> UrlModel:
    """Trees fitted on labelled urls, label 1 to block and 0 to allow; others are left out.

    A hash range that holds about half as many again as wanted is taken first, so what is sorted does not grow with the input.
    """
    urls = labelled.select(F.col(url_col).alias("url"), F.col(label_col).cast("double").alias("label")).filter("url is not null and label in (0, 1)")
    known = checkpointed(urls.dropDuplicates().withColumn("_host", host_of(F.col("url"))).withColumn("_fold", fold_of(F.col("url"))))
    counts = dict(known.groupBy("label").count().collect())
    low = lambda v: F.pmod(F.xxhash64("url"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, 1.5 * max_rows / counts.get(v, 1))) + 1
    each = [known.select("url", "label", "_fold").filter((F.col("label") == v) & low(v)).orderBy(F.xxhash64("url"), "url").limit(max_rows) for v in (0.0, 1.0)]
    sample = checkpointed(with_lexical(each[0].unionByName(each[1])))
    if len(counts) < 2:
        return UrlModel(None, [], 0.0)
    prior = counts[1.0] / sum(counts.values())
    rate = lambda hits, n: (hits + prior * weight) / (n + weight)
    rates = []
    for k in (1, 2, 3):
        folds = checkpointed(known.groupBy(suffix(F.col("_host"), k).alias("suffix"), F.col("_fold").alias("fold")).agg(F.sum("label").alias("hits"), F.count("*").alias("n")))
        whole = checkpointed(folds.groupBy("suffix").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n")))
        rates.append(whole.select("suffix", rate(F.col("hits"), F.col("n")).alias("rate")))
        mine = folds.alias("f").join(whole.alias("w"), "suffix").select(
            F.col("suffix").alias("_s"), F.col("fold").alias("_f"), rate(F.col("w.hits") - F.col("f.hits"), F.col("w.n") - F.col("f.n")).alias(f"rate{k}")
        )
        sample = sample.join(mine, (suffix(F.col("_host"), k) == F.col("_s")) & (F.col("_fold") == F.col("_f")), "left").drop("_s", "_f")
    model = UrlModel(None, rates, prior)
    trees = GBTClassifier(featuresCol="_features", labelCol="label", predictionCol="_prediction", maxIter=rounds, maxDepth=depth, maxBins=32, seed=7)
    trees.setRawPredictionCol("_raw").setProbabilityCol("_probability")
    model.trees = trees.fit(assembled(sample, prior).select("url", "_features", "label").coalesce(1).sortWithinPartitions("url", "label"))
    return model


def judge(urls: DataFrame, rules: list[UrlRule], model: UrlModel, url_col: str = "url") -> DataFrame:
    """urls with host, path, rule (its text or null) and verdict: the rule's action, else block or allow by the trees."""
    own, name = renamed(urls.drop("host", "path", "rule", "verdict"))
    url = F.col(name[url_col])
    made = model.blocks(own, name[url_col], "_blocks").withColumns({"host": host_of(url), "path": path_of(url)})
    made = made.withColumn("_rule", rule_for(rules, F.col("host"), F.col("path")))
    by_trees = F.when(F.col("_blocks"), "block").otherwise("allow")
    return made.select(*restored(name), "host", "path", F.col("_rule.text").alias("rule"), F.coalesce(F.col("_rule.action"), by_trees).alias("verdict"))
