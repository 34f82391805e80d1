"""URL filter: rules first, then gradient-boosted trees on lexical features.

URLs that a rule decides are the labelled examples. From them a boosted model learns what
blocked URLs look like: lengths, depth, share of digits, entropy of characters, parameters,
and how often hosts of the same suffix are blocked. URLs without a rule get its verdict. All
features are column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import stored

#: Labelled URLs the model is fitted on, at most; chosen by a hash.
TRAINING_ROWS = 20_000

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Verdict for a host with all its subdomains, below a path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(rules: Sequence[Rule], host: str = "host", path: str = "path") -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null if none does. Rules
    of one length cannot both fit unless they are the same."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = (F.col(host) == rule.host) | F.endswith(F.col(host), F.lit("." + rule.host))
        fits = fits & F.startswith(F.col(path), F.lit(rule.path))
        named = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, named).otherwise(found)
    return found


def suffix_of(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits: counts come from runs of sorted characters.
    With n characters and counts c it is log2(n) - sum of c * log2(c) / n."""
    characters = F.array_sort(F.filter(F.split(text, ""), lambda c: c != ""))
    total = F.size(characters).cast("double")
    bits = lambda acc: acc["sum"] + F.when(acc["n"] > 0, acc["n"] * F.log2(acc["n"])).otherwise(0.0)

    def step(acc: Column, c: Column) -> Column:
        same = c == acc["last"]
        return F.struct(
            c.alias("last"),
            F.when(same, acc["n"] + 1.0).otherwise(1.0).alias("n"),
            F.when(same, acc["sum"]).otherwise(bits(acc)).alias("sum"),
        )

    begin = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("n"), F.lit(0.0).alias("sum"))
    return F.greatest(F.log2(total) - F.aggregate(characters, begin, step, bits) / total, F.lit(0.0))


def _count(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("double")


def features(rows: DataFrame) -> DataFrame:
    """Adds the lexical features of `url`, `host` and `path` but for the suffix rate."""
    url = F.coalesce(F.col("url"), F.lit(""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    length = F.length(url).cast("double")
    return rows.withColumns(
        {
            "f_length": length,
            "f_host_length": F.length("host").cast("double"),
            "f_path_length": F.length("path").cast("double"),
            "f_depth": _count(F.col("path"), "[^/]") * -1 + F.length("path"),
            "f_labels": F.length("host") - _count(F.col("host"), "\\.") * -1 - F.length("host"),
            "f_digit_ratio": _count(url, "[0-9]") / F.greatest(length, F.lit(1.0)),
            "f_hyphens": _count(url, "-"),
            "f_entropy": F.coalesce(_entropy(url), F.lit(0.0)),
            "f_parameters": F.when(query == "", 0.0).otherwise(1.0 + _count(query, "&")),
            "f_fragment": F.when(F.contains(url, F.lit("#")), 1.0).otherwise(0.0),
        }
    )


FEATURES = [
    "f_length",
    "f_host_length",
    "f_path_length",
    "f_depth",
    "f_labels",
    "f_digit_ratio",
    "f_hyphens",
    "f_entropy",
    "f_parameters",
    "f_fragment",
    "f_suffix_rate",
]


def _with_suffix_rate(rows: DataFrame, rates: DataFrame, base: float) -> DataFrame:
    """Adds the block rate of each row's suffix. Rates have one row per suffix and are sent
    to all tasks only if small; otherwise a hot suffix is split by Spark's skewed join."""
    joined = rows.withColumn("f_suffix", suffix_of(F.col("host"))).join(rates, "f_suffix", "left")
    return joined.withColumn("f_suffix_rate", F.coalesce("f_rate", F.lit(base))).drop("f_suffix", "f_rate")


@dataclass
class UrlModel:
    """Trees, and the block rates they use; without both kinds of labels only the rate."""

    trees: GBTClassificationModel | None
    rates: DataFrame | None
    base: float

    def verdicts(self, rows: DataFrame) -> DataFrame:
        """Adds `model_verdict`."""
        if self.trees is None:
            return rows.withColumn("model_verdict", F.lit("block" if self.base > 0.5 else "allow"))
        ready = _with_suffix_rate(features(rows), self.rates, self.base)
        assembled = VectorAssembler(inputCols=FEATURES, outputCol="f_vector").transform(ready)
        predicted = self.trees.transform(assembled)
        verdict = F.when(F.col("f_predicted") == 1.0, "block").otherwise("allow")
        return predicted.withColumn("model_verdict", verdict)


def fit(labelled: DataFrame, trees: int = 12, depth: int = 4, training_rows: int = TRAINING_ROWS) -> UrlModel:
    """A model from rows of url, host, path and `blocked` (0 or 1). Suffix rates are counted
    over all labelled rows, trees are fitted on at most `training_rows` of them."""
    suffix = suffix_of(F.col("host")).alias("f_suffix")
    counted = labelled.groupBy(suffix).agg(F.count(F.lit(1)).alias("n"), F.sum("blocked").alias("blocked"))
    counted = stored(counted, "url-suffixes")
    totals = counted.agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked")).first()
    n, blocked = totals.n or 0, totals.blocked or 0
    base = blocked / n if n else 0.0
    if not 0 < base < 1:
        return UrlModel(None, None, base)
    rate = (F.col("blocked") + 4 * base) / (F.col("n") + 4)
    rates = counted.select("f_suffix", rate.alias("f_rate"))
    order = [F.xxhash64("url", "page_id"), F.col("url"), F.col("page_id")]
    sample = labelled.orderBy(*order).limit(training_rows)
    ready = _with_suffix_rate(features(sample), rates, base).withColumn("f_label", F.col("blocked").cast("double"))
    # one order of the sample, however it was joined: trees depend on it
    ready = ready.repartition(1).sortWithinPartitions(*order)
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="f_vector").transform(ready).select("f_vector", "f_label")
    learner = GBTClassifier(
        featuresCol="f_vector",
        labelCol="f_label",
        predictionCol="f_predicted",
        maxIter=trees,
        maxDepth=depth,
        seed=1,
    )
    kept = assembled.persist()
    try:
        kinds = kept.agg(F.count_distinct("f_label")).first()[0]
        return UrlModel(learner.fit(kept) if kinds == 2 else None, rates, base)
    finally:
        kept.unpersist()


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """Per row: page_id, host, path, rule (null if none fits) and verdict.

    A null url, or one without `://`, has an empty host and path, fits no rule and gets the
    model's verdict. Repeated rows are judged alike and stay. If the rules label no URL, or
    all of them alike, the verdict without a rule is that of the labelled ones, or allow. An
    empty table gives no rows; other columns are not read.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    ruled = rows.withColumn("found", rule_for(rules))
    labelled = ruled.where(F.col("found").isNotNull())
    labelled = labelled.withColumn("blocked", (F.col("found.verdict") == "block").cast("int"))
    judged = fit(labelled).verdicts(ruled)
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), F.col("model_verdict")).alias("verdict"),
    )
