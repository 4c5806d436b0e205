"""URL rules and a gradient-boosted classifier on lexical features.

A URL that a rule fits takes the rule's verdict. The rest is judged by
gradient-boosted trees trained on labelled URLs (here: those that rules
decide), over features of the URL text alone: lengths, depth, digit ratio,
entropy, parameter counts and statistics of the host's last label.
DataFrame functions and Spark ML only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import attach_groups, materialize, prepare

# Fixed values of this query's rule list: (verdict, host and path).
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
FEATURES = ("url_len", "host_len", "path_len", "depth", "labels", "digit_ratio", "host_digits", "hyphens", "entropy",
            "params", "suffix_share", "suffix_weight")
ALLOW, BLOCK = "allow", "block"
# Statistics of up to this many suffixes are broadcast; more meet the rows in
# a shuffle join.
BROADCAST_SUFFIXES = 200_000


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): the host runs from the first ``://`` to ``/``, ``?``,
    ``#`` or the end, A-Z lower-cased; the path from there to ``?``, ``#`` or
    the end. Both are empty if the URL is null or has no ``://``."""
    pattern = r"^(?s:.*?)://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(text, pattern, 1), upper, upper.lower()), F.regexp_extract(text, pattern, 2)


def match_rules(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, both null if none does.
    A rule fits its host and every subdomain where the path starts with its
    path. Of rules of equal length the first in the list counts."""
    rule = verdict = F.lit(None).cast("string")
    ordered = sorted(enumerate(rules), key=lambda x: (-len(x[1][1]), x[0]))
    for _, (says, text) in reversed(ordered):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    n = F.length(text)
    terms = F.transform(F.array_distinct(F.split(text, "")),
                        lambda c: F.when(c == "", F.lit(0.0)).otherwise(
                            _plogp((n - F.length(F.replace(text, c, F.lit("")))) / n)))
    return F.when(n > 0, F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)).otherwise(F.lit(0.0))


def _plogp(p: Column) -> Column:
    return F.when(p > 0, -p * F.log2(p)).otherwise(F.lit(0.0))


def lexical(pages: DataFrame, keep: str = "page_id") -> DataFrame:
    """Adds host, path, suffix and the lexical features to (page_id, url), or
    another column in place of page_id."""
    host, path = split_url(F.col("url"))
    df = pages.select(keep, F.coalesce(F.col("url"), F.lit("")).alias("url")).withColumns({"host": host, "path": path})
    n = F.length("url")

    def digits(c: str) -> Column:
        return (F.length(c) - F.length(F.translate(F.col(c), "0123456789", ""))).cast("double")

    query = F.regexp_extract("url", r"\?([^#]*)", 1)
    return df.withColumns({
        "suffix": F.element_at(F.split("host", r"\."), -1),
        "url_len": n.cast("double"), "host_len": F.length("host").cast("double"), "path_len": F.length("path").cast("double"),
        "depth": (F.length("path") - F.length(F.replace(F.col("path"), F.lit("/"), F.lit("")))).cast("double"),
        "labels": F.size(F.split("host", r"\.")).cast("double"),
        "digit_ratio": F.when(n > 0, digits("url") / n).otherwise(F.lit(0.0)),
        "host_digits": digits("host"),
        "hyphens": (F.length("host") - F.length(F.replace(F.col("host"), F.lit("-"), F.lit("")))).cast("double"),
        "entropy": entropy(F.col("url")),
        "params": F.when(query == "", F.lit(0.0)).otherwise(
            (F.length(query) - F.length(F.replace(query, F.lit("&"), F.lit(""))) + 1).cast("double")),
    })


def suffix_stats(features: DataFrame, label: str = "label") -> tuple[DataFrame, float]:
    """(statistics, share of allow), counted over all rows: per suffix its
    rows, its smoothed share of allowed labels and its weight (the latter two
    null if no row of it has a label). The share is 1 without labels."""
    counts = materialize(features.groupBy("suffix").agg(F.sum(label).alias("allowed"), F.count(label).alias("labelled"),
                                                        F.count(F.lit(1)).alias("suffix_rows")), "url-suffixes")
    allowed, n = counts.agg(F.sum("allowed"), F.sum("labelled")).first()
    share = allowed / n if n else 1.0
    return counts.select("suffix", "suffix_rows", *[F.when(F.col("labelled") > 0, c).alias(name) for name, c in (
        ("suffix_share", (F.col("allowed") + 10 * F.lit(share)) / (F.col("labelled") + 10)), ("suffix_weight", F.log1p("labelled")))]), share


def _with_suffix(df: DataFrame, stats: DataFrame, prior: float) -> DataFrame:
    """Adds the smoothed share of allowed URLs of the suffix and its weight."""
    if stats.count() <= BROADCAST_SUFFIXES:
        labelled = stats.filter(F.col("suffix_share").isNotNull()).drop("suffix_rows")
        df = df.join(F.broadcast(labelled), "suffix", "left")
    else:
        # any suffix may be on a third of the rows, with or without labels
        df = materialize(df, "url-features")
        df = attach_groups(df, stats, "suffix", "suffix_rows", df.count()).drop("suffix_rows")
    return df.withColumns({"suffix_share": F.coalesce("suffix_share", F.lit(prior)),
                           "suffix_weight": F.coalesce("suffix_weight", F.lit(0.0))})


def train(features: DataFrame, label: str = "label", sample_rows: int = 20_000, rounds: int = 10,
          depth: int = 3) -> tuple[Model | None, DataFrame, float]:
    """Boosted trees on a bounded sample: the ``sample_rows`` distinct
    labelled URLs that come first by a hash of the URL (an equal share by
    suffix isn't enforced). ``label`` is 1 for allow, 0 for block, null for
    unlabelled. Returns (model, suffix statistics, share of allow); only the
    fit is on the sample, the other two count all labelled rows. No model if
    the sample hasn't two classes."""
    stats, share = suffix_stats(features, label)
    urls = features.filter(F.col(label).isNotNull()).select("url", label).distinct()
    sample = urls.orderBy(F.xxhash64("url"), "url", label).limit(sample_rows).checkpoint()
    if sample.select(label).distinct().count() < 2:
        return None, stats, share
    data = _assemble(_with_suffix(lexical(sample, label), stats, share)).select("features", F.col(label).cast("double").alias("label"))
    return GBTClassifier(maxIter=rounds, maxDepth=depth, seed=7).fit(data), stats, share


def _assemble(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(df)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule and verdict for every row of ``pages``.

    Null and odd URLs have an empty host and path, no rule, and the method's
    verdict. Where no labels of both kinds exist the method says what the
    majority says (allow without any). Repeated rows are judged each."""
    prepare(pages.sparkSession)
    rows = lexical(pages)
    rule, verdict = match_rules(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "said": verdict})
    rows = rows.withColumn("label", F.when(F.col("said") == ALLOW, 1).when(F.col("said") == BLOCK, 0))
    model, stats, share = train(rows)
    full = _with_suffix(rows, stats, share)
    if model is None:
        full = full.withColumn("prediction", F.lit(1.0 if share >= 0.5 else 0.0))
    else:
        full = model.transform(_assemble(full))
    return full.select("page_id", "host", "path", "rule",
                       F.coalesce("said", F.when(F.col("prediction") >= 0.5, ALLOW).otherwise(BLOCK)).alias("verdict"))
