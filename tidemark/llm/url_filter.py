"""URL filter: host and path rules, and gradient-boosted trees on lexical features for the rest.

The trees see lengths, depth, digit ratios, entropy, parameter counts and statistics of the host's suffix over
all URLs, never the URL's words. They are trained from labelled URLs.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rows import loose
from tidemark.llm.common import bare, share_of_hashes, store

# Fixed values: (rule, verdict); a rule is a host and the beginning of a path.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRAIN_ROWS = 20_000      # labelled URLs the trees are fitted on, about (by hash of the URL)
FIT_ROWS = 25_000        # of them in a partition; a fit runs some 200 stages over all its partitions
TREES, DEPTH, SEED = 20, 4, 7
CUT = 0.5                # chance of "block" from which the trees block

LEXICAL = ["url_length", "host_length", "path_length", "labels", "depth", "host_digits", "path_digits", "host_hyphens",
           "host_entropy", "path_entropy", "parameters", "query_length", "has_fragment", "is_https", "longest_label"]
SUFFIX = ["suffix_urls", "suffix_hosts", "suffix_length", "suffix_depth", "suffix_digits", "suffix_parameters"]


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without it or for null."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From behind the host to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits (of equals the first by name) and its verdict; null without one."""
    rule = verdict = F.lit(None).cast("string")
    for name, said in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        own, _, begin = name.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + begin)
        rule, verdict = F.when(fits, name).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Shannon entropy of a text's characters in bits; 0 for the empty text."""
    letters = F.filter(F.split(text, ""), lambda c: c != "")
    share = F.transform(F.array_distinct(letters), lambda c: F.size(F.filter(letters, lambda x: x == c)) / F.size(letters))
    return F.coalesce(F.aggregate(share, F.lit(0.0), lambda a, p: a - p * F.log2(p)), F.lit(0.0))


def digits(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[0-9]")) / F.greatest(F.length(text), F.lit(1))


def lexical(urls: DataFrame) -> DataFrame:
    """``urls`` (url, ...) with host, path, suffix and the lexical features."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    parts = F.split(host, r"\.")
    made = {
        "url_length": F.length(url), "host_length": F.length(host), "path_length": F.length(path),
        "labels": F.size(parts), "depth": F.regexp_count(path, F.lit("/[^/]")), "host_digits": digits(host),
        "path_digits": digits(path), "host_hyphens": F.regexp_count(host, F.lit("-")), "host_entropy": entropy(host),
        "path_entropy": entropy(path), "parameters": F.when(query != "", F.regexp_count(query, F.lit("&")) + 1).otherwise(0),
        "query_length": F.length(query), "has_fragment": url.contains("#").cast("int"),
        "is_https": F.lower(url).startswith("https://").cast("int"),
        "longest_label": F.array_max(F.transform(parts, F.length)),
    }
    cut = urls.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    return cut.withColumns({k: v.cast("double") for k, v in made.items()}).withColumn(
        "suffix", F.element_at(F.split("host", r"\."), -1))


def with_suffixes(found: DataFrame) -> DataFrame:
    """Adds statistics of each suffix over all URLs; they are folded before the shuffle and joined back."""
    per = found.groupBy("suffix").agg(
        F.log1p(F.count(F.lit(1))).alias("suffix_urls"), F.log1p(F.approx_count_distinct("host")).alias("suffix_hosts"),
        F.avg("url_length").alias("suffix_length"), F.avg("depth").alias("suffix_depth"),
        F.avg("path_digits").alias("suffix_digits"), F.avg("parameters").alias("suffix_parameters"))
    return found.join(loose(per), "suffix")


def train(featured: DataFrame, rows: int = TRAIN_ROWS) -> GBTClassificationModel | None:
    """Trees fitted on about ``rows`` URLs with a ``label`` (1: block); null without both labels."""
    known = featured.filter("label is not null")
    n = known.count()
    drawn = store(known.filter(F.xxhash64("url") <= share_of_hashes(rows, n)).select("url", *LEXICAL, *SUFFIX, "label"), "url-train")
    if drawn.select("label").distinct().count() < 2:
        return None
    # As many partitions as the sample's rows ask for, however many the cluster deals to: the trees are grown level by
    # level, two stages each. One order in few partitions makes them the same from run to run.
    few = drawn.coalesce(max(1, -(-min(n, rows) // FIT_ROWS))).sortWithinPartitions("url", *LEXICAL[:3])
    vectors = VectorAssembler(inputCols=LEXICAL + SUFFIX, outputCol="features").transform(few).select("features", "label")
    return GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, stepSize=0.2).fit(vectors)


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES, cut: float = CUT,
          labelled: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, chance) of every row of ``pages`` (page_id, url).

    ``labelled`` (url, label; 1: block) trains the trees; without it the URLs that a rule decides do. Null URLs
    and such without ``://`` have empty host and path and no rule; the trees judge them like any other. With
    labels of one kind or none, what no rule decides is allowed with chance 0. Repeated rows come out repeated.
    """
    found = store(with_suffixes(lexical(bare(pages, "page_id", "url"))), "url-features")
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    ruled = found.withColumn("rule", rule).withColumn("said", said)
    if labelled is None:
        taught = ruled.withColumn("label", F.when(F.col("said").isNotNull(), (F.col("said") == "block").cast("double")))
    else:
        own = lexical(bare(labelled, "url", "label").withColumn("label", F.col("label").cast("double")))
        stats = found.select("suffix", *SUFFIX).groupBy("suffix").agg(*[F.max(c).alias(c) for c in SUFFIX])
        taught = own.join(loose(stats), "suffix", "left").fillna(0.0, SUFFIX)
    model = train(taught)
    if model is None:
        scored = ruled.withColumn("chance", F.lit(0.0))
    else:
        vectors = VectorAssembler(inputCols=LEXICAL + SUFFIX, outputCol="features").transform(ruled)
        model.setPredictionCol("").setRawPredictionCol("")
        scored = model.transform(vectors).withColumn("chance", vector_to_array("probability")[1])
    by_trees = F.when(F.col("chance") >= cut, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("said", by_trees).alias("verdict"), "chance")
