"""URL filter: explicit rules first, for the rest boosted trees on lexical features.

A rule names a host and a path. It fits its host and all subdomains, for paths that start with the
rule's path; of several the longest wins. URLs that a rule judges are the labelled examples: the trees
learn the rules' verdicts from lexical features (lengths, depth, digits, entropy, parameters and
statistics of the host's suffix), so that they carry over to URLs that no rule fits.

The trees are fitted on at most ``MAX_TRAINING`` distinct labelled URLs, half of them of each verdict, those with the smallest hash. Everything
else covers all rows. Suffix statistics are kept for ``SUFFIX_CELLS`` hash cells of the suffix, which
bounds what is joined back.

Defined results: a null URL or one without ``://`` has an empty host and path and fits no rule; its
features are those of an empty text. Without any labelled URL everything else is allowed; with labels of
one kind only, everything else gets that verdict. Rows are judged one by one, so repeated rows get equal
verdicts; an empty table gives an empty table. Other columns are kept.
"""

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlark.llm.expressions import let, lower_ascii
from ledgerlark.session import stored

#: (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
MAX_TRAINING = 20_000
SUFFIX_CELLS = 256
TREES = 10
DEPTH = 4
SEED = 7

FEATURES = (
    "url_length host_length path_length depth digit_ratio upper_ratio entropy parameters fragment "
    "labels hyphens longest_segment suffix_length suffix_share suffix_blocked"
).split()


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(text, parts, 1)), F.regexp_extract(text, parts, 2)


def fitting_rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; both null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, on, at in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == on) | host.endswith("." + on)) & path.startswith(at)
        rule, verdict = F.when(fits, F.lit(on + at)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def _entropy(text: Column) -> Column:
    """Bits per character."""

    def bits(chars: Column) -> Column:
        n = F.size(chars)
        shares = F.transform(
            F.array_distinct(chars), lambda c: F.size(F.filter(chars, lambda x: x == c)) / n
        )
        return F.aggregate(shares, F.lit(0.0), lambda total, p: total - p * F.log2(p))

    return let(F.filter(F.split(text, ""), lambda c: c != ""), bits)


def lexical(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds the features of ``FEATURES`` that need no statistics, prefixed ``_f_``, and ``_cell``."""
    text = F.coalesce(F.col(url), F.lit(""))
    host, path = F.col("host"), F.col("path")
    suffix = F.substring_index(host, ".", -1)
    size = F.greatest(F.length(text), F.lit(1))

    def count(pattern: str, of: Column = text) -> Column:
        return F.length(of) - F.length(F.regexp_replace(of, pattern, ""))

    found = {
        "url_length": F.length(text),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": count("/", path),
        "digit_ratio": count("[0-9]") / size,
        "upper_ratio": count("[A-Z]") / size,
        "entropy": _entropy(text),
        "parameters": count("[?&]"),
        "fragment": count("#"),
        "labels": count("[.]", host),
        "hyphens": count("-"),
        "longest_segment": F.array_max(F.transform(F.split(path, "/"), lambda s: F.length(s))),
        "suffix_length": F.length(suffix),
    }
    found = {f"_f_{n}": c.cast("double") for n, c in found.items()}
    return df.withColumns(found | {"_cell": F.pmod(F.xxhash64(suffix), F.lit(SUFFIX_CELLS)).cast("int")})


def suffix_statistics(judged: DataFrame) -> DataFrame:
    """Per suffix cell: its share of all URLs and the smoothed share of blocked among the labelled."""
    blocked = F.sum((F.col("_verdict") == "block").cast("long"))
    labelled = F.count("_verdict")
    cells = judged.groupBy("_cell").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(blocked, F.lit(0)).alias("bad"), labelled.alias("known")
    )
    total = F.sum("n").over(Window.partitionBy())  # of at most SUFFIX_CELLS rows
    return cells.withColumn("all", total).select(
        "_cell",
        F.log((F.col("n") + 1.0) / (F.col("all") + SUFFIX_CELLS)).alias("_f_suffix_share"),
        ((F.col("bad") + 1.0) / (F.col("known") + 2.0)).alias("_f_suffix_blocked"),
    )


def judge_urls(pages: DataFrame, url: str = "url", rules: tuple = RULES) -> DataFrame:
    """Adds ``host``, ``path``, ``rule``, ``verdict`` and ``block_score`` (the trees' probability)."""
    own = ["host", "path", "rule", "verdict", "block_score"]
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in own]
    # The input's columns travel in one, so that none can have a name that is used here.
    df = pages.select(F.struct(*kept).alias("_page"), F.col(url).alias("_url"))
    url = "_url"
    host, path = split_url(F.col(url))
    df = df.withColumns({"host": host, "path": path})
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    df = df.withColumns({"rule": rule, "_verdict": verdict})
    narrow = df.select(url, "host", "path", "_verdict")
    suffix = F.pmod(F.xxhash64(F.substring_index("host", ".", -1)), F.lit(SUFFIX_CELLS)).cast("int")
    stats = stored(suffix_statistics(narrow.withColumn("_cell", suffix)), "url-suffixes")
    order = [F.xxhash64(F.lit(SEED), url), F.col(url)]
    once = narrow.filter(F.col("_verdict").isNotNull()).dropDuplicates([url])
    parts = [once.filter(F.col("_verdict") == v).orderBy(*order).limit(MAX_TRAINING // 2) for v in ("allow", "block")]
    sample = parts[0].union(parts[1])
    columns = [f"_f_{n}" for n in FEATURES]
    assembler = VectorAssembler(inputCols=columns, outputCol="_features", handleInvalid="keep")

    def featured(rows: DataFrame) -> DataFrame:
        # stats has at most SUFFIX_CELLS rows
        return assembler.transform(lexical(rows, url).join(F.broadcast(stats), "_cell", "left"))

    training = featured(sample).select("_features", (F.col("_verdict") == "block").cast("double").alias("_label"))
    training = stored(training.coalesce(1), "url-training")
    kinds = sorted(r[0] for r in training.select("_label").distinct().collect())
    if len(kinds) == 2:
        trees = GBTClassifier(
            featuresCol="_features", labelCol="_label", predictionCol="_said",
            maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=SEED,
        )
        model = trees.fit(training).setRawPredictionCol("_raw").setProbabilityCol("_probability")
        scored = model.transform(featured(df))
        scored = scored.withColumn("block_score", vector_to_array("_probability")[1])
    else:
        scored = df.withColumn("block_score", F.lit(kinds[0] if kinds else 0.0))
    method = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    scored = scored.withColumn("verdict", F.coalesce("_verdict", method))
    return scored.select("_page.*", *own)
