"""URL filters: host and path rules, then gradient-boosted trees.

Rules decide first; the longest one that fits wins. A URL without a rule is
judged by gradient-boosted trees over lexical features (lengths, depth,
digit ratio, entropy, parameter counts, and statistics of suffixes of the
host and beginnings of the path), trained on labelled URLs. The labelled URLs
are a table (url, label); the query takes those that a rule has decided,
label 1 for block.

Defined results: NULL or no ``://`` gives empty host and path, no rule, and
the method's verdict on the empty URL; repeated rows get equal verdicts; an
empty table gives an empty result; without labels of both kinds the verdict
is the one label's, or allow.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corate.llm.common import bounded_sample

# Fixed values: (verdict, rule as host/path).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

#: Labelled URLs that the fit takes; values of each part of a URL whose
#: statistics it keeps.
FIT_ROWS = 20_000
SUFFIXES = 200
#: Parts of a URL whose block rates among labelled URLs are features.
PARTS = ("suffix", "domain", "segment", "suffix_segment", "domain_segment", "domain_second")
TREES, DEPTH = 20, 4

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

FEATURES = ("url_length", "host_length", "path_length", "host_labels", "depth", "parameters", "digits", "digit_ratio",
            "host_digits", "hyphens", "entropy", "host_entropy", "has_fragment", "is_https", "longest_label", "suffix_share",
            *(f"{p}_rate" for p in PARTS))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def rule_columns(rules=RULES) -> tuple[Column, Column]:
    """The fitting rule that is longest, and its verdict; NULL if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: len(r[1])):
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(slash + path))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _entropy(text: Column) -> Column:
    """Shannon entropy of a string's characters, in bits."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    n = F.size(chars).cast("double")
    return F.when(n == 0, 0.0).otherwise(F.aggregate(
        F.array_distinct(chars), F.lit(0.0),
        lambda acc, c: acc - (F.size(F.filter(chars, lambda x: x == c)) / n) * F.log2(F.size(F.filter(chars, lambda x: x == c)) / n)))


def lexical(urls: DataFrame) -> DataFrame:
    """``urls`` (host, path, url) with the lexical features that need no
    statistics, and the host's suffix (its last label)."""
    url = F.coalesce("url", F.lit(""))
    digits = F.length(F.regexp_replace(url, "[^0-9]", ""))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    segments = F.split(F.regexp_replace("path", "^/", ""), "/")
    first, second = (F.coalesce(F.get(segments, i), F.lit("")) for i in (0, 1))
    suffix, domain = F.substring_index("host", ".", -1), F.substring_index("host", ".", -2)
    return urls.withColumns({
        "suffix": suffix, "domain": domain, "segment": first,
        "suffix_segment": F.concat_ws("/", suffix, first), "domain_segment": F.concat_ws("/", domain, first),
        # of the second segment its first character: ids and names differ there
        "domain_second": F.concat_ws("/", domain, first, F.substring(second, 1, 1)),
        "url_length": F.length(url), "host_length": F.length("host"), "path_length": F.length("path"),
        "host_labels": F.size(F.split("host", r"\.")),
        "depth": F.size(F.filter(F.split("path", "/"), lambda p: p != "")),
        "parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))),
        "digits": digits, "digit_ratio": digits / F.greatest(F.length(url), F.lit(1)),
        "host_digits": F.length(F.regexp_replace("host", "[^0-9]", "")),
        "hyphens": F.length(F.regexp_replace("host", "[^-]", "")),
        "entropy": _entropy(url), "host_entropy": _entropy(F.col("host")),
        "has_fragment": F.instr(url, "#").cast("boolean").cast("int"),
        "is_https": F.startswith(url, F.lit("https://")).cast("int"),
        "longest_label": F.array_max(F.transform(F.split("host", r"\."), lambda x: F.length(x))),
    })


class UrlModel:
    """Trees, the statistics of URL parts they were trained with (value ->
    block rate and share, by part), or one constant."""

    def __init__(self, trees: PipelineModel | None, parts: dict[str, dict[str, tuple[float, float]]], prior: float):
        self.trees, self.parts, self.prior = trees, parts, prior

    def with_parts(self, rows: DataFrame) -> DataFrame:
        """Block rate of each part, and share of the suffix; an unknown value
        gets the prior."""
        def look_up(part: str, i: int, default: float) -> Column:
            known = self.parts.get(part, {})
            if not known:
                return F.lit(default)
            table = F.create_map(*(F.lit(x) for k, v in known.items() for x in (k, v[i])))
            return F.coalesce(F.try_element_at(table, F.col(part)), F.lit(default))

        rates = {f"{p}_rate": look_up(p, 0, self.prior) for p in PARTS}
        return rows.withColumns(rates | {"suffix_share": look_up("suffix", 1, 0.0)})

    def judge(self, urls: DataFrame) -> DataFrame:
        """``urls`` with probability of block."""
        if self.trees is None:
            return urls.withColumn("probability", F.lit(self.prior))
        kept = urls.columns
        scored = self.trees.transform(self.with_parts(lexical(urls)))
        return scored.select(*kept, vector_to_array("probability_vector")[1].alias("probability"))


def fit_urls(labelled: DataFrame, rows: int = FIT_ROWS) -> UrlModel:
    """Fit on at most ``rows`` labelled URLs (url, host, path, label).

    Statistics are kept for the SUFFIXES most frequent values of each part
    among the labelled rows; their number bounds the model, other values get
    the prior. While the trees are trained, a row's own label is left out of
    its rates, so that they say of it what they say of a new URL."""
    sample = lexical(bounded_sample(labelled, "url", rows)).persist()
    try:
        total = sample.agg(F.count("*").alias("n"), F.avg("label").alias("rate")).first()
        if not total.n or total.rate in (0.0, 1.0):
            return UrlModel(None, {}, float(total.rate or 0.0))
        prior, parts, trained = float(total.rate), {}, sample
        for part in PARTS:
            stats = (sample.groupBy(part).agg(F.count("*").alias("n"), F.sum("label").alias("bad"))
                     .orderBy(F.desc("n"), part).limit(SUFFIXES))
            parts[part] = {r[part]: ((r.bad + 2 * prior) / (r.n + 2), r.n / total.n) for r in stats.collect()}
            # at most SUFFIXES rows a part
            known = F.broadcast(stats.select(part, F.col("n").alias("_n"), F.col("bad").alias("_bad")))
            others = (F.col("_bad") - F.col("label") + 2 * prior) / (F.col("_n") + 1)
            trained = trained.join(known, part, "left").withColumns({
                f"{part}_rate": F.coalesce(others, F.lit(prior)), f"{part}_share": F.coalesce(F.col("_n") / total.n, F.lit(0.0))}).drop("_n", "_bad")
        model = UrlModel(None, parts, prior)
        assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep")
        train = assembler.transform(trained).select("features", F.col("label").cast("double").alias("label"))
        trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, predictionCol="says").setProbabilityCol("probability_vector").setRawPredictionCol("raw").fit(train)
        model.trees = PipelineModel([assembler, trees])
        return model
    finally:
        sample.unpersist()


def with_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, url, host, path, rule and the rule's verdict."""
    host, path = split_url(F.col("url"))
    rule, verdict = rule_columns(rules)
    return pages.select("page_id", "url").select("page_id", "url", host.alias("host"), path.alias("path")).withColumns({"rule": rule, "rule_verdict": verdict})


def filter_urls(pages: DataFrame, model: UrlModel, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and probability of block."""
    judged = model.judge(with_rules(pages, rules))
    verdict = F.coalesce("rule_verdict", F.when(F.col("probability") >= 0.5, "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "probability")
