"""URL filter: rules first, then a logistic regression on character n-grams of host and path.

The regression sees n-grams of ``GRAMS`` lengths of the lower-cased host and, apart from them,
of the path, hashed to ``WIDTH`` slots as 0 or 1. It is trained from a small table of labelled
URLs, of which at most ``MAX_LABELLED`` rows are used, those with the smallest hash. Training
and scoring are MLlib's, on the executors.

NULL URLs and those without ``://`` have an empty host and path; no rule fits them. Where the
labelled table is empty or has one label only, that label (without any: allow) is the verdict
for every URL that no rule fits. A score of exactly 0.5 blocks. Repeated rows and NULL ids stay
as they are. Columns that the result names are replaced, other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom import store
from tallyloom.llm import common

GRAMS = (3, 4, 5)
WIDTH = 1 << 18
MAX_LABELLED = 20_000
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rules(text: str) -> list[Rule]:
    """Rules from lines like ``block example.org/es/``; the path begins at the first slash."""
    found = []
    for line in filter(None, map(str.strip, text.splitlines())):
        verdict, pattern = line.split()
        host, slash, path = pattern.partition("/")
        found.append(Rule(verdict, host, slash + path))
    return found


def parts(urls: DataFrame, *keys: str) -> DataFrame:
    """The key columns, host and path of every row."""
    url = F.coalesce(F.col("url"), F.lit(""))
    found = common.take(urls, *keys, "url")
    host = common.ascii_lower(F.regexp_extract(url, PARTS, 1)).alias("host")
    return found.select(*keys, host, F.regexp_extract(url, PARTS, 2).alias("path"))


def _fits(rule: Rule) -> Column:
    host = (F.col("host") == rule.host) | F.endswith(F.col("host"), F.lit("." + rule.host))
    return host & F.startswith(F.col("path"), F.lit(rule.path))


def matched(rules: list[Rule], value: str) -> Column:
    """``name`` or ``verdict`` of the longest rule that fits, NULL without one."""
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    if not ordered:
        return F.lit(None).cast("string")
    return F.coalesce(*(F.when(_fits(r), F.lit(getattr(r, value))) for r in ordered))


def _hashed(rows: DataFrame) -> DataFrame:
    """Adds ``features``: all n-grams of host and path, each marked with the part it is from."""
    columns, grams = rows.columns, []
    for part in ("host", "path"):
        signs = F.split(F.concat(F.lit("^"), F.lower(F.col(part)), F.lit("$")), "")
        rows = rows.withColumn(f"_{part}", signs)
        for n in GRAMS:
            rows = NGram(n=n, inputCol=f"_{part}", outputCol=f"_{part}_{n}").transform(rows)
            grams.append(F.transform(f"_{part}_{n}", lambda g: F.concat(F.lit(part), g)))
    rows = rows.select(*columns, F.concat(*grams).alias("_grams"))
    hashing = HashingTF(inputCol="_grams", outputCol="features", numFeatures=WIDTH, binary=True)
    return hashing.transform(rows).drop("_grams")


def fit(labelled: DataFrame, limit: int = MAX_LABELLED):
    """A model from rows of host, path and label (1 blocks), or the only label there is."""
    rows = labelled.where("label IS NOT NULL").select("host", "path", F.col("label").cast("double"))
    some = rows.orderBy(F.xxhash64("host", "path"), "host", "path", "label").limit(limit)
    some = store.materialise(_hashed(some).select("features", "label"), "labelled-urls")
    labels = [row[0] for row in some.select("label").distinct().limit(2).collect()]
    if len(labels) < 2:
        return labels[0] if labels else 0.0
    return LogisticRegression(maxIter=50, regParam=1e-3, aggregationDepth=2).fit(some)


def judge(urls: DataFrame, rules: list[Rule], labelled: DataFrame, *keys: str) -> DataFrame:
    """The key columns, host, path, rule, verdict and score (NULL where a rule decides).

    ``labelled`` has url and label (1 blocks, NULL is left out).
    """
    rows = parts(urls, *keys)
    model = fit(parts(labelled, "label"))
    if isinstance(model, float):
        scored = rows.withColumn("score", F.lit(model))
    else:
        score = vector_to_array("probability")[1]
        scored = model.transform(_hashed(rows)).select(*rows.columns, score.alias("score"))
    fitting, said = matched(rules, "name"), matched(rules, "verdict")
    learned = F.when(F.col("score") >= 0.5, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return scored.select(
        *rows.columns,
        fitting.alias("rule"),
        F.coalesce(said, learned).alias("verdict"),
        F.when(fitting.isNull(), F.col("score")).alias("score"),
    )
