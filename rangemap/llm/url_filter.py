"""URL filters: a rule list first, a logistic regression on hashed character n-grams for the rest.

Only DataFrame functions and Spark's own estimators run here. The regression reads n-grams of host and path, marked by
which they come from, hashed to a fixed number of features; it is trained from a small labelled URL table.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURES = 1 << 14
GRAMS = (3, 4)

# The rules of the contract.
RULES: list[tuple[str, str, str]] = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

# Terms of the default labelled table.
BLOCKED = "adult bet betting bonus cams casino cheap click crack dates escort free hack jackpot keygen loans malware payday phish pills poker porn prize replica slots spam torrent viagra warez win xxx".split()
ALLOWED = "archive art bakery bird book bridge city clinic coast college cook council daily field forest garden guide harbour health history home house journal kitchen lab library local map market museum music news paper park photo physics post recipe review river school science shop society sport story street study theatre town travel tree valley village weather wiki work world".split()
SYLLABLES = "an ba be ca co da de el en er ga ha he in is ka la le li lo ma me mi mo na ne no on or pa pe ra re ri ro sa se si sh so ta te th ti tion to tu un va ve wa we wh".split()


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://` and for null."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null. rules: (host, path, verdict), a short list."""
    found = None
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found if found is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def labelled(spark: SparkSession, rows: int = 6000, seed: int = 0) -> DataFrame:
    """(label, host, path): the default labelled table, 1 is to be blocked; distinct rows of about that number.

    Made from terms by rule. Hosts have one or two terms, or syllables, under a common domain, paths a language or section and a
    number, as host_of and path_of give them. A row is to be blocked if a blocked term stands in its host or path.
    """
    draw = lambda n, key: F.pmod(F.xxhash64("id", F.lit(f"{key} {seed}")), F.lit(n)).cast("int")
    pick = lambda values, key: F.element_at(F.array(*(F.lit(v) for v in values)), draw(len(values), key) + 1)
    bad, made = draw(5, "bad") < 2, draw(3, "made") == 0
    name = F.concat(*(pick(SYLLABLES, f"s{i}") for i in range(3)))
    in_path = draw(3, "where") == 0  # the blocked term stands in the path only
    good_term = F.when(made, name).otherwise(pick(ALLOWED, "a"))
    term = F.when(bad & ~in_path, pick(BLOCKED, "b")).otherwise(good_term)
    other = F.when(draw(3, "both") == 0, pick(BLOCKED, "c")).otherwise(pick(ALLOWED, "d"))
    second = F.when(bad & ~in_path, other).otherwise(pick(ALLOWED, "d"))
    pair = F.when((made | (draw(2, "one") == 0)) & ~(bad & ~in_path), term).when(draw(2, "turn") == 0, F.concat_ws("-", term, second)).otherwise(F.concat_ws("-", second, term))
    host = F.concat(pick(["", "", "www.", "m.", "blog."], "prefix"), pair, pick([".example.com", ".example.net", ".example.org"], "domain"))
    section = F.when(bad & in_path, pick(BLOCKED, "p")).otherwise(pick(["en", "fr", "de", "es", "en", "fr", "de", "es", *ALLOWED], "q"))
    path = F.concat(F.lit("/"), section, F.lit("/"), draw(1000, "number").cast("string"), pick(["", "", "/", ".html"], "end"))
    return spark.range(rows).select(bad.cast("double").alias("label"), host.alias("host"), path.alias("path")).distinct()


def _gram(whole: Column, mark: str, n: int):
    # A function of one argument: transform would give a second one the place.
    return lambda i: F.concat(F.lit(mark), F.substring(whole, i, n))


def _marked(text: Column, mark: str) -> Column:
    whole = F.concat(F.lit("^"), text, F.lit("$"))
    return F.concat(*(F.transform(F.sequence(F.lit(1), F.greatest(F.length(whole) - n + 1, F.lit(1))), _gram(whole, mark, n)) for n in GRAMS))


def with_features(df: DataFrame, features: int = FEATURES) -> DataFrame:
    """df (host, path) with the hashed n-gram counts of both."""
    grams = df.withColumn("grams", F.concat(_marked(F.col("host"), "h:"), _marked(F.regexp_replace("path", "[0-9]+", "0"), "p:")))
    return HashingTF(numFeatures=features, binary=True, inputCol="grams", outputCol="features").transform(grams).drop("grams")


def train(table: DataFrame, features: int = FEATURES) -> LogisticRegressionModel:
    """From a small table of (label, host, path), of thousands of rows."""
    return LogisticRegression(maxIter=40, regParam=0.0005, standardization=False).fit(with_features(table, features))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, table: DataFrame | None = None, model: LogisticRegressionModel | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, block_score) per row of pages; a narrow map that reads two columns.

    The method is a model that train() gave, or learns from table (label, host, path), by default labelled(). Null urls and those without `://` have an empty host and path and are judged by the method like any other; repeated
    rows get equal results; null ids stay null; other columns are left out.
    """
    model = model or train(labelled(pages.sparkSession) if table is None else table)
    urls = pages.select(pages[id_col].alias("page_id"), host_of(pages[url_col]).alias("host"), path_of(pages[url_col]).alias("path"))
    scored = model.transform(with_features(urls, model.numFeatures)).withColumn("block_score", vector_to_array("probability")[1])
    scored = scored.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    method = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", method).alias("verdict"), "block_score")
