"""URL filter: host-suffix and path-prefix expressions looked up by short hash prefixes.

Each url is expanded into the host suffixes and path prefixes whose label counts and lengths occur
among the rules, so the number of expressions per url depends on the rules' shapes and not on the
url's length. Expressions meet the rules in an equi-join on the first hex digits of a digest; full
digests then confirm a match, and the longest fitting rule wins.

Defined cases: NULL url or one without ``://`` has empty host and path and gets the default verdict;
equal rules with both verdicts count as block; repeated rows each get their row; columns other than
the id and the url are ignored; an empty rule table gives the default everywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spellcast.llm.text import lower_ascii

PREFIX_DIGITS = 8

#: Fixed values: (verdict, host, path) of the registered query.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def _digest(expression):
    return F.sha2(expression, 256)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row of ``pages``: id, host, path, the winning rule (NULL if none fits) and its verdict."""
    shape = rules.agg(
        F.array_sort(F.collect_set(F.size(F.split("host", r"\.")))).alias("labels"),
        F.array_sort(F.collect_set(F.length("path"))).alias("lengths"),
    ).first()
    known = rules.groupBy(F.concat("host", "path").alias("rule"), F.length("host").alias("rule_host")).agg(
        F.max(F.col("verdict") == "block").alias("blocks")
    )
    known = known.withColumn("rule_digest", _digest(F.col("rule"))).withColumn("prefix", F.substring("rule_digest", 1, PREFIX_DIGITS))

    url = F.coalesce(F.col("url"), F.lit(""))
    rows = (
        pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
        .groupBy("page_id", "url")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("host", lower_ascii(F.regexp_extract(url, _URL, 1)))
        .withColumn("path", F.regexp_extract(url, _URL, 2))
    )
    suffixes = F.array_distinct(F.array(*[F.substring_index("host", ".", -k) for k in shape.labels] or [F.lit(None).cast("string")]))
    prefixes = F.array(*[F.when(F.length("path") >= k, F.substring("path", 1, k)) for k in shape.lengths] or [F.lit(None).cast("string")])
    expressions = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    tried = (
        rows.withColumn("expression", F.explode_outer(F.filter(expressions, lambda e: e.isNotNull())))
        .withColumn("digest", _digest(F.col("expression")))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
    )
    fits = F.col("digest") == F.col("rule_digest")
    best = F.max(F.when(fits, F.struct(F.length("rule").alias("n"), F.col("rule_host"), F.col("blocks"), F.col("rule"))))
    judged = tried.join(known, "prefix", "left").groupBy("page_id", "url", "host", "path", "copies").agg(best.alias("best"))
    verdict = F.when(F.col("best").isNull(), F.lit(default)).when(F.col("best.blocks"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.withColumn("copy", F.explode(F.expr("sequence(1L, copies)"))).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict")
    )
