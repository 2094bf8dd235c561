"""URL rules by host suffix and path prefix, matched through short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airseries.llm.common import free_names, lower_ascii


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return lower_ascii(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def rules_frame(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """A rule table from (verdict, rule) pairs; a rule is a host, then a path that starts with ``/``."""
    return spark.createDataFrame(rules, "verdict string, rule string")


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    url_col: str = "url",
    default: str = "allow",
    prefix_bytes: int = 4,
) -> DataFrame:
    """Verdict of the longest rule that fits each url.

    Every distinct (host, path) is expanded into all pairs of a host suffix and a
    path prefix whose lengths some rule has. Their SHA-256 digests meet
    those of the rules in an equi-join on the first ``prefix_bytes`` bytes; the full
    digest confirms. Of the rules that fit, the longest wins, then the one with
    the longer host, then ``block`` before other verdicts.

    All columns come back and four more, which replace columns of the same name:
    ``host``, ``path``, ``rule`` (null if none fits) and ``verdict`` (the rule's,
    else ``default``). A null url and one without ``://`` have an empty host and path.
    Rules that are null or have no path are left out of the match; a rule given twice counts
    once, with ``block`` before other verdicts. A url that many rows share is expanded once.
    An empty table gives an empty table; other columns may have any name.
    """
    own_host, own_path, won = free_names(pages, "__host", "__path", "__won")
    hash_chars = 2 * prefix_bytes
    known = (
        rules.select(F.col("rule"), F.col("verdict"))
        .where(F.col("rule").contains("/") & F.col("verdict").isNotNull())
        .groupBy("rule")
        .agg(F.min_by("verdict", F.struct(F.col("verdict") != "block", F.col("verdict"))).alias("verdict"))
        .withColumn("rule_host", lower_ascii(F.substring_index("rule", "/", 1)))
        .withColumn("rule_path", F.expr("substr(rule, locate('/', rule))"))
        .withColumn("digest", F.sha2(F.concat("rule_host", "rule_path").cast("binary"), 256))
        .withColumn("short", F.substring("digest", 1, hash_chars))
    )
    out = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    split = pages.select(
        *out, host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")
    )
    # Path lengths of the rules: one number for each length, at most the length of the longest rule.
    lengths = known.agg(F.collect_set(F.length("rule_path")).alias("lengths"))
    sites = (
        split.where(F.col("path") != "")
        .groupBy("host", "path")
        .agg(F.lit(1).alias("one"))
        .select("host", "path")
    )
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    tried = (
        sites.withColumn("n", F.explode(lengths.scalar()))
        .where(F.col("n") <= F.length("path"))
        .select("host", "path", F.col("n"), F.explode(suffixes).alias("suffix"))
        .withColumn(
            "digest", F.sha2(F.concat("suffix", F.expr("substr(path, 1, n)")).cast("binary"), 256)
        )
        .withColumn("short", F.substring("digest", 1, hash_chars))
    )
    best = (
        tried.alias("t")
        .join(known.alias("k"), "short")
        .where(F.col("t.digest") == F.col("k.digest"))
        .groupBy(F.col("t.host").alias(own_host), F.col("t.path").alias(own_path))
        .agg(
            F.max_by(
                F.struct("k.rule", "k.verdict"),
                F.struct(
                    F.length("k.rule"), F.length("k.rule_host"), F.col("k.verdict") == "block", "k.rule"
                ),
            ).alias(won)
        )
    )
    joined = split.join(
        best, (F.col("host") == F.col(own_host)) & (F.col("path") == F.col(own_path)), "left"
    )
    return joined.select(
        *out,
        "host",
        "path",
        F.col(f"{won}.rule").alias("rule"),
        F.coalesce(F.col(f"{won}.verdict"), F.lit(default)).alias("verdict"),
    )


#: The rules of the registered query.
PAGE_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def judged_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return judge_urls(pages.select("page_id", "url"), rules_frame(spark, PAGE_RULES)).select(
        "page_id", "host", "path", "rule", "verdict"
    )
