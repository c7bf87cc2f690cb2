"""URL filter: host suffixes and path prefixes looked up in a rule table by short hashes.

Every distinct URL becomes the expressions that one of the rules could be
written as: suffixes of its host with prefixes of its path. Expressions meet the rules by
an equi-join on the first bytes of a digest, then the full digest confirms the
match; of the confirmed rules the longest wins.
"""

from pyspark.sql import functions as F

from creditloom.llm.scratch import small

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SHORT_HEX = 8  # 4 bytes of the digest


def host_of(url):
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for NULL."""
    return F.coalesce(
        F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), ASCII_UPPER, ASCII_UPPER.lower()), F.lit("")
    )


def path_of(url):
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://`` or for NULL."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host, path):
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _labels(host):
    """How many labels a host has."""
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def _expressions(found):
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def rule_table(spark, rules):
    """A DataFrame of ``(host, path, verdict)`` from plain tuples."""
    return spark.createDataFrame([tuple(r) for r in rules], "host string, path string, verdict string")


def judge_urls(df, rules, url="url", default="allow"):
    """``df`` with columns ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` is a DataFrame (host, path, verdict); rule hosts are in lower
    case. A rule fits its host and all subdomains of it if the URL's path starts
    with the rule's. Of the fitting rules the one with the longest text (host and
    path) wins, then the longest host; a rule given twice with different
    verdicts blocks. URLs no rule fits get ``default`` and a NULL rule.

    NULL URLs and URLs without ``://`` have empty host and path and match no
    rule; rules with a NULL part are ignored; repeated rows stay. Input columns
    named like a result column are replaced. No row is dropped: distinct URLs are judged and joined back, where a
    very frequent URL can be split by adaptive execution.
    """
    rules = rules.dropna(subset=["host", "path", "verdict"]).groupBy("host", "path").agg(
        F.max("verdict").alias("verdict")  # "block" sorts after "allow"
    )
    digest = _digest(F.col("host"), F.col("path"))
    known = small(rules.select(
        F.substring(digest, 1, SHORT_HEX).alias("short"), digest.alias("digest"),
        F.struct(
            (F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"),
            F.concat("host", "path").alias("rule"), F.col("verdict").alias("verdict"),
        ).alias("found"),
    ))
    # Only suffixes with as many labels as some rule's host and prefixes as long as some rule's path can match, so a
    # URL gives no more expressions than the rules have shapes, however long it is.
    shapes = rules.select(_labels(F.col("host")), F.length("path")).distinct().collect()
    suffixes = _expressions([
        F.when(_labels(F.col("host")) >= n, F.substring_index("host", ".", -n)) for n in sorted({r[0] for r in shapes})
    ])
    prefixes = _expressions([
        F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted({r[1] for r in shapes})
    ])
    urls = df.select(F.col(url).alias("url")).where(F.col("url").isNotNull()).distinct().select(
        "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    ).where("host <> ''")
    expressions = (
        urls.select("url", F.explode(suffixes).alias("host"), prefixes.alias("prefixes"))
        .select("url", "host", F.explode("prefixes").alias("path"))
        .select("url", digest.alias("wanted"))
        .withColumn("short", F.substring("wanted", 1, SHORT_HEX))
    )
    best = (
        expressions.join(known, "short").where("wanted = digest")
        .groupBy("url").agg(F.max("found").alias("found"))
        .select(F.col("url").alias("judged_url"), "found")
    )
    given = [c for c in df.columns if c.lower() not in ("host", "path", "rule", "verdict", "judged_url", "found") or c == url]
    return (
        df.select(*[df[f"`{c}`"] for c in given])
        .join(best, F.col(url) == F.col("judged_url"), "left")
        .select(
            *[F.col(f"`{c}`") for c in given],
            host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
            F.col("found.rule").alias("rule"),
            F.coalesce("found.verdict", F.lit(default)).alias("verdict"),
        )
    )
