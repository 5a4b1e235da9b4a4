"""URL filters: host-suffix and path-prefix expressions, joined on short hash prefixes.

Each URL is expanded into its host suffixes and path prefixes (those as long as
some rule has: label counts and path depths are bounded by the rules' own).
Expressions meet the rules in an equi-join on the first 32 bits of their
SHA-256; full digests confirm, and the longest matching rule wins.  Spark picks
the join by the rules' size; nothing is forced to be broadcast.

A rule is ``(action, host, path)``; its path is a folder: it starts and ends
with ``/``.  It fits its host and the subdomains, if the URL's path starts with
the rule's.  Of rules with equal host and path, ``allow`` wins.

Defined cases: a null URL or one without ``://`` has an empty host and path, no
rule, and the default verdict; repeated rows are kept; null ids are kept; an
empty rule list judges everything by default; other columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULE_SCHEMA = "action string, host string, path string"
DEFAULT_VERDICT = "allow"


def rules_frame(spark: SparkSession, rules) -> DataFrame:
    """Rules given as ``(action, 'host/path/')`` pairs."""
    rows = []
    for action, text in rules:
        host, slash, rest = text.partition("/")
        if action not in ("allow", "block") or not host or not slash or not text.endswith("/"):
            raise ValueError(f"not a rule: {action!r} {text!r}")
        rows.append((action, host.translate(str.maketrans(_UPPER, _LOWER)), "/" + rest))
    return spark.createDataFrame(rows, RULE_SCHEMA)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL (see the module text)."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(raw) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(raw, _UPPER, _LOWER), path


def _keyed(df: DataFrame, expression: str) -> DataFrame:
    full = F.sha2(F.col(expression), 256)
    return df.withColumn("digest", full).withColumn("short", F.substring("digest", 1, 8))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = DEFAULT_VERDICT) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` of every row of ``pages``."""
    best = (rules.groupBy("host", "path").agg(F.min("action").alias("action"))
            .withColumn("rule", F.concat("host", "path")))
    top = best.agg(F.max(F.size(F.split("host", "[.]"))), F.max(F.size(F.split("path", "/")) - 2)).first()
    labels, depth = top[0] or 0, top[1] or 0
    host, path = url_parts(pages[url_col])
    # repeated rows become one with a count; this exchange also serves the last aggregate
    f = (pages.select(pages[id_col].alias("page_id"), host.alias("host"), path.alias("path"))
         .groupBy("page_id", "host", "path").agg(F.count("*").alias("copies")))
    suffixes = F.expr(f"""transform(sequence(1, least(size(split(host, '[.]')), {max(labels, 1)})),
                          n -> array_join(slice(split(host, '[.]'), -n, n), '.'))""")
    prefixes = F.expr(f"""if(startswith(path, '/'), transform(
                          sequence(1, least(size(split(path, '/')) - 1, {depth + 1})),
                          n -> concat(array_join(slice(split(path, '/'), 1, n), '/'), '/')), array())""")
    pairs = F.expr("flatten(transform(hosts, h -> transform(paths, p -> concat(h, p))))")
    wide = (f.select("*", suffixes.alias("hosts"), prefixes.alias("paths"))
            .select("page_id", "host", "path", "copies", F.explode_outer(pairs).alias("expression")))
    left = _keyed(wide, "expression")
    right = _keyed(best, "rule").select(F.col("short").alias("r_short"), F.col("digest").alias("r_digest"),
                                        "rule", "action")
    hit = left.join(right, (left["short"] == right["r_short"]) & (left["digest"] == right["r_digest"]), "left")
    won = F.max(F.when(F.col("rule").isNotNull(), F.struct(F.length("rule").alias("n"), "rule", "action")))
    out = hit.groupBy("page_id", "host", "path").agg(won.alias("won"), F.first("copies").alias("copies"))
    return (out.select("page_id", "host", "path", F.col("won.rule").alias("rule"),
                       F.coalesce("won.action", F.lit(default)).alias("verdict"),
                       F.explode(F.expr("sequence(1L, copies)")).alias("copy"))
            .drop("copy"))
