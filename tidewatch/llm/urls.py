"""URL filters: every URL is expanded into host-suffix and path-prefix expressions, these are joined to
the rules on a short hash prefix, and the full digest and the rules' precedence decide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import UPPER, literal

#: Hexadecimal digits of a digest that the join compares; the full digest is confirmed after it.
SHORT = 8
_PARTS = literal(r"://([^/?#]*)([^?#]*)")


def split_url(pages: DataFrame) -> DataFrame:
    """Add `host` (A-Z in lower case) and `path`; both are empty for a null URL or one without `://`."""
    return pages.withColumns(
        {
            "host": F.expr(f"translate(coalesce(regexp_extract(url, {_PARTS}, 1), ''), '{UPPER}', '{UPPER.lower()}')"),
            "path": F.expr(f"coalesce(regexp_extract(url, {_PARTS}, 2), '')"),
        }
    )


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of each page.

    `rules` has host, path and verdict. A rule fits its host and all subdomains where the URL's path
    starts with the rule's path; the longest rule wins, and of equals a block. Without a fitting rule
    the verdict is `default` and the rule null. Only path prefixes of lengths that occur among the
    rules are expanded; that set of numbers is bounded by the longest rule path. A page is one row
    throughout, also if it is repeated; its many expressions meet again before the only shuffle when the
    rules are small enough for Spark to broadcast, and by a hash of the row number otherwise.
    """
    lengths = sorted(row[0] for row in rules.select(F.expr("length(path)")).distinct().collect())
    known = rules.select(
        F.expr("concat(host, path) AS rule"), F.col("verdict").alias("rule_verdict"), F.expr("sha2(concat(host, path), 256) AS rule_digest")
    ).withColumn("short", F.expr(f"substr(rule_digest, 1, {SHORT})"))
    hosts = "transform(sequence(1, size(labels)), i -> array_join(slice(labels, i, size(labels) - i + 1), '.'))"
    paths = f"transform(filter(array({', '.join(map(str, lengths))}), n -> n <= length(path)), n -> substr(path, 1, n))" if lengths else "array('')"
    rows = split_url(pages.select("page_id", "url")).select(
        F.monotonically_increasing_id().alias("row"), "page_id", "host", "path", F.expr("split(host, '[.]') AS labels")
    )
    asked = rows.select(
        "row", "page_id", "host", "path", F.explode_outer(F.expr(f"flatten(transform({hosts}, h -> transform({paths}, p -> concat(h, p))))")).alias("asked")
    ).withColumn("digest", F.expr("sha2(asked, 256)"))
    met = asked.withColumn("short", F.expr(f"substr(digest, 1, {SHORT})")).join(known, "short", "left")
    hit = "CASE WHEN digest = rule_digest THEN struct(length(rule) AS long, rule_verdict = 'block' AS blocks, rule, rule_verdict AS verdict) END"
    return (
        met.groupBy("row", "page_id", "host", "path")
        .agg(F.expr(f"max({hit}) AS best"))
        .select("page_id", "host", "path", F.expr("best.rule AS rule"), F.expr(f"coalesce(best.verdict, {literal(default)}) AS verdict"))
    )
