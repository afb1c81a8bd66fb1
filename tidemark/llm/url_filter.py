"""URL filter lists by hash prefixes of host-suffix and path-prefix expressions.

A rule names a host and the beginning of a path; it fits its host and all
subdomains. A URL is expanded into the expressions that a rule could name: each
suffix of its host in labels with each prefix of its path, but only in the
shapes (number of labels, length of path) that rules have. Expressions meet
rules in an equi-join on the first four bytes of their SHA-256; the full digest
confirms. Of the rules that fit the longest (host and path) wins, of equally
long ones that with the longer host, and if one place is both allowed and
blocked it is blocked.

Everything is DataFrame expressions. Rows are grouped once, by what is returned
of them and by the task that read them, so a URL or row that fills a third of
the table is one row for each task, and no group grows with the table. Whether
the rules are small enough to be sent to all executors is for Spark to see from
their size; beyond that they are joined by a shuffle whose hot hash prefixes
adaptive execution splits. The shapes of rules come to the driver: pairs of two
small numbers, however many rules there are.

Cases: a null URL or one without ``://`` has an empty host and path; an empty
path starts with no rule's path but the empty one, which fits all of a host;
only A-Z are lower-cased; ports and user names are part of the host; a rule
whose host is null, empty or none that a URL can have, or whose path is null or
starts with something else than ``/``, fits nothing; repeated rules count once;
repeated rows each give a row; an empty table gives no rows and without rules
every URL gets the default; columns that aren't kept are not read, so their
names don't matter. Kept columns must be of types that Spark can group by (no
maps).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased, and path of a URL; both empty where there is no ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _labels(host: Column) -> Column:
    return F.char_length(host) - F.char_length(F.replace(host, F.lit("."))) + 1


def _digest(expression: Column) -> list[Column]:
    digest = F.sha2(expression.cast("binary"), 256)
    return [F.substring(digest, 1, 8).alias("prefix"), digest.alias("digest")]


def _known(rules: DataFrame) -> DataFrame:
    """One row for each place that a URL can have, a block before an allowance."""
    host = F.translate(F.col("host").cast("string"), _UPPER, _LOWER)
    path = F.col("path").cast("string")
    places = (rules.select(host.alias("host"), path.alias("path"),
                           F.col("verdict").cast("string").alias("verdict"))
              .where((F.col("host") != "") & ~F.col("host").rlike("[/?#]")
                     & F.col("path").rlike("^(/[^?#]*)?$"))
              .groupBy("host", "path").agg(F.max("verdict").alias("verdict")))
    rule = F.concat("host", "path")
    return places.select(
        *_digest(rule), _labels(F.col("host")).alias("labels"),
        F.char_length("path").alias("length"),
        F.struct(F.char_length(rule).alias("size"), F.char_length("host").alias("host_size"),
                 rule.alias("rule"), "verdict").alias("found"))


def judge(urls: DataFrame, rules: DataFrame, keep: list[str], url_col: str = "url",
          default: str = ALLOW) -> DataFrame:
    """Per URL: ``row`` (the columns ``keep``), ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict``. ``rule`` is the host and
    path of the rule that decides, null where none fits and ``default`` holds.
    """
    known = _known(rules)
    shapes = known.select("labels", "length").distinct().collect()
    host, path = host_and_path(F.col(f"`{url_col}`"))
    # nothing here depends on a row's neighbours, so a task that runs again groups alike
    rows = urls.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"),
                       host.alias("host"), path.alias("path"),
                       F.spark_partition_id().alias("task"))
    once = rows.groupBy("row", "host", "path", "task").agg(F.count(F.lit(1)).alias("times"))
    shape = F.array(*(F.struct(F.lit(s.labels).alias("labels"), F.lit(s.length).alias("length"))
                      for s in shapes))
    expressions = F.transform(
        F.filter(shape, lambda s: (s["labels"] <= _labels(F.col("host")))
                 & (s["length"] <= F.char_length("path"))),
        lambda s: F.concat(
            F.call_function("substring_index", F.col("host"), F.lit("."), -s["labels"]),
            F.substr(F.col("path"), F.lit(1), s["length"])))
    if not shapes:
        expressions = F.array().cast("array<string>")
    expanded = once.withColumn("expression", F.explode_outer(expressions))
    expanded = expanded.select("row", "host", "path", "task", "times",
                               *_digest(F.col("expression")))
    known = known.select(F.col("prefix").alias("rule_prefix"), F.col("digest").alias("rule_digest"),
                         "found")
    met = expanded.join(known, F.col("prefix") == F.col("rule_prefix"), "left")
    confirmed = F.when(F.col("digest") == F.col("rule_digest"), F.col("found"))
    best = met.groupBy("row", "host", "path", "task").agg(
        F.first("times").alias("times"), F.max(confirmed).alias("found"))
    return best.select(
        "row", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("copy")).drop("copy")
