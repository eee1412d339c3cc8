"""URL allow and block rules by a sorted sweep over nested intervals, with DataFrame functions alone.

A rule (host, path) fits its host and all subdomains, for paths that start with its own.
Hosts become keys with their labels reversed, so that a rule's subdomains form one
interval of the sorted keys; within a rule's host, the paths that start with the rule's
path form one as well. Both kinds of intervals are nested or apart, never crossing.

``sweep`` sorts distinct keys and rules together. Its stack at a key, the rules that
enclose it, is the stack of the rule that began last, less those that have ended. It
runs once over the hosts and once over (rule host, path), each time on distinct keys,
so a host or path with a third of all pages is one row of it.

* A null url, or one without ``://``, has an empty host and path and fits no rule of a host.
* Equal rows get equal verdicts. Of equal rules that allow and block, block holds.
* The longest rule wins, of equally long ones that with the longer host; a page without
  a fitting rule gets ``default``.
* Empty tables of pages or rules are fine. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkmart.llm.common import ascii_lower, written

_HOST = r"(?s)^.*?://([^/?#]*)"
_PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, _HOST, 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _PATH, 1), F.lit(""))


def reversed_host(host: Column) -> Column:
    """``a.b.org`` as ``org.b.a.``: the key of a host starts with the keys of those above it."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def host_ends(key: Column) -> Column:
    """The hosts that may enclose the host of ``key``: all leading runs of its labels."""
    labels = F.split(key, r"\.", -1)
    return F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1),
        lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit(".")),
    )


def path_ends(path: Column) -> Column:
    """All leading parts of a path, the empty one too."""
    return F.transform(F.sequence(F.lit(0), F.length(path)), lambda n: F.substring(path, F.lit(1), n))


def _stacks(rules: DataFrame, group: str, key: str, ends) -> DataFrame:
    """For each distinct (group, key) of the rules, the keys of the same group that enclose it, shortest first."""
    keys = rules.select(group, key).distinct()
    above = keys.select(group, key, F.explode(ends(F.col(key))).alias("above"))
    inside = above.join(keys.withColumnRenamed(key, "above"), [group, "above"], "left_semi")
    return inside.groupBy(group, key).agg(F.sort_array(F.collect_list("above")).alias("stack"))


def sweep(points: DataFrame, rules: DataFrame, group: str, key: str, ends) -> DataFrame:
    """(group, key, stack) for each distinct (group, key) of ``points`` that some key of ``rules`` encloses."""
    stacks = _stacks(rules, group, key, ends)
    events = stacks.select(group, key, F.lit(0).alias("kind"), "stack").unionByName(
        points.select(group, key).distinct().select(group, key, F.lit(1).alias("kind"), F.lit(None).cast("array<string>").alias("stack"))
    )
    # Each range of the sorted keys is swept by itself; the partition's number is its place among the ranges.
    ranges = written(events.repartitionByRange(group, key, "kind").withColumn("range", F.spark_partition_id()))
    began = F.when(F.col("kind") == 0, F.struct(group, "stack"))
    last = ranges.where("kind = 0").groupBy("range").agg(F.max_by(F.struct(group, "stack"), F.struct(group, key)).alias("last"))
    every = ranges.groupBy("range").agg(F.count(F.lit(1)).alias("n")).join(last, "range", "left")
    # One row for each range: the rule that began last before it.
    carried = every.select(
        "range", F.last("last", ignorenulls=True).over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)).alias("carried")
    )
    here = Window.partitionBy("range").orderBy(group, key, "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = ranges.withColumn("open", F.last(began, ignorenulls=True).over(here)).where("kind = 1")
    swept = swept.drop("stack").join(F.broadcast(carried), "range")
    top = F.coalesce("open", "carried")
    held = F.when(top[group] == F.col(group), F.filter(top["stack"], lambda r: F.startswith(F.col(key), r)))
    return swept.select(group, key, held.alias("stack")).where(F.size("stack") > 0)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``pages`` (page_id, url) with host, path, rule and verdict by ``rules`` (host, path, verdict).

    ``rules`` may be of any size; nothing of it is sent whole to every task.
    """
    pages = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    # 'block' sorts after 'allow'.
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    rules = rules.select(F.lit(0).alias("all"), reversed_host(F.col("host")).alias("host_key"), "host", "path", "verdict")

    hosts = pages.select("host", F.lit(0).alias("all"), reversed_host(F.col("host")).alias("host_key")).distinct()
    enclosing = sweep(hosts, rules, "all", "host_key", host_ends).select("host_key", F.explode("stack").alias("rule_key"))
    by_host = hosts.join(enclosing, "host_key").select("host", "rule_key")

    # Distinct (host, path) first: what many pages share is judged once.
    places = pages.select("host", "path").distinct().join(by_host, "host").withColumnRenamed("path", "page_path")
    keyed = rules.select(F.col("host_key").alias("rule_key"), "host", "path", "verdict")
    paths = sweep(places.select("rule_key", F.col("page_path").alias("path")), keyed, "rule_key", "path", path_ends)
    longest = paths.select("rule_key", F.col("path").alias("page_path"), F.try_element_at("stack", F.lit(-1)).alias("path"))
    fitting = longest.join(keyed, ["rule_key", "path"])
    rank = F.struct((F.length("rule_host") + F.length("path")).alias("length"), F.length("rule_host").alias("host_length"))
    best = (
        places.join(fitting.withColumnRenamed("host", "rule_host"), ["rule_key", "page_path"])
        .groupBy("host", "page_path")
        .agg(F.max_by(F.struct(F.concat("rule_host", "path").alias("rule"), "verdict"), rank).alias("best"))
        .withColumnRenamed("page_path", "path")
    )
    return pages.join(best, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )

