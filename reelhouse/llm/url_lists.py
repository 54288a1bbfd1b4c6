"""URL filtering against dated lists: a temporal join.

A list is a log of dated entries: from a time on, a rule (a host with all its subdomains, or a host
with a path prefix) is listed or taken off again. Entries become validity intervals, and every
capture is judged by the entries in force when it was fetched.

Of the rules that could cover a URL only listed ones matter: a Bloom filter of the list takes out nearly all
others before anything is shuffled. Questions (rule and fetch time) and intervals are then laid on one time line, which is sorted by
range over all partitions: each question takes the last interval begun in its partition, or the last one of the
partitions before. So neither a rule that covers most captures nor one of many entries comes to one task.

Defined results: entries with a null rule, time or action are ignored, as are actions other than
`block`, `allow` and `drop`. Of entries of a rule at one time the last in the order drop, allow, block
counts, so repeated rows change nothing; an entry is in force from its own time on. A date is its first moment. A capture with a
null or hostless URL or a null time is kept, with no rule. All captures are returned, repeated ones too. Empty tables
give no rows, or captures without a rule. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.llm.common import checkpointed, parts_for
from reelhouse.operators.integrity import bloom_filter, may_contain

#: End of the last interval of a rule: entries in force stay so.
FOREVER = "9999-12-31 00:00:00"


def url_host(url: Column) -> Column:
    """Lower-case host without user, port and trailing dot; null without scheme or host. IPv6 addresses keep their brackets."""
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#@]*\]|[^/?#:\[\]]+)", 1)
    return F.nullif(F.rtrim(F.lower(host), F.lit(".")), F.lit(""))


def url_path(url: Column) -> Column:
    """Path without query and fragment, beginning with a slash."""
    path = F.regexp_extract(url, r"^[^:/?#]+://[^/?#]*(/[^?#]*)?", 1)
    return F.when(path == "", F.lit("/")).otherwise(path)


def intervals(entries: DataFrame, time_col: str = "day") -> DataFrame:
    """(rule, action, since, until) from dated (rule, time, action) entries: half-open, disjoint per rule.

    An entry holds until the next one of its rule; `drop` ends without a successor of its own.
    Entries of a rule at the same time are merged before the window, so a rule costs a row per time it
    changed at.
    """
    strength = F.when(F.col("action") == "block", 2).when(F.col("action") == "allow", 1).when(F.col("action") == "drop", 0)
    times = (
        entries.select(F.lower("rule").alias("rule"), F.col(time_col).cast("timestamp").alias("since"), strength.alias("strength"))
        .dropna()
        .groupBy("rule", "since")
        .agg(F.max("strength").alias("strength"))
    )
    after = Window.partitionBy("rule").orderBy("since")
    return (
        times.withColumn("until", F.lead("since", 1).over(after))
        .where("strength > 0")
        .select(
            "rule",
            F.when(F.col("strength") == 2, "block").otherwise("allow").alias("action"),
            "since",
            F.coalesce("until", F.lit(FOREVER).cast("timestamp")).alias("until"),
        )
    )


def candidate_rules(url: Column) -> Column:
    """Every rule that covers a URL: its host, the parent domains, and host with path prefixes."""
    host, path = url_host(url), url_path(url)
    # an address in brackets has no parent domains
    labels = F.when(F.startswith(host, F.lit("[")), F.array(host)).otherwise(F.split(host, r"\."))
    hosts = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."),
    )
    parts = F.filter(F.split(path, "/"), lambda part: part != "")
    prefixes = F.when(
        F.size(parts) > 0,
        F.transform(
            F.sequence(F.lit(1), F.size(parts)),
            lambda k: F.concat(host, F.lit("/"), F.lower(F.array_join(F.slice(parts, F.lit(1), k), "/"))),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return F.when(host.isNotNull(), F.concat(hosts, prefixes))


def active_rules(asked: DataFrame, valid: DataFrame) -> DataFrame:
    """As-of join: the (rule, at, action) of the asked (rule, at) pairs that an interval covers.

    Both sides are laid on one time line, and each question takes the last interval of its rule that has begun: in
    its own partition, or else the last of the partitions before. The second is a row for each rule and partition.
    """
    nothing = F.lit(None).cast("struct<since:timestamp,until:timestamp,action:string>")
    questions = asked.select("rule", "at", F.lit(1).alias("question"), nothing.alias("held"))
    beginnings = valid.select(
        "rule", F.col("since").alias("at"), F.lit(0).alias("question"), F.struct("since", "until", "action").alias("held")
    )
    order = ["rule", "at", "question"]
    line = checkpointed(
        questions.unionByName(beginnings)
        .repartitionByRange(parts_for(asked), *order)
        .withColumn("part", F.spark_partition_id())
    )
    before = Window.partitionBy("rule").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = line.groupBy("part", "rule").agg(F.max("held").alias("last")).select(
        "part", "rule", F.last("last", ignorenulls=True).over(before).alias("carried")
    )
    so_far = Window.partitionBy("part", "rule").orderBy("at", "question").rowsBetween(Window.unboundedPreceding, 0)
    return (
        line.withColumn("here", F.last("held", ignorenulls=True).over(so_far))
        .where("question = 1")
        .join(carried, ["part", "rule"])
        .withColumn("held", F.coalesce("here", "carried"))
        .where("at < held.until")
        .select("rule", "at", "held.action")
    )


def filter_urls(
    captures: DataFrame,
    entries: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    time_col: str = "fetched_on",
    entry_time_col: str = "day",
) -> DataFrame:
    """(id, url, time, rule, action, kept) for every capture, the time as it was given.

    The longest rule in force at the fetch time decides: a host with a path before the host, a
    subdomain before its parent. Blocked captures are not kept.

    Equal (URL, time) pairs are judged once, and equal (rule, time) pairs looked up once, so a hot host
    is aggregated before it is shuffled. What is joined back by rule or URL is
    exchanged for that join alone, so that Spark's skew join can split a hot key.
    """
    rows = captures.select(
        captures[id_col].cast("long").alias("id"),
        captures[url_col].alias("url"),
        captures[time_col].alias("time"),
        captures[time_col].cast("timestamp").alias("at"),
    )
    valid = checkpointed(intervals(entries, entry_time_col))
    bits, words = bloom_filter(valid, ["rule"])
    covered = (
        rows.select("url", "at")
        .dropna()
        .select("url", "at", F.explode(candidate_rules(F.col("url"))).alias("rule"))
        .where(may_contain(["rule"], bits.scalar(), words))
        .distinct()
    )
    active = active_rules(covered.select("rule", "at").distinct(), valid)
    verdicts = (
        covered.join(active, ["rule", "at"])
        .groupBy("url", "at")
        .agg(F.max(F.struct(F.length("rule").alias("size"), "rule", "action")).alias("best"))
        .select("url", "at", "best.rule", "best.action")
    )
    return rows.join(verdicts, ["url", "at"], "left").select(
        F.col("id").alias(id_col),
        F.col("url").alias(url_col),
        F.col("time").alias(time_col),
        "rule",
        "action",
        (F.coalesce("action", F.lit("")) != "block").alias("kept"),
    )
