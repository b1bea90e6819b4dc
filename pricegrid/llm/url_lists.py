"""URL filters by dated lists.

List entries are dated additions and removals of a host or a URL. They become
validity intervals, the last one of a list and pattern open towards the future, and
each capture is judged by the intervals that were open when it was fetched. Only the
periods in which a pattern has captures are given its intervals, so the join has equal
keys (kind, pattern, period), a busy host is spread over its periods, and an interval
that is open for good makes no rows for times nobody asks about. Inside a period the
times themselves are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

PERIOD_DAYS = 28


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1))


def intervals(entries: DataFrame) -> DataFrame:
    """Entries (list, allow, kind, pattern, added, on) as intervals [since, until);
    ``until`` is null while an interval is open.

    An addition holds until the next entry of its list and pattern. At one time a
    removal comes before an addition, so an entry that is removed and added stays.
    ``on`` is a date, which begins at midnight, or a time. Entries without a time or
    pattern say nothing.
    """
    of_pattern = Window.partitionBy("list", "kind", "pattern").orderBy("on", "added", "allow")
    dated = entries.select("list", "allow", "kind", "pattern", "added", F.col("on").cast("timestamp").alias("on"))
    return (
        dated.where(F.col("on").isNotNull() & F.col("pattern").isNotNull())
        .distinct()
        .withColumn("until", F.lead("on").over(of_pattern))
        .where(F.col("added") & (F.col("until").isNull() | (F.col("on") < F.col("until"))))
        .select("list", "allow", "kind", "pattern", F.col("on").alias("since"), "until")
    )


def _period(time: Column) -> Column:
    return F.floor(F.unix_seconds(time) / (PERIOD_DAYS * 86_400))


def dealt_intervals(spans: DataFrame, asked: DataFrame) -> DataFrame:
    """Intervals with each ``period`` they reach into, of the periods that rows
    (kind, pattern, period) ask for."""
    wanted = asked.select("kind", "pattern", "period").distinct()
    begun = F.col("period") >= _period(F.col("since"))
    ongoing = F.col("until").isNull() | (F.col("period") <= _period(F.col("until")))
    return spans.join(wanted, ["kind", "pattern"]).where(begun & ongoing)


def _patterns(url: Column, host: Column) -> Column:
    """What a URL can be listed by: itself, its host and the domains above."""
    labels = F.split(host, r"\.")
    hosts = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.struct(F.lit("host").alias("kind"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern")),
    )
    own = F.array(F.struct(F.lit("url").alias("kind"), url.alias("pattern")))
    return F.when(host == "", own).otherwise(F.concat(own, hosts))


def listed(captures: DataFrame, entries: DataFrame, key: str = "page_id", url: str = "url", fetched: str = "fetched_on") -> DataFrame:
    """Per capture: ``host``, ``fetched_on`` as given (a date or a time), ``n_active``
    entries that hold for it at that time, the ``lists`` they are on (sorted,
    comma-joined) and ``blocked``: on a list that blocks and on none that allows.

    A capture without URL or time is on no list. Repeated captures each get a row; an
    empty list blocks nothing. Other columns are ignored.
    """
    rows = captures.select(
        F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{fetched}`").alias("fetched_on")
    ).withColumn("host", F.coalesce(host_of(F.col("url")), F.lit("")))
    seen = rows.where(F.col("url").isNotNull() & F.col("fetched_on").isNotNull()).select("url", "host", "fetched_on").distinct()
    timed = seen.withColumn("at", F.col("fetched_on").cast("timestamp"))
    keyed = timed.select(
        "url", "fetched_on", "at", _period(F.col("at")).alias("period"), F.explode(_patterns(F.col("url"), F.col("host"))).alias("p")
    ).select("url", "fetched_on", "at", "period", "p.kind", "p.pattern")
    dealt = dealt_intervals(intervals(entries), keyed)
    active = (
        keyed.join(dealt, ["kind", "pattern", "period"])
        .where((F.col("at") >= F.col("since")) & (F.col("until").isNull() | (F.col("at") < F.col("until"))))
        .groupBy("url", "fetched_on")
        .agg(
            F.count("*").alias("n"),
            F.array_join(F.sort_array(F.collect_set("list")), ",").alias("lists"),
            F.bool_or("allow").alias("allowed"),
            F.bool_or(~F.col("allow")).alias("denied"),
        )
    )
    return rows.join(active, ["url", "fetched_on"], "left").select(
        "page_id",
        "host",
        "fetched_on",
        F.coalesce("n", F.lit(0)).alias("n_active"),
        F.coalesce("lists", F.lit("")).alias("lists"),
        F.coalesce(F.col("denied") & ~F.col("allowed"), F.lit(False)).alias("blocked"),
    )
