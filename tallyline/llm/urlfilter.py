"""URL filters with history: every capture is judged by the list entries that were in force when it was fetched.

Dated entries ("listed" or "taken off" at a time) become validity intervals: an entry's state holds from its time to the next
dated entry of the same name. A capture proposes its URL and all domains its host lies in, and an as-of join finds those in
force at its time.

Entries are of two kinds: ``domain`` (a host name and all names below it) and ``url`` (one URL, without fragment).

Scale. Time is cut into periods, and the join's key is (kind, entry, period): a host with a third of all captures, or an entry
with a third of all list rows, is spread over its periods, and inside one period only intervals that touch it meet. The
intervals of an entry are found per period too, with the first time of the next period that has one. Captures
lie between the earliest and the latest fetch time, so no interval covers more periods than the crawl does. Joined rows are
narrow and reduced to one row per capture on the map side.

Defined results: a null URL matches nothing; one without host can match as a whole only. A capture without time is not blocked.
List rows without entry, kind or time are left out. Of entries with the same name and time, listed wins. An entry is in force
from its time on and no longer at the time it is taken off. Repeated captures each get a row. Empty tables on either
side give no row or no blocked row. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERIOD = 30 * 86_400
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"


def url_host(url: Column) -> Column:
    """Host of a URL in lower case without trailing dot, or null."""
    host = F.rtrim(F.lower(F.regexp_extract(url, HOST, 1)), F.lit("."))
    return F.nullif(host, F.lit(""))


def host_domains(host: Column) -> Column:
    """The host and every domain above it."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), ".")
    )


def bare_url(url: Column) -> Column:
    return F.regexp_replace(url, r"#[\s\S]*$", "")


def validity(entries: DataFrame, period: int = PERIOD) -> DataFrame:
    """``kind, entry, since, until``: the times at which each entry is in force; ``until`` is null for good."""
    name = ["kind", "entry"]
    dated = entries.select("kind", "entry", F.col("at").cast("long").alias("at"), F.coalesce("listed", F.lit(False)).alias("listed"))
    dated = dated.dropna(subset=[*name, "at"]).groupBy(*name, "at").agg(F.max("listed").alias("listed"))
    dated = dated.withColumn("period", F.floor(F.col("at") / period))
    inside = F.lead("at").over(Window.partitionBy(*name, "period").orderBy("at"))
    firsts = dated.groupBy(*name, "period").agg(F.min("at").alias("first"))
    after = F.lead("first").over(Window.partitionBy(*name).orderBy("period"))
    firsts = firsts.select(*name, "period", after.alias("after"))
    dated = dated.withColumn("inside", inside).join(firsts, [*name, "period"])
    return dated.where("listed").select(*name, F.col("at").alias("since"), F.coalesce("inside", "after").alias("until"))


def filter_captures(
    captures: DataFrame, entries: DataFrame, period: int = PERIOD, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched_at"
) -> DataFrame:
    """``page_id, url, fetched_at, n_active, entry, since, blocked`` of every capture.

    ``entry`` is the first of the entries in force by kind and name (``kind:name``), ``since`` the earliest time from which one of
    them has been.
    """
    rows = captures.select(
        F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(time_col).cast("long").alias("fetched_at")
    )
    crawl = rows.agg(F.min("fetched_at").alias("low"), F.max("fetched_at").alias("high")).first()
    low, high = (crawl["low"], crawl["high"]) if crawl["low"] is not None else (0, -1)

    def period_of(time: Column) -> Column:
        return F.floor(time / period)

    # A capture is told by its page, its time and a hash of its URL, which is long.
    capture = ["page_id", "fetched_at", "url_hash"]
    named = rows.withColumn("url_hash", F.xxhash64("url")).withColumn("host", url_host(F.col("url")))
    domains = F.coalesce(F.transform(host_domains(F.col("host")), lambda d: _candidate("domain", d)), F.array())
    proposed = F.concat(domains, F.array(_candidate("url", bare_url(F.col("url")))))
    proposed = named.where("url is not null and fetched_at is not null").select(*capture, F.explode(proposed).alias("c"))
    proposed = proposed.distinct().select(*capture, "c.*", period_of(F.col("fetched_at")).alias("period"))

    spans = validity(entries, period).where((F.col("since") <= high) & (F.coalesce("until", F.lit(high + 1)) > low))
    first = period_of(F.greatest("since", F.lit(low)))
    last = period_of(F.least(F.coalesce(F.col("until") - 1, F.lit(high)), F.lit(high)))
    spans = spans.withColumn("period", F.explode(F.sequence(first, last)))
    met = proposed.join(spans, ["kind", "entry", "period"])
    met = met.where((F.col("since") <= F.col("fetched_at")) & (F.col("until").isNull() | (F.col("fetched_at") < F.col("until"))))
    verdict = met.groupBy(*capture).agg(
        F.count("*").alias("n_active"),
        F.min(F.concat_ws(":", "kind", "entry")).alias("entry"),
        F.min("since").alias("since"),
    ).withColumnsRenamed({name: f"_{name}" for name in capture})
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in capture]
    out = named.join(verdict, same, "left").withColumn("n_active", F.coalesce("n_active", F.lit(0)).cast("long"))
    return out.select("page_id", "url", "fetched_at", "n_active", "entry", "since", (F.col("n_active") > 0).alias("blocked"))


def _candidate(kind: str, entry: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), entry.alias("entry"))
