"""URL filters as a temporal list join.

Dated list entries become validity intervals: an entry holds from its date until the next entry
for the same pattern. Every capture is then judged by the entries that were active when it was
fetched, so a filter can be replayed for any past day. A pattern's intervals don't overlap, so
each of the three joins (path prefix, host, domain) finds at most one interval per capture:
no row is multiplied and nothing has to be grouped again. The most specific match decides.
Only DataFrame functions are used.

Defined cases: a null or malformed URL has no host and matches nothing; a capture without a fetch
date matches nothing; both are kept with scope null. Entries without pattern or date are ignored.
Several entries for one pattern on one day count as one: block wins over allow, allow over remove.
Repeated captures are judged one by one; other columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chatlens.llm.staging import stage

# Most specific first.
SCOPES = ("prefix", "host", "domain")
SEVERITY = {"remove": 0, "allow": 1, "block": 2}


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and leading www; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))
    return F.nullif(F.regexp_replace(host, r"^www\.", ""), F.lit(""))


def domain_of(host: Column) -> Column:
    """The last two labels of a host."""
    return F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit(""))


def prefix_of(url: Column, host: Column) -> Column:
    """Host and first path segment; null without a segment."""
    segment = F.regexp_extract(url, r"^[^:]+://[^/?#]+/([^/?#]+)", 1)
    return F.when(segment != "", F.concat(host, F.lit("/"), segment))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """scope, pattern, action, entry_date -> scope, pattern, action, valid_from, valid_to (exclusive, null: open).

    Removals close an interval and open none.
    """
    rank = F.create_map(*[F.lit(x) for pair in SEVERITY.items() for x in pair])
    known = entries.where("pattern IS NOT NULL AND entry_date IS NOT NULL").withColumn("_rank", rank[F.col("action")])
    daily = known.where("_rank IS NOT NULL").groupBy("scope", "pattern", "entry_date").agg(F.max("_rank").alias("_rank"))
    following = Window.partitionBy("scope", "pattern").orderBy("entry_date")
    action = F.get(F.array(*[F.lit(name) for name in SEVERITY]), F.col("_rank"))
    dated = daily.select(
        "scope", "pattern", action.alias("action"), F.col("entry_date").alias("valid_from"),
        F.lead("entry_date").over(following).alias("valid_to"),
    )
    return dated.where("action <> 'remove'")


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """page_id, url, fetch_date -> plus host, scope, pattern, action, valid_from, n_active, kept.

    The intervals are written first, so both sides of each join have an exchange of their own and
    adaptive execution can split a host that has a third of all captures.
    """
    intervals = stage(validity_intervals(entries))
    keyed = captures.select("page_id", "url", "fetch_date").withColumn("host", host_of(F.col("url")))
    keyed = keyed.withColumn("_prefix", prefix_of(F.col("url"), F.col("host")))
    keyed = keyed.withColumn("_host", F.col("host")).withColumn("_domain", domain_of(F.col("host")))
    for scope in SCOPES:
        own = intervals.where(F.col("scope") == scope)
        found = F.struct(F.lit(scope).alias("scope"), "pattern", "action", "valid_from").alias(f"_{scope}_hit")
        own = own.select(F.col("pattern").alias("_key"), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"), found)
        active = (F.col("fetch_date") >= F.col("_from")) & (F.col("_to").isNull() | (F.col("fetch_date") < F.col("_to")))
        keyed = keyed.join(own, (F.col(f"_{scope}") == F.col("_key")) & active, "left").drop("_key", "_from", "_to")
    hits = [F.col(f"_{scope}_hit") for scope in SCOPES]
    best = F.coalesce(*hits)
    n_active = sum((hit.isNotNull().cast("long") for hit in hits), F.lit(0).cast("long"))
    return keyed.select(
        "page_id", "url", "fetch_date", "host", best["scope"].alias("scope"), best["pattern"].alias("pattern"),
        best["action"].alias("action"), best["valid_from"].alias("valid_from"), n_active.alias("n_active"),
        F.coalesce(best["action"] != "block", F.lit(True)).alias("kept"),
    )


def kept_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """The captures no active entry blocks."""
    return judge(captures, entries).where("kept")
