"""URL filtering by dated lists: every capture is judged by the entries in force when it was fetched.

Dated entries ``(entry, listed, action)`` become validity intervals: an entry holds from its date until the
next date of the same entry; ``remove`` ends it.  An entry is a host, which covers its subdomains, or a host
and a path prefix, which covers that host's paths below it.  A capture asks for all the entries that could
cover it (each suffix of its host, each prefix of its path), and an as-of join finds those in force.  The
most specific one wins; of one entry listed twice on a day, block wins over allow, allow over remove.

The list is broadcast if its intervals number at most ``broadcast_entries``, after a count.  Beyond that both
sides are shuffled on the entry, captures dealt over ``salt`` copies of the list, so that a hot host is
spread.  Built-in functions only.

Defined cases: a null or empty url, a url without a host and a null fetch time match nothing and get the
verdict ``none``; host case, port, user, a leading ``www.`` and a trailing dot do not count; entries with a
null field are ignored; repeated entries count once; repeated captures get a row each; empty lists and empty
captures are fine; extra columns of the captures pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import match

BROADCAST_ENTRIES = 500_000
SALT = 16


def host_of(url: Column) -> Column:
    """Lower-case host without user, port, ``www.`` and trailing dot; null if there is none."""
    host = F.regexp_extract(F.lower(F.trim(url)), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    host = F.regexp_replace(F.regexp_replace(host, r"\.$", ""), r"^www\.", "")
    return F.when(host != "", host)


def path_of(url: Column) -> Column:
    """Path segments below the host."""
    path = F.regexp_extract(F.trim(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*(/[^?#]*)", 1)
    return F.array_remove(F.split(path, "/"), "")


def lookups(url: Column) -> Column:
    """The entries that could cover a url: suffixes of its host, then its host with each prefix of its path."""
    labels, path = F.split(host_of(url), r"\."), path_of(url)
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    paths = F.when(F.size(path) > 0, F.transform(F.sequence(F.lit(1), F.size(path)), lambda i: F.concat(host_of(url), F.lit("/"), F.array_join(F.slice(path, F.lit(1), i), "/")))).otherwise(F.array().cast("array<string>"))
    return F.when(host_of(url).isNotNull(), F.concat(hosts, paths))


def intervals(entries: DataFrame) -> DataFrame:
    """``entry, action, since, until``: when each entry was in force; until is open at the end."""
    rank = F.expr("case action when 'block' then 0 when 'allow' then 1 else 2 end")
    clean = entries.select(F.lower(F.rtrim(F.col("entry"), F.lit("/"))).alias("raw"), F.col("entry").alias("given"), F.col("listed").cast("date").alias("since"), "action").dropna()
    host, slash = F.substring_index("raw", "/", 1), F.instr("given", "/")
    entry = F.when(slash > 0, F.concat(host, F.expr("substring(trim(trailing '/' from given), instr(given, '/'))"))).otherwise(host)
    clean = clean.select(F.regexp_replace(entry, r"^www\.", "").alias("entry"), "since", "action")
    day = clean.groupBy("entry", "since").agg(F.min_by("action", rank).alias("action"))
    until = F.lead("since").over(Window.partitionBy("entry").orderBy("since"))
    return day.withColumn("until", until).filter(F.col("action") != "remove").select("entry", "action", "since", "until")


def filter_urls(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched", broadcast_entries: int = BROADCAST_ENTRIES, salt: int = SALT) -> DataFrame:
    """``captures`` with the struct ``listing``: verdict (block, allow or none), entry, since."""
    held = intervals(entries)
    rows = captures.select(F.struct("*").alias("__row"), F.col(url).alias("__url"), F.col(fetched).cast("date").alias("__at"))
    asked = rows.select("__url", "__at").distinct()
    asked = asked.select("__url", "__at", F.explode(lookups(F.col("__url"))).alias("entry"))
    if held.count() <= broadcast_entries:
        pairs = asked.join(F.broadcast(held), "entry")
    else:
        dealt = asked.withColumn("__salt", F.pmod(F.xxhash64("__url", "__at"), F.lit(salt)).cast("int"))
        copies = held.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        pairs = dealt.join(copies, ["entry", "__salt"])
    active = pairs.filter((F.col("since") <= F.col("__at")) & (F.col("until").isNull() | (F.col("__at") < F.col("until"))))
    best = active.groupBy("__url", "__at").agg(F.max_by(F.struct(F.col("action").alias("verdict"), "entry", "since"), F.char_length("entry")).alias("listing"))
    none = F.struct(F.lit("none").alias("verdict"), F.lit(None).cast("string").alias("entry"), F.lit(None).cast("date").alias("since"))
    out = match(rows, best, ["__url", "__at"], "left").withColumn("listing", F.coalesce("listing", none))
    return out.select("__row.*", "listing")
