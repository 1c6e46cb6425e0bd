"""URL filters (op 2): temporal list join, in DataFrame functions only.

A list is a log of dated entries (list, value, action, dated): a host or domain is added to a list or taken off it.
`validity` turns the log into intervals: from an entry to the next one of the same list and value. `captures` gives each
page the host it was fetched from, and `filtered` evaluates it as of its fetch time: the host and each of its parent
domains are looked up in one equi-join on the value with the interval as further condition. The most specific value
decides; on equal values `block` goes before `allow`. A hot host only meets its own few intervals, and its rows may be
split over tasks, as no window or group gathers captures by host.

Defined results: entries without value, date or a known action are ignored; of entries of one date the last action in
alphabetical order counts (`remove`); captures without a host or a fetch time match nothing and are kept (`none`); repeated
captures are judged one by one; an IP address matches only entries of the whole address, IPv6 in brackets; extra columns are
dropped; an empty list blocks nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.common import pick

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#@:]*)"
ADDRESS = r"^(\[.*|[0-9]+(\.[0-9]+){3})$"  # hosts that are IP addresses and have no parent domains
LISTS = ("allow", "block")


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and a closing dot, an IPv6 address with its brackets; empty if there is none."""
    return F.rtrim(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1)), F.lit("."))


def domains(host: Column) -> Column:
    """The host and its parent domains of at least two labels, longest first; an address stands for itself."""
    labels = F.split(host, r"\.")
    count = F.size(labels)
    parents = F.when(host.rlike(ADDRESS), F.lit(1)).otherwise(F.greatest(count - 1, F.lit(1)))
    every = F.transform(F.sequence(F.lit(1), parents), lambda i: F.array_join(F.slice(labels, i, count), "."))
    return F.when(host != "", every).otherwise(F.array().cast("array<string>"))


def validity(entries: DataFrame) -> DataFrame:
    """(list, value, since, until): when each value was on each list; `until` is null while it still is."""
    log = pick(entries, "list", "value", "action", "dated").where(F.col("list").isin(*LISTS) & F.col("action").isin("add", "remove"))
    log = log.where("value <> '' and dated is not null").withColumn("value", F.lower("value"))
    daily = log.groupBy("list", "value", "dated").agg(F.max("action").alias("action"))
    order = Window.partitionBy("list", "value").orderBy("dated")
    spans = daily.select("list", "value", "action", F.col("dated").alias("since"), F.lead("dated").over(order).alias("until"))
    return spans.where("action = 'add'").drop("action")


def filtered(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Captures (page_id, url, fetched) with host, verdict (block, allow, none) and the value that decided."""
    rows = pick(captures, "page_id", "url", "fetched").withColumn("host", host_of(F.col("url")))
    # Captures of one host and time share their verdict: look each up once, whatever their number.
    keys = rows.select("host", "fetched").where("host <> '' and fetched is not null").distinct()
    looked = keys.select("host", "fetched", F.explode(domains(F.col("host"))).alias("value"))
    active = (F.col("since") <= F.col("fetched")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until")))
    hits = looked.join(validity(entries), "value").where(active)
    best = hits.groupBy("host", "fetched").agg(F.max(F.struct(F.length("value").alias("n"), "list", "value")).alias("best"))
    out = rows.join(best, ["host", "fetched"], "left")
    return out.select("page_id", "host", "fetched", F.coalesce("best.list", F.lit("none")).alias("verdict"), F.col("best.value").alias("matched"))


# --- captures and lists derived from the table of pages --------------------------------------


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages with a fetch date within 2024, spread by page id."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 7, F.lit(366)).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched"))


def entries_of(pages: DataFrame) -> DataFrame:
    """A dated list log over the hosts of the pages: some domains blocked for a time, some hosts allowed again."""
    hosts = pages.select(host_of(F.col("url")).alias("value")).where("value <> ''").distinct()
    number = F.conv(F.substring(F.md5(F.col("value").cast("binary")), 1, 6), 16, 10).cast("long")
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(number, F.lit(n)).cast("int"))
    later = F.date_add(day(150), F.lit(60))

    def log(name: str, action: str, value: Column, when: Column, some: Column) -> DataFrame:
        return hosts.where(some).select(F.lit(name).alias("list"), value.alias("value"), F.lit(action).alias("action"), when.alias("dated"))

    parent = F.concat_ws(".", F.slice(F.split("value", r"\."), -2, 2))
    host, third = F.col("value"), number % 3 == 0
    out = log("block", "add", host, day(150), third)
    out = out.union(log("block", "remove", host, later, third & (number % 2 == 0)))
    out = out.union(log("block", "add", host, F.date_add(later, F.lit(90)), third & (number % 4 == 0)))
    out = out.union(log("allow", "add", host, day(300), number % 5 == 1))
    labels = F.size(F.split("value", r"\."))
    return out.union(log("block", "add", parent, F.lit("2024-08-01").cast("date"), (number % 7 == 0) & (labels > 2) & ~host.rlike(ADDRESS)))
