"""Filtering of URLs by rules and by a list, with DataFrame functions only.

Rules name a host and the beginning of a path and hold for the host's subdomains too; of the rules that fit, the
longest decides. Where none fits, a URL is blocked if its canonical form is on the list. A blocked Bloom filter of
the list, eight bits in one block of 256, is sent to every executor and passes possible hits; only
these go on to an exact hash join with the list, which removes the false ones. The filter grows with
the list up to ``filter_bytes``; beyond that it passes more URLs to the exact join and the result
stays the same.

Defined results: a null URL or one without ``://`` has an empty host and path, fits no rule, has no canonical form
and is allowed; rows that repeat an id or a URL are judged alike; null entries of the list are
ignored; an empty list blocks nothing; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from .bloom import FILTER_BYTES, maybe_among
from .common import join_groups, landed

#: Verdict, host and path of the rules of the registered query.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Query parameters that do not tell pages apart.
TRACKING = "^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(F.coalesce(at, F.lit(0)) > 0, url.substr(at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), ascii_uppercase, ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without user, default port and www, path without final slashes, other than tracking parameters in order; null without a host."""
    host = reduce(lambda h, p: F.regexp_replace(h, p, ""), ("^[^@]*@", r":(80|443)\z", r"^www\."), host_of(url))
    query = F.split(F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1), "&")
    kept = F.array_join(F.array_sort(F.filter(query, lambda p: (p != "") & ~p.rlike(TRACKING))), "&")
    return F.when(host != "", F.concat(host, F.regexp_replace(path_of(url), r"/+\z", ""), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The rule that decides and its verdict, null if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, of, begins in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]), r[0])):  # the longest is asked first
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(begins)
        name, verdict = F.when(fits, of + begins).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def filter_urls(
    df: DataFrame, listed: DataFrame, id: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES, filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``listed`` of each row; ``listed`` has canonical URLs in its first column."""
    listed = landed(listed.select(F.col(listed.columns[0]).alias("canonical")).filter("canonical is not null").distinct(), "listed")
    address = df[url].cast("string")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = df.select(df[id].alias("page_id"), host_of(address).alias("host"), path_of(address).alias("path"), canonical(address).alias("canonical"))
    rows = rows.select("*", rule.alias("rule"), verdict.alias("says"))
    probed = maybe_among(rows, F.col("canonical"), listed, "hit", filter_bytes)
    judged = landed(probed.select("page_id", "host", "path", "rule", "says", "canonical", (
        F.col("canonical").isNotNull() & F.col("hit")).alias("maybe")), "judged")
    maybe = judged.filter("maybe")
    found = maybe.groupBy("canonical").agg(F.count(F.lit(1)).alias("n")).join(listed, "canonical", "left_semi")
    hits = join_groups(maybe, found, "canonical", "n", judged.count()).withColumn("listed", F.lit(True))
    false = judged.filter("maybe").join(found.select("canonical"), "canonical", "left_anti").withColumn("listed", F.lit(False))
    rest = judged.filter("not maybe").withColumn("listed", F.lit(False))
    columns = ["page_id", "host", "path", "rule", "says", "listed"]
    every = hits.select(columns).unionByName(false.select(columns)).unionByName(rest.select(columns))
    return every.select("page_id", "host", "path", "rule", F.coalesce(
        "says", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")


def claimed_twice(df: DataFrame, url: str = "url") -> DataFrame:
    """The canonical URLs that more than one row has."""
    return df.select(canonical(df[url].cast("string")).alias("canonical")).groupBy("canonical").agg(F.count(F.lit(1)).alias("n")).filter(
        "canonical is not null and n > 1").select("canonical")
