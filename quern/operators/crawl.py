"""A crawl frontier over fetched pages: rounds of links, each round's new ones an anti-join against all that were seen."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.scalars import host
from quern.session import staged

ROUNDS = 64
OUTCOMES = ("fetched", "missing", "domain_not_allowed", "host_budget", "rounds")


def allowed(url: Column, domains: Sequence[str]) -> Column:
    """Whether the url's host is one of the domains or lies under one."""
    of = host(url)
    return F.coalesce(reduce(lambda a, b: a | b, ((of == d) | of.endswith(f".{d}") for d in domains), F.lit(False)), F.lit(False))


def crawl(pages: DataFrame, seeds: DataFrame, domains: Sequence[str], per_host: int | None = None, rounds: int = ROUNDS) -> DataFrame:
    """(url, depth, found_on, outcome) of every url that is reached from the seeds (url).

    pages: url, links (absolute urls), as fetched; rows that repeat a url add their
    links. A url is met in the first round that links to it, found on the least of
    that round's urls that do. Those of foreign hosts are not followed
    (domain_not_allowed); of a host at most `per_host` are taken, in order of round,
    finder and url, the rest is host_budget; taken urls without a page are missing;
    what a last round still finds is `rounds`. Null urls and links take no part.
    Nothing is lost: every url met is one row. Each round is staged.
    """
    links = pages.where(F.col("url").isNotNull()).select("url", F.explode("links").alias("to")).where(F.col("to").isNotNull())
    known = pages.select("url").where(F.col("url").isNotNull()).distinct().withColumn("_page", F.lit(True))
    new = seeds.select("url", F.lit(None).cast("string").alias("found_on")).where(F.col("url").isNotNull()).distinct()
    done: list[DataFrame] = []
    for depth in range(rounds + 1):
        good = allowed(F.col("url"), domains)
        met = new.withColumn("_host", host(F.col("url"))).withColumn("_good", good)
        if per_host is not None:
            taken = met.where("_good").withColumn("_n", F.row_number().over(Window.partitionBy("_host").orderBy(F.col("found_on").asc_nulls_first(), "url"))).where(F.col("_n") <= per_host)
            if done:
                used = reduce(lambda a, b: a.unionByName(b), done).where(F.col("outcome").isin("fetched", "missing"))
                used = used.groupBy(host(F.col("url")).alias("_host")).agg(F.count("*").alias("_used"))
                taken = taken.join(used, "_host", "left").where(F.col("_n") <= per_host - F.coalesce("_used", F.lit(0)))
            met = met.join(taken.select("url", F.lit(True).alias("_taken")), "url", "left")
        else:
            met = met.withColumn("_taken", F.lit(True))
        outcome = (F.when(~F.col("_good"), "domain_not_allowed").when(F.lit(depth == rounds), "rounds").when(F.col("_taken").isNull(), "host_budget")
                   .when(F.col("_page"), "fetched").otherwise("missing"))
        now = staged(met.join(known, "url", "left").select("url", F.lit(depth).alias("depth"), "found_on", outcome.alias("outcome")))
        done.append(now)
        if depth == rounds or now.where("outcome = 'fetched'").isEmpty():
            break
        seen = reduce(lambda a, b: a.unionByName(b), done).select("url")
        found = now.where("outcome = 'fetched'").select("url").join(links, "url").groupBy(F.col("to").alias("url")).agg(F.min("url").alias("found_on"))
        new = staged(found.join(seen, "url", "left_anti"))
    return reduce(lambda a, b: a.unionByName(b), done)
