"""Which URLs may be visited: allowlist, revisit age, queue membership."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.urls import url_domain
from millrace.operators.sizing import broadcast_if_small, fits_broadcast, store

REVISIT_AFTER_SECONDS = 86_400

Rule = Callable[..., DataFrame]  # (urls, name of the URL column) -> those allowed


def distinct_domains(urls: DataFrame, url: str = "url") -> DataFrame:
    """The domains of ``urls``, once each."""
    return urls.select(url_domain(F.col(url)).alias("domain")).distinct()


def allow_all(df: DataFrame, url: str = "url") -> DataFrame:
    """Every URL that has a domain."""
    return df.where(url_domain(F.col(url)) != "")


def allow_exact(df: DataFrame, allowlist: DataFrame, url: str = "url") -> DataFrame:
    """URLs whose domain is in ``allowlist(domain)``."""
    return exact_rule(allowlist)(df, url)


def _names(allowlist: DataFrame) -> DataFrame:
    """Distinct names as domains are written: trimmed, in lower case, none blank."""
    return allowlist.select(F.lower(F.trim("domain")).alias("domain")).where("domain <> ''").distinct()


def exact_rule(allowlist: DataFrame) -> Rule:
    """:func:`allow_exact` for repeated use: the allowlist is measured once."""
    allowed = broadcast_if_small(store(_names(allowlist).withColumnRenamed("domain", "_domain")))

    def rule(df: DataFrame, url: str = "url") -> DataFrame:
        same = url_domain(F.col(url)) == F.col("_domain")
        return allow_all(df, url).join(allowed, same, "left_semi")

    return rule


def allow_subdomains(df: DataFrame, allowlist: DataFrame, url: str = "url") -> DataFrame:
    """URLs whose domain is in ``allowlist(domain)`` or below one of its names."""
    return subdomain_rule(allowlist)(df, url)


def _suffixes(domain: str) -> Column:
    """A domain and all it lies below: ``a.b.c``, ``b.c``, ``c``."""
    labels = F.size(F.split(domain, "[.]", -1))
    return F.transform(F.sequence(F.lit(1), labels), lambda k: F.call_function("substring_index", F.col(domain), F.lit("."), -k))


def _topmost(names: DataFrame) -> DataFrame:
    """Names that lie below no other of ``names(domain)``: what is below them is allowed anyway."""
    above = F.explode(F.array_remove(_suffixes("domain"), F.col("domain"))).alias("_above")
    covered = names.select("domain", above).join(names.select(F.col("domain").alias("_above")), "_above", "left_semi")
    return names.join(covered.select("domain"), "domain", "left_anti")


def subdomain_rule(allowlist: DataFrame) -> Rule:
    """:func:`allow_subdomains` for repeated use: the allowlist is measured once.

    "Below" is turned into equality with one of a domain's own suffixes. Of the list only the
    topmost names are kept, so at most one suffix of a domain is in it, and one semi join finds it,
    however many labels names have. A large allowlist first meets the distinct domains, so that
    joins on a domain never carry the URLs.
    """
    allowed = store(_topmost(store(_names(allowlist))).select(F.col("domain").alias("_name")))
    small = fits_broadcast(allowed)

    def match(domains: DataFrame) -> DataFrame:
        names = F.broadcast(allowed) if small else allowed
        split = domains.select("*", F.explode(_suffixes("_domain")).alias("_suffix"))
        return split.join(names, F.col("_suffix") == F.col("_name"), "left_semi").drop("_suffix")

    def rule(df: DataFrame, url: str = "url") -> DataFrame:
        if small:
            placed = allow_all(df, url).withColumn("_domain", url_domain(F.col(url)))
            return match(placed).select(df.columns)
        domains = distinct_domains(df, url).where("domain <> ''").withColumnRenamed("domain", "_domain")
        return allow_exact(df, match(domains).withColumnRenamed("_domain", "domain"), url)

    return rule


def link_rule(
    seed_domains: DataFrame,
    allowed_domains: DataFrame | None = None,
    same_domain_only: bool = True,
    subdomains: bool = True,
) -> Rule:
    """The allowlist rule with its switches, as a function of a table of URLs.

    The list is ``allowed_domains`` if given and not empty, else the seeds' domains; without
    ``same_domain_only`` only a given list restricts, and then by exact domain.
    """
    if allowed_domains is not None and _names(allowed_domains).isEmpty():
        allowed_domains = None
    allowlist = seed_domains if allowed_domains is None else allowed_domains
    if same_domain_only and subdomains:
        return subdomain_rule(allowlist)
    if not same_domain_only and allowed_domains is None:
        return allow_all
    return exact_rule(allowlist)


def allowed_links(df: DataFrame, seed_domains: DataFrame, url: str = "url", **switches) -> DataFrame:
    """:func:`link_rule` applied to ``df``."""
    return link_rule(seed_domains, **switches)(df, url)


def visits_of(urls: DataFrame, visited: DataFrame) -> DataFrame:
    """The part of ``visited`` that concerns ``urls(url)``, a stored table.

    Where the URLs are measured to be few they are sent to the visit table;
    the semi join moves below its aggregate, and the history is read once
    without a shuffle.
    """
    wanted = urls.select("url").distinct()
    return visited.join(F.broadcast(wanted), "url", "left_semi") if fits_broadcast(wanted) else visited


def revisit_due(
    df: DataFrame,
    visited: DataFrame,
    now: Column | int,
    revisit_after: int = REVISIT_AFTER_SECONDS,
    url: str = "url",
) -> DataFrame:
    """URLs not in ``visited(url, last_visited)``, or visited ``revisit_after`` seconds ago or more."""
    last = visited.select(F.col("url").alias("_url"), F.col("last_visited").alias("_last"))
    now = F.lit(now) if isinstance(now, int) else now
    joined = df.join(last, F.col(url) == F.col("_url"), "left")
    due = F.col("_last").isNull() | (now - F.col("_last") >= revisit_after)
    return joined.where(due).select(df.columns)


def not_queued(df: DataFrame, queue: DataFrame, url: str = "url") -> DataFrame:
    """URLs that are not in ``queue(url)``."""
    waiting = queue.select(F.col("url").alias("_url")).distinct()
    return df.join(waiting, F.col(url) == F.col("_url"), "left_anti")
