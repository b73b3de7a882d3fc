"""Robots rules as a join: bodies become ordered rules per host, URLs look theirs up.

Input table: ``robots(base, status, body)`` with ``base`` as ``scheme://host``;
a null status stands for a failed fetch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import WHITESPACE
from millrace.functions.urls import url_base
from millrace.operators.admission import Rule
from millrace.operators.sizing import broadcast_if_small, store

_LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"
_EDGES = rf"^[{WHITESPACE}]+|[{WHITESPACE}]+\z"
_BEFORE_PATH = r"(?s)^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?"


def _same_escapes(part: Column) -> Column:
    """Percent-decode, then encode all but ``/`` and unreserved characters."""
    plain = F.regexp_replace(part, "%(?![0-9A-Fa-f]{2})", "%25")
    coded = F.url_encode(F.url_decode(F.replace(plain, F.lit("+"), F.lit("%2B"))))
    for found, put in (("+", "%20"), ("%2F", "/"), ("*", "%2A"), ("%7E", "~")):
        coded = F.replace(coded, F.lit(found), F.lit(put))
    return coded


def _path(part: Column) -> Column:
    """Comparable path; an empty query or fragment mark does not count."""
    return _same_escapes(F.regexp_replace(part, r";?\??#?\z", ""))


def rules_for_agent(robots: DataFrame, user_agent: str) -> DataFrame:
    """``(base, rules)``: for each host the rules of the group that applies to the agent.

    That is the first group naming it, else the first ``*`` group. The windows
    run inside one robots body each.
    """
    agent = user_agent.split("/")[0].lower()
    lines = robots.where("status < 400").select(
        "base", F.posexplode(F.split("body", _LINE_BREAK, -1)).alias("pos", "raw")
    )
    text = F.regexp_replace(F.regexp_replace("raw", "(?s)#.*", ""), _EDGES, "")
    key = F.lower(F.regexp_replace(F.regexp_extract(text, "(?s)^([^:]*):", 1), _EDGES, ""))
    value = F.regexp_replace(F.regexp_extract(text, "(?s)^[^:]*:(.*)", 1), _EDGES, "")
    kind = (
        F.when(F.col("raw") == "", "blank")
        .when(key == "user-agent", "agent")
        .when(key.isin("allow", "disallow", "crawl-delay", "request-rate"), key)
    )
    read = lines.select("base", "pos", kind.alias("kind"), value.alias("value")).where("kind is not null")

    # A blank line ends a group; so does a user-agent line that follows a rule.
    in_body = Window.partitionBy("base").orderBy("pos")
    blocks = read.withColumn("block", F.count_if(F.col("kind") == "blank").over(in_body)).where(
        "kind <> 'blank'"
    )
    in_block = Window.partitionBy("base", "block").orderBy("pos")
    opens = (F.col("kind") == "agent") & (F.coalesce(F.lag("kind").over(in_block), F.lit("")) != "agent")
    members = (
        blocks.withColumn("opens", opens)
        .withColumn("part", F.count_if("opens").over(in_block))
        .where("part > 0")
    )
    is_rule = F.col("kind").isin("allow", "disallow")
    allow = (F.col("kind") == "allow") | (F.col("value") == "")
    rule = F.struct("pos", _path(F.col("value")).alias("path"), allow.alias("allow"))
    groups = members.groupBy("base", "block", "part").agg(
        F.collect_list(F.when(F.col("kind") == "agent", F.lower("value"))).alias("agents"),
        F.array_sort(F.collect_list(F.when(is_rule, rule))).alias("rules"),
        F.bool_or(F.col("kind") != "agent").alias("closed"),
    )
    general = F.array_contains("agents", "*")
    named = F.exists("agents", lambda a: F.lit(agent).contains(a))
    fitting = groups.where("closed").where(general | named)
    return fitting.groupBy("base").agg(
        F.min_by("rules", F.struct(general, F.col("block"), F.col("part"))).alias("rules")
    )


def _one_per_base(robots: DataFrame) -> DataFrame:
    """The newest row of each base by ``fetched_at``, where there is one, else the smallest row."""
    others = F.struct(*[c for c in robots.columns if c != "base"])
    one = F.max_by(others, "fetched_at") if "fetched_at" in robots.columns else F.min(others)
    return robots.groupBy("base").agg(one.alias("_one")).select("base", "_one.*")


def robots_rule(robots: DataFrame, user_agent: str) -> Rule:
    """:func:`robots_allowed` for repeated use: rules are read and measured once."""
    robots = _one_per_base(robots)
    rules = robots.select("base", "status").join(rules_for_agent(robots, user_agent), "base", "left")
    rules = store(rules.select(F.col("base").alias("_base"), "status", "rules"))
    rules = broadcast_if_small(rules)
    first = F.get(F.filter("rules", lambda r: F.col("_path").startswith(r["path"])), F.lit(0))
    allowed = (
        F.when(F.col("status").isNull(), F.lit(True))
        .when(F.col("status").isin(401, 403), F.lit(False))
        .when(F.col("status") >= 500, F.lit(False))
        .when(F.col("status") >= 400, F.lit(True))
        .otherwise(F.coalesce(first["allow"], F.lit(True)))
    )

    def rule(df: DataFrame, url: str = "url") -> DataFrame:
        path = _path(F.regexp_replace(F.col(url), _BEFORE_PATH, ""))
        placed = df.withColumn("_base", url_base(F.col(url))).join(rules, "_base", "left")
        rooted = placed.withColumn("_path", F.when(path == "", F.lit("/")).otherwise(path))
        return rooted.where(allowed).select(df.columns)

    return rule


def robots_allowed(df: DataFrame, robots: DataFrame, user_agent: str, url: str = "url") -> DataFrame:
    """URLs the robots table does not forbid to ``user_agent``.

    401 and 403 forbid the host, other 4xx allow it, 5xx forbid it; a failed
    fetch or an absent host allows it. Otherwise the first rule whose path
    starts the URL's path decides. Of several rows of a host one is taken, so the join
    does not multiply URLs.
    """
    return robots_rule(robots, user_agent)(df, url)
