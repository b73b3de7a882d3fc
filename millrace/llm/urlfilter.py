"""URL filter: rules by host and path, else a logistic regression on hashed character n-grams.

The model is trained from a small labelled table of URLs. Each n-gram of the
host and of the path is one feature; a URL is blocked from probability 0.5 on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shingles import mix

FEATURE_BITS = 18
GRAMS = (3, 4, 5)
_DIGITS = bytes.maketrans(b"123456789", b"000000000")
#: Labelled hosts and paths: ordinary reading, and what a text corpus does not want.
KEEP_HOSTS = (
    "www.example.com", "blog.example.org", "news.example.net", "m.example.org", "docs.example.com",
    "wiki.example.org", "library.example.edu", "journal.example.net", "history.example.net", "garden.example.com",
    "www.weather.example.org", "blog.cooking.example.com", "m.science.example.net", "theatre.example.org",
    "www.nation.example.net", "blog.others.example.com", "m.thread.example.org", "this-and-that.example.com",
)
KEEP_PATHS = (
    "", "/", "/en/12345", "/fr/2020/05/article.html", "/de/98765/", "/es/noticias/31415", "/about", "/posts/how-to-read",
    "/wiki/History", "/archive/1998/index.html", "/science/water", "/en/40451.html",
    "/de/news/", "/es/77", "/fr/1234", "/es/", "/de/5.html", "/fr/99/",
)
BLOCK_HOSTS = (
    "casino-bonus.example.com", "free-xxx-videos.example.net", "cheap-pills.example.org", "hot-porn.example.com",
    "betting-slots.example.net", "ads.tracker.example.com", "adserver.example.org", "poker-jackpot.example.net",
    "viagra-online.example.com", "warez-crack.example.org", "adult-cams.example.com", "sports-bets.example.net",
    "seo-spam.example.org", "link-farm.example.org", "casino-games.example.net", "ads-click.example.com",
    "lucky-win.example.net", "spam-links.example.com",
    "content-farm.example.net", "www.big-win.example.com", "blog.casino-club.example.org", "adult-dating.example.org", "free-pills.example.com", "live-bets.example.org",
)
BLOCK_PATHS = (
    "/casino/free-spins", "/xxx/video/1", "/porn/gallery", "/buy-viagra-online", "/poker/bonus", "/ads/click",
    "/banner/track", "/torrent/crack-keygen", "/sex/chat", "/slots/jackpot", "/adult/cams", "/payday-loans/apply",
)


def labelled_urls() -> list[tuple[str, int]]:
    """(url, 1 to block): kept hosts with kept paths, and any host or path that is blocked."""
    rows = [(f"https://{h}{p}", 0) for h in KEEP_HOSTS for p in KEEP_PATHS]
    rows += [(f"https://{h}{p}", 1) for h in BLOCK_HOSTS for p in (*KEEP_PATHS, *BLOCK_PATHS)]
    return rows + [(f"https://{h}{p}", 1) for h in KEEP_HOSTS for p in BLOCK_PATHS]


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(found, upper, upper.lower())


def path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all URLs, and the URL of each. Host and path have features of their
    own, and all digits are one."""
    out, owner = [], []
    for kind, values in enumerate((hosts, paths)):
        raw = [f"\2{v}\3".encode("utf-8", "surrogatepass").translate(_DIGITS) for v in values]
        buffer = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
        whose = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
        for n in GRAMS:
            if len(buffer) < n:
                continue
            last = len(buffer) - n + 1
            code = np.full(last, 2 * n + kind, np.uint64)
            for place in range(n):
                code = code * np.uint64(257) + buffer[place : place + last]
            inside = whose[:last] == whose[n - 1 :]
            out.append((mix(code[inside]) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64))
            owner.append(whose[:last][inside])
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(owner)


def _parts(url: str) -> tuple[str, str]:
    _, mark, rest = url.partition("://")
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    tail = rest[end:]
    return (rest[:end].lower(), tail.split("#")[0].split("?")[0]) if mark else ("", "")


class Model:
    def __init__(self, weights: np.ndarray, bias: float) -> None:
        self.weights, self.bias = weights, bias

    def probability(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        found, owner = features(hosts, paths)
        z = self.bias + np.bincount(owner, self.weights[found], len(hosts))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(labelled: list[tuple[str, int]], epochs: int = 800, rate: float = 0.5, decay: float = 1e-4) -> Model:
    """Logistic regression by gradient descent, both labels having the same weight in all."""
    parts = [_parts(u) for u, _ in labelled]
    y = np.array([b for _, b in labelled], float)
    found, owner = features([h for h, _ in parts], [p for _, p in parts])
    used, short = np.unique(found, return_inverse=True)
    weights, bias = np.zeros(len(used)), 0.0
    share = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    for _ in range(epochs):
        p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(owner, weights[short], len(y)), -30, 30)))
        slope = (p - y) * share
        weights -= rate * (np.bincount(short, slope[owner], len(used)) + decay * weights)
        bias -= rate * slope.sum()
    whole = np.zeros(1 << FEATURE_BITS)
    whole[used] = weights
    return Model(whole, bias)


def rule_of(host_: Column, path_: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting rule (host and path as one text); null if none fits.

    ``rules`` are (host, path, verdict): a rule fits its host and all subdomains
    where the path starts with the rule's.
    """
    out = F.lit(None).cast("string")
    for name, start, _ in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host_ == name) | host_.endswith(f".{name}")) & path_.startswith(start)
        out = F.when(fits, F.lit(name + start)).otherwise(out)
    return out


def judge(
    pages: DataFrame, rules: list[tuple[str, str, str]], model: Model, page_id: str = "page_id", url: str = "url"
) -> DataFrame:
    """Per row: (page_id, host, path, rule, verdict, probability).

    ``probability`` is the model's, for every URL; the verdict (``allow`` or ``block``)
    is the rule's where one fits, else the model's. A null URL, or one without
    ``://``, has an empty host and path and is judged by the model. Repeated rows
    and rows without an id are judged alike. Other columns are ignored.
    """
    used = np.flatnonzero(model.weights)
    values, bias = model.weights[used], model.bias

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        weights = np.zeros(1 << FEATURE_BITS)
        weights[used] = values
        local = Model(weights, bias)
        for hosts, paths in batches:
            out = [np.zeros(0)]
            for at in range(0, len(hosts), 1024):
                out.append(local.probability(hosts[at : at + 1024].tolist(), paths[at : at + 1024].tolist()))
            yield pd.Series(np.concatenate(out))

    split = pages.select(
        F.col(page_id).alias("page_id"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path")
    )
    probability = F.pandas_udf(run, "double")(F.col("host"), F.col("path"))
    found = split.select("*", rule_of(F.col("host"), F.col("path"), rules).alias("rule"), probability.alias("probability"))
    verdict = F.when(F.col("probability") >= 0.5, "block").otherwise("allow")
    for name, start, said in rules:
        verdict = F.when(F.col("rule") == name + start, said).otherwise(verdict)
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "probability")
