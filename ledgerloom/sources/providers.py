"""Interfaces to the outside: page fetcher and model. Both run as their own stage before the lazy plan and write a table;
the defaults are offline, reading tables of pages and answers."""

from __future__ import annotations

import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import text as X
from ledgerloom.schema import Settings

PAGE_SCHEMA = "url string, final_url string, status_code int, html string, error string, redirect_count int"
AGENTS = ("Mozilla/5.0 (X11; Linux x86_64)", "Mozilla/5.0 (Windows NT 10.0; Win64; x64)", "Mozilla/5.0 (Macintosh)")


def with_retry(call: Callable[[], object], attempts: int, backoff: float, errors: tuple, sleep=time.sleep):
    """Call until it works, at most `attempts` times; waits grow exponentially between 1 and 30 seconds."""
    for k in range(max(1, attempts)):
        try:
            return call()
        except errors:
            if k + 1 >= max(1, attempts):
                raise
            sleep(min(30.0, max(1.0, backoff * 2**k)))
    return None


class HttpFetcher:
    """One GET per url with rotating agents, time-out, redirects, robots rules per origin and a rate per partition."""

    def __init__(self, settings: Settings, opener: Callable | None = None, sleep=time.sleep):
        self.settings, self.sleep = settings, sleep
        self.open = opener or (lambda req: urllib.request.urlopen(req, timeout=settings.request_timeout))
        self.rules: dict[str, RobotFileParser | None] = {}

    def allowed(self, url: str) -> bool:
        parts = urlsplit(url)
        origin = f"{parts.scheme}://{parts.netloc}"
        if origin not in self.rules:
            rules = RobotFileParser()
            try:
                with self.open(urllib.request.Request(f"{origin}/robots.txt")) as r:
                    rules.parse(r.read().decode("utf-8", "replace").splitlines())
                self.rules[origin] = rules
            except OSError:
                self.rules[origin] = None  # out of reach means allowed
        known = self.rules[origin]
        return known is None or known.can_fetch("*", url)

    def fetch(self, url: str) -> dict:
        out = {"url": url, "final_url": None, "status_code": None, "html": None, "error": None, "redirect_count": 0}
        if self.settings.respect_robots and not self.allowed(url):
            return out | {"error": "robots_blocked"}

        def get():
            req = urllib.request.Request(url, headers={"User-Agent": random.choice(AGENTS), "Accept": "text/html"})
            with self.open(req) as r:
                return r.status, r.geturl(), r.read().decode("utf-8", "replace")

        s = self.settings
        try:
            code, final, html = with_retry(get, s.max_retries, s.retry_backoff_factor, (ConnectionError, TimeoutError), self.sleep)
        except (OSError, urllib.error.URLError) as e:
            return out | {"error": str(e), "status_code": getattr(e, "code", None)}
        return out | {"final_url": final, "status_code": code, "html": html, "redirect_count": int(final != url)}


def fetch_pages(urls: DataFrame, settings: Settings, cached: DataFrame | None = None, make=HttpFetcher) -> DataFrame:
    """Pages of distinct urls that aren't in the cache of at most `page_ttl_hours`; one fetcher per partition."""
    todo = urls.select(X.ensure_scheme(F.col("url")).alias("url")).distinct().withColumn("_key", X.cache_key(F.col("url")))
    if cached is not None:
        fresh = F.col("fetched_at") > F.current_timestamp() - F.expr(f"INTERVAL {settings.page_ttl_hours} HOURS")
        known = cached.filter(fresh).select(X.cache_key(F.col("url")).alias("_key"))
        todo = todo.join(known, "_key", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetcher = make(settings)
        for b in batches:
            rows = []
            for url in b["url"]:
                rows.append(fetcher.fetch(url))
                fetcher.sleep(1 / settings.requests_per_second)
            yield pd.DataFrame(rows)

    return todo.select("url").mapInPandas(run, PAGE_SCHEMA).withColumn("fetched_at", F.current_timestamp())


def ask_model(prompts: DataFrame, settings: Settings, make: Callable[[Settings], Callable[[str], str]] | None = None) -> DataFrame:
    """key, answer: a model's raw answers; NULL for all where no model is configured."""
    if make is None or not settings.llm_enabled:
        return prompts.select("key", F.lit(None).cast("string").alias("answer"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = make(settings)
        for b in batches:
            got = []
            for p in b["prompt"]:
                try:
                    got.append(
                        with_retry(lambda p=p: ask(p), settings.max_retries + 1, settings.retry_backoff_factor, (ConnectionError, TimeoutError))
                    )
                except OSError:
                    got.append(None)
                time.sleep(60 / settings.llm_requests_per_minute)
            yield pd.DataFrame({"key": b["key"], "answer": got})

    return prompts.select("key", "prompt").mapInPandas(run, "key string, answer string")
