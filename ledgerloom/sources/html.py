"""Facts from a page's HTML: title, descriptions, visible text, contacts, social links.

Visible text needs a tokenizer, so it is one Arrow-batched function over the standard parser; everything after it is
column expressions. NULL or empty HTML gives '' everywhere; broken markup is read as far as it goes; long pages are
parsed whole and only the visible text is cut, where the text limit is a setting of the extraction.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import text as X
from ledgerloom.functions.nulls import strip

# Elements whose content is no visible text, and paths where sub-pages are looked for, in order.
SKIPPED = (
    "script", "style", "noscript", "header", "footer", "nav", "aside", "meta", "head", "link", "form",
)
ABOUT_PATHS = (
    "/about", "/about-us", "/about_us", "/company", "/who-we-are", "/our-story", "/overview", "/mission", "/vision",
)
CONTACT_PATHS = (
    "/contact", "/contact-us", "/contact_us", "/get-in-touch", "/reach-us", "/support", "/help",
)
LEADERSHIP_PATHS = (
    "/leadership", "/team", "/our-team", "/management", "/executives", "/board-of-directors", "/leadership-team",
)

_VOID = {"meta", "link", "br", "img", "hr", "input", "area", "base", "col", "embed", "source", "track", "wbr"}


class _Page(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title: str | None = None
        self.meta: str | None = None
        self.og: str | None = None
        self.texts: list[str] = []
        self.open: list[str] = []
        self.in_title = False

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "meta":
            if self.meta is None and a.get("name", "").lower() == "description":
                self.meta = a.get("content", "").strip()
            if self.og is None and a.get("property") == "og:description":
                self.og = a.get("content", "").strip()
        if tag == "title" and self.title is None:
            self.in_title, self.title = True, ""
        if tag in SKIPPED and tag not in _VOID:
            self.open.append(tag)

    def handle_endtag(self, tag):
        if tag == "title":
            self.in_title = False
        if tag in self.open:
            while self.open.pop() != tag:
                pass

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        elif not self.open and (t := data.strip()):
            self.texts.append(t)


def parse_page(html: str | None) -> dict[str, str]:
    page = _Page()
    page.feed(html or "")
    page.close()
    visible = re.sub(r"\s{2,}", " ", " ".join(page.texts))
    return {
        "title": (page.title or "").strip(),
        "meta_description": page.meta or "",
        "og_description": page.og or "",
        "visible_text": visible,
    }


PARTS = ("title", "meta_description", "og_description", "visible_text")


def _parse_or_tell(html: str | None) -> dict[str, str]:
    """A page that can't be parsed gives '' everywhere and the reason; it doesn't end the job."""
    try:
        return parse_page(html) | {"parse_error": None}
    except Exception as e:  # noqa: BLE001 - whatever a broken page makes the parser raise
        return dict.fromkeys(PARTS, "") | {"parse_error": f"{type(e).__name__}: {e}"}


def page_parts(html: Column) -> Column:
    """Struct of title, meta_description, og_description, visible_text and parse_error (NULL where all went well)."""

    def run(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_parse_or_tell(p) for p in pages], columns=[*PARTS, "parse_error"])

    return F.pandas_udf(run, ", ".join(f"{c} string" for c in (*PARTS, "parse_error")))(html)


def best_description(p: Column) -> Column:
    parts = [F.nullif(strip(p[c]), F.lit("")) for c in ("og_description", "meta_description", "title")]
    return F.coalesce(*parts, F.lit(""))


def extract_pages(pages: DataFrame, html: str = "html", most_chars: int = 8000) -> DataFrame:
    """pages with the extracted fields; contacts come from the visible text, social links from the raw HTML."""
    raw = F.coalesce(F.col(html), F.lit(""))
    x = pages.withColumn("_p", page_parts(F.col(html)))
    p = F.col("_p")
    visible = F.substring(p["visible_text"], 1, most_chars)
    x = x.withColumns(
        {
            "title": p["title"],
            "meta_description": p["meta_description"],
            "og_description": p["og_description"],
            "visible_text": visible,
            "best_description": best_description(p),
            "parse_error": p["parse_error"],
            "linkedin_found": X.find_linkedin(raw),
            **{f"{n}_found": X.find_social(raw, n) for n in X.SOCIAL_SITES},
        }
    )
    return x.withColumns(
        {"emails_found": X.find_emails(F.col("visible_text")), "phones_found": X.find_phones(F.col("visible_text"))}
    ).drop("_p")


def full_text(most_chars: int = 8000) -> Column:
    parts = [F.nullif(F.coalesce(F.col(c), F.lit("")), F.lit("")) for c in ("visible_text", "about_text", "contact_text", "team_text")]
    return F.substring(F.concat_ws("\n\n", *parts), 1, most_chars)


def redirected(requested: Column, final: Column) -> Column:
    bare = lambda c: F.regexp_replace(c, "/+$", "")
    return bare(requested) != bare(final)


def sub_page_text(sites: DataFrame, pages: DataFrame, paths: tuple[str, ...], to: str) -> DataFrame:
    """Per site url the text of the first of the paths that has one. pages: url, visible_text.

    A page's url is taken apart into site and path; sites aren't multiplied by paths. What Spark estimates of either side
    is the size of the columns read, not of the texts made of them, so the join is never a broadcast.
    """
    bare = lambda p: F.expr(f"left(url, length(url) - {len(p)})")
    ends = [F.when(F.col("url").endswith(p), F.struct(bare(p).alias("site"), F.lit(i).alias("pos"))) for i, p in enumerate(paths)]
    known = pages.filter("trim(visible_text) != ''").select("visible_text", F.explode(F.array_compact(F.array(*ends))).alias("e"))
    texts = known.groupBy("e.site").agg(F.min_by("visible_text", "e.pos").alias(to))
    asked = sites.select("url", F.regexp_replace("url", "/+$", "").alias("site")).distinct()
    return asked.join(texts.hint("merge"), "site").select("url", to)


def scrape_state(url: Column, cached: Column, allowed: Column, status_code: Column, parsed: Column) -> Column:
    """Outcome of a scrape, from what is known about it; the first that holds."""
    return (
        F.when(F.coalesce(strip(url), F.lit("")) == "", "empty_url")
        .when(F.coalesce(cached, F.lit(False)), "cache_hit")
        .when(~F.coalesce(allowed, F.lit(True)), "robots_blocked")
        .when(~F.coalesce(status_code.between(200, 299), F.lit(False)), "fetch_failed")
        .when(~F.coalesce(parsed, F.lit(False)), "parse_error")
        .otherwise("success")
    )
