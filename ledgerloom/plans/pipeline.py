"""The run from files to export: load, clean, enrich, validate, export, with parquet checkpoints between steps.

    python -m ledgerloom.plans.pipeline INPUT OUTPUT [load|clean|enrich|validate|export|all|check] [--pages T] [--answers T] [--fetch]

Pages (url, html) and answers (key, answer) are Parquet tables. With --fetch, pages that are missing are fetched before the
enrich step and written under OUTPUT/tables, as are the answers of a model where one is given (`Pipeline.gather`).
"""

from __future__ import annotations

import argparse
import logging
import sys
import time
from contextlib import contextmanager
from logging.handlers import RotatingFileHandler

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions.text import cache_domain, find_emails, find_phones
from ledgerloom.operators.clean import clean, in_output_order, standard_columns, with_order
from ledgerloom.operators.enrich import FAILED, domains_to_fetch, enrich, enrichment_stats, prompt_text, render_prompt, split_done
from ledgerloom.operators.score import score_dataframe
from ledgerloom.operators.validate import findings, log_summary, report, save_report
from ledgerloom.runtime import remove, small_methods, write_text
from ledgerloom.schema import Settings
from ledgerloom.sources.export import export_csv, has_checkpoint, read_checkpoint, write_checkpoint
from ledgerloom.sources.html import ABOUT_PATHS, CONTACT_PATHS, LEADERSHIP_PATHS, extract_pages, full_text, scrape_state, sub_page_text
from ledgerloom.sources.loader import list_files, load_all
from ledgerloom.sources.providers import PAGE_SCHEMA, HttpFetcher, ask_model, fetch_pages

log = logging.getLogger("ledgerloom")
STEPS = ("load", "clean", "enrich", "validate", "export")


def setup_logging(level: str = "INFO", file: str | None = None) -> None:
    handlers: list[logging.Handler] = [logging.StreamHandler()]
    if file:
        handlers.append(RotatingFileHandler(file, maxBytes=10 * 1024 * 1024, backupCount=5, encoding="utf-8"))
    logging.basicConfig(level=level, handlers=handlers, format="%(asctime)s %(levelname)s %(message)s", force=True)


SUB_PAGES = {"about_text": ABOUT_PATHS, "contact_text": CONTACT_PATHS, "team_text": LEADERSHIP_PATHS}


def site_pages(pages: DataFrame, settings: Settings) -> DataFrame:
    """One extracted page per domain, the one with the shortest address, with its sub-pages' texts; contacts are looked for
    in all of them."""
    x = extract_pages(pages, most_chars=settings.max_text_chars).withColumn("_domain", cache_domain(F.col("url")))
    nearest = Window.partitionBy("_domain").orderBy(F.length(F.regexp_replace("url", "/+$", "")), "url")
    sites = x.withColumn("_n", F.row_number().over(nearest)).filter("_n = 1").drop("_n", "_domain")
    for name, paths in SUB_PAGES.items():
        sites = sites.join(sub_page_text(sites, x, paths, name), "url", "left")
    text = full_text(settings.max_text_chars)
    return sites.withColumns({"emails_found": find_emails(text), "phones_found": find_phones(text)})


@contextmanager
def timed(what: str, into: dict[str, float] | None = None):
    """Log, and keep, how long something took; also where it failed."""
    began = time.monotonic()
    try:
        yield
    finally:
        seconds = time.monotonic() - began
        if into is not None:
            into[what] = seconds
        log.info("%s took %.1f s", what, seconds)


def check_environment(spark: SparkSession, source: str, output: str, settings: Settings) -> dict[str, bool]:
    """What a run needs: a model's key, input files, an output folder that can be written to, a recent Python."""
    checks = {"model_key": settings.llm_enabled}
    try:
        checks["input_files"] = bool(list_files(spark, source))
    except (AnalysisException, Py4JJavaError):
        checks["input_files"] = False
    try:
        write_text(spark, f"{output}/.write_test", "")
        remove(spark, f"{output}/.write_test")
        checks["output_writable"] = True
    except Py4JJavaError:
        checks["output_writable"] = False
    return checks | {"python": sys.version_info >= (3, 10)}


class Pipeline:
    """Steps over checkpoints: each reads what the one before wrote, so a run resumes where it stopped."""

    def __init__(self, spark: SparkSession, source: str, output: str, settings: Settings | None = None):
        self.spark, self.source, self.output = spark, source, output.rstrip("/")
        self.settings = settings or Settings()
        self.timings: dict[str, float] = {}

    def path(self, step: str) -> str:
        return f"{self.output}/checkpoints/{step}"

    def has(self, step: str) -> bool:
        """Written to its end: a run that broke off leaves nothing that counts."""
        return has_checkpoint(self.spark, self.path(step))

    def read(self, *steps: str) -> DataFrame:
        """The first of the steps that has been run."""
        step = next((s for s in steps if self.has(s)), None)
        if step is None:
            raise FileNotFoundError(f"run one of {', '.join(steps)} first")
        return read_checkpoint(self.spark, self.path(step))

    def run(self, step: str, pages: DataFrame | None = None, answers: DataFrame | None = None):
        with timed(step, self.timings), small_methods(self.spark):
            return getattr(self, f"_{step}")(*((pages, answers) if step == "enrich" else ()))

    def summary(self) -> dict[str, float]:
        """Seconds of every step that was run, and of all of them."""
        return self.timings | {"all": sum(self.timings.values())}

    def _load(self):
        df, state = load_all(self.spark, self.source)
        write_checkpoint(with_order(df), self.path("load"))
        return state.summary()

    def _clean(self):
        write_checkpoint(clean(self.read("load"), self.settings), self.path("clean"))

    def _enrich(self, pages, answers):
        df = self.read("clean")
        if pages is None:
            out = score_dataframe(df, self.settings)
        else:
            if answers is not None:
                answers = answers.withColumn("domain", cache_domain(F.col("key"))).select("domain", "answer")
            out = enrich(df, site_pages(pages, self.settings), answers, self.settings)
        write_checkpoint(out, self.path("enrich"))
        done = self.read("enrich")
        stats = enrichment_stats(done).first().asDict() if FAILED in done.columns else {"processed": done.count()}
        log.info("enrichment: %s", stats)
        return stats

    def gather(self, pages: DataFrame | None = None, make_fetcher=HttpFetcher, make_model=None) -> tuple[DataFrame, DataFrame]:
        """Network and model calls, before the plan: fetches what `pages` lacks, asks the model, writes both as tables."""
        s, spark = self.settings, self.spark
        _, todo = split_done(self.read("clean"), s.skip_found)
        if pages is None:
            pages = spark.createDataFrame([], PAGE_SCHEMA)
        pages = pages.drop("cached", "state")
        if "fetched_at" not in pages.columns:
            pages = pages.withColumn("fetched_at", F.current_timestamp())
        facts = pages.select(cache_domain(F.col("url")).alias("domain"), "fetched_at")
        paths = F.array(*[F.lit(p) for p in ("", *[p for group in SUB_PAGES.values() for p in group])])
        wanted = domains_to_fetch(todo, facts, s.cache_ttl_days).select(F.explode(paths).alias("path"), "domain")
        new = fetch_pages(wanted.select(F.concat("domain", "path").alias("url")), s, pages, make_fetcher)
        newest = Window.partitionBy("url").orderBy(F.desc("fetched_at"))
        both = new.unionByName(pages, allowMissingColumns=True).withColumn("_n", F.row_number().over(newest))
        where = f"{self.output}/tables"
        both = both.filter("_n = 1").drop("_n")
        known = both.join(pages.select("url", F.lit(True).alias("cached")).distinct(), "url", "left")
        state = scrape_state(F.col("url"), F.col("cached"), ~F.coalesce(F.col("error") == "robots_blocked", F.lit(False)), F.col("status_code"), F.col("html").isNotNull())
        write_checkpoint(known.withColumns({"cached": F.coalesce("cached", F.lit(False)), "state": state}), f"{where}/pages")
        pages = read_checkpoint(spark, f"{where}/pages")
        names = todo.groupBy(cache_domain(F.coalesce("website", "linkedin")).alias("key")).agg(F.min("name").alias("name"))
        text = prompt_text(F.col("about_text"), F.col("team_text"), F.col("visible_text"), F.col("contact_text"), s)
        texts = site_pages(pages, s).select(cache_domain(F.col("url")).alias("key"), text.alias("text")).filter("text IS NOT NULL")
        prompts = texts.join(names, "key").select("key", render_prompt(F.col("text"), F.col("name")).alias("prompt"))
        write_checkpoint(ask_model(prompts, s, make_model), f"{where}/answers")
        return pages, read_checkpoint(spark, f"{where}/answers")

    def _validate(self):
        rows, one = report(self.read("enrich"), self.settings)
        write_checkpoint(rows, self.path("validate"))
        rows = self.read("validate")
        log_summary(one)
        return save_report(one, findings(rows), f"{self.output}/validation_report.json")

    def _export(self):
        df = self.read("validate", "enrich", "clean")
        return export_csv(standard_columns(in_output_order(df)), f"{self.output}/companies.csv", single=self.settings.single_export)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("input")
    p.add_argument("output")
    p.add_argument("step", nargs="?", default="all", choices=[*STEPS, "all", "check"])
    p.add_argument("--pages", help="Parquet table of pages: url, html")
    p.add_argument("--answers", help="Parquet table of a model's answers: key, answer")
    p.add_argument("--fetch", action="store_true", help="fetch pages that are missing before the enrich step")
    a = p.parse_args(argv)
    if a.answers and not (a.pages or a.fetch):
        p.error("--answers needs --pages or --fetch")
    setup_logging()
    spark = SparkSession.builder.appName("ledgerloom").getOrCreate()
    run = Pipeline(spark, a.input, a.output, Settings.from_env())
    if a.step == "check":
        for name, ok in check_environment(spark, a.input, a.output, run.settings).items():
            print("OK  " if ok else "FAIL", name)
        return 0
    for step in STEPS if a.step == "all" else (a.step,):
        pages = answers = None
        if step == "enrich":
            pages, answers = (spark.read.parquet(t) if t else None for t in (a.pages, a.answers))
            if a.fetch:
                pages, asked = run.gather(pages)
                answers = answers or asked
        run.run(step, pages, answers)
    log.info("seconds: %s", run.summary())
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
