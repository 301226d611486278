"""Loading, cleaning, linking, scoring, validation, enrichment and export."""

import itertools
import json
import random
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import similarity, text
from ledgerloom.functions.similarity import indel_ratio, similar_pairs
from ledgerloom.operators import clean, enrich, score, validate
from ledgerloom.operators.clean import ORD
from ledgerloom.operators.graph import connected_components
from ledgerloom.plans import company
from ledgerloom.plans.pipeline import Pipeline, check_environment, main
from ledgerloom.schema import SOURCE_FILE, STANDARD_COLUMNS, STANDARD_SCHEMA, Settings
from ledgerloom.sources import export, html, providers
from ledgerloom.sources.headers import column_mapping, detect_column, plain
from ledgerloom.sources.loader import list_files, load_all, load_single, probe
from ledgerloom.streaming import ingest

GOOD = dict(
    company_id="1", name="Acme Corporation", website="acme.com", description="Makes sturdy tools for small workshops.", industry="Tools",
    ceo="Jane Smith", founder="Jane Smith, John Doe", size="11-50", email="a@acme.com", phone="+1 555 123 4567",
    linkedin="https://www.linkedin.com/company/acme", facebook="https://www.facebook.com/acme", twitter="https://www.twitter.com/acme",
    instagram="https://www.instagram.com/acme", confidence_score="85", status="FOUND", source_used="official_website",
)


def frame(spark, *rows):
    data = [tuple(r.get(c) for c in STANDARD_COLUMNS) for r in rows]
    return spark.createDataFrame(data, STANDARD_SCHEMA).withColumn(ORD, F.monotonically_increasing_id())


# ---- headers and loading ----
def test_headers():
    assert plain(" Company Name-X ") == "company_name_x"
    assert detect_column(["domain", "website"], "website") == "website"
    assert detect_column(["our_website_now"], "website") == "our_website_now"
    assert column_mapping(["company_name", "website", "linkedin_url"]) == {"company_name": "name", "website": "website", "linkedin_url": "linkedin"}
    assert column_mapping(["linkedin_url"]) == {"linkedin_url": "linkedin"}
    assert column_mapping([]) == {}


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.csv").write_text('company_name,website,linkedin_url\nAcme Corp,https://www.acme.com/x,\n"Quo ""ted"", Inc",quo.com,x\nShort\nToo,many,fields,here\n')
    (tmp_path / "b+c.csv").write_text("company_name,name\nAlpha,beta\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("company_name\n")
    (tmp_path / "junk.csv").write_bytes(b"\x00\x01\x02\x03")
    (tmp_path / "sub" / "z.csv").write_bytes(b"input-company-name,input-company-domain\nCaf\xe9 SA,cafe.fr\nAcme Corporation,acme.com\n")
    (tmp_path / "y.csv").write_bytes(b'\xef\xbb\xbfcompany_name,website\n"Line\nbreak",x.io\n')
    return tmp_path


def test_load_all(spark, folder):
    df, state = load_all(spark, folder)
    rows = df.orderBy(ORD).collect()
    assert [r["name"] for r in rows] == ["Acme Corp", 'Quo "ted", Inc', "Short", "Alpha", "Café SA", "Acme Corporation", "Line\nbreak"]
    assert rows[3]["name__raw2"] == "beta" and rows[2]["website"] is None
    assert {r["status"] for r in rows} == {"NOT_FOUND"} and {r["confidence_score"] for r in rows} == {"0"}
    assert df.columns[: len(STANDARD_COLUMNS)] == list(STANDARD_COLUMNS) and SOURCE_FILE in df.columns
    assert state.summary()["loaded"] == 4 and set(state.skipped) == {"empty.csv", "header.csv", "junk.csv"}


def test_load_nothing(spark, tmp_path):
    df, state = load_all(spark, tmp_path)
    assert df.count() == 0 and set(STANDARD_COLUMNS) <= set(df.columns) and state.summary()["loaded"] == 0
    (tmp_path / "e.csv").write_text("")
    assert load_single(spark, tmp_path / "e.csv") is None


def test_pipeline_resumes(spark, folder, tmp_path):
    run = Pipeline(spark, str(folder), str(tmp_path / "out"))
    with pytest.raises(FileNotFoundError):
        run.run("clean")
    for step in ("load", "clean", "enrich", "validate"):
        run.run(step)
    out = Pipeline(spark, str(folder), str(tmp_path / "out")).run("export")
    text = Path(out).read_bytes()
    assert text.startswith(b"\xef\xbb\xbfcompany_id,name,") and text.decode("utf-8-sig").count("acme.com") == 1
    report = json.loads((tmp_path / "out" / "validation_report.json").read_text())
    assert report["total"] == 6


# ---- cleaning and linking ----
def test_exact_duplicates_keep_the_richest(spark):
    df = frame(spark, dict(name="A"), dict(name="A", ceo="X"), dict(name="A", phone="1"), dict(name=None), dict(name=None))
    got = clean.drop_exact_duplicates(df).orderBy(ORD).collect()
    assert [(r["name"], r["ceo"]) for r in got] == [("A", "X"), (None, None)]


def test_merge_never_loses_a_value(spark):
    rows = [
        dict(name="Acme Corporation", website="acme.com", confidence_score="12.7"),
        dict(name="Acme Corporatio", ceo="Jane", confidence_score="90"),
        dict(name="Other Firm", website="acme.com", phone="5551234"),
        dict(name="Unrelated"), dict(name=None, email="x@y.zz"),
    ]
    got = {r["name"]: r for r in clean.clean(frame(spark, *rows)).collect()}
    assert len(got) == 3
    merged = got["Acme Corporatio"]
    assert (merged["website"], merged["ceo"], merged["phone"], merged["confidence_score"]) == ("acme.com", "Jane", "5551234", "90")


def test_cleaning_twice_changes_nothing(spark):
    df = clean.normalise(clean.coerce_and_trim(frame(spark, GOOD, dict(name=" acme INC. ", website="HTTP://WWW.X.COM/a", phone="tel 555.123.4567"))))
    again = clean.normalise(clean.coerce_and_trim(df))
    assert df.collect() == again.collect()


def test_linked_rows_are_not_broadcast(spark):
    df = frame(spark, GOOD, dict(name="Acme Corporatio", website="x.com"), dict(name="Other", website="acme.com"), dict(name="corporation acme"))
    edges = clean.match_edges(clean.with_order(df), 90)
    assert "Broadcast" not in edges._jdf.queryExecution().sparkPlan().toString()


def test_clean_empty(spark):
    assert clean.clean(frame(spark).limit(0)).count() == 0


@pytest.mark.parametrize("threshold", [40, 60, 85, 90, 92, 100])
def test_similar_pairs_lose_nothing(spark, threshold):
    rng = random.Random(threshold)
    base = ["alpha works inc", "beta motors", "gamma glass ltd", "delta", "abc", "ab", "omega wind power holding"]
    names = set(base)
    for _ in range(150):
        w = list(rng.choice(base))
        for _ in range(rng.randint(1, 2)):
            w.insert(rng.randrange(len(w)), rng.choice("abcde"))
            w.pop(rng.randrange(len(w)))
            if rng.random() < 0.5 and len(w) > 1:
                w.pop()
        names.add("".join(w))
    expected = {tuple(sorted(p)) for p in itertools.combinations(sorted(names), 2) if indel_ratio(*p) >= threshold}
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "key string")
    assert {(r["left"], r["right"]) for r in similar_pairs(df, threshold).collect()} == expected


def test_hot_grams_are_split(spark, monkeypatch):
    monkeypatch.setattr(similarity, "HOT", 3)
    names = [f"{c}alpha works {d}" for c in "abcdefgh" for d in "xy"] + ["z" * 3000, "z" * 2999 + "y"]
    expected = {tuple(sorted(p)) for p in itertools.combinations(names, 2) if indel_ratio(*p) >= 90}
    got = similar_pairs(spark.createDataFrame([(n,) for n in names], "key string"), 90)
    assert {(r["left"], r["right"]) for r in got.collect()} == expected


def test_short_texts_meet_on_whole_subsequences_only(spark, monkeypatch):
    monkeypatch.setattr(similarity, "_grams", lambda *_: pytest.fail("pairs that share a gram grow with the square of the texts"))
    rng = random.Random(7)
    names = {"".join(rng.choices("0123456789aB", k=12)) + " Inc" for _ in range(60)}
    names |= {n[:i] + n[i + 1 :] for n in names for i in (2, 9)} | {n[:5] + "a" + n[6:] for n in names}
    expected = {p for p in itertools.combinations(sorted(names), 2) if indel_ratio(*p) >= 90}
    got = similar_pairs(spark.createDataFrame([(n,) for n in names], "key string"), 90)
    assert {(r["left"], r["right"]) for r in got.collect()} == expected and expected


@pytest.mark.parametrize("threshold", [0, -1, 101])
def test_thresholds_are_checked(spark, threshold):
    with pytest.raises(ValueError):
        similar_pairs(spark.createDataFrame([("a",)], "key string"), threshold)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, edges):
    root = {}

    def top(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        if a != b:
            x, y = sorted((top(a), top(b)))
            root[y] = x
    df = spark.createDataFrame([*edges, (None, 1)], "a bigint, b bigint")
    assert {r["node"]: r["component"] for r in connected_components(df).collect()} == {i: top(i) for i in root}


def test_long_chain(spark):
    df = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["component"] for r in connected_components(df).collect()} == {0}


# ---- scores ----
def test_score_records(spark):
    assert score.score_record(spark, GOOD) == (100, "FOUND", [])
    assert score.score_record(spark, {}) == (0, "NEEDS_REVIEW", ["score_below_threshold", "missing_critical_field"])
    s, status, flags = score.score_record(spark, GOOD | dict(ceo="12345", description="short", website="other.com"))
    assert status == "NEEDS_REVIEW" and flags == ["description_too_short", "suspicious_ceo_value", "name_domain_mismatch"] and s == 70
    assert score.score_record(spark, GOOD | dict(industry=None, source_used="llm"))[1] == "NOT_FOUND"


def test_settings_are_checked():
    with pytest.raises(ValueError):
        Settings(min_confidence=101)
    s = Settings(llm_api_key="secret")
    assert s.llm_enabled and s.as_dict()["llm_api_key"] == "***" and "secret" not in repr(s)


# ---- validation ----
def test_validate(spark):
    bad = dict(GOOD, email="no", phone="12", linkedin="x", ceo="1", founder="Jane, 42", size="9", name="Zebra", confidence_score="abc", status="NOT_FOUND")
    rows = validate.validate(frame(spark, GOOD, bad, {})).orderBy(ORD).collect()
    assert (rows[0]["_issues"], rows[0]["_warnings"]) == ([], ["DUPLICATE_DOMAIN"])
    assert rows[1]["_warnings"] == [
        "INVALID_EMAIL", "INVALID_PHONE", "INVALID_URL", "INVALID_CEO", "INVALID_FOUNDER", "NAME_DOMAIN_MISMATCH",
        "LOW_CONFIDENCE_SCORE", "STATUS_NOT_FOUND", "DUPLICATE_DOMAIN",
    ]
    assert all(rows[1][c] is None for c in ("email", "phone", "linkedin", "ceo", "founder", "size"))
    assert rows[2]["_issues"] == ["MISSING_NAME", "MISSING_WEBSITE", "MISSING_DESCRIPTION", "MISSING_INDUSTRY"]


def test_greedy_duplicate_names(spark):
    names = ["alpha works limited", "alpha works limite", "alpha works limit", "alpha works lim", "beta", "beta", "xy", "xy", None]
    expected, leader = {}, {}
    for i, a in enumerate(names):
        if i in leader or not a or len(a) < 3:
            continue
        for j in range(i + 1, len(names)):
            b = names[j]
            if j not in leader and b and len(b) >= 3 and indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))) >= 92:
                leader[j] = i
    expected = leader
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], f"{ORD} bigint, name string")
    assert {r["row"]: r["leader"] for r in validate.duplicate_names(df).collect()} == expected


def test_report_of_nothing(spark):
    one = validate.report(frame(spark).limit(0))[1].first()
    assert one["total"] == 0 and one["average_score"] == 0.0 and one["duplicate_names"] == 0


# ---- pages, answers, enrichment ----
PAGE = """<html><head><title> T </title><meta NAME="Description" content=" D "><script>x='a@b.io'</script></head>
<body><nav>menu n@n.io</nav><p>Write to a@b.io &amp; call</p>  <p>+1 555 123 4567</p><!-- c --><form>f</form>
<a href="https://facebook.com/sharer?u">s</a><a href="https://www.linkedin.com/company/acme">l</a><a href="https://x.com/acme?l=en">t</a></body>"""


def test_page(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, "<p>open <b>tag"), (4, "<script>" * 2000)], "i int, html string")
    r = {x["i"]: x for x in html.extract_pages(df).collect()}
    assert r[1]["visible_text"] == "Write to a@b.io & call +1 555 123 4567 s l t"
    assert (r[1]["title"], r[1]["best_description"], r[1]["emails_found"], r[1]["phones_found"]) == ("T", "D", ["a@b.io"], ["+1 555 123 4567"])
    assert (r[1]["facebook_found"], r[1]["linkedin_found"], r[1]["twitter_found"]) == ("", "https://www.linkedin.com/company/acme", "https://x.com/acme?l=en")
    assert r[2]["visible_text"] == "" and r[3]["visible_text"] == "open tag" and r[4]["visible_text"] == ""


def test_sub_pages(spark):
    sites = spark.createDataFrame([("https://a.io/",), ("https://b.io",)], "url string")
    known = spark.createDataFrame([("https://a.io/about", " "), ("https://a.io/company", "we"), ("https://a.io/vision", "far")], "url string, visible_text string")
    assert [tuple(r) for r in html.sub_page_text(sites, known, html.ABOUT_PATHS, "about_text").collect()] == [("https://a.io/", "we")]


def test_sub_pages_are_neither_multiplied_nor_broadcast(spark):
    sites = spark.createDataFrame([("https://a.io",), ("https://a.io/",), ("https://a.io/our",), (None,)], "url string")
    known = spark.createDataFrame([("https://a.io/our/team", "our"), ("https://a.io/team", "team"), ("https://b.io/team", "b"), (None, "c")], "url string, visible_text string")
    got = html.sub_page_text(sites, known, ("/our/team", "/team"), "text")
    assert {tuple(r) for r in got.collect()} == {("https://a.io", "our"), ("https://a.io/", "our"), ("https://a.io/our", "our")}
    plan = got._jdf.queryExecution().optimizedPlan().toString() + got._jdf.queryExecution().sparkPlan().toString()
    assert "Broadcast" not in plan and "posexplode" not in plan


def test_answers(spark):
    raws = ['{"description":" x ","company_size":"11-50","confidence_score":"250"}', "no json", None, '{"company_size":"9"}']
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    got = [r[0] for r in df.select(enrich.parse_answer(F.col("raw"))).collect()]
    assert (got[0]["description"], got[0]["company_size"], got[0]["confidence_score"]) == ("x", "11-50", 100)
    assert all(g["company_size"] == "" and g["confidence_score"] == 0 for g in got[1:])


def test_enrich(spark):
    rows = [dict(name="Acme", website="acme.com", ceo="Keep Me"), dict(GOOD), dict(name="Bare")]
    pages = html.extract_pages(spark.createDataFrame([("https://www.acme.com/", PAGE)], "url string, html string"))
    ask = spark.createDataFrame([("acme.com", '{"industry":"Tools","ceo":"New One"}')], "domain string, answer string")
    got = {r["name"]: r for r in enrich.enrich(frame(spark, *rows), pages, ask).collect()}
    acme = got["Acme"]
    assert (acme["ceo"], acme["industry"], acme["description"], acme["email"]) == ("Keep Me", "Tools", "D", "a@b.io")
    assert acme["source_used"] == "official_website,web_scrape" and got["Acme Corporation"]["last_updated"] is None
    assert got["Bare"]["source_used"] == "not_found"


def test_prompts_hold_page_texts(spark):
    docs = [(4, "h", "about", "We " * 5000), (1, "h", None, "Home " * 4000), (3, "h", "leadership", "Al  Bo"), (2, "h", "about", "First"), (5, "h", "contact", "late"), (6, "g", "home", " "), (7, "k", "contact", "Call  us")]
    df = spark.createDataFrame(docs, "doc_id bigint, source string, page_kind string, text string")
    got = {r["source"]: r["prompt"] for r in company.site_prompts(df, Settings()).collect()}
    words = ["First", *["We"] * 5000, "Al", "Bo", *["Home"] * 997]
    text = lambda p: p.split("TEXT:\n")[1].split("\n\nCOMPANY: ")[0]
    assert set(got) == {"h", "k"} and text(got["h"]).rstrip() == " ".join(words) and len(text(got["h"]).split()) == 6000
    assert text(got["k"]) == "Call  us"


def test_a_failed_page_is_told(spark, monkeypatch):
    def parse(page):
        if page == "bad":
            raise RuntimeError("no page")
        return dict.fromkeys(html.PARTS, "") | {"title": "T"}

    rows = [dict(name="Acme", website="acme.com", status="PARTIALLY_FOUND"), dict(name="Bad", website="bad.com", confidence_score="70", ceo="Al Bo"), dict(GOOD, website="x.com")]
    # parsing runs in worker processes, so the broken parser is handed over by hand
    pages = html.extract_pages(spark.createDataFrame([("https://acme.com", "<p>ok"), ("https://bad.com", "<p>ok")], "url string, html string"))
    pages = pages.withColumn("parse_error", F.when(F.col("url").contains("bad"), "RuntimeError: no page"))
    out = enrich.enrich(frame(spark, *rows), pages)
    got = {r["name"]: r for r in out.collect()}
    bad = got["Bad"]
    assert (bad["status"], bad["confidence_score"], bad["ceo"], bad["_failure"]) == ("NOT_FOUND", "0", "Al Bo", "RuntimeError: no page")
    assert got["Acme"]["_failure"] is None and got["Acme"]["confidence_score"] != "0"
    assert enrich.enrichment_stats(out).first().asDict() == {"processed": 2, "succeeded": 1, "failed": 1, "skipped": 1}
    monkeypatch.setattr(html, "parse_page", parse)
    assert html._parse_or_tell("bad")["parse_error"] == "RuntimeError: no page" and html._parse_or_tell("x")["parse_error"] is None


def test_known_facts_may_keep_the_old_score(spark):
    rows = [dict(name="Acme", website="acme.com", confidence_score="12", status="NOT_FOUND"), dict(name="New", website="new.com", confidence_score="12", status="NOT_FOUND")]
    pages = html.extract_pages(spark.createDataFrame([("https://acme.com", PAGE, True), ("https://new.com", PAGE, False)], "url string, html string, cached boolean"))
    got = {r["name"]: r for r in enrich.enrich(frame(spark, *rows), pages, settings=Settings(score_cached=False)).collect()}
    assert (got["Acme"]["confidence_score"], got["Acme"]["status"], got["Acme"]["email"]) == ("12", "NOT_FOUND", "a@b.io")
    assert got["New"]["confidence_score"] != "12"


def test_settings_from_the_environment(monkeypatch):
    monkeypatch.setenv("LEDGERLOOM_FUZZY_THRESHOLD", "85")
    monkeypatch.setenv("LEDGERLOOM_SKIP_FOUND", "no")
    s = Settings.from_env()
    assert (s.fuzzy_threshold, s.skip_found, s.validation_threshold) == (85, False, 92)
    monkeypatch.setenv("LEDGERLOOM_FUZZY_THRESHOLD", "0")
    with pytest.raises(ValueError):
        Settings.from_env()


def test_environment_is_checked(spark, folder, tmp_path):
    ok = check_environment(spark, str(folder), str(tmp_path / "o"), Settings(llm_api_key="k"))
    assert ok == {"model_key": True, "input_files": True, "output_writable": True, "python": True}
    assert not check_environment(spark, str(tmp_path / "none"), "/proc/nowhere", Settings())["input_files"]


def test_scores_without_flags():
    assert [score.score_for_source(x) for x in ("official_website", "weak_signal", "?")] == [95, 30, 0]
    assert [score.quick_status(s, c) for s, c in ((80, True), (80, False), (60, True), (59, True))] == ["FOUND", "PARTIALLY_FOUND", "PARTIALLY_FOUND", "NOT_FOUND"]


def test_links(spark):
    cases = [
        ("see https://www.LinkedIn.com/company/acme/about", "linkedin", "https://www.LinkedIn.com/company/acme"),
        ("http://linkedin.com/in/jo https://linkedin.com/company/ https://uk.linkedin.com/company/x", "linkedin", ""),
        ("https://t.io/?u=https://linkedin.com/company/a-b'>", "linkedin", "https://linkedin.com/company/a-b"),
        ('<a href="https://facebook.com/sharer.php"><a href="https://www.facebook.com/acme?x=1">', "facebook", "https://www.facebook.com/acme?x=1"),
        ("https://facebook.com/ https://facebook.com", "facebook", ""),
        ("https://x.com/intent/tweet https://twitter.com/share?u https://x.com/acme", "twitter", "https://x.com/acme"),
        ("https://xx.com/acme", "twitter", ""),
        ("HTTPS://INSTAGRAM.COM/Acme/", "instagram", "HTTPS://INSTAGRAM.COM/Acme/"),
        (None, "instagram", None), ("", "instagram", ""),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(cases)], "i int, t string")
    find = lambda p: text.find_linkedin(F.col("t")) if p == "linkedin" else text.find_social(F.col("t"), p)
    got = df.select("i", *[find(p).alias(p) for p in ("linkedin", "facebook", "twitter", "instagram")]).orderBy("i").collect()
    assert [got[i][p] for i, (_, p, _) in enumerate(cases)] == [w for _, _, w in cases]


def test_large_files_are_split_in_order(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a[1].csv").write_text("name,website\n" + "".join(f"Firm {i},f{i}.io\n" for i in range(30_000)))
    (tmp_path / "in" / "b.csv").write_text('name,website\n"Two\nlines",x.io\n')
    (tmp_path / "in" / "c.csv").write_bytes("name,website\nSociété,y.io\n".encode("latin-1"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        df, state = load_all(spark, tmp_path / "in")
        found = probe(spark, [p for p, _ in list_files(spark, str(tmp_path / "in"))])
        assert [(f.multi_line, f.encoding) for _, f in sorted(found.items())] == [(False, "UTF-8"), (True, "UTF-8"), (False, "ISO-8859-1")]
        names = [r["name"] for r in df.orderBy(ORD).select("name").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert names == [*[f"Firm {i}" for i in range(30_000)], "Two\nlines", "Société"] and state.summary()["loaded"] == 3


class Site:
    """A fetcher over fixed pages."""

    def __init__(self, settings):
        self.sleep = lambda s: None

    def fetch(self, url):
        text = {"https://acme.com": "<p>Home</p>", "https://acme.com/about": "<p>We make tools. Write to me@acme.com</p>"}.get(url)
        return dict(url=url, final_url=url, status_code=200 if text else 404, html=text, error=None, redirect_count=0)


def test_pipeline_fills_gaps(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("name,website\nAcme Corp,acme.com\n")
    ask = spark.createDataFrame([("acme.com", '{"industry":"Tools"}')], "key string, answer string")
    pages = spark.createDataFrame([("https://acme.com/", PAGE)], "url string, html string")
    ask.write.parquet(str(tmp_path / "answers"))
    pages.write.parquet(str(tmp_path / "pages"))
    args = [str(tmp_path / "in"), str(tmp_path / "out")]
    for step in ("load", "clean"):
        assert main([*args, step]) == 0
    assert main([*args, "enrich", "--pages", str(tmp_path / "pages"), "--answers", str(tmp_path / "answers")]) == 0
    run = Pipeline(spark, *args, Settings(llm_api_key="k", llm_requests_per_minute=6000))
    r = run.read("enrich").first()
    assert (r["industry"], r["description"], r["email"]) == ("Tools", "D", "a@b.io")
    got, said = run.gather(make_fetcher=Site, make_model=lambda s: lambda p: '{"ceo":"Al Bo"}' if "We make tools." in p and "Acme" in p else None)
    assert {x["url"] for x in got.filter("html IS NOT NULL").collect()} == {"https://acme.com", "https://acme.com/about"}
    run.run("enrich", got, said)
    r = run.read("enrich").first()
    assert (r["ceo"], r["email"]) == ("Al Bo", "me@acme.com")


def test_retry_and_robots():
    calls = []

    def fail():
        calls.append(1)
        raise TimeoutError

    with pytest.raises(TimeoutError):
        providers.with_retry(fail, 3, 1.5, (TimeoutError,), sleep=lambda s: None)
    assert len(calls) == 3

    def opener(req):
        raise OSError("no network")

    f = providers.HttpFetcher(Settings(), opener, sleep=lambda s: None)
    assert f.allowed("https://a.io/x") and f.fetch("https://a.io/x")["error"] == "no network"


def test_profile_and_checkpoint(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("nan", None), (None, 3)], "x string, y int")
    got = {r["column_name"]: (r["non_null"], r["n_null"], r["fill_pct"]) for r in export.column_profile(df).collect()}
    assert got == {"x": (1, 2, 33.3), "y": (2, 1, 66.7)}
    assert export.column_profile(df.limit(0)).first()["fill_pct"] == 0.0
    export.write_checkpoint(df, str(tmp_path / "c"))
    assert export.read_checkpoint(spark, str(tmp_path / "c")).count() == 3


def test_stream_equals_batch(spark, tmp_path):
    df = frame(spark, GOOD, dict(name="acme inc", website="HTTPS://acme.com/x")).drop(ORD)
    df.write.parquet(str(tmp_path / "in"))
    q = ingest.write_stream(ingest.scored_stream(ingest.read_stream(spark, str(tmp_path / "in"), df.schema)), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    batch = score.score_dataframe(clean.normalise(clean.coerce_and_trim(df)))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.select(got.columns).collect()))
