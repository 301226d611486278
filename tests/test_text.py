"""Scalar functions on hand-made cases."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions import text as X
from ledgerloom.functions.nulls import clean_str, safe_str
from ledgerloom.functions.similarity import best_window_ratio, indel_ratio, lcs_length


def values(spark, f, cases):
    rows = spark.createDataFrame([(i, a) for i, a in enumerate(cases)], "i int, a string")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("a"))).collect()]


CASES = [
    (clean_str, [None, "nan", "None", " N/A ", "-", "", " \t", "#N/A", "  Acme  ", " x "], [None] * 8 + ["Acme", "x"]),
    (safe_str, [None, "x"], ["", "x"]),
    (
        X.norm_name,
        ["acme corporation", "Acme   Corp", "IBM global services", "beta inc.", "gamma llc", "coca-cola o'neil 3m", "hubspot gmbh", None],
        ["Acme Corporation", "Acme Corporation", "IBM Global Services", "Beta Inc", "Gamma LLC", "Coca-Cola O'Neil 3M", "Hubspot Gmbh", None],
    ),
    (
        X.norm_domain,
        ["https://www.example.com/a", "http://www2.example.com/", "HTTPS://EXAMPLE.COM", "example.com?x=1", "a.b.com:80#t", "info@example.com", "not a url at all!", "", None],
        ["example.com", "example.com", "example.com", "example.com", "a.b.com:80", "", "", "", None],
    ),
    (
        X.norm_linkedin,
        ["https://www.linkedin.com/company/acme/", "linkedin.com/in/Jane?x", "https://uk.linkedin.com/school/s", "https://x.com/acme", "", None],
        ["https://www.linkedin.com/company/acme", "https://www.linkedin.com/company/Jane", "https://www.linkedin.com/company/s", "", "", None],
    ),
    (lambda c: X.norm_social(c, "twitter"), ["x.com/a?b", "http://twitter.com/c/status", "facebook.com/d", None], ["https://www.twitter.com/a", "https://www.twitter.com/c", "", None]),
    (X.norm_email, [" Info@X.com ", "nope", "a@b", "", None], ["info@x.com", "", "", "", None]),
    (X.norm_phone, ["+1 (555) 123-4567", "123", "Call: +44 20 7946 0958", "", None], ["+1 (555) 123-4567", "", "+44 20 7946 0958", "", None]),
    (X.phone_ok, ["1234567", "123456", "1" * 15, "1" * 16], [True, False, True, False]),
    (X.person_ok, ["Jane Smith", "Mary-Jane O'Neil", "1234567", "http://x", "a@b.c", "A", "", "Zoë"], [True, True] + [False] * 6),
    (X.founders_ok, ["Jane Smith, John Doe", "Jane Smith, 42", "Jane,,"], [True, False, True]),
    (X.url_ok, ["https://a.b/c?d=e", "a.b", "HTTP://a.b"], [True, False, False]),
    (X.score_int, ["85.7", "abc", None, "1e3"], [85, 0, 0, 1000]),
    (lambda c: X.token_budget(c, 2), ["a  b", "a b c", ""], ["a  b", "a b", ""]),
    (X.find_emails, ["a@b.io, A@b.io a@b.io x@y"], [["a@b.io", "A@b.io"]]),
    (X.find_phones, ["call +1 555 123 4567 or 12345 or 2025 99.999"], [["+1 555 123 4567", "2025 99.999"]]),
    (X.to_utc, ["2020-01-01T00:00:00Z", "2020-01-01 00:00:00", "2020-01-01T02:00:00+02:00", "soon", None, "2020-01-01"], None),
]


@pytest.mark.parametrize("f,cases,expected", CASES)
def test_cases(spark, f, cases, expected):
    got = values(spark, f, cases)
    if expected is None:
        assert len({str(v) for v in got[:3]}) == 1 and got[3] is None and got[4] is None and got[5] == got[0]
    else:
        assert got == expected


def test_company_id(spark):
    df = spark.createDataFrame([("Salesforce ", "salesforce.com"), (None, None)], "n string, w string")
    got = [r[0] for r in df.select(X.company_id(F.col("n"), F.col("w"))).collect()]
    assert got[0] == "739739cd-0c06-6b8c-4795-8973dc29a46c"
    assert len(got[1]) == 36


def test_long_text_is_fine(spark):
    long = "word " * 200_000
    assert values(spark, clean_str, [long]) == [long.strip()]
    assert values(spark, X.norm_domain, ["x" * 100_000]) == [""]


def lcs_table(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


@settings(max_examples=200, suppress_health_check=list(HealthCheck))
@given(st.text("abcde ", max_size=20), st.text("abcde ", max_size=20))
def test_lcs(a, b):
    assert lcs_length(a, b) == lcs_table(a, b)


def test_ratios():
    assert indel_ratio("Inc Stripe", "Stripe") == 75.0
    assert best_window_ratio("microsoft", "microsoftazure") == 100.0
    assert best_window_ratio("", "x") == 0.0


def test_token_budget_counts_tokens(spark):
    import os

    from ledgerloom.functions import tokens

    path = os.environ.get("LEDGERLOOM_RANKS", "/opt/tokenizers/byte_bpe_50k.tiktoken")
    if not os.path.exists(path):
        pytest.skip("no vocabulary")
    texts = ["", "Hello world, it's 12345!", "漢字🙂 " * 50, None, "a b c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", "t", tokens.count_tokens(F.col("t"), path).alias("n"), tokens.token_budget(F.col("t"), 5, path).alias("cut")).orderBy("i").collect()
    assert [r["n"] for r in got][:2] == [0, 8] and got[3]["n"] is None and got[3]["cut"] is None
    assert got[4]["cut"] == "a b c" and got[1]["cut"] == "Hello world, it's"
    again = tokens.encoding(path).encode_ordinary(got[2]["cut"])
    assert len(again) <= 5 and texts[2].startswith(got[2]["cut"])
