import pytest
from pyspark.sql import functions as F

from attesta.functions import scores, text, urls

SAME = [
    ("HTTPS://Example.COM:443/a?b=1#c", "https://example.com/a?b=1"), ("http://example.com", "http://example.com/"), ("http://example.com:80/", "http://example.com/"), ("  http://example.com./x  ", "http://example.com/x"), ("http://example.com:8080/", "http://example.com:8080/"),
    ("http://example.com/a?", "http://example.com/a?"), ("http://example.com/a?#f", "http://example.com/a?"), ("http://[::1]:80/x", "http://[::1]/x"), ("http://example.com/A?b=2&a=1", "http://example.com/A?b=2&a=1"), ("https://example.com:080/", "https://example.com:80/"), ("http://example.com:/", "http://example.com/"),
]
BAD = ["", "  ", None, "ftp://example.com/", "/relative", "http://", "http://user@example.com/", "http://u:p@example.com/", "http://example.com:99999/", "http://example.com:x/", "http://exa\x01mple.com/", "mailto:a@b.c", "http://:80/"]


def one(spark, column, **values):
    names = {k: v for k, v in values.items()}
    schema = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string' if v is None or isinstance(v, str) else 'double' if isinstance(v, float) else 'long'}" for k, v in names.items())
    return spark.createDataFrame([tuple(names.values())], schema).select(column.alias("x")).first().x


def test_canonical_urls(spark):
    df = spark.createDataFrame([(a, b) for a, b in SAME] + [(b, None) for b in BAD], "url string, want string")
    for r in df.withColumn("got", urls.canonical_url(F.col("url"))).collect():
        assert r.got == r.want, r.url
    again = df.withColumn("got", urls.canonical_url(urls.canonical_url(F.col("url")))).collect()
    assert all(r.got == r.want for r in again)


def test_hosts_outside_ascii(spark):
    df = spark.createDataFrame([("http://Bücher.example/x",)], "url string")
    assert df.select(urls.canonical_url(F.col("url"), urls.idna_host("url"))).first()[0] == "http://xn--bcher-kva.example/x"
    assert df.select(urls.canonical_url(F.col("url"))).first()[0] is None


@pytest.mark.parametrize("host,domain,want", [("example.com", "example.com", True), ("a.example.com", "Example.COM.", True), ("badexample.com", "example.com", False), ("example.com", "a.example.com", False), ("", "example.com", False)])
def test_domains(spark, host, domain, want):
    assert one(spark, urls.domain_matches(F.col("h"), domain), h=host) is want


def test_pages_and_files(spark):
    df = spark.createDataFrame([(u,) for u in ("http://a/b.PDF", "http://a/b.pdf?x", "http://a/b", "http://a/pdf", "http://a/b.html", "http://a/x.tar")], "u string")
    assert [r[0] for r in df.select(urls.is_page_url(F.col("u"))).collect()] == [False, False, True, True, True, False]


MESSY = "\r\n# Title  \r\n\r\n\r\nSome   text\there now.\r\n- item   one\r\n| a |  b | \r\nHome | Blog\r\nCookie settings.\r\n© 2020 Me. All rights reserved.\r\nhome sweet home\r\n\r\n"


def test_cleaning_either_way(spark):
    want = ("# Title\n\nSome text here now.\n- item   one\n| a |  b |\nhome sweet home", 3)
    assert text.exact_clean(MESSY) == want
    assert tuple(one(spark, text.clean_plain(F.col("t")), t=MESSY)) == want
    for t in (None, "", "\n\n", " x ", "a\n\n\n\nb", "menu", "1. one\n2) two\n  * three "):
        assert tuple(one(spark, text.clean_plain(F.col("t")), t=t)) == text.exact_clean(t), t
        assert text.exact_clean(text.exact_clean(t)[0])[0] == text.exact_clean(t)[0]


def test_fences_stay_word_for_word():
    t = "x  y\n```py\nHome | Blog\n  a   b\n```\nmenu"
    assert text.exact_clean(t) == ("x y\n```py\nHome | Blog\n  a   b\n```", 1)
    assert text.exact_clean("é")[0] == "é"


@pytest.mark.parametrize("content,candidate,want", [("The Big  Cat sat", "Big", "Big"), ("The Big  Cat sat", "big cat", "Big  Cat"), ("a.b*c", "A.B*C", "a.b*c"), ("abc", "x", None), ("abc", " ", None), ("abc", None, None), ("Été là", "été", "Été"), ("(x) [y]", "[Y]", "[y]")])
def test_evidence_slices(spark, content, candidate, want):
    assert one(spark, text.evidence_slice(F.col("c"), F.col("w")), c=content, w=candidate) == want


@pytest.mark.parametrize("kind,value,found,want", [("string", "open", "It is not  open.", True), ("string", "open", "no open", True), ("string", "open", "nothing open", False), ("boolean", "true", "No.", True), ("boolean", "true", "yes and no", False), ("boolean", "false", "it is on", True), ("integer", "3", "not 3", False), ("string", "c++", "not c++ code", False)])
def test_contradictions(spark, kind, value, found, want):
    assert one(spark, text.contradicts(F.col("k"), F.col("v"), F.col("e")), k=kind, v=value, e=found) is want


def test_counts_and_hints(spark):
    assert one(spark, text.word_count(F.col("t")), t="don't re-use it, ok? ’x 3.5") == 7
    assert one(spark, text.token_estimate(F.col("t")), t="abcd é! _x") == 2 + 1 + 1 + 1
    assert one(spark, text.first_words(F.col("t"), 2), t="  a  b\tc") == "a  b"
    md = "# A #\n## B\n- x\n1. y\n| a | b |\n```\n[l](u)"
    assert one(spark, text.headings(F.col("t")), t=md) == ["A", "B"]
    assert one(spark, text.structure_hints(F.col("t"), text.headings(F.col("t"))), t=md) == ["headings", "unordered_list", "ordered_list", "table", "code_block", "links"]
    assert one(spark, text.labels(F.col("a")), a=[" Code Examples ", "code-examples", ""]) == ["code_examples"]
    assert one(spark, text.entities(F.col("t")), t="Ada Lovelace met Bob. Ada Lovelace left") == ["Ada Lovelace", "Bob"]


def test_scores(spark):
    assert one(spark, scores.ratio(F.col("a"), F.col("b")), a=1, b=3) == 0.333333
    assert one(spark, scores.ratio(F.col("a"), F.col("b")), a=1, b=0) == 0.0
    assert [one(spark, scores.bounded(F.col("s")), s=s) for s in ("0.4", "7", "-1", "x", None)] == [0.4, 1.0, 0.0, 0.5, 0.5]
    assert one(spark, scores.record_quality([F.lit(1.0), F.lit(1.0), F.lit(1.0), F.lit(0.8), F.lit(1.0), F.lit(0.5)])  , a=1) == 0.883333


def test_a_urls_parts_are_taken_once(spark):
    """The expression stays small where it is copied into filters and keys, so that it compiles."""
    df = spark.createDataFrame([("http://a/b",)], "url string")
    out = df.withColumn("c", urls.any_canonical_url(df.url)).where("c is not null").groupBy("c").count()
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") < 60
    assert len(plan) < 12_000
