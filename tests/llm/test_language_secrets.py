import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from msgflow.llm import language, secrets

EN = "the quick fox and the lazy dog were out on the hill with this man"
FR = "le renard et la chienne sont dans la maison avec les enfants de la ville"


@pytest.fixture(scope="module")
def known(spark):
    rows = [(i, EN, "en") for i in range(30)] + [(i, FR, "FR") for i in range(30)] + [(1, None, "en"), (2, FR, None), (3, "x", "")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def page(lang, text):
    attribute = f' lang="{lang}"' if lang else ""
    return f"<!DOCTYPE html><html{attribute}><head><script>var the='the the the'</script></head><body><nav>the the of</nav><p>{text}</p></body></html>"


def identify(spark, rows, known):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r for r in language.identify(df, known).collect()}


def test_evidence_is_fused(spark, known):
    rows = [(i, f"https://fr.site.example.fr/{i}", page("fr", FR)) for i in range(20)]
    rows += [(100 + i, f"https://en.site.example.com/{i}", page("en", EN)) for i in range(20)]
    rows += [
        (200, "https://fr.site.example.fr/x", page("en", FR)),  # the text outweighs a wrong declaration
        (201, "https://fr.site.example.fr/y", page("", "zzz")),  # no known word: the host decides
        (202, "https://en.site.example.com/z", page("", "")),
        (203, "https://new.site.example.fr/a", page("", "")),  # a new host: its domain decides
        (204, "https://other.org/", page("fr", "")),  # nothing but the declaration
        (205, None, None),
        (206, "not an address", "<p>" + EN),
    ]
    got = identify(spark, rows, known)
    assert len(got) == len(rows)
    assert all(got[i].lang == "fr" and got[100 + i].lang == "en" for i in range(20))
    assert [got[i].lang for i in (200, 201, 202, 203, 204, 206)] == ["fr", "fr", "en", "fr", "fr", "en"]
    assert got[202].text_lang is None and got[200].declared_lang == "en" and got[205].declared_lang is None
    assert all(0.5 <= r.confidence <= 1 for r in got.values())


def test_posterior_equals_plain_version(spark, known):
    """The fused posterior recomputed from the counts for every page."""
    import math

    texts = {"en": EN, "fr": FR, "": ""}
    rows, k = [], 0
    for suffix, lang, text, n in (("com", "en", "en", 6), ("com", "", "fr", 2), ("fr", "fr", "fr", 5), ("fr", "en", "", 3)):
        for j in range(n):
            rows.append((k, f"http://h{j % 2}.site.{suffix}/p", page(lang, texts[text])))
            k += 1
    got = identify(spark, rows, known)
    evidence = {}
    names, model = language.text_model(known)
    for r in language.evidence(spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect():
        evidence[r.page_id] = r
    best = {i: max(range(2), key=lambda k: r.likelihood[k]) if r.n_words else None for i, r in evidence.items()}
    total = [sum(v == k for v in best.values()) for k in range(2)]
    for i, r in evidence.items():
        logs = []
        for k in range(2):

            def n(by, k):
                return sum(v == k for j, v in best.items() if j != i and evidence[j][by] == r[by])

            every = (total[k] + 1) / (sum(total) + 2)
            domain = (n("domain", k) + 8 * every) / (n("domain", 0) + n("domain", 1) + 8)
            prior = (n("host", k) + 8 * domain) / (n("host", 0) + n("host", 1) + 8)
            log = r.likelihood[k] + math.log(prior)
            for by in ("suffix", "declared"):
                share = (n(by, 0) + n(by, 1) + 1) / (sum(total) + 1)
                log += math.log((n(by, k) + 8 * share) / (total[k] + 8))
            logs.append(log)
        top = max(logs)
        assert got[i].lang == names[logs.index(top)]
        assert got[i].confidence == pytest.approx(1 / sum(math.exp(x - top) for x in logs))


def test_any_number_of_languages(spark, make, known, monkeypatch):
    """More languages than a block: every page has a row, and blocks give what one block gives."""
    more = known.union(spark.createDataFrame([(k, f"wort{chr(97 + k // 26)}{chr(97 + k % 26)} " * 9, f"x{k:02d}-y") for k in range(68)], known.schema))
    rows = [(k, f"http://h{k % 3}.a.org/", page("", f"wort{chr(97 + k // 26)}{chr(97 + k % 26)} " * 9)) for k in range(68)]
    rows += [(100, "http://h1.a.fr/", page("fr", FR)), (101, None, None)]
    got = identify(spark, rows, more)
    assert set(got) == {r[0] for r in rows} and got[100].lang == "fr"
    assert all(got[k].text_lang == f"x{k:02d}-y" for k in range(68))
    monkeypatch.setattr(language, "BLOCK", 128)
    assert {k: tuple(r) for k, r in identify(spark, rows, more).items()} == {k: pytest.approx(tuple(r)) for k, r in got.items()}


def plain_strip(html):
    """The markup rule as one pattern; quadratic, so for short pages only."""
    names = "script|style|nav|footer|header|aside|template"
    return re.sub(rf"(?isa)<({names})\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?[a-z0-9]+;", " ", html)


def test_markup_equals_the_pattern():
    r = random.Random(3)
    parts = ["<nav ", "<nav>", "</nav>", "</NAV >", "<!--", "-->", "<", ">", "text", " ", "<p class='x'>", "&amp;", "&", ";", "<script>", "</script\n>", "é", "<navy>"]
    for _ in range(3000):
        html = "".join(r.choice(parts) for _ in range(r.randrange(25)))
        assert language.strip_markup(html) == plain_strip(html), html


@pytest.mark.parametrize("part", ["<nav ", "<!-- ", "<", "<script>", "</nav ", "&a", "<nav></p>"])
def test_long_broken_pages_take_linear_time(part):
    start = time.perf_counter()
    language.strip_markup(part * (5_000_000 // len(part)))
    assert time.perf_counter() - start < 10


def test_hosts(spark):
    wanted = {
        "http://user:pw@Host.example.org:80/x": ("host.example.org", "example.org"),
        "https://news.site.co.uk/?a=b@c": ("news.site.co.uk", "site.co.uk"),
        "//cdn.example.net/x": ("cdn.example.net", "example.net"),
        "www.example.fr/page": ("www.example.fr", "example.fr"),
        "example.de": ("example.de", "example.de"),
        "http://[2001:db8::1]:8080/": ("[2001:db8::1]", "[2001:db8::1]"),
        "/relative/page.html": ("", ""),
        "not an address": ("", ""),
        "http://co.uk/": ("co.uk", "co.uk"),
        None: ("", ""),
    }
    df = spark.createDataFrame([(u,) for u in wanted], "url string").withColumn("host", language.host(F.col("url")))
    got = {r.url: (r.host, r.domain) for r in df.withColumn("domain", language.domain(F.split("host", r"\."))).collect()}
    assert got == wanted


def test_no_pages_and_no_languages(spark, known):
    none = spark.createDataFrame([], "page_id long, url string, html string, host string")
    assert language.identify(none, known).count() == 0
    rows = [(1, "http://a.b/", page("en", EN)), (1, "http://a.b/", page("en", EN))]
    assert [r.lang for r in identify(spark, rows, known.limit(0)).values()] == [None]


def test_agrees_with_declared_languages_of_the_tables(spark):
    pages, documents = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("pages", "documents"))
    rows = language.identify(pages, documents).collect()
    assert len(rows) == pages.count() and sum(r.lang == r.declared_lang for r in rows) >= 0.95 * len(rows)


def secret(i):
    return hashlib.sha1(str(i).encode()).hexdigest()


def found(df, **options):
    return {(r.doc_id, r.place): r for r in secrets.scan(df, **options).collect()}


TEXTS = (
    [(i, f'one two token = "{secret(i)}" three') for i in range(30)]
    + [(100 + i, f"password={secret(i)[:18]}, and more") for i in range(30)]
    + [(200 + i, f"sees commit {secret(-i)} merged by order {4000_0000_0000_0000 + i * 7919}") for i in range(30)]
    + [(300 + i, f"page2number{i}ofthedocuments and invoice-{2000 + i}-{i:06d}") for i in range(30)]
)


def test_secrets_are_kept_and_other_numbers_go(make):
    got = found(make(TEXTS, value="a", label="b", features="c", place="d"))
    assert {i for i, _ in got} == {i for i, _ in TEXTS if i < 200}
    r = got[3, 4]
    assert (r.value_sha256, r.n_chars, r.name) == (hashlib.sha256(secret(3).encode()).hexdigest(), 40, None)
    assert got[105, 0].name == "password"


def test_forest_decides_what_no_rule_labels(make):
    """A key without a name next to it looks like the secrets the forest was trained on."""
    extra = [(900, f"one two = \"{secret(900)}\" three"), (901, "one two 4111111111111111 three"), (902, None), (903, "")]
    got = {i for i, _ in found(make(TEXTS + extra))}
    assert 900 in got and 901 not in got


def test_given_findings(make):
    known = secrets.dictionary(make(TEXTS))
    featured = secrets.with_features(secrets.candidates(make(TEXTS)), known)
    # Labelled the other way round: the forest follows the findings, not the rules.
    turned = featured.withColumn("label", 1 - (featured["doc_id"] < 200).cast("int"))
    got = {i for i, _ in found(make(TEXTS), findings=turned)}
    assert got and all(i >= 200 for i in got)


def test_candidates_of_every_form(make):
    """All values that may be secrets become candidates, several a word, whatever their length and signs."""
    jwt = f"eyJhbGciOiJIUzI1NiJ9.{secret(1)}.{secret(2)}"
    forms = [
        (f"Bearer {jwt}.", {jwt}),
        ("key SG.abcdefghijklmnop123456.qrstuvwxyzABCDEF7890 sent", {"SG.abcdefghijklmnop123456.qrstuvwxyzABCDEF7890"}),
        ("postgres://u:s3cr3t@host/db", {"s3cr3t"}),
        ("DB_URL=postgres://u:p%40ss@host/db?password=inner1&x=1", {"p%40ss", "inner1"}),
        ("https://h.org/?api_key=k3yk3y&x=1", {"k3yk3y"}),
        ('{"user":"me","password":"pa55!word","token":"tok-123"}', {"pa55!word", "tok-123"}),
        ('{"conn":"Server=s;Pwd=abc1;Uid=u"}', {"abc1"}),
        ("a=abc123def456ghi;b=xyz789uvw012rst", {"abc123def456ghi", "xyz789uvw012rst"}),
        ("a=first1value,b=second2value", {"first1value", "second2value"}),
        ("password=k1ne7ic&9lampQ", {"k1ne7ic&9lampQ"}),
        ("password=hunter2abc, and", {"hunter2abc"}),
        ("password=violetcanalbutter", {"violetcanalbutter"}),
        ('secret : "h2#x"', {"h2#x"}),
        ("password is hunter2abc", {"hunter2abc"}),
        ("password: violet&canal&1butter", {"violet&canal&1butter"}),
    ]
    got = {}
    for r in secrets.candidates(make(list(enumerate(text for text, _ in forms)))).collect():
        got.setdefault(r.doc_id, set()).add(r.value)
    assert [(text, wanted - got.get(i, set())) for i, (text, wanted) in enumerate(forms) if not wanted <= got.get(i, set())] == []


def test_secrets_of_every_form_are_found(make):
    def forms(i):
        x = secret(i)
        return [
            f"postgres://u{i}:{x[:9]}@host/db", f"https://h.org/?api_key={x[:10]}&x=1", f"eyJ{x}.{x[::-1]}.{x[5:25]}",
            f"password={x[:5]}&{x[5:9]}!", f'{{"id":{i},"token":"{x[:20]}","n":1}}', f"the latest password={x[:9]}",
        ]

    rows = [(1000 + 10 * i + k, text) for i in range(30) for k, text in enumerate(forms(i))]
    got = {i for i, _ in found(make(TEXTS + rows))}
    assert {i for i, _ in rows} <= got and not any(200 <= i < 400 for i in got)


def test_long_words(make):
    """Words without spaces are read once: long runs and long chains of assignments."""
    rows = [(1, "a" * 500_000), (2, "ab:cd1:" * 50_000), (3, "x=1&" * 50_000 + "token=" + secret(1)), (4, "-" * 300_000)]
    values = secrets.candidates(make(rows)).where("name = 'token'").select("value").collect()
    assert [r.value for r in values] == [secret(1)]


def test_long_text_of_candidates(make):
    """Memory and time grow with the text, not with its square: every word is a candidate."""
    text = " ".join(secret(k)[:14] for k in range(100_000))
    found = secrets.candidates(make([(1, text)])).agg(F.count("*").alias("n"), F.max("place").alias("last"), F.max(F.length("before")).alias("b"))
    assert found.first().asDict() == {"n": 100_000, "last": 99_999, "b": 44}


def test_repeats_long_texts_and_reruns(make):
    long = "word " * 60_000 + f'token = "{secret(1)}"'
    rows = TEXTS + [(1, TEXTS[1][1]), (5000, long), (None, TEXTS[2][1])]
    first = found(make(rows))
    assert (5000, 60_002) in first and (None, 4) in first
    again = found(make(rows[::-1]).repartition(5))
    assert {k: tuple(r) for k, r in first.items()} == {k: tuple(r) for k, r in again.items()}


def test_without_two_labels(make):
    assert secrets.scan(make([])).count() == 0
    only = found(make([(1, f'token = "{secret(1)}"'), (2, "nothing here 12")]))
    assert [(k, r.probability) for k, r in only.items()] == [((1, 2), 1.0)]
