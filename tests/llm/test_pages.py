"""URL filter and line dedup."""

import re

import pytest
from pyspark.sql import functions as F

from martspark.llm import line_dedup as L
from martspark.llm import url_filter as U

URLS = [
    (1, "https://Spam-Farm.Example.ORG/a"), (2, None), (3, "no scheme"), (4, "http://"),
    (5, "http://x.example.com/en/1?q=net/es/"), (6, "http://www.example.com/en/1"),
    (7, "http://www.example.com/fr/"), (8, "http://a.net/es/x"), (9, "http://a.net/de/x"),
    (10, "http://example.com"), (11, "http://notexample.com/en/"), (12, "http://a.net/fr"),
    (13, "ftp://casino.org#://b"), (14, "http://myexample.com/EN/"), (15, "http://a.org/ads/1"),
    (16, "http://a.org/loads/1"), (17, "x://h/p://q"), (17, "x://h/p://q"), (18, ""),
    (None, "http://ads.a.org/"), (19, "http://a.org/" + "y/" * 20_000),
]


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    m = re.match(r"[^/?#]*", rest)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m)
    path = re.match(r"[^?#]*", rest[len(m):])[0]
    best = max(((r.rank, r.verdict, r.name) for r in rules if re.search(r.regex(), host + path)),
               default=None)
    return host, path, best and best[2], best[1] if best else default


@pytest.mark.parametrize("limit", [U.BROADCAST_RULES, 0])
def test_judge_equals_all_rules_on_all_urls(spark, monkeypatch, limit):
    monkeypatch.setattr(U, "BROADCAST_RULES", limit)
    rules = U.site_rules() + U.spam_rules() + [U.Rule("any", "*oads*", "block")]
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in URLS],
                               "page_id int, url string, host string, best string")
    rows = U.judge(df, rules).collect()
    got = sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict) for r in rows)
    want = sorted((str(i), h, p, str(r), v) for i, u in URLS for h, p, r, v in [brute(u, rules)])
    assert got == want
    assert all(r.best == "y" for r in rows)


def test_rarest_token_is_the_index(spark):
    rules = [U.Rule("r", "||rare.common^", "block")]
    targets = spark.createDataFrame([(f"h{i}.common", "/") for i in range(5)], "host string, path string")
    assert U._index(targets, rules).first().token == "rare"


def test_rule_tokens_are_whole_tokens():
    assert U.Rule("r", "||a.com/en", "allow").tokens() == ["a", "com"]
    assert U.Rule("r", "*ab/cd/e*", "allow").tokens() == ["cd"]


def test_judge_empty(spark):
    df = spark.createDataFrame([], "page_id int, url string")
    assert U.judge(df, U.site_rules()).collect() == []


def test_html_becomes_lines(spark):
    html = ("<html><head><title>T &amp; t</title><style>p{}</style><script>x('</p>')</script></head>"
            "<body><!-- no --><p>one <b>two</b><br/>three</p><ul><li> a\t b</li></ul>1 < 2")
    df = spark.createDataFrame([(html,), (None,), ("",)], "html string")
    got = [r[0] for r in df.select(L.text_lines(L.html_text(F.col("html")))).collect()]
    assert got == [["T & t", "one two", "three", "a b", "1 < 2"], [], []]


def test_boilerplate_by_site(spark):
    pages = [(i, "site.a", ["menu", f"story {i}", "menu"] + (["rare"] if i < 2 else [])) for i in range(6)]
    pages += [(10, "site.b", ["menu", "x"]), (11, "site.b", ["menu"])]        # too few pages
    pages += [(20 + i, "", ["menu", "no host"]) for i in range(5)]            # no site
    pages += [(30, "site.a", []), (31, None, ["menu"]), (0, "site.a", ["menu", "story 0"])]
    df = spark.createDataFrame([(*p, "k", "t") for p in pages],
                               "page_id int, host string, lines array<string>, kept string, text string")
    rows = L.drop_boilerplate(df).collect()
    for r in rows:
        lines = next(p[2] for p in pages if p[0] == r.page_id and p[1] == r.host
                     and len(p[2]) == r.n_lines)
        want = [x for x in lines if not (r.host == "site.a" and x == "menu")]
        assert (r.text, r.n_dropped, r.kept) == ("\n".join(want), len(lines) - len(want), "k")
    assert len(rows) == len(pages)


def test_boilerplate_empty(spark):
    df = spark.createDataFrame([], "page_id int, host string, lines array<string>")
    assert L.drop_boilerplate(df).collect() == []


def test_rules_of_a_filter_list(spark, tmp_dir):
    path = f"{tmp_dir}/rules.txt"
    with open(path, "w") as f:
        f.write("! a comment\n[Adblock]\n||ads.example.com^\n@@||ads.example.com/ok^\n/banner/*\n"
                "site.com##.ad\n||party.com^$third-party\n\n  |plain.org/  \n")
    rules = U.read_rules(spark, path)
    assert [(r.pattern, r.verdict, r.rank) for r in rules] == [
        ("||ads.example.com^", "block", 0), ("||ads.example.com/ok^", "allow", 1), ("/banner/*", "block", 0),
        ("|plain.org/", "block", 0)]
    urls = ["http://ads.example.com/x", "http://b.ads.example.com/ok/1", "http://x.net/banner/1", "http://plain.org/",
            "http://a.plain.org/", "http://party.com/"]
    rows = U.judge(spark.createDataFrame([(u,) for u in urls], "url string"), rules).collect()
    got = {r.url: r.verdict for r in rows}
    assert [got[u] for u in urls] == ["block", "allow", "block", "block", "allow", "allow"]


def test_a_hundred_thousand_rules(spark):
    import random
    import re
    rng = random.Random(6)
    word = lambda: f"{rng.choice(['ad', 'track', 'shop', 'news', 'img'])}{rng.randrange(30_000)}"
    forms = ["||{0}.com^", "/{0}/*", "^{0}^", "|{0}.org/{1}/", "||{0}.net/*/{1}^", "/{0}/{1}", "{0}*{1}"]
    lines = [("@@" if rng.random() < 0.1 else "") + rng.choice(forms).format(word(), word()) for _ in range(100_000)]
    rules = U.parse_rules(lines)
    assert len(rules) == 100_000
    urls = [f"http://{word()}.{rng.choice(['com', 'org', 'net'])}/{word()}/{word()}/" for _ in range(40)]
    for r in rng.sample(rules, 20):  # some that surely match
        urls.append("http://" + r.pattern.replace("@@", "").strip("|").replace("^", "/").replace("*", "x"))
    got = {r.url: (r.verdict, r.rule) for r in U.judge(
        spark.createDataFrame([(u,) for u in urls], "url string"), rules).collect()}
    compiled = [(re.compile(r.regex()), r) for r in rules]
    blocked = 0
    for u in urls:
        target = u.split("://")[1]
        best = max(((r.rank, r.verdict, r.name) for rx, r in compiled if rx.search(target)), default=None)
        assert got[u] == ((best[1], best[2]) if best else ("allow", None)), u
        blocked += best is not None
    assert blocked >= 15
