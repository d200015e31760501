"""URL filter and page extraction."""

import re
from collections import Counter, defaultdict
from html import unescape
from itertools import combinations
from math import ceil

from pyspark.sql import functions as F

from terrace.llm import html_extract, queries, url_filter
from terrace.llm.html_extract import Blocks
from terrace.llm.url_filter import Rule

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string"


def brute_rule(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else None
    if rest is None:
        return "", "", None
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: (len(r.name), len(r.host)), default=None)
    return host, path, best


URLS = ["https://a.Example.com/en/1?x=1", "http://www.example.com/en/2", "http://x.www.example.com/en/2", "http://example.com/fr/3",
        "http://b.net/es/4#t", "http://b.net/de/4", "http://net/fr/", "http://notnet/fr/", "http://example.com", "no scheme", None, "",
        "ftp://q.org/a/b.html?k=v&k2=w", "://com/x", "http://com/a://net/es/", "http://É.com/", "http://a.net/es", "x\n://c.net/fr/\ny?z"]


def test_rules_hosts_and_paths(spark):
    rows = [(i, u, "h") for i, u in enumerate(URLS)] + [(3, URLS[3], "h")] * 2
    df = spark.createDataFrame(rows, PAGES).withColumn("verdict", F.lit("clash")).withColumn("host", F.lit(1))
    out = url_filter.judge(df, queries.URL_RULES).collect()
    assert len(out) == len(rows)
    for r in out:
        host, path, rule = brute_rule(r.url, queries.URL_RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule.name if rule else None), r.url
        assert r.verdict == rule.verdict if rule else r.verdict in ("allow", "block")
        assert r.mined == (rule is None)
    assert url_filter.judge(df.limit(0), queries.URL_RULES).count() == 0


def test_mined_rules_decide_by_tokens(spark):
    rows = [(["tld:com", f"path0:{x}"], "block" if x == "bad" else "allow") for x in ("bad", "good", "fine") for _ in range(30)]
    mined = url_filter.mine(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.05, 0.8)
    index = mined.index()
    assert mined.verdict(["path0:bad", "tld:org"], index) == "block"
    assert mined.verdict(["path0:good", "tld:org"], index) == "allow"
    assert mined.verdict(["tld:org"], index) == "allow" and mined.verdict([], index) == "allow"
    for tokens, verdict, confidence, support in mined.rules:  # against counts over all transactions
        has = [v for t, v in rows if tokens <= set(t)]
        assert confidence == has.count(verdict) / len(has) >= 0.8
        assert abs(support - has.count(verdict) / len(rows)) < 1e-9


def test_tokens_cover_the_whole_url():
    url = "http://a.casino.b.example.com/2024/05/v1.2/12/the-slug.html?z=1&b=2&a=3&y=4&c=5"
    tokens = set(url_filter.tokens_of("a.casino.b.example.com", "/2024/05/v1.2/12/the-slug.html", url))
    assert {"label:casino", "label:b", "path4:the-slug", "path2:v0.0", "ending:html", *(f"key:{k}" for k in "abcyz")} <= tokens
    assert not any(t.startswith("ending:") and t != "ending:html" for t in tokens)


def test_verdicts_by_tokens_far_in_the_url(spark):
    rules = [Rule("bad.org", "/", "block"), Rule("good.org", "/", "allow")]
    far = ["http://x.casino.b.{}.org/", "http://{}.org/1/2/3/4/pills.html", "http://{}.org/q?a=1&b=1&c=1&win=1"]
    rows = [(i, far[i % 3].format("bad"), "") for i in range(60)]
    rows += [(100 + i, far[i % 3].format("good").replace("casino", "shop").replace("pills", "news").replace("win", "id"), "") for i in range(60)]
    rows += [(1000 + i, far[i].format("other").replace(".org", ".net"), "") for i in range(3)] + [(1003, "http://z.casino.q.r.net/", "")]
    out = {r.page_id: r.verdict for r in url_filter.judge(spark.createDataFrame(rows, PAGES), rules).collect()}
    assert [out[i] for i in range(1000, 1004)] == ["block"] * 4


def test_long_urls_are_mined_within_bounds(spark):
    import random
    deal = random.Random(1)     # 40 keys, each in nine of ten urls: 2 ** 36 combinations
    rows = [([f"key:{k}" for k in range(40) if deal.random() < 0.9] + [f"path9:{x}"], "block" if x == "bad" else "allow")
            for x in ("bad", "good") for _ in range(200)]
    rows += [(["path8:rare", "key:z", "key:y"], "block")] * 5
    mined = url_filter.mine(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.01, 0.9)
    for token, verdict in (("path9:bad", "block"), ("path9:good", "allow"), ("path8:rare", "block"), ("key:y", "block")):
        assert mined.verdict([token], mined.index()) == verdict
    for tokens, verdict, confidence, support in mined.rules:
        has = [v for t, v in rows if tokens <= set(t)]
        assert abs(confidence - has.count(verdict) / len(has)) < 1e-9 and abs(support - has.count(verdict) / len(rows)) < 1e-9


def brute_rules(labelled, min_support, min_confidence, min_hosts=1, seeds=frozenset()):
    """All rules of one to three tokens by counting every combination; rows (tokens, verdict, site)."""
    times, of, sites = Counter(), Counter(), defaultdict(set)
    for tokens, verdict, site in labelled:
        for some in (frozenset(c) for k in (1, 2, 3) for c in combinations(sorted(set(tokens)), k)):
            times[some, verdict] += 1
            of[some] += 1
            sites[some, verdict].add(site)
    rules = {k: n / of[k[0]] for k, n in times.items() if n >= ceil(min_support * len(labelled)) and n / of[k[0]] >= min_confidence}
    return {k: (c, times[k]) for k, c in rules.items() if not k[0] <= seeds and len(sites[k]) >= min_hosts and not any(
        rules.get((frozenset(part), k[1]), 0) >= c for n in range(1, len(k[0])) for part in combinations(k[0], n))}


def brute_verdict(tokens, rules):
    fit = [(-c, -n, verdict) for (some, verdict), (c, n) in rules.items() if some <= set(tokens)]
    return min(fit)[2] if fit else "allow"


def test_same_rules_for_any_cut_of_long_urls(spark, monkeypatch):
    import random
    deal = random.Random(7)
    rows = [(sorted({f"key:{k}" for k in range(14) if deal.random() < 0.5} | {f"label:{deal.choice('abc')}"}),
             "block" if deal.random() < 0.6 else "allow", deal.choice(["x.org", "y.org", "z.org"])) for _ in range(60)]
    rows += [(["key:0|1", "label:a"], "block", "x.org"), (["key:0|1", "label:a", "label:b"], "allow", "x.org")] * 5
    df = spark.createDataFrame(rows, "tokens array<string>, verdict string, site string")
    seeds = frozenset(["label:a", "key:3"])
    want = brute_rules(rows, 0.1, 0.7, 2, seeds)
    assert len(want) > 20
    for at_once in (100, 5):
        monkeypatch.setattr(url_filter, "ITEMS_AT_ONCE", at_once)
        got = url_filter.mine(df, 0.1, 0.7, min_hosts=2, seeds=seeds).rules
        assert {(s, v): (c, round(n * len(rows))) for s, v, c, n in got} == want


def test_seed_rules_are_not_restated_on_other_hosts(spark):
    rules = [Rule("com", "/", "allow"), Rule("net", "/es/", "block"), Rule("org", "/es/", "block")]
    rows = [(i, f"http://{x}{i % 4}.com/{x}/{i}", "") for i, x in enumerate(["shop", "news"] * 20)]
    rows += [(100 + i, f"http://s{i % 4}.{'net' if i % 2 else 'org'}/es/?win={i}", "") for i in range(40)]
    rows += [(1000, "http://q.net/de/", ""), (1001, "http://q.info/es/", ""), (1002, "http://q.info/x?win=3", "")]
    out = {r.page_id: r.verdict for r in url_filter.judge(spark.createDataFrame(rows, PAGES), rules, min_hosts=2).collect()}
    # tld:net and path0:es only say what the rules do; the key is seen on blocked pages of several hosts
    assert (out[1000], out[1001], out[1002]) == ("allow", "allow", "block")


def test_op3_query_matches_brute_force(spark):
    out = queries.op3_url_filter(spark, SF).collect()
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(out) == len(urls)
    judged = [(u, *brute_rule(u, queries.URL_RULES)) for u in urls.values()]
    mined = brute_rules([(url_filter.tokens_of(host, path, u), rule.verdict, ".".join(host.split(".")[-2:]))
                         for u, host, path, rule in judged if rule], 0.002, 0.8, 2, url_filter.seed_tokens(queries.URL_RULES))
    for r in out:
        host, path, rule = brute_rule(urls[r.page_id], queries.URL_RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule.name if rule else None)
        assert r.verdict == (rule.verdict if rule else brute_verdict(url_filter.tokens_of(host, path, urls[r.page_id]), mined))


def test_longest_rule_wins_and_ties_go_to_the_longer_host(spark):
    rules = [Rule("com", "/abcd", "allow"), Rule("x.com", "/ab", "block"), Rule("x.com", "/", "allow")]
    df = spark.createDataFrame([(1, "http://x.com/abcd", ""), (2, "http://x.com/ac", "")], PAGES)
    assert {r.page_id: r.rule for r in url_filter.judge(df, rules).collect()} == {1: "x.com/ab", 2: "x.com/"}


# --- pages ------------------------------------------------------------------------------------

def page(body, name="content-1"):
    return f"""<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a="</p><div>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav><div id="cookie-notice"><p>We use cookies and more of them</p></div>
<div class="layout"><div class="{name} post">{body}<div class="ad-slot">Buy now</div><form><label>Name</label><input></form></div>
<div class="sidebar"><p>Other stories that are long enough to be taken for text, if one looks at length alone, one after another</p></div></div>
<section class="comments"><p>First! A comment of a reader that goes on and on, longer than some articles</p></section>
<footer><p>Imprint &copy;</p></footer></body></html>"""


def test_parts_outside_the_article_are_left_out():
    html = page("<h2>A &lt;b&gt;\n title</h2><p>One  <b>two</b>\tthree<br>four <p>five &amp;amp; six&nbsp;seven<ul><li>eight<li>nine</ul>"
                "<!-- hidden <p>no</p> --><script>no()</script>")
    votes = Blocks(html).votes()
    best = max(votes, key=votes.get)
    assert best == ">html>body>div.layout>div.content-0.post"
    assert Blocks(html).main(best) == "A <b> title\nOne two three\nfour\nfive &amp; six seven\neight\nnine"


def test_consensus_repairs_short_pages(spark):
    long = "<p>" + "A long paragraph of the article itself. " * 20 + "</p>"
    rows = [(i, f"http://h.org/{i}", page(long, f"content-{i}")) for i in range(5)]
    rows.append((9, "http://H.org/9", page("<p>Short.</p>", "content-9")))
    rows.append((10, "http://other.org/", "<p>a<p>b"))
    out = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert out[9] == "Short." and out[10] == "a\nb"
    assert out[0] == ("A long paragraph of the article itself. " * 20).strip()


def test_edge_pages(spark, monkeypatch):
    cases = [(None, ""), ("", ""), ("plain  text", "plain text"), ("<p", ""), ("<", "<"), ("</div>y", "y"), ("<!-- a", ""), ("<script>x", ""),
             ("a<b>c</b>d &amp; &am", "acd & &am"), ("<div class='comment'>q</div>", ""), ("<p>" + "w " * 50000, ("w " * 50000).strip())]
    rows = [(i, None if i % 2 else "x", h) for i, (h, _) in enumerate(cases)] + [(0, "http://a.b/", None)]
    df = spark.createDataFrame(rows, PAGES).withColumn("text", F.lit("clash")).withColumn("path", F.lit("p"))
    for small in (True, False):
        if not small:
            monkeypatch.setattr(html_extract, "BROADCAST_BYTES", -1)
        out = html_extract.extract(df)
        assert out.columns == ["page_id", "url", "html", "path", "text"]
        got = sorted((r.page_id, r.text) for r in out.collect())
        assert got == sorted([(i, t) for i, (_, t) in enumerate(cases)] + [(0, "")])
    assert html_extract.extract(df.limit(0)).count() == 0


def test_op10_query_gives_the_articles(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    out = queries.op10_html_extract(spark, SF).collect()
    assert len(out) == len(pages)
    for r in out:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(unescape(x).split()) for x in re.split(r"</?(?:p|h1|br)>", re.sub("</?b>", "", article))]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def main_of(html):
    return Blocks(html).main(None)


def test_left_out_inline_elements_end_at_their_end_tag():
    assert main_of('<body><a class="skip-link" href="#c">Skip</a><main><p>The article.</p></main></body>') == "The article."
    assert main_of('<p>A <span class="ad">x</span> B</p>') == "A B"
    assert main_of('<p>A <span class="ad">x <span>y</span> z</span> B <span>C</span></p><p>D</p>') == "A B C\nD"
    assert main_of('<div>A <a class="promo"><div>card</div></a> B</div>') == "A B"
    # without an end tag: up to the end of its block, or the next one's begin
    assert main_of('<p>A <span class="ad">x<p>B<ul><li>C <b class="ad">y<li>D</ul>') == "A\nB\nC\nD"
    assert main_of('<body>A <a class="skip-link">Skip<main><p>The article.</p></main></body>') == "A\nThe article."
    assert main_of('<p>A <a class="ad" href="x">x <a href="y">B</a> C') == "A B C"
    assert main_of('<body><a class="ad"><p>B</p><p>C</p></body>') == "B\nC"


def test_raw_elements_without_an_end_tag_do_not_cut_the_page():
    for tag in ("svg", "iframe", "noscript", "textarea", "title", "template", "noframes", "xmp"):
        for start in (f"<{tag}/>", f'<{tag} class="icon"/>', f"<{tag} data-x=a />", f"<{tag}>", f"<{tag.upper()} x=http://a/>"):
            assert main_of(f"<body>{start}<p>One</p>{start}<p>Two</p></body>") == "One\nTwo", start
            assert main_of(f"<body>{start}<p>One</p><{tag}>left out</{tag}><p>Two</p></body>") == "One\nTwo", start
        assert main_of(f"<p>One</p><{tag}>a <{tag}>b</{tag}> c</{tag}><p>Two</p>") == "One\nTwo"
        assert main_of(f"<p>One</p><{tag} x=http://a/>a</{tag}><p>Two</p>") == "One\nTwo"
    assert main_of("<p>One</p><script/><p>Two</p>") == "One"
    assert main_of("<html><head><title>t</title><body><p>One</p></body></html>") == "One"


def test_noise_words_in_anchors_and_wrappers_keep_the_article():
    for element in ('h2 id="related-work"', 'section id="search-engines"', 'section id="legal-framework"', 'p id="social-impact"',
                    'div class="section" id="related-work"', 'h2 id="search"'):
        tag = element.split()[0]
        assert main_of(f"<article><p>One</p><{element}>Two</{tag}><p>Three</p></article>") == "One\nTwo\nThree", element
    assert main_of('<div><p>One</p><section id="comments"><p>no</p></section><div id="related-links">no</div></div>') == "One"
    prose = "<h1>Title</h1>" + "<p>A paragraph of the article itself, long enough.</p>" * 5
    want = "\n".join(["Title"] + ["A paragraph of the article itself, long enough."] * 5)
    around = '<div class="comments"><p>' + "A thread of readers longer than the article. " * 30 + "</p></div>"
    for wrapper in ('div class="content-sidebar-wrap"', 'div class="layout-sidebar"', 'div class="sidebar"', 'form id="aspnetForm"',
                    'div class="content-sidebar-wrap"><div class="layout-sidebar"'):
        tag = wrapper.split()[0]
        html = f"<body><{wrapper}><main>{prose}</main><div class='sidebar'><p>Other stories of the day here</p></div></{tag}>{around}</body>"
        assert main_of(html) == want, wrapper
    # boxes that hold much text beside an article stay out
    html = f'<body><div class="post">{prose}</div><div class="site-footer"><p>{"Legal text of the imprint. " * 30}</p></div>{around}</body>'
    assert main_of(html) == want
    assert main_of('<body><div class="cookie-notice"><p>We use cookies and more of them on this site.</p></div></body>') == ""


def words(n, word="word"):
    return " ".join([word] * n)


ARTICLES = {
    "article class='long'": ["<h1>Title</h1>", f"<section><div class='x'><p>{words(1000)}</p></div></section>"],
    "div class='long'": ["<h1>Title</h1>", f"<div class='x'><p>{words(1000)}</p></div>"],
    "article": ["<h1>Title</h1>", f"<p>{words(20)}</p>", f"<section><h2>One</h2><p>{words(300)}</p></section>",
                f"<section class='s'><p>{words(200)}</p></section>"],
    "div class='post'": ["<h1>Title</h1>", f"<p>{words(30)}</p>", f"<section><div><p>{words(300)}</p></div></section>"],
    "div class='story'": [f"<div class='lead'><p>{words(30)}</p></div>", f"<div class='body'><p>{words(70)}</p></div>"],
    "div class='rows'": [f"<div class='lead'><p>{words(30)}</p></div>",
                         f"<div class='row'><div class='col'><div class='body'><p>{words(70)}</p></div></div></div>"],
    "div class='data'": [f"<p>{words(30)}</p>", f"<table><tbody><tr><td>{words(40)}</td><td>{words(30)}</td></tr></tbody></table>"],
    "article class='data'": [f"<p>{words(10)}</p>", f"<table><tr><td>{words(40)}</td><td>{words(50)}</td></tr></table>"],
}


def test_articles_of_several_parts_are_whole(spark):
    rows, want = [], {}
    for k, (element, parts) in enumerate(ARTICLES.items()):
        html = (f"<body><div class='top'>Site</div><div class='layout'><{element}>{''.join(parts)}</{element.split()[0]}></div>"
                f"<div class='bottom'>Imprint</div></body>")
        want[k] = [x for x in (" ".join(re.sub("<[^>]*>", " ", x).split()) for x in re.split("</?(?:p|td|h1|h2)>", "".join(parts))) if x]
        assert main_of(html).split("\n") == want[k], element
        rows += [(k, f"http://h{k}.org/{i}", html) for i in range(3)]
    for r in html_extract.extract(spark.createDataFrame(rows, PAGES)).collect():
        assert r.text.split("\n") == want[r.page_id]
