"""HTML extraction: wrappers, whole hosts, odd pages."""

import os
import random
import re

import pytest

from opsledger.llm import html_text, page_tokens, queries, wrappers
from opsledger.llm.wrappers import dump, fold_page, load, matched, merged

SF = os.environ.get("OPSLEDGER_TEST_SF", "/root/testdata/sf0.001")


def shape(html):
    return dump(fold_page(page_tokens.read_page(html)[0]))


def test_matches_sql(spark, duck):
    got = sorted(map(tuple, queries.op11_html_text(spark, SF).collect()))
    assert got == sorted(duck.execute(queries.ORACLE["op11_html_text"]).fetchall())


def test_wrapper_resolves_mismatches():
    both = merged([shape("<div><h1>a</h1><p>b</p></div>"), shape("<div><h1>a</h1><table><tr><td>x</td></tr></table><p>b</p><p>c</p></div>")])
    assert both == '[["div",0,["h1",0,["#",0]],["table",1,["tr",0,["td",0,["#",0]]]],["p",2,["#",0]]]]'
    group = shape("<dl><dt>a<dd>b<dt>c<dd>d</dl>")
    assert group == '[["dl",0,["(dt dd)",2,["dt",0,["#",0]],["dd",0,["#",0]]]]]'
    assert merged([group, shape("<dl><dt>a<dd>b</dl>")]) == group
    assert merged([shape("<dl><dt>a<dd>b</dl>"), group]) == group
    assert matched(both, shape("<div><h1>a</h1><p>b</p><p>c</p></div>")) == [0, 2]


@pytest.mark.parametrize("seed", range(30))
def test_wrapper_covers_every_page(seed):
    rnd = random.Random(seed)

    def node(depth):
        tag = rnd.choice(["div", "ul", "section", "p", "h2", "table"])
        inner = "x" if depth > 3 or tag in ("p", "h2") else "".join(node(depth + 1) for _ in range(rnd.randint(1, 5)))
        return f"<{tag}>{inner}</{tag}>"

    pages = [shape("".join(node(0) for _ in range(rnd.randint(1, 4)))) for _ in range(12)]
    wrapper = merged(pages)
    assert dump(load(wrapper)) == wrapper
    n = len(wrappers.slots(load(wrapper)))
    for page in pages:
        own = matched(wrapper, page)
        assert len(own) == len(wrappers.slots(load(page))) and all(k is None or k < n for k in own)
        assert all(wrappers.kept_slots(wrapper, "1" * n, page)) and not any(wrappers.kept_slots(wrapper, "0" * n, page))
    assert all(k is not None for k in matched(pages[0], pages[0]))


def test_long_sequences_align():
    a, b = [str(k) for k in range(5000)], [str(k) for k in range(5000) if k % 7]
    pairs = wrappers._common(a, b)
    assert len(pairs) >= 0.9 * len(b) and all(a[i] == b[j] for i, j in pairs)
    assert pairs == sorted(pairs) and len({i for i, _ in pairs}) == len(pairs)


def test_reader_takes_broken_markup():
    def texts(html):
        return page_tokens.read_page(html)[1]

    assert texts(None) == texts("") == texts("<a href=\"") == texts("<!-- x") == texts("<script>a") == []
    assert texts("<p>a<p>b</div>c<hr>d<li>e<li>f") == list("abcdef")
    assert texts("x &lt; y&nbsp;&nbsp;z &am &amp") == ["x < y z &am &"]
    assert texts("a\n\t b<br>c <b>d</b>e<i> f") == ["a b c de f"]
    assert texts('<div title="a>b">q</div>') == ["q"]
    assert texts("<script>var t='</p>';</SCRIPT >x<title>y</title>z") == ["xz"]
    assert texts("1 < 2 <3") == ["1 < 2 <3"]
    assert texts("<div>" * 3000 + "deep" + "</div>" * 3000) == ["deep"]
    assert texts("<nav>" * 3000 + "deep") == ["deep"]
    assert len(shape("<div>" * 3000 + "deep")) < 3000


NAV = "<nav><a href=/>Home</a></nav>"
CASES = {
    # semantic elements, comments and notices inside the article
    "a": (
        "<html><head><title>t</title></head><body><header>Site</header>" + NAV + "<main><article><h1>T{0}</h1><p>One {0}.</p><div class='ad-box'>Buy</div>"
        "<div class=cookieNotice>We use cookies</div><p>Two &amp; {0}</p><section id='comments'><p>Nice {0}</p></section><form><p>Mail</p></form></article>"
        "<aside>See {0}</aside></main><footer>(c)</footer></body></html>",
        "T{0}\nOne {0}.\nTwo & {0}",
    ),
    # no element names the article: the changing text mass does
    "b": (
        "<div class=top><a href=/x>Shop</a> <a href=/y>News</a></div><div id=c1><div><h2>Title {0}</h2><div>A first long sentence about {0} and more of it.</div>"
        "<div>A second long sentence about {0} and more of it.</div></div></div><div class=c9>All rights reserved by the site</div>",
        "Title {0}\nA first long sentence about {0} and more of it.\nA second long sentence about {0} and more of it.",
    ),
    # main only
    "c": ("<body><div>Menu</div><main><h1>H{0}</h1>loose {0}<ul><li>x{0}<li>y</ul></main><div>end</div>", "H{0}\nloose {0}\nx{0}\ny"),
}


def test_hosts_by_their_wrappers(spark):
    rows, want = [], {}
    for host, (page, text) in CASES.items():
        for k in range(7):
            pid = len(rows)
            rows.append((pid, f"https://{host.upper()}.example/p/{k}?x", page.format(k), "kept"))
            want[pid] = text.format(k)
    rows += [(900, None, CASES["a"][0].format(9), "k"), (901, "https://a.example/", None, "k"), (902, "https://a.example/", "", "k"), (903, "no url", "<p>", None), (None, "https://a.example/1", CASES["a"][0].format(9), "k")]
    rows += [rows[0]] * 3
    want |= {900: CASES["a"][1].format(9), 901: "", 902: "", 903: "", None: CASES["a"][1].format(9)}
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, __host string")
    got = html_text.main_text(pages).collect()
    assert len(got) == len(rows)
    assert set(got[0].asDict()) == {"page_id", "url", "__host", "text", "n_chars"}
    for r in got:
        assert r.text == want[r.page_id], r.page_id
        assert r.n_chars == len(r.text)


def test_copies_keep_their_text(spark):
    page = CASES["a"][0].format(1)
    pages = spark.createDataFrame([(k, "http://one.example/x", page) for k in range(50)], "page_id long, url string, html string")
    assert {r.text for r in html_text.main_text(pages).collect()} == {CASES["a"][1].format(1)}


def test_many_shapes_in_rounds_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(html_text, "BUCKET", 3)
    rnd = random.Random(5)
    rows = []
    for k in range(60):
        middle = "".join(rnd.choice(["<p>t</p>", "<ul><li>u</ul>", "<h2>v</h2>", "<table><tr><td>w</table>"]) for _ in range(rnd.randint(1, 6)))
        rows.append((k, "http://one.example/x", f"<div>menu</div><article>{middle}</article>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    first = html_text.host_wrappers(pages.repartition(5)).collect()
    assert len(first) == 1 and first == html_text.host_wrappers(pages.repartition(2, "page_id")).collect()
    got = {r.page_id: r.text for r in html_text.main_text(pages).collect()}
    for k, _, page in rows:
        want = [x[-1] for x in re.findall(r">[tuvw](?=<)", page.split("<article>")[1])]
        assert got[k].split("\n") == want


def test_empty_table(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    out = html_text.main_text(empty)
    assert out.collect() == [] and out.columns == ["page_id", "url", "text", "n_chars"]
