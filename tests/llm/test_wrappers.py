import html as entities
import json
import re

from pyspark.sql import functions as F

from quotegrid.llm import wrappers as X


def page(i, ad=False):
    items = "".join(f"<li><a href=/{k}>menu {k}</a></li>" for k in range(3 + i % 3))
    body = "".join(f"<p>Paragraph {i}.{k}&nbsp;&amp; so <b>on</b>ward\n it goes with words enough.</p>" for k in range(2 + i % 4))
    advert = '<div class="ad">Buy now</div>' if ad else ""
    return (
        f'<html><head><title>T{i}</title><style>p{{}}</style></head><body><div id="header"><a href=/>Site</a></div><ul class="menu">{items}</ul>'
        f'<div class="cookie-notice">We use cookies</div><div class="wrap"><div class="content"><h2>Head {i}</h2>{body}{advert}</div>'
        f'<div class="sidebar"><p>side {i}</p></div></div><div id="comments"><p>nice {i}</p></div><form><label>Mail</label></form>'
        f'<div class=footer>&copy; 2024 <script>var a = "</div><p>";</script></div></body></html>'
    )


def main_text(i):
    return " ".join([f"Head {i}"] + [f"Paragraph {i}.{k} & so onward it goes with words enough." for k in range(2 + i % 4)])


def test_wrapper_has_repeats_options_and_slots():
    w = X.infer([page(i, ad=i % 2 == 1) for i in range(6)])
    assert "<ul.menu>(<li>#</li>)+</ul.menu>" in w["expression"]
    assert "<h2>#</h2>(<p>#</p>)+(<div.ad>#</div.ad>)?</div.content>" in w["expression"]
    assert w["root"].endswith("div.content")
    assert ["html/body/div#header", "Site"] in w["template"]
    assert [X.extract(page(i, True), w) for i in range(9)] == [main_text(i) for i in range(9)]


def test_fold_and_align():
    assert X.fold(list("abcbcbcd")) == ["a", ("b", "c"), "d"]
    one = [(x, False) for x in X.fold(list("abbbc"))]
    assert X.expression(X.align(one, X.fold(list("abc")))) == "a(b)+c"
    assert X.expression(X.align([(x, False) for x in "axc"], list("ac"))) == "a(x)?c"
    assert X.expression(X.align([(x, False) for x in "ac"], list("axyc"))) == "a(xy)?c"


def test_a_name_is_not_believed_when_it_holds_the_article():
    pages = [f'<body><div class="social-post"><p>{"story %d " % i * 20}</p></div><div class="menu">m</div></body>' for i in range(5)]
    w = X.infer(pages)
    assert w["trusted"] and X.extract(pages[0], w) == ("story 0 " * 20).strip()


def test_broken_and_odd_html():
    get = lambda h: X.extract(h, None)
    assert get("") == "" and get("plain & text") == "plain & text" and get("<p>a<p>b") == "a b"
    assert get("<article>x<br>y<b>z</b>w &lt;i&gt; <a href='>'>l</a></article><p>other") == "x yzw <i> l"
    assert get("<p>cut <b>off &am") == "cut off &am" and get("<p>ends in a tag <a hre") == "ends in a tag"
    assert get("<div hidden>no</div><p>yes</p><!-- never --><div style='display: none'>no</div><script>if (a<b) x()") == "yes"
    assert get("<article><header><h1>Title</h1></header><p>t</p><section class='comments'><p>c</p></section></article>") == "Title t"
    assert get("</div></p>a</article>b") == "a b" and get("1 < 2 and 3 > 2") == "1 < 2 and 3 > 2"
    assert get("<p>" + "word " * 50000 + "</p>") == ("word " * 50000).strip()
    assert get("<p class='a" + " b" * 30000) == ""


def test_odd_rows(spark):
    rows = [(1, None, page(1)), (2, "http://h.example/a", None), (3, "odd url", page(2)), (None, "HTTP://H.example?x", "<p>a</p>"), (4, "http://h.example/b", "")]
    rows += [(10 + i, f"https://big.example/{i}", page(i % 7)) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit("x"), "wrapper": F.lit("y"), "h": F.lit(1)})
    got = {r.page_id: r for r in X.main_texts(pages).collect()}
    assert len(got) == len(rows) and got[2].text == "" and got[4].n_chars == 0 and got[None].text == "a"
    assert all(got[10 + i].text == main_text(i % 7) and got[10 + i].n_chars == len(main_text(i % 7)) for i in range(60))
    assert got[1].text == main_text(1) and got[1].url is None
    assert X.main_texts(pages.limit(0)).count() == 0
    w = {r.host: json.loads(r.wrapper) for r in X.infer_wrappers(pages).collect()}
    assert set(w) == {"", "h.example", "big.example"}


def test_whole_table_equals_its_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        want[r.page_id] = " ".join(entities.unescape(re.sub(r"<[^>]*>", " ", inner.replace("<b>", ""))).split())
    assert {r.page_id: r.text for r in X.main_texts(pages).collect()} == want


def test_a_title_beside_the_body_stays():
    get = lambda i: f"<body><ul class=menu><li>m{i}</ul><div class=page><h1>Title {i}</h1><p>Lead {i}</p><div class=body><p>{f'word {i} ' * 90}</p></div></div><div class=end>Imprint</div></body>"
    w = X.infer([get(i) for i in range(8)])
    assert w["root"] == "body/div.page"
    want = f"Title 9 Lead 9 {('word 9 ' * 90).strip()}"
    assert X.extract(get(9), w) == want and X.extract(get(9).replace("<div class=end>Imprint</div>", ""), None) == want


def test_all_articles_of_a_page_and_rare_layouts_stay():
    common = [f"<body><article class=a><p>{f'text {i} ' * 30}</p></article><div>Imprint</div></body>" for i in range(12)]
    w = X.infer(common)
    two = "<body><article class=a><p>one</p></article><div><article class=b><p>two</p></article></div><div>Imprint</div></body>"
    assert X.extract(two, w) == "one two"
    plain = X.infer([f"<body><div class=x><p>{f'text {i} ' * 30}</p></div><div class=end>Imprint</div></body>" for i in range(12)])
    assert X.extract("<body><div class=x><p>a</p></div><div class=y><p>b</p></div><div class=end>Imprint</div></body>", plain) == "a b"


def test_links_alone_are_no_main_text_but_a_linked_title_is():
    get = lambda i: f"<body><div class=top><a href=/>topic {i}</a></div><div class=page><h1><a href=/>Title {i}</a></h1><p>Text {i} of it.</p></div></body>"
    w = X.infer([get(i) for i in range(8)])
    assert X.extract(get(9), w) == "Title 9 Text 9 of it."


def test_a_notice_behind_a_long_page_is_template():
    get = lambda i: "<body><div class=x>" + "".join(f"<p>{i} {k}</p><h2>h {i} {k}</h2>" for k in range(1500)) + "</div><div class=end>Imprint</div></body>"
    w = X.infer([get(i) for i in range(4)])
    assert ["body/div.end", "Imprint"] in w["template"] and "Imprint" not in X.extract(get(5), w)


def layouts(i):
    """Pages without article tags: most have a notice at the end, few have links beside the text, a name that holds all text, or no head."""
    rail = f"<div class=rail><a href=/>see {i}</a></div>" * (i % 40 == 7)
    end = "<div class=end>Imprint</div>" * (i % 10 > 0)
    head = f"<h1>Head {i}</h1>" * (i % 25 != 3)
    return f"<body>{rail}<div class=page>{head}<div class='social-post'>{f'<p>Story {i} of it</p>' * (1 + i % 3)}</div></div>{end}</body>"


def test_a_wrapper_comes_from_all_pages_of_its_host(spark, monkeypatch):
    monkeypatch.setattr(X, "AT_ONCE", 2, raising=False)  # streams are aligned in rounds
    html = [layouts(i) for i in range(120)]
    rows = [(i, f"http://a.example/{i}", h) for i, h in enumerate(html)] + [(200 + i, f"http://b.example/{i}", page(i, i % 2 == 1)) for i in range(9)]
    rows += [(300 + i, f"http://a.example/copy/{i}", html[7]) for i in range(400)]  # copies count once
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.host: json.loads(r.wrapper) for r in X.infer_wrappers(pages).collect()}
    assert set(got) == {"a.example", "b.example"}
    for host, of in (("a.example", html), ("b.example", [page(i, i % 2 == 1) for i in range(9)])):
        want = X.infer(of)
        assert {k: v for k, v in got[host].items() if k != "expression"} == {k: v for k, v in want.items() if k != "expression"}
        for h in of:
            stream = "".join("#" if x.startswith("#") else x for x in X.read_page(h, stream=True).stream)
            assert re.fullmatch(got[host]["expression"], stream) and re.fullmatch(want["expression"], stream)
    assert got["a.example"]["links"] and got["a.example"]["template"] == [["body/div.end", "Imprint"]]
    texts = {r.page_id: r.text for r in X.main_texts(pages).collect()}
    assert texts[7] == texts[399] == "Head 7 Story 7 of it Story 7 of it"


def test_alignment_takes_long_streams_whole():
    one = [(f"<a{i}>", False) for i in range(9000)]
    assert X.align(one, [x for x, _ in one if x != "<a8000>"]) == [(x, x == "<a8000>") for x, _ in one]
    long = "".join(f"<div class=x{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}><p>{i}</p></div>" for i in range(1500))
    w = X.infer([f"<body>{long}</body>", f"<body>{long}<div class=end>b</div></body>"])
    assert w["expression"].endswith("(<div.end>#</div.end>)?</body>")
