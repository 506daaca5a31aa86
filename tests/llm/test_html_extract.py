import tracemalloc

from tickerlake.llm.html_extract import Page, extract, host_paths

TEMPLATE = (
    '<html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body><nav><ul><li>Home</li></ul></nav>'
    '<div class="wrap n{n}"><div id="sidebar">side</div><div class="post-{n}"><h2>Title &amp;amp; {n}</h2><p>First   <b>bold\n</b>words &lt;tag&gt;<p>Second<br>line'
    '<ul><li>one<li>two</ul><form><p>sign up</form><section class="comments"><p>me too</p></section></div></div><footer>&copy; f</footer></body></html>'
)
TEXT = "Title &amp; {n}\nFirst bold words <tag>\nSecond line\none\ntwo"


def test_blocks_and_boilerplate():
    for n in (1, 20):
        page = Page(TEMPLATE.replace("{n}", str(n)))
        path, share = page.votes()[0]
        assert (path, share) == ("html>body>div.nN.wrap>div.post-N", 1.0)
        assert page.text(path)[0] == TEXT.replace("{n}", str(n))


def test_broken_and_plain_pages():
    assert Page("").text("x") == ("", "")
    assert Page("plain   text\n ok").text(None)[0] == "plain text ok"
    assert Page("a < b and <p>c<script>never closed").text(None)[0] == "a < b and\nc"
    assert Page("<article><p>a<div class=ad>buy</div>b</article>").text(None)[0] == "a\nb"
    assert Page('<article><p>x <a href="a>b">link</a> y<!-- no --></article>').text(None)[0] == "x link y"
    assert Page("<div>" * 3000 + "deep").text(None)[0] == "deep"
    assert len(Page("<p>" + "long word " * 200_000).text(None)[0]) == 1_999_999


def test_no_text_is_lost_after_what_is_not_closed():
    for odd in ("<svg/>", "<canvas/>", "<svg>", "<button>", "<select><option>", "<object>", "<title>", "<iframe src=x>", "<svg><svg></svg>", "<button><button>go</button>"):
        text = Page(f"<article><p>start text</p>{odd}<p>rest of the text</p><p>and more</p></article>").text(None)[0]
        assert text.startswith("start text") and text.endswith("rest of the text\nand more"), odd
    assert Page("<article>a<svg><svg>x</svg>y</svg>b<script>'<script>' </b></script>c<button>no</button>d</article>").text(None)[0] == "abcd"


def test_deep_and_unclosed_pages_stay_small():
    tracemalloc.start()
    deep = "<div class='a b c d'>" * 20_000 + "deep" + "</div>" * 20_000
    assert Page(deep).text(None)[0] == "deep"
    assert Page("<button>" * 20_000 + "x").text(None)[0] == "x"
    assert Page("<svg>" * 20_000 + "x").text(None)[0] == "x"
    assert Page("<i>" * 20_000 + "x" + "</u>" * 20_000).text(None)[0] == "x"
    assert tracemalloc.get_traced_memory()[1] < 60_000_000
    tracemalloc.stop()


def test_paths_tell_all_classes_apart():
    page = Page("<body><div class='a b c d'><p>one</p></div><div class='a b c e1 x>y'><p>two</p></div></body>")
    paths = [page.path(i) for i, t in enumerate(page.tag) if t == "div"]
    assert paths == ["body>div.a.b.c.d", "body>div.a.b.c.eN.xy"]
    assert page.text(paths[1]) == ("two", paths[1]) and page.at_path("body>div") == set()


def test_consensus_overrules_a_page(spark):
    good = '<body><div class="story"><p>{}</p></div><div class="feed"><p>{}</p></div></body>'
    rows = [(i, f"https://A.example/{i}", good.format("long story text " * 9, "x"), "h") for i in range(5)]
    rows += [(9, "https://a.example/9", good.format("short story", "a feed that is much longer than the story on this page"), "h")]
    rows += [(10, None, None, "h"), (11, "not a url", "", None), (11, "not a url", "", None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string").repartition(3)
    found = {r["page_id"]: (r["text"], r["n_chars"]) for r in extract(pages).collect()}
    assert found[9] == ("short story", 11)
    assert found[10] == found[11] == ("", 0)
    assert extract(pages).count() == 9
    assert [tuple(r)[:2] for r in host_paths(pages).collect()] == [("a.example", "body>div.story")]
    assert extract(pages.where("false")).collect() == []


def test_whole_text_of_every_page(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in extract(rows).join(rows.select("page_id", "html"), "page_id").collect():
        inside = r["html"].split("<article>")[1].split("</article>")[0]
        import html
        import re

        blocks = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " " if False else "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
        assert r["text"] == "\n".join(b for b in blocks if b)
