import random

import plain

from adlens.llm import html_text as h


def kept(page, other=None):
    lines = h.text_lines(page)
    texts = [t for t, _ in lines]
    shared = set() if other is None else set(h.common_lines([hash(t) for t in texts], [hash(t) for t, _ in h.text_lines(other)]))
    return h.main_text(texts, [z for _, z in lines], shared)


def test_longest_common_subsequence():
    rng = random.Random(1)
    for bits in (1 << 26, 40):
        for _ in range(200):
            a = [rng.randrange(5) for _ in range(rng.randrange(25))]
            b = [rng.randrange(5) for _ in range(rng.randrange(25))]
            at = h._aligned(a, b, bits)
            assert at == sorted(set(at)) and len(at) == plain.lcs_length(a, b)
            rest = iter(b)
            assert all(a[i] in rest for i in at)  # a subsequence of b
            assert len(h.common_lines(a, b)) == plain.lcs_length(a, b)


def test_structure():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
    <header><h1>Site</h1></header><nav><ul><li><a href=/x>menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
    <article class="post"><header><h1>Head &amp; line</h1></header><p>One <b>bold</b>er&nbsp;word,
      two<br>lines<p>Unclosed &lt;tag&gt; &#233;&#x1F600;<div class="ad">Buy</div><form><p>Sign up</p></form>
      <section id="comments"><p>First!</p></section><p hidden>secret</p><table><tr><td>a<td>b</table></article>
    <aside>Side</aside><!-- note <p>x</p> --><p>after</p><footer>&copy; Site</footer>"""
    assert kept(page) == "Head & line One bolder word, two lines Unclosed <tag> é😀 a b"


def test_attributes_and_content_elements():
    assert kept('<div title="hidden comments" data-id="ad">text</div><div id=sidebar>no</div>') == "text"
    assert kept('<div class="main-header">Site</div><div id="content"><p>one</p><p class="ad">x</p><p>two</p></div><div>after</div>') == "one two"
    assert kept("<article>The long story of it all, told at length</article><article>Teaser</article>") == "The long story of it all, told at length"
    assert kept("<article>first half of it</article><article>second half of it</article><article class=comment>Great, thanks!</article>") == "first half of it second half of it"
    assert kept('<div class="content">body<ul class="menu"><li>x</ul><div class="user-comments">y</div></div>') == "body"


def test_text_after_hidden_inline_elements():
    assert kept('<p>One <span aria-hidden="true">*</span> rest of the paragraph</p>') == "One rest of the paragraph"
    assert kept('<article>a <a aria-hidden="true" href="#x"><span>#</span></a> b <b>c</b><p>d</p></article>') == "a b c d"
    assert kept("<p>a <span hidden>x <span>y</span> z</span> b</p><p>c") == "a b c"
    assert kept("<p>a <span hidden>x</p><p>b <span>c</span> d</p>") == "a b c d"
    assert kept('<p>mid<span class="overflow-hidden">word</span> on</p>') == "midword on"


def test_a_small_content_element_does_not_silence_the_page():
    page = '<p>Menu of the site</p><p>{} The long story of it all, told at length</p><p>and a second paragraph of it</p><div class="post">See also this</div>'
    assert kept(page.format("One.")).count("story") == 1
    assert kept(page.format("One."), '<p>Menu of the site</p><p>Some other text</p><div class="post">See also this</div>') == (
        "One. The long story of it all, told at length and a second paragraph of it")


def test_odd_pages():
    assert kept(None) == "" and kept("") == "" and kept("<p></p><br>") == ""
    assert kept("plain text, no markup") == "plain text, no markup"
    assert kept("a < b and <b>c</b> > d <i>e") == "a < b and c > d e"
    assert kept("<p>cut off <b") == "cut off"
    assert kept("<article><p>one</p>") == "one"
    long = "<main>" + "".join(f"<p>line {i % 7}</p>" for i in range(20000)) + "</main>"
    assert kept(long, long).count("line") == 20000


def test_shared_open_lines_go_but_copies_and_articles_stay():
    frame = "<div>Welcome to the site</div><div>{}</div><div>{}</div><div>All rights reserved</div>"
    a, b = frame.format("First story told here", "with more of it"), frame.format("Another one", "which goes on for quite a while")
    assert kept(a, b) == "First story told here with more of it"
    assert kept(a, a) == "Welcome to the site First story told here with more of it All rights reserved"
    c = "<article><p>A common licence</p><p>own words</p></article>"
    assert kept(c, c.replace("own", "other")) == "A common licence own words"


def test_partners_and_extract(spark):
    urls = ["http://A.example/b/2?x=1", "https://a.example/b/1", "http://a.example/c", "http://z.example/only", None, "", "not a url", "http://a.example/b/1"]
    pages = [(i, u, f"<div>Menu of the host</div><div>Story number {i} of many</div>", "x") for i, u in enumerate(urls)] + [(None, None, None, None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text string").repartition(4)
    rows = {r["page_id"]: r for r in h.extract(df).collect()}
    assert len(rows) == len(pages)
    assert rows[3]["text"] == "Menu of the host Story number 3 of many"  # alone on its host
    for i in (0, 1, 2, 7):
        assert rows[i]["text"] == f"Story number {i} of many" and rows[i]["n_shared"] == 1
    assert rows[None]["text"] == "" and rows[None]["n_chars"] == 0
    assert all(r["n_chars"] == len(r["text"]) for r in rows.values())
    keys = spark.createDataFrame([(i, "h", p) for i, p in enumerate(["/a/1", "/a/2", "/b/1", "/c"])] + [(9, "g", "/a/1")], "rid long, host string, path string")
    assert {r["rid"]: r["partner"] for r in h.partners(keys).collect()} == {0: 1, 1: 0, 2: 1, 3: 2, 9: None}
    assert h.extract(df.limit(0)).count() == 0
    twice = h.extract(df.union(df)).collect()
    assert len(twice) == 2 * len(pages) and all(r["text"] == rows[r["page_id"]]["text"] for r in twice)
