from estate.llm import pages

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var a="</p><p>no";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=x>Home<li>News</ul></nav><div class="cookie-notice">We use</div>
<main><article><header><h1>Title &amp; more</h1></header><p>One <b>bold</b>&nbsp;two<br>three<p>Next &lt;tag&gt; &#233;
<!-- note <p>no</p> --><ul><li>a<li>b</ul><aside>see also</aside><form><p>mail</p></form><table><tr><td>x<td>y</table></article>
<div id="comments"><p>first!</p></div></main><div class="ad">Buy</div><footer>&copy; site</footer></body></html>"""


def run(spark, rows, **options):
    frame = spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, text string").repartition(3)
    return {r.page_id: r for r in pages.extract_text(frame, **options).collect()}


def test_one_page_by_presentation(spark):
    got = run(spark, [(1, "http://a.org/x", PAGE), (2, None, None), (3, "odd", ""), (4, "http://a.org/y", "plain\n text"), (5, "http://a.org/z", "<p>open <b>end &amp")])
    assert got[1].text == "Title & more\nOne bold two three\nNext <tag> é\na\nb\nx\ny"
    assert got[1].n_chars == len(got[1].text)
    assert [got[i].text for i in (2, 3, 4, 5)] == ["", "", "plain text", "open end &"]
    assert run(spark, []) == {}


def test_templates_are_found_by_entropy(spark):
    """Branches without telling names go where a site repeats them, and stay where their content varies."""
    rows = []
    for i in range(60):
        body = "".join(f"<p>Story {i} part {k}</p>" for k in range(3))
        rows.append((i, f"https://Big.net/{i}", f'<div class="x1">Offer {i % 3}</div><div class="x2">{body}</div><div><span>Imprint</span></div>'))
    rows += [(100 + i, f"http://small.net/{i}", '<div class="x1">Offer 1</div><div class="x2"><p>Text</p></div>') for i in range(3)]
    # A host of copies alone: nothing there is more important than the rest.
    rows += [(200 + i, f"http://copies.net/{i}", '<div class="x1">Same</div><p>All same</p>') for i in range(30)]
    got = run(spark, rows)
    assert all(got[i].text == "\n".join(f"Story {i} part {k}" for k in range(3)) for i in range(60))
    assert got[101].text == "Offer 1\nText" and got[205].text == "Same\nAll same"


def test_importance_is_the_entropy_of_contents(spark):
    rows = [(i, "http://h/", f"<p>{i}</p><div>{i % 2}</div>") for i in range(8)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted(round(r.importance, 6) for r in pages.style_importance(frame).collect()) == [round(1 / 3, 6), 1.0]


def test_long_page(spark):
    long = "<article>" + "<p>word " * 50_000 + "</article>"
    assert run(spark, [(1, "http://a/", long)])[1].n_chars == 50_000 * 5 - 1


def test_rare_templates_and_lists_of_a_large_host(spark):
    """What few of a host's pages have is judged by those pages, and copies of a page count once."""
    menu = '<div class="m1">Home News About</div>'
    rows = [(i, "http://big/", f'{menu}<div class="x2"><p>Story {i}</p></div>') for i in range(4000)]
    rows += [(4000 + i, "http://big/", f'{menu}<div class="y1"><h5>Head {i}</h5><dl><dd>Text {i}</dd></dl></div>') for i in range(40)]
    rows += [(5000 + i, "http://big/", f'{menu}<div class="x2"><p>Listed {i}</p><ol class="z"><li>one {i}<li>two {i}</ol></div>') for i in range(40)]
    # A template whose pages are mostly copies of one.
    rows += [(6000 + i, "http://big/", f'{menu}<div class="w1"><h6>Notes {max(0, i - 170)}</h6></div>') for i in range(200)]
    got = run(spark, rows)
    assert all(got[i].text == f"Story {i}" for i in range(4000))
    assert all(got[4000 + i].text == f"Head {i}\nText {i}" for i in range(40))
    assert all(got[5000 + i].text == f"Listed {i}\none {i}\ntwo {i}" for i in range(40))
    assert all(got[6000 + i].text == f"Notes {max(0, i - 170)}" for i in range(200))


def test_class_words_do_not_decide_alone(spark):
    side = '<div class="sidebar"><p>Other news</p></div>'
    bodies = [
        f'<div class="content has-sidebar"><p>Text</p>{side}</div>',
        f'<main class="no-sidebar sidebar"><p>Text</p>{side}</main>',
        f'<article class="post category-advertising comments-open widget"><p>Text</p></article>{side}',
        f'<div id="search-result-page"><p>Text</p></div>{side}',
        f'<div class="search"><div class="menu-right menu"><article><p>Text</p></article></div></div>{side}',
        f'<main><article><p>Text</p><div id="comments"><article><p>first!</p></article></div></article></main>{side}',
        '<div class="widget"><p>Text</p></div>',
    ]
    rows = [(i, f"http://small{i}/", body) for i, body in enumerate(bodies)]
    # Class words against what differs on every page, and against what does not.
    rows += [(100 + i, "http://big/", f'<p>Intro {i}</p><div class="widget"><p>Body {i}</p></div><div class="promo"><b>Buy {i % 20}</b></div>') for i in range(60)]
    got = run(spark, rows)
    assert [got[i].text for i in range(len(bodies))] == ["Text"] * len(bodies)
    assert all(got[100 + i].text == f"Intro {i}\nBody {i}" for i in range(60))


def test_deep_nesting_takes_linear_time():
    """Elements that are never closed, with and without class words and articles; a step costs the same at any depth."""
    import time

    for open_, close in (('<div class="row">x', ""), ('<div class="sidebar"><article>x', ""), ("<p>x<div>y", "</div>"), ("<ul><li>x", ""), ("<button><p>x<button>y", "")):
        begin = time.time()
        blocks = pages.page_blocks(open_ * 60_000 + close * 60_000)
        assert len(blocks) >= 60_000 and time.time() - begin < 30
    # Chains of different depth or classes are different, equal ones equal.
    chains = [b[0] for b in pages.page_blocks('<div class="a">1<div>2<div>3</div></div></div><div class="a">4<div class="b">5</div></div>')]
    assert chains[0] == chains[3] and len(set(chains)) == 4
