import copy
import random

import pytest

from cartwheel.llm import wrappers as w

PAGE = (
    "<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a='</p><article>';</script></head><body>"
    "<nav><ul><li><a href='/'>Home</a></li></ul></nav><!-- <p>no</p> --><div class='ad'>Buy</div>"
    "<article><h1>Title &amp; more</h1><p><b>One<br>two<p>Three &lt;4&gt;\n  five &eacute;</p>"
    "<aside>side</aside><form>f<input></form></article><div id='comments'><article>Nice!</article></div>"
    "<footer>&copy; x</footer></body></html>"
)


def test_article_text():
    assert w.extract(PAGE, None) == "Title & more\nOne two\nThree <4> five é"


@pytest.mark.parametrize(
    "page, want",
    [
        ("", ""),
        ("plain   text", "plain text"),
        ("<p>a<p>b<table><tr><td>c<td>d<tr><td>e</table>", "a\nb\nc\nd\ne"),
        ("<main><p>in</p></main><p>out</p>", "in"),
        ("<div role='main'><p>in</p></div><p>out</p>", "in"),
        ("<p>x</p><div class='cookie-notice'>cookies</div><header>site</header><p>y</p>", "x\ny"),
        ("<article><header><h1>H</h1></header>t</article>", "H\nt"),
        ("<ul><li><a href=1>one link</a><li><a href=2>two</a></ul><p>text <a href=3>l</a> goes on</p>", "text l goes on"),
        ("<article>cut off <b>here", "cut off here"),
        ("<article>a < b & c &amp;amp; &#65;&#x42; 1 <2</article>", "a < b & c &amp; AB 1 <2"),
        ("<article><p title='a>b'>q</p><p title=\"x>r</p></article>", 'q\nr'),
        ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
        ("<article><pre>a\n  b</pre><textarea>no</textarea><noscript>no</noscript>c</article>", "a b\nc"),
    ],
)
def test_pages(page, want):
    assert w.extract(page, None) == want


def test_repeats_are_found():
    assert w.runs(list("aaab")) == [(0, 1, 3), (3, 1, 1)]
    assert w.runs(list("xababab")) == [(0, 1, 1), (1, 2, 3)]
    assert w.runs([]) == []


def words(r, n):
    return " ".join(r.choice(["lo", "ren", "mip", "sum", "dol"]) for _ in range(n))


def site(r, extra):
    paragraphs = "".join(f"<p>{words(r, 12)}</p>" for _ in range(r.randrange(1, 5)))
    table = f"<table><tr><td>{words(r, 3)}</td></tr></table>" if extra else ""
    return f"<body><div>Template line</div><article><p class=k>Read our rules</p><h1>{words(r, 4)}</h1>{paragraphs}{table}</article></body>"


def shape(node):
    if node["l"] == "#":
        return "#" if node["v"] is None else repr(node["v"])
    inner = " ".join(
        "(" + " ".join(shape(n) for n in item["s"]) + ")" + ("+" if item["r"] else "") + ("?" if item["o"] else "")
        for item in node["i"]
    )
    return f"{node['l']}[{inner}]"


def test_alignment_gives_optionals_repeats_and_slots():
    r = random.Random(1)
    pages = [site(r, i % 3 == 0) for i in range(9)]
    wrapper = None
    for p in pages:
        wrapper = w.merge(wrapper, w.page_wrapper(w.parse(p)))
    body = wrapper["i"][0]["s"][0]
    assert shape(body) == (
        "body[(div[('Template line')]) (article[(p class=k[('Read our rules')]) (h1[(#)]) (p[(#)])+ "
        "(table[(tr[(td[(#)])])])?])]"
    )
    assert wrapper["n"] == 9
    # texts that are constants of the template are not the article's
    assert "Read our rules" not in w.extract(pages[0], wrapper)
    assert "Read our rules" in w.extract(pages[0], None)


def test_merging_partial_wrappers_equals_one_pass():
    r = random.Random(2)
    parts = [w.page_wrapper(w.parse(site(r, i % 4 == 1))) for i in range(12)]
    one = None
    for p in copy.deepcopy(parts):
        one = w.merge(one, p)
    left, right = None, None
    for p in copy.deepcopy(parts[:6]):
        left = w.merge(left, p)
    for p in copy.deepcopy(parts[6:]):
        right = w.merge(right, p)
    assert shape(w.merge(left, right)) == shape(one)


def test_long_constants_go():
    r = random.Random(4)
    notice = "This site stores small files on your device, " * 12
    pages = [f"<body><div class=k>{notice}</div><div>{words(r, 300)}</div></body>" for _ in range(8)]
    wrapper = None
    for p in pages:
        wrapper = w.merge(wrapper, w.page_wrapper(w.parse(p)))
    for p in pages:
        text = w.extract(p, wrapper)
        assert "small files" not in text and text == w.extract(p, None).split("\n")[1]


def test_copies_of_one_article_stay():
    wrapper = None
    for _ in range(20):
        wrapper = w.merge(wrapper, w.page_wrapper(w.parse(PAGE)))
    assert w.extract(PAGE, wrapper) == w.extract(PAGE, None)


@pytest.mark.parametrize("n", [10, 148, 200, 3000])
def test_deep_markup(n):
    deep = lambda inner, tag="div": f"<{tag}>" * n + inner + f"</{tag}>" * n
    assert w.extract(f"<div><article>{deep('text')}<p>rest</p></article></div><p>out</p>", None) == "text\nrest"
    assert w.extract(f"<article>{deep('a<nav>n<nav>m</nav>o</nav><div class=ad>b<p>c</p>d</div>e')}f</article>", None) == "a\ne\nf"
    assert w.extract(f"<article>{deep('a<header>h<nav>n</nav></header>e<div>g</div>i')}</article>", None) == "a\nh\ne\ng\ni"
    assert w.extract(f"<p>out</p>{deep('x<article>in <b>bold</b> on</article>y')}<p>out</p>", None) == "in bold on"
    assert w.extract(f"<article><p>{'<span>' * n}a <b>b</b> c<p>d</article><p>out</p>", None) == "a b c\nd"
    assert w.extract(f"{deep('<p>a text with a <a>link</a></p><p><a>only link</a></p>')}", None) == "a text with a link"


@pytest.mark.parametrize("others", [0, 2])
def test_near_copies_keep_their_article(others):
    r = random.Random(5)
    one = f"<h1>{words(r, 5)}</h1><p class=by>By A. Writer</p><p>{words(r, 60)}</p>"
    pages = [f"<body><article>{one}<div>advert {i} {words(r, 6)}</div></article></body>" for i in range(30)]
    other = [f"<body><article><p>{words(r, 60)}</p></article></body>" for _ in range(others)]
    wrapper = None
    for p in pages + other:
        wrapper = w.merge(wrapper, w.page_wrapper(w.parse(p)))
    for p in pages + other:
        assert w.extract(p, wrapper) == w.extract(p, None)


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_table(spark, monkeypatch, limit):
    monkeypatch.setattr(w, "BROADCAST_BYTES", limit)
    r = random.Random(3)
    rows = [(i, f"http://h{i % 2}.example/{i}", site(r, i % 2), "x") for i in range(40)]
    rows += [(100, None, PAGE, "x"), (101, "http://h0.example/", None, "x"), (None, "odd", "", "x"), (100, None, PAGE, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(40)
    got = w.main_text(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    by = {x.page_id: x for x in got.collect()}
    assert got.count() == len(rows)
    assert by[100].text == "Title & more\nOne two\nThree <4> five é" and by[100].n_chars == len(by[100].text)
    assert by[101].text == "" and by[None].text == "" and by[None].n_chars == 0
    assert all("Read our rules" not in by[i].text and by[i].text for i in range(40))
    assert w.main_text(pages.where("page_id = -1")).count() == 0


def test_copies_are_told_apart_among_all_pages(spark, monkeypatch):
    monkeypatch.setattr(w, "FRONT", 4)
    r = random.Random(6)
    hosts = {}
    for host, pool in (("few", 12), ("many", 60), ("all", 9)):
        votes = {}
        for _ in range(150):
            texts = {w._digest(f"{host}{j}"): 5 + 7 * (j % 5) for j in r.sample(range(pool), r.randrange(1, 7))}
            texts[w._digest(f"own {r.random()}")] = r.randrange(1, 60)
            votes[w._digest(" ".join(sorted(texts)))] = texts
        hosts[host] = votes
    line = {w._digest("notice"): 40}  # all share a notice and have as much of their own, a few have nothing else
    hosts["notice"] = {w._digest(f"v{i}"): {**line, w._digest(f"n{i}"): 1 if i % 40 == 0 else 90} for i in range(150)}
    near = {w._digest("article"): 400}
    hosts["near"] = {w._digest(f"c{i}"): {**near, w._digest(f"a{i}"): 30} for i in range(150)}
    rows = [(h, v, [f"{x}{n}" for x, n in t.items()]) for h, votes in hosts.items() for v, t in votes.items()]
    df = spark.createDataFrame(rows, "host string, vote string, texts array<string>").repartition(5)
    got = w.copies(df)
    assert got.count() == got.distinct().count()
    gone = {tuple(x) for x in got.collect()}
    for host, votes in hosts.items():
        left = [t for v, t in sorted(votes.items()) if (host, v) not in gone]
        assert left == w._different(votes), host
    assert len([x for x in gone if x[0] == "near"]) == 149


def test_every_page_of_a_host_counts(spark):
    """A line on nine pages of ten, but on none of those with the smallest
    digests."""
    r = random.Random(7)
    pages = {True: [], False: []}
    while min(len(pages[True]) - 180, len(pages[False]) - 20) < 0:
        with_line = r.random() < 0.5
        page = f"<body><article>{'<p class=k>Read our rules</p>' if with_line else ''}<p>{words(r, 30)} {r.random()}</p></article></body>"
        if (min(w.page_wrapper(w.parse(page))["p"]) > "4") == with_line:
            pages[with_line].append(page)
    rows = [(i, "http://h/", p) for i, p in enumerate(pages[True][:180] + pages[False][:20])]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = w.main_text(table).collect()
    assert len(got) == 200 and all(x.text and "Read our rules" not in x.text for x in got)
