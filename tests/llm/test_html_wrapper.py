import html

from orbitlens.llm.html_wrapper import extract, html_text, match, numbered, parse, skeleton, slots, union


def test_blocks_references_and_tag_soup():
    page = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body>
    <nav><ul><li><a href="/a">a</a><li>b</ul></nav><!-- ad --><div class="ad">buy</div><header><h1>Site</h1></header>
    <article><header><h1>Head &amp; line</h1><span>by us</span></header><p><b>One
      two.<br><p>Thr<i>ee</i> &lt;4&gt; caf&eacute;<aside>side</aside><form><p>mail</p></form><ul><li>x<li>y</ul>
    <div class="cookie-notice">we use</div><table><tr><td>c1<td>c2</table><section id="comments"><p>first!</p></section></article>
    <footer>&copy; x</footer>"""
    assert extract(page) == "Head & line\nOne two.\nThree <4> café\nx\ny\nc1\nc2"
    assert extract("") == "" and extract("just  text &am") == "just text &am" and extract("<p>a") == "a" and extract("<") == "<"
    assert extract('<p hidden>a</p><p style="display: none">b</p><p class="shadow">c</p>') == "c"


def test_matching_is_simple_tree_matching():
    wrapper, n = numbered(("r", (("a", (("x", ()), ("y", ()))), ("b", ()), ("a", (("z", ()),)))))
    assert n == 7
    page = slots(parse(""))
    assert skeleton(page) == ("#", ())
    tree = slots(parse("<div class=a><p>1<p>2</div><section><h2>q</h2></section><div class=a><h2>z</h2></div>"))
    same, size = numbered(skeleton(tree))
    assert match(tree, same) == size == 7
    other, _ = numbered(skeleton(slots(parse("<section><h2>q</h2></section><div class=a><p>1</div>"))))
    assert match(tree, other) == 4                                    # root, section with heading, the later div
    swapped, _ = numbered(skeleton(slots(parse("<div class=a><p>1</div><div class=a></div><section><h2>q</h2></section>"))))
    assert match(tree, swapped) == 5                                  # order keeps the later div apart


def site(i, words):
    return (f"<html><body><div><p>Welcome to our site</p><p>Sign in to read more</p></div><div class=body><h2>Title {i} {words}</h2>"
            f"<p>Body {words} {i}.</p><p>More {i}</p></div><div><a href=/1>link {i}</a> <a href=/2>other {i + 1}</a></div>"
            f"<div><p>All rights reserved</p></div></body></html>")


def test_constant_slots_become_template(spark):
    rows = [(i, f"http://h.example.com/{i}", site(i, "w" * (i % 5))) for i in range(12)]
    rows += [(100, "http://single.example.org/", "<body><div><p>alone</p></div></body>"), (101, None, None), (102, "x", ""), (101, None, None),
             (None, "http://h.example.com/n", site(50, "null"))]
    # copies of one article on a host: its text stays
    rows += [(200 + i, "http://c.example.com/", "<nav>m</nav><article><p>same words</p></article>") for i in range(6)]
    df = spark.createDataFrame([(*r, "h", 1) for r in rows], "page_id long, url string, html string, host string, n_chars int")
    got = html_text(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id is None:
            assert r.text == "Title 50 null\nBody null 50.\nMore 50"
        elif r.page_id < 12:
            w = "w" * (r.page_id % 5)
            assert r.text == "\n".join([f"Title {r.page_id} {w}".strip(), f"Body {w} {r.page_id}.".replace("  ", " "), f"More {r.page_id}"])
        elif r.page_id >= 200:
            assert r.text == "same words"
        else:
            assert r.text == {100: "alone", 101: "", 102: ""}[r.page_id]
        assert r.n_chars == len(r.text)
    assert html_text(df.limit(0)).count() == 0


def test_pages_table(spark, sf01):
    import re
    pages = spark.read.parquet(f"{sf01}/pages.parquet")
    raw = {r.page_id: r.html for r in pages.collect()}
    for r in html_text(pages).collect():
        body = re.search(r"<article>(.*?)(?:</article>|$)", raw[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)[^>]*>", body)]
        assert r.text == "\n".join(x for x in blocks if x)


def test_very_long_and_deep_pages():
    long = "<article>" + "<p>w &amp; x</p>" * 50_000 + "</article>"
    assert extract(long).count("\n") == 49_999
    deep = "<div>" * 20_000 + "text" + "</div>" * 20_000
    assert extract(deep) == "text"


def test_slots_decide_inside_and_outside_of_marks(spark):
    rows = []
    for i in range(6):
        rows.append((i, "http://cards.example.com/", f"<div class=text><p>Story {i} first.</p><p>Story {i} second.</p></div><article><p>Card {i}</p></article>"
                                                     f"<div class=low><p>All rights reserved</p></div>"))
        rows.append((10 + i, "http://inner.example.com/", f"<main><div><p>Body {i}.</p></div><article><p>Read our best stories</p></article></main>"))
        rows.append((20 + i, "http://same.example.com/", f"<article><p>News {i}</p><section><p>Tell your friends</p></section></article>"))
        rows.append((30 + i, "http://copies.example.com/", "<p>x</p><article><p>one article</p></article>"))
    rows.append((40, "http://one.example.com/", "<div><p>A long text that stands outside of the mark</p></div><article><p>Card</p></article>"))
    rows.append((41, "http://two.example.com/", "<div><p>Sign in</p></div><main><p>Menu</p><article><p>The long text of the only page</p></article></main>"))
    got = {r.page_id: r.text for r in html_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(6):
        assert got[i] == f"Story {i} first.\nStory {i} second.\nCard {i}"
        assert got[10 + i] == f"Body {i}."
        assert got[20 + i] == f"News {i}"
        assert got[30 + i] == "one article"
    assert got[40] == "A long text that stands outside of the mark\nCard" and got[41] == "The long text of the only page"


def test_every_layout_of_a_host_has_its_template(spark):
    rows = []
    for i in range(5):
        rows.append((i, "http://h.example.com/", f"<div><p>Top of news</p></div><h2>News {i}</h2><p>Body {i}.</p><div><p>End of news</p></div>"))
        rows.append((10 + i, "http://h.example.com/", f"<div><p>Top of recipes</p></div><table><tr><td>Dish {i}</table><div><p>End of recipes</p></div>"))
        rows.append((20 + i, "http://h.example.com/", f"<div><p>Top of forum</p></div><section><p>Post {i}</p></section><div><p>End of forum</p></div>"))
    # a block that a fifth of the pages have is constant where it stands
    for i in range(20):
        extra = "<div class=offer><p>Buy two, pay one</p></div>" if i % 5 == 0 else ""
        rows.append((100 + i, "http://o.example.com/", f"<body><div class=text><h2>Head {i}</h2>{extra}<p>Words {i}.</p></div></body>"))
    got = {r.page_id: r.text for r in html_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(5):
        assert got[i] == f"News {i}\nBody {i}." and got[10 + i] == f"Dish {i}" and got[20 + i] == f"Post {i}"
    for i in range(20):
        assert got[100 + i] == f"Head {i}\nWords {i}."


def test_labels_of_single_pages_stay_out_of_the_wrapper(spark):
    from orbitlens.llm.html_wrapper import host_of, wrappers
    rows = [(i, "http://h.example.com/", f"<body><div class=post-{i}><p>Text {i}</p></div><div class=low><p>All rights reserved</p></div></body>") for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in html_text(df).collect()} == {f"Text {i}" for i in range(40)}
    w = wrappers(df.select(host_of("url").alias("host"), "page_id", "html")).collect()
    assert len(w) == 1 and "post" not in w[0].tree and "low" in w[0].tree


def test_union_holds_every_tree():
    import itertools

    def tree(page):
        return skeleton(slots(parse(page)))

    pages = ["<div><p>1</div><ul><li>2</ul>", "<ul><li>1</ul><div><h2>2</h2></div>", "<table><tr><td>1</table><div><p>1<h2>2</h2></div>", "<section>1</section>", ""]
    for order in itertools.permutations(pages):
        whole = tree(order[0])
        for x in order[1:]:
            whole = union(whole, tree(x))
        for x in order:
            own = slots(parse(x))
            assert match(own, numbered(whole)[0]) == numbered(skeleton(own))[1]


def test_words_of_class_names_and_content_elements_drop_nothing():
    names = ["social-impact", "share-price", "related-work", "navy", "promontory", "alert-level", "notice", "toc", "my-comments-on-x"]
    page = "".join(f"<div class='{x}'><p>about {x}</p></div>" for x in names) + "<div id=toc-2><p>part 2</p></div>"
    want = "\n".join([f"about {x}" for x in names] + ["part 2"])
    assert extract(f"<article>{page}</article>") == want and extract(page) == want
    assert extract('<article><div class="text sidebar">no</div><div id="Comments">no</div><p>yes</p></article>') == "yes"
    assert (extract("<article><p>so <math><mi>x</mi>=<mn>2</mn></math> and <label>name</label> <svg><text>drawn</text></svg> <object>kept</object></p>"
                    "<menu><li>cut</menu></article>") == "so x=2 and name drawn kept\ncut")
    assert extract("<article><header><h1>Head</h1><p>Standfirst.</p><ul><li>Point</ul>by us</header><p>Text</p></article>") == "Head\nStandfirst.\nPoint\nText"
    assert extract("<div><p>See <a href=1>the long list of all our papers</a></p><p><a href=2>One paper</a></p><p><a href=3>a</a> | <a href=4>b</a></p></div>") == \
        "See the long list of all our papers\nOne paper"


def test_class_words_go_with_the_template(spark):
    rows = [(i, "http://h.example.com/", f"<article><header><h1>Head {i}</h1>by author {i}</header><div class=share-box><p>Share this</p></div>"
                                         f"<div class=share-price><p>Price {i}</p></div></article>") for i in range(5)]
    got = html_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {f"Head {i}\nby author {i}\nPrice {i}" for i in range(5)}


def test_slots_find_the_advert_without_names(spark, sf01):
    """With a class that no list knows the result on the table is the same: the advert's slot falls by what it holds."""
    pages = spark.read.parquet(sf01.replace("sf0.01", "sf0.1") + "/pages.parquet")
    want = {(r.page_id, r.url): r.text for r in html_text(pages).collect()}
    # the class that the list knows gets a name that nobody knows
    from pyspark.sql import functions as F
    renamed = pages.withColumn("html", F.regexp_replace("html", 'class="ad"', 'class="zq7"'))
    assert renamed.where(F.col("html").contains("zq7")).count() == 2500
    got = {(r.page_id, r.url): r.text for r in html_text(renamed).collect()}
    differ = [k for k in want if want[k] != got[k]]
    assert not differ, (len(differ), differ[:3], want[differ[0]][:200], got[differ[0]][:200])


def plain_wrapper(pages):
    """A wrapper by definition for hosts of one layout: texts at (path of labels, place among the path's texts) that most pages share
    are constant; a path outside the longest top block that never holds 300 characters, and little of the page's, is an aside."""
    from collections import Counter, defaultdict
    found = []
    for page in pages:
        out, count = [], Counter()

        def walk(node, path, top):
            path += "/" + node.label
            for x in node.items:
                if isinstance(x, str):
                    t = " ".join(x.split())
                    if t:
                        out.append((path, top, t))
                elif not x.dropped:
                    walk(x, path, top or (x.label if node.tag == "body" else ""))
        walk(parse(page), "", "")
        found.append(out)
    seen = Counter(k for out in found for k in {(p, t) for p, _, t in out})
    size, longest, total = Counter(), Counter(), defaultdict(int)
    for out in found:
        for p, top, t in out:
            if 2 * seen[(p, t)] < len(pages):
                size[p, top] += len(t)
                longest[p] = max(longest[p], len(t))
                total[top] += len(t)
    main = max(total, key=total.get)
    aside = {p for (p, top), n in size.items() if top != main and longest[p] < 300 and n <= 0.2 * total[main]}
    return ["\n".join(t for p, _, t in out if 2 * seen[(p, t)] < len(pages) and p not in aside) for out in found]


def test_three_hosts_equal_a_plain_wrapper(spark):
    import random
    rng = random.Random(3)
    w = lambda n: " ".join(rng.choice("lorem ipsum dolor sit amet elit sed do tempor".split()) + str(rng.randint(0, 99)) for _ in range(n))
    rows, want = [], {}
    for host, make in enumerate((
            lambda i: f"<body><div class=q><p>Home of things</p></div><div class=z9>{w(5)}</div><article><h1>{w(4)}</h1><p>{w(40)}</p><p>{w(50)}</p></article><div><p>All rights reserved</p></div></body>",
            lambda i: f"<body><div class=text><h2>{w(4)}</h2><p>{w(60)}</p><p>{w(30)}</p></div><section class=x1><p>{w(6)}</p></section><div class=low><p>Imprint and contact</p></div></body>",
            lambda i: f"<body><ul class=k><li>Start</li><li>Top</li></ul><div class=body><p>{w(80)}</p><div class=more><p>{w(70)}</p></div></div><div class=r><p>{w(3)}</p><p>{w(4)}</p></div></body>")):
        pages = [make(i) for i in range(8)]
        for i, (page, text) in enumerate(zip(pages, plain_wrapper(pages))):
            rows.append((100 * host + i, f"http://h{host}.example.org/{i}", page))
            want[100 * host + i] = text
    got = {r.page_id: r.text for r in html_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want and all(len(t) > 100 for t in got.values())


def test_constant_heading_between_varying_blocks_stays(spark):
    rows = [(i, f"http://s.example.com/{i}", f"<body><article><h1>Story {i}</h1><p>First {i}.</p><h2>Summary</h2><p>Second {i}.</p><p>Tell your friends</p></article></body>")
            for i in range(6)]
    got = {r.page_id: r.text for r in html_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"Story {i}\nFirst {i}.\nSummary\nSecond {i}." for i in range(6)}
