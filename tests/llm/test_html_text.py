import random
import tracemalloc

import pytest

from schoolzones.llm import html_text
from schoolzones.llm.html_text import Folded, _align, fold, match, pack, tree, unpack

NAV = '<nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>'
PAGE = (
    "<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{margin:0}</style><script>var a='</p>';</script></head><body>"
    + NAV
    + '<div class="cookie-notice">We use cookies</div><aside>side</aside>INNER'
    '<div class="comments"><p>a reader says</p></div><footer>&copy; me</footer></body></html>'
)


def text(html):
    return html_text.extract(tree(html), set())


CASES = [
    ("<article><h1>Head</h1><p>One  \n two</p><p>Three &amp; four &lt;b&gt; &#233;</article>", "Head\n\nOne two\n\nThree & four <b> é"),
    ("<article><p><b>bold<br><p>next <i>in</i>line</p></article>", "bold\n\nnext inline"),
    ("<main><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></main>", "a\n\nb\n\nc\n\nd"),
    ("<article>bare <!-- ad --> text<div>in</div>tail</article>", "bare text\n\nin\n\ntail"),
    ("<article><p>x</p><form><p>mail</p></form><div class='ad'>buy</div><p>y</p></article>", "x\n\ny"),
    ("<article><p>a<script>var x='<p>no</p>'</script>b</p></article>", "ab"),
    ("<article><p>cut &am", "cut &am"),
    ("<article></article>", ""),
    ("<div><p>no article</p></div>", "no article"),
    ("<header><p>site</p></header><p>text</p>", "text"),
    ("<article><header class='entry-header'><h1 class='header'>Head</h1></header><p>x</p></article>", "Head\n\nx"),
    ("<main><p>before</p><article><p>x</p></article></main>", "x"),
    ("<main><p>x</p><div class='share'>no</div></main>", "x"),
    ("<div id='page' class='with-sidebar'><article><p>x</p></article></div>", "x"),
    ("<div class='related'><article><p>other</p></article></div><article><p>x</p></article>", "x"),
    ("<article><p>x</p><article class='comment'><p>reader</p></article></article>", "x"),
    ("<div class='post-body'><p>one</p></div><section id='sidebar'>no</section>", "one"),
]


@pytest.mark.parametrize("inner,want", CASES)
def test_extraction(inner, want):
    assert text(PAGE.replace("INNER", inner)) == want


def test_odd_pages():
    assert text("") == "" and text(None) == ""
    assert text("plain &amp; simple") == "plain & simple"
    assert text("</div></p>x<p>y") == "x\n\ny"
    assert text("<p>" * 3000 + "deep") == "deep"
    assert text("<div>" * 3000 + "deep") == "deep"
    assert len(text("<article><p>" + "w " * 500_000)) == 999_999


def random_tree(rnd, n):
    nodes = [Folded("r", 0, [], [])]
    for _ in range(n):
        node = Folded(rnd.choice("abc"), rnd.randint(0, 2), [], [])
        rnd.choice(nodes).children.append(node)
        nodes.append(node)
    return nodes[0]


def brute_size(x, y):
    """Simple tree matching by its recursive definition."""
    if x.label != y.label:
        return 0

    def best(a, b):
        if not a or not b:
            return 0
        return max(best(a[1:], b), best(a, b[1:]), (brute_size(a[0], b[0]) or -99) + best(a[1:], b[1:]))

    return 1 + best(x.children, y.children)


def test_match_is_the_largest():
    rnd = random.Random(1)
    for _ in range(60):
        a, b = random_tree(rnd, rnd.randint(0, 9)), random_tree(rnd, rnd.randint(0, 9))
        pairs = match(a, b)
        assert len(pairs) == brute_size(a, b)
        assert all(x.label == y.label for x, y in pairs)
        assert len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs}) == len(pairs)


def test_pack_round_trip():
    rnd = random.Random(2)
    for _ in range(20):
        a = random_tree(rnd, 12)
        assert pack(unpack(pack(a))) == pack(a)
    assert pack(unpack(pack(fold(tree(PAGE.replace("INNER", CASES[0][0])))))).startswith("#page")


def test_wrapper_learns_what_recurs(spark):
    """Parts without any telling name: constant ones fall away on hosts with enough different pages."""
    page = "<body><div>Menu of this site</div><div><p>{0}</p><p>{0} more</p></div><div>Call us now</div></body>"
    rows = [(i, f"https://big.example/{i}?x", page.format(f"story {i}")) for i in range(30)]
    rows += [(100 + i, f"http://BIG.example:80/{i}", page.format("a copy")) for i in range(40)]
    rows += [(200, "https://lone.example/", page.format("alone"))]
    rows += [(300, None, page.format("nowhere")), (301, "odd", ""), (302, "https://big.example/z", None)]
    df = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, html string, host string")
    out = html_text.main_text(df)
    assert out.columns == ["page_id", "url", "text"]
    got = {r["page_id"]: r["text"] for r in out.collect()}
    assert len(got) == len(rows)
    assert all(got[i] == f"story {i}\n\nstory {i} more" for i in range(30))
    assert all(got[100 + i] == "a copy\n\na copy more" for i in range(40))
    assert got[200] == "Menu of this site\n\nalone\n\nalone more\n\nCall us now"
    assert got[301] == got[302] == ""
    assert html_text.main_text(df.limit(0)).count() == 0


def test_like_neighbours_recur_only_together(spark):
    """Where nothing marks the article, an item met on all pages stays in a list that varies; a list that recurs goes."""
    page = "<body><ul><li>Home</li><li>News</li></ul><div><ul><li>Salt</li><li>{0} eggs</li></ul></div></body>"
    df = spark.createDataFrame(
        [(i, f"https://h.example/{i}", page.format(i)) for i in range(20)], "page_id long, url string, html string"
    )
    got = {r["page_id"]: r["text"] for r in html_text.main_text(df).collect()}
    assert got == {i: f"Salt\n\n{i} eggs" for i in range(20)}


def test_article_stays_though_it_recurs(spark):
    page = "<body><div>Menu</div><article><p>Always the same</p></article><div>{}</div></body>"
    df = spark.createDataFrame(
        [(i, "https://h.example/", page.format(i)) for i in range(9)] * 2, "page_id long, url string, html string"
    )
    assert {r["text"] for r in html_text.main_text(df).collect()} == {"Always the same"}


def test_recurring_blocks_inside_articles_go(spark):
    page = (
        "<body><main><p>Part {0}</p><p>Our paper</p><article><h1>Head {0}</h1>{1}<p>Subscribe to <b>us</b></p><p>end {0}</p>"
        "Share this<div>All rights reserved</div></article></main></body>"
    )
    html = [page.format(i, "".join(f"<p>story {i}.{k}</p>" for k in range(i % 4))) for i in range(12)]
    rows = [(i, "https://h.example/", h) for i, h in enumerate(html)] + [(99, "https://few.example/", html[1])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"].split("\n\n") for r in html_text.main_text(df).collect()}
    for i in range(12):
        assert got[i] == [f"Part {i}", f"Head {i}", *(f"story {i}.{k}" for k in range(i % 4)), f"end {i}"]
    assert got[99] == ["Head 1", "story 1.0", "Subscribe to us", "end 1", "Share this", "All rights reserved"]


def test_first_page_of_a_host_is_odd(spark):
    """Neither an empty or null page nor one of a rare layout with the least page_id keeps a host from being learned."""
    page = "<body><div>Menu of this site</div><div><p>{0}</p><p>{0} more</p></div><section>Call us now</section></body>"
    odd = {"empty": "", "null": None, "error": "<body><table><tr><td>Not found</table></body>"}
    rows = [(None if host == "null" else 0, f"https://{host}.example/", html) for host, html in odd.items()]
    rows += [(1 + i, f"https://{host}.example/{i}", page.format(f"story {i}")) for host in odd for i in range(30)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = html_text.main_text(df).where("page_id > 0").collect()
    assert len(got) == 90
    assert all(r["text"] == f"story {r['page_id'] - 1}\n\nstory {r['page_id'] - 1} more" for r in got)


def test_deep_pages(spark):
    html = ["<div>" * 3000 + f"deep {i}" for i in range(4)] + ["<div><p>flat</p></div>"]
    rows = [(i, "https://deep.example/", h) for i, h in enumerate(html)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.main_text(df).collect()}
    assert got == {0: "deep 0", 1: "deep 1", 2: "deep 2", 3: "deep 3", 4: "flat"}
    top = fold(tree(html[0]))
    assert len(match(top, fold(tree(html[1])))) == 3001


def test_many_siblings_take_little_memory():
    rnd = random.Random(3)
    kinds = ["a", "a", "b", "c"]

    def page(n):
        rows = [Folded(rnd.choice(kinds), 0, [Folded("x", 0, [], []) for _ in range(rnd.randint(0, 2))], []) for _ in range(n)]
        return Folded("r", 0, rows, [])

    a, b = page(20_000), page(20_000)
    tracemalloc.start()
    pairs = match(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300_000_000
    place = [{id(c): k for k, c in enumerate(t.children)} for t in (a, b)]
    at = sorted((place[0][id(x)], place[1][id(y)]) for x, y in pairs if id(x) in place[0])
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(at, at[1:])) and len(at) > 12_000


def test_large_and_small_tables_agree():
    """Tables past the size that numpy takes over hold the weight that the definition gives."""
    rnd = random.Random(4)
    for _ in range(5):
        size = {(x, y): rnd.choice([0, 1, 3]) for x in range(4) for y in range(4)}
        left, right = [rnd.randrange(4) for _ in range(45)], [rnd.randrange(4) for _ in range(40)]
        last = [0] * 41
        for x in left:
            row = [0]
            for j, y in enumerate(right):
                row.append(max(row[j], last[j + 1], last[j] + size[x, y] if size[x, y] else 0))
            last = row
        total, rows = _align(left, right, size)
        assert total == last[-1] and len(rows) == 45
        i, j, weight = 45, 40, 0
        while i and j:
            if rows[i - 1][0][(j - 1) // 8] >> (j - 1) % 8 & 1:
                i -= 1
            elif rows[i - 1][1][(j - 1) // 8] >> (j - 1) % 8 & 1:
                j -= 1
            else:
                i, j = i - 1, j - 1
                weight += size[left[i], right[j]]
        assert weight == total


def test_recurring_headings_stay_before_what_varies(spark):
    page = (
        "<body><article><h1>Introduction</h1><p>Own {0}</p><h2>Facts</h2><table><tr><th>Weight<td>{0} kg<tr><th>Size<td>{0} m"
        "</table><h2>Newsletter</h2><p>Get our mail</p><h3>Results</h3><h4>First</h4><p>More {0}</p><h2>Rights</h2>"
        "<p>All reserved</p></article></body>"
    )
    rows = [(i, "https://h.example/", page.format(i)) for i in range(5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in html_text.main_text(df).collect():
        i = r["page_id"]
        want = ["Introduction", f"Own {i}", "Facts", "Weight", f"{i} kg", "Size", f"{i} m", "Results", "First", f"More {i}"]
        assert r["text"].split("\n\n") == want


def brute_texts(rows):
    """Learning and extraction page by page in plain Python; ``rows``: (page_id, host, html)."""
    texts = {}
    for host in {h for _, h, _ in rows}:
        pages = sorted((i, html) for i, h, html in rows if h == host)
        outlines = {}
        for i, html in pages:
            outlines.setdefault(pack(fold(tree(html))), html)
        enough = len(outlines) >= html_text.LEAST_PAGES
        often = lambda n: n >= html_text.CONSTANT_SHARE * len(outlines)
        trees = {o: fold(tree(html)) for o, html in outlines.items()}
        leaves = {o: set(html_text.leaf_keys(t)) for o, t in trees.items()}
        shared = {k for ks in leaves.values() for k in ks if often(sum(k in other for other in leaves.values()))}
        first = min(outlines, key=lambda o: (-len(leaves[o] & shared), min(i for i, h in pages if pack(fold(tree(h))) == o)))
        same = {}
        for t in trees.values():
            for x, y in match(unpack(first), t):
                same[x.number] = same.get(x.number, 0) + (not x.children and not y.children and x.text == y.text)
        recurring = {}
        for o, html in outlines.items():
            top = tree(html)
            for key in {b[0] for b in html_text._blocks(top, set(), True)} if html_text._content(top) else ():
                recurring[key] = recurring.get(key, 0) + 1
        for i, html in pages:
            top, template = tree(html), set()
            if enough:
                for x, y in match(unpack(first), fold(top)):
                    if x.number > 0 and often(same[x.number]) and x.text == y.text and not y.children and not y.nodes[0].main:
                        template.update(map(id, y.nodes))
            constant = {k for k, n in recurring.items() if often(n)} if enough and html_text._content(top) else None
            texts[i] = html_text.extract(top, template, constant)
    return texts


def test_learning_equals_brute_force(spark):
    """Random hosts, with and without articles; parts come in any order, recur or vary, and some are missing."""
    rnd = random.Random(5)
    rows = []
    for h in range(12):
        fixed = [f"<{t}>Fixed {k} of {h}</{t}>" for k, t in enumerate(["div", "p", "h2", "section"])]
        shell = rnd.choice(["<body>{}</body>", "<body>{}<article>{}</article></body>", "<main>{}<article>{}</article></main>"])
        for i in range(rnd.choice([1, 2, 6, 14])):
            def part():
                own = [f"<{t}>Own {rnd.randint(0, 99)} {k}</{t}>" for k, t in enumerate(["div", "p", "h3"]) if rnd.random() < 0.8]
                there = [x for x in fixed if rnd.random() < 0.97]
                at = rnd.randint(0, len(there)) if rnd.random() < 0.2 else 2
                return "".join(there[:at] + own + there[at:])

            rows.append((len(rows), f"h{h}.example", shell.format(part(), part())))
    df = spark.createDataFrame([(i, f"https://{h}/", html) for i, h, html in rows], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.main_text(df).collect()}
    want = brute_texts(rows)
    assert got == want
    assert any("Fixed" in t for t in want.values()) and any("Fixed" not in t for t in want.values())


def stories(i):
    return "".join(f"<p>story {i}.{k}</p>" for k in range(1 + i % 4))


#: Pages without an article, and what is left of them: {0} is the page's number, {1} its one to four paragraphs.
LAYOUTS = [
    ("<p>Menu</p>{1}<p>Share this</p><p>Imprint</p>", "{1}"),
    ("<font><div>Menu</div><div>{1}</div><div>Call us</div></font>", "{1}"),
    ("<a href=x><span><div>Menu</div></span></a><div>{1}</div>", "{1}"),
    ("Menu of <i>this</i> site<div>{1}</div>Call us", "{1}"),
    ("<b>own {0}</b><div>Menu</div>", "own {0}"),
    ("<div>Menu<script>t({0})</script></div><p>Now<button>x{0}</button></p><div>{1}</div>", "{1}"),
    ("<table><tr><td>Menu</td></tr><tr><td>{1}</td></tr><tr><td>Imprint</td></tr></table>", "{1}"),
    ("<table><tr><td><div>Home</div><div>News</div><td>{1}<p>more {0}</p></table>", "{1}|more {0}"),
    ("<div>Menu</div><table><tr><th>Name<th>Price<tr><td>Salt<td>{0} cent<tr><td>Oil<td>9</table>", "Name|Price|Salt|{0} cent|Oil|9"),
    ("<table><tr><td>Name<td>Price</table><table><tr><td>Salt<td>{0} cent</table>", "Salt|{0} cent"),
    ("<ul><li><p>Salt<li><p>{0} eggs</ul><ol><li><p>Home<li><p>News</ol>", "Salt|{0} eggs"),
    ("<ul><li>{1}<div>Share<ul><li>Mail<li>Print</ul></div><li>Notes<ul><li>One<li>Two</ul></ul>", "{1}|Notes|One|Two"),
    ("<dl><dt>Needs<dd>Salt<dd>{0} eggs</dl>", "Salt|{0} eggs"),
]


def test_every_text_of_a_page_is_judged(spark):
    """Wherever it stands: among paragraphs, in inline elements, beside blocks or noise, in cells and in list items."""
    rows, want = [], {}
    for k, (page, left) in enumerate(LAYOUTS):
        for i in range(12):
            rows.append((100 * k + i, f"https://h{k}.example/", "<body>" + page.format(i, stories(i)) + "</body>"))
            own = "|".join(f"story {i}.{n}" for n in range(1 + i % 4))
            want[100 * k + i] = left.format(i, own).split("|")
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"].split("\n\n") for r in html_text.main_text(df).collect()} == want


def random_page(rnd, unique, depth=0):
    tags = "div p section ul li table tr td th dl dt dd h2 article main a b span font nav script br center".split()
    out = []
    for _ in range(rnd.randint(0, 4) if depth else 6):
        if depth > 5 or rnd.random() < 0.4:
            out.append(f" w{next(unique)} ")
        else:
            tag = rnd.choice(tags)
            named = rnd.choice(["", "", "", " class=share", " class=main"])
            out.append(f"<{tag}{named}>{random_page(rnd, unique, depth + 1)}" + f"</{tag}>" * (rnd.random() < 0.8))
    return "".join(out)


def test_every_text_is_a_leaf():
    """Nothing that can be text is missing in the outline, below articles neither; with all leaves gone no text is left."""
    rnd = random.Random(6)
    inside = 0
    for _ in range(400):
        top = tree(random_page(rnd, iter(range(10**6))))
        leaves, stack = [], [fold(top)]
        while stack:
            x = stack.pop()
            stack.extend(x.children)
            if not (x.children or x.label.endswith("!")):
                leaves.append(x)
        texts = [block[1] for block in html_text._blocks(top, set(), True)]
        hashes = [x.text for x in leaves if x.text]
        assert len(hashes) == len(set(hashes)) and {html_text.crc32(t.encode()) for t in texts} <= set(hashes)
        if html_text._content(top):
            inside += len(texts) > 1
        else:
            assert html_text.extract(top, {id(x.nodes[0]) for x in leaves}) == ""
    assert inside > 50


def test_matching_goes_into_articles():
    page = "<body><div>Menu</div><main><div><article><h1>{0}</h1><p>own {0}</p><p>Share</p>{1}</article></div></main></body>"
    a, b = (fold(tree(page.format(i, stories(i)))) for i in (1, 2))
    equal = {y.nodes[0].items[0].items[0] for x, y in match(a, b) if x.text == y.text and not x.children}
    assert equal == {"Menu", "Share"}
    # Such a node is template as a recurring block is, and articles in which nothing else is stay whole.
    top = tree(page.format(1, stories(1)))
    share = {id(y.nodes[0]) for x, y in match(a, fold(top)) if y.nodes[0].tag == "p" and x.text == html_text.crc32(b"Share")}
    assert len(share) == 1
    assert html_text.extract(top, share, set()) == "1\n\nown 1\n\nstory 1.0\n\nstory 1.1"


def test_largest_pairing_with_most_equal_texts():
    """Against every pairing of two lists: as many as can be, and of those one with the most equal texts."""
    rnd = random.Random(7)

    def best(a, b):
        if not a or not b:
            return 0, 0
        with_both = best(a[1:], b[1:])
        return max(best(a[1:], b), best(a, b[1:]), (with_both[0] + 1, with_both[1] + (a[0] == b[0])) if a[0][0] == b[0][0] else (0, 0))

    for _ in range(200):
        a, b = ([(rnd.choice("ppph"), rnd.randint(1, 4)) for _ in range(rnd.randint(0, 6))] for _ in range(2))
        pairs = match(*(Folded("r", 0, [Folded(tag, text, [], []) for tag, text in z], []) for z in (a, b)))[1:]
        assert all(x.label == y.label for x, y in pairs)
        assert (len(pairs), sum(x.text == y.text for x, y in pairs)) == best(a, b)


def test_long_lists_pair_as_heavily_as_full_tables():
    """Lists that differ little and much, near the diagonal and far from it."""
    rnd = random.Random(8)
    for n in range(60):
        size = {(x, y): 100 if x == y else rnd.choice([0, 100]) for x in range(3) for y in range(3)}
        left = [rnd.randrange(3) for _ in range(rnd.randint(40, 120))]
        right = list(left) if n % 2 else [rnd.randrange(3) for _ in range(rnd.randint(40, 120))]
        for _ in range(rnd.randint(0, 40) if n % 2 else 0):
            right.insert(rnd.randint(0, len(right)), rnd.randrange(3))
        same = [[10 * x + rnd.randrange(9) for x in z] for z in (left, right)]
        more = *same, [1 + x % 2 for x in same[0]]
        last = [0] * (len(right) + 1)
        for i, x in enumerate(left):
            row = [0]
            for j, y in enumerate(right):
                weight = size[x, y] + (more[2][i] if same[0][i] == same[1][j] else 0)
                row.append(max(row[j], last[j + 1], last[j] + weight if weight else 0))
            last = row
        total, rows = _align(left, right, size, more)
        assert total == last[-1]
        i, j, weight = len(left), len(right), 0
        while i and j:
            if rows[i - 1][0][(j - 1) // 8] >> (j - 1) % 8 & 1:
                i -= 1
            elif rows[i - 1][1][(j - 1) // 8] >> (j - 1) % 8 & 1:
                j -= 1
            else:
                i, j = i - 1, j - 1
                weight += size[left[i], right[j]] + (more[2][i] if same[0][i] == same[1][j] else 0)
        assert weight == total


def test_long_pages_of_paragraphs():
    """20,000 paragraphs beside some fewer: those that recur meet themselves."""
    rnd = random.Random(9)

    def page(n):
        return fold(tree("<p>Menu</p>" + "".join(f"<p>{rnd.random()}</p>" for _ in range(n)) + "<p>Share</p><p>End</p><p>Imprint</p>"))

    a, b = page(20_000), page(19_900)
    equal = [y.nodes[0].items[0].items[0] for x, y in match(a, b) if x.text == y.text and not x.children]
    assert sorted(equal) == ["End", "Imprint", "Menu", "Share"]


def test_rows_end_before_the_next():
    assert text("<table><tr class=ad><td>buy<tr><td>a<td>b<tr><td>c</table>") == "a\n\nb\n\nc"
