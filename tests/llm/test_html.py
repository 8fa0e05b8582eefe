import random

from changeloom.llm import html

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></ul></nav><div class="cookie-notice">We use cookies, ok?</div>
<article><h1>Head &amp; line</h1><p>First   <b>bold</b> text, with commas, and more words here.<p>Second one.<div class="ad">Buy now, today!</div>
<ul><li>one<li>two</ul><form><input><p>Your mail</p></form></article>
<section id="comments"><p>I disagree, strongly, with all of this long text, really, every word.</p></section><aside>More</aside><footer>&copy; us</footer></body></html>"""


def test_page_parts():
    assert html.extract(PAGE) == "Head & line\n\nFirst bold text, with commas, and more words here.\n\nSecond one.\n\none\n\ntwo"


def test_without_article_the_ratios_find_the_container():
    body = "".join(f"<p>Sentence number {i}, which is long enough, has commas, and goes on.</p>" for i in range(8))
    page = f"<body><div id=top><div><a href=#>Home</a></div><div><a href=#>About</a></div></div><div class=c><h2>Short</h2>{body}<p>End.</p></div><div>x</div></body>"
    got = html.extract(page).split("\n\n")
    assert got[0] == "Short" and got[-1] == "End." and len(got) == 10


def test_without_article_the_headline_stays_and_a_smaller_container_goes():
    said = lambda k, n: [f"Sentence number {i} of part {k}, which is long enough, has commas, and goes on." for i in range(n)]
    div = lambda name, texts: f"<div class={name}>" + "".join(f"<p>{t}</p>" for t in texts) + "</div>"
    a, b = said("one", 9), said("two", 3)
    menu = "<div id=top><div><a href=#>Home</a></div><div><a href=#>About</a></div></div>"
    for name in ("comments", "more"):  # no name decides
        page = f"<body>{menu}<h1>Head line</h1>{div('content', a)}{div(name, b)}<div>x</div><footer>us</footer></body>"
        assert html.extract(page).split("\n\n") == ["Head line", *a]
    page = f"<body>{menu}<h1>Head line</h1>{div('part', a)}{div('part', b)}<div>x</div></body>"  # one path
    assert html.extract(page).split("\n\n") == ["Head line", *a, *b]
    nested = f"<body>{menu}<article><h1>Head line</h1><p>{b[0]}</p><div>x</div>{div('content', a)}</article></body>"
    assert html.extract(nested).split("\n\n") == ["Head line", b[0], *a]


def test_odd_pages(spark):
    pages = [None, "", "plain <b>a</b>&lt;c", "<nav>only menu</nav>", "<p>unclosed", "<" * 50, "<div>" * 3000 + "deep text", "a\x00b", "<p>" + "word, " * 50_000]
    rows = spark.createDataFrame(list(enumerate(pages)) * 2, "page_id long, html string").selectExpr("*", "'u' as text")
    out = {r.page_id: r for r in html.main_text(rows).collect()}
    assert out[0].text == out[1].text == out[3].text == "" and out[2].text == "plain a<c" and out[4].text == "unclosed" and out[6].text == "deep text"
    assert out[8].n_chars == len(out[8].text) == len(("word, " * 50_000).strip())
    assert html.main_text(rows.limit(0)).count() == 0


def brute(page):
    """The text of a well-formed page, from lists of whole paths: every rule spelled out over all nodes, no shared state."""
    from html.parser import HTMLParser

    texts = []

    class Reader(HTMLParser):
        stack, count = [], 0

        def handle_starttag(self, tag, attrs):
            self.count += tag in html.BLOCK
            self.stack = [*self.stack, (tag, dict(attrs).get("class", ""), self.count if tag in html.BLOCK else None)]

        def handle_endtag(self, tag):
            self.count += tag in html.BLOCK
            self.stack = self.stack[:-1]

        def handle_data(self, data):
            texts.append((tuple(self.stack), self.count, data))

    Reader().feed(page)
    name = lambda way: "/".join(f"{t}.{c}" for t, c, _ in way)
    cut = lambda way: way[: max(i for i, (t, _, _) in enumerate(way) if t in html.BLOCK) + 1]  # noqa: E731  up to the block element
    link = lambda way: any(t == "a" for t, *_ in way)
    said = [(w, b, d.strip()) for w, b, d in texts if d.strip() and not any(t in html.BOILERPLATE for t, *_ in w)]
    if not said:
        return ""

    def fused(of, way, power):
        mine = [(b, d) for w, b, d in said if of(w) == way and not link(w)]
        return sum(len(d) for _, d in mine) * (1 + sum(d.count(c) for _, d in mine for c in ",.;:!?")) * len({b for b, _ in mine}) ** power

    block, within = (lambda w: name(cut(w))), (lambda w: name(cut(w)[:-1]))
    top = max(fused(within, within(w), 4) for w, *_ in said)
    strong = lambda w: fused(block, block(w), 0) >= html.SHARE * max(fused(block, block(x), 0) for x, *_ in said if within(x) == within(w))
    good = {block(w) for w, *_ in said if not link(w) and top and strong(w) and fused(within, within(w), 4) >= html.SHARE * top}
    content = [(w, b) for w, b, _ in said if not link(w) and name(cut(w)) in good] or [(w, b) for w, b, _ in said]
    above = {w[:k] for w, _ in content for k in range(len(cut(w)))}

    def holder(w):
        w = cut(w)[:-1]
        while w and w[-1][0] in html.HOLDERS:
            w = w[:-1]
        return w

    order = list(dict.fromkeys(b for _, b, _ in said))
    kept = {b for _, b in content}
    for b in order:
        own = [w for w, x, _ in said if x == b]
        tag, inside = cut(own[0])[-1][0], content[0][1] < b < content[-1][1]
        if holder(own[0]) in above and (tag in html.ITEMS and (inside or not all(map(link, own))) or tag in html.BETWEEN and inside):
            kept.add(b)
    for k, b in reversed(list(enumerate(order))):
        way = cut(next(w for w, x, _ in said if x == b))
        after = next((x for x in order[k + 1 :] if cut(next(w for w, y, _ in said if y == x))[-1][0] not in html.HEADINGS), None)
        if way[-1][0] in html.HEADINGS and after in kept and (way[-1][0] == "h1" or holder(way) in above):
            kept.add(b)
    out = {}
    for w, b, d in texts:
        if b in kept and not any(t in html.BOILERPLATE for t, *_ in w):
            out[b] = out.get(b, "") + d
    return "\n\n".join(t for b in out if (t := " ".join(out[b].split())))


def test_random_pages_equal_brute_force(monkeypatch):
    rnd, differs = random.Random(8), 0
    word = lambda: rnd.choice(["one", "two,", "three.", "four", "five;"])

    def inline(n):
        s = " ".join(word() for _ in range(rnd.randint(1, n)))
        return rnd.choice([s, s, f"{s} <b>{word()}</b> {s}", f"<b>{s}</b>", f"<a href=x>{s}</a>", f"{s} <a href=x>{word()}</a>"])

    def part(depth):
        kind = rnd.choice(["p", "p", "p", "ul", "h2", "div", "div", "nav", "blockquote"])
        if kind == "ul":
            return "<ul>" + "".join(f"<li>{inline(4)}</li>" for _ in range(3)) + "</ul>"
        if kind in ("div", "nav") and depth:
            return f'<{kind} class="{rnd.choice(["a", "b", "ad-box", "comments", "text"])}">' + "".join(part(depth - 1) for _ in range(rnd.randint(1, 4))) + f"</{kind}>"
        return f"<{kind}>{inline(rnd.choice((3, 40)))}</{kind}>"

    for _ in range(300):
        page = "<html><body>" + rnd.choice(["", "<h1>Head</h1>"]) + "".join(part(3) for _ in range(rnd.randint(1, 6))) + "</body></html>"
        assert html.extract(page) == brute(page), page
    pages = ["<body><h1>Head</h1>" + "".join(part(3) for _ in range(6)) + "</body>" for _ in range(100)]
    with_ratios = [html.extract(p) for p in pages]
    monkeypatch.setattr(html, "path_ratios", lambda said: {node.path: 1.0 for node, *_ in said})
    assert sum(html.extract(p) != t for p, t in zip(pages, with_ratios)) > 30  # the ratios decide


def test_names_of_classes_decide_nothing():
    said = [f"Sentence number {i}, which is long enough, has commas, and goes on for a while." for i in range(6)]
    page = '<body><div class="c">Menu</div><div class="related privacy-notice comments"><h1>Head line</h1>' + "".join(f"<p class=ad>{s}</p>" for s in said) + "</div><div>x</div></body>"
    assert html.extract(page).split("\n\n") == ["Head line", *said]
    page = "<body><div class=z><p>" + "</p><p>".join(said) + "</p></div><div class=comments><p>" + "</p><p>".join(said[:3]) + "</p></div></body>"
    assert html.extract(page).split("\n\n") == said
    page = "<main><header><h1>Own header</h1></header><p>" + said[0] + "</p><div hidden><p>" + said[1] + "</p></div></main><header><h1>Site</h1></header>"
    assert html.extract(page).split("\n\n") == ["Own header", said[0]]
