from __future__ import annotations

import random

import numpy as np

from tripmill.llm import html

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body><header>Head</header>
<nav><ul><li>a<li>b</ul></nav><div class="ad">Ad</div><main><h1>One &amp; two</h1><p>A <b>b</b>old
word<br>new &eacute;&#8364;<p>next<div class="cookie-notice">C</div><form>f</form><ul><li>x<li>y</ul>
<article class="comment">said</article></main><aside>S</aside><!-- <p>hidden --><section id="comments"><p>bad</section><footer>F"""


def test_markup():
    assert html.blocks_of(PAGE) == [(True, t) for t in ("One & two", "A bold word new é€", "next", "x", "y")]
    assert html.blocks_of("") == [] and html.blocks_of("<p>1 < 2 &amp <b") == [(False, "1 < 2 &")]
    assert html.blocks_of("<article>a<article>reply</article>b</article>c") == [(True, "a"), (True, "b"), (False, "c")]


def test_suffix_array_and_cover_against_brute_force():
    draw = random.Random(1)
    for _ in range(40):
        n = draw.randrange(1, 80)
        ids = np.array([draw.randrange(3) if draw.random() < 0.95 else -i - 1 for i in range(n)])
        assert list(html.suffix_array(ids)) == sorted(range(n), key=lambda i: list(ids[i:]))
        page = np.sort([draw.randrange(4) for _ in range(n)])
        wanted = np.zeros(n, dtype=bool)
        for i in range(n - 3):
            piece = list(ids[i : i + 4])
            pages = {page[j] for j in range(n - 3) if list(ids[j : j + 4]) == piece}
            if min(piece) >= 0 and len(pages) >= 2:
                wanted[i : i + 4] = True
        assert list(html.covered(ids, page, 4, 2)) == list(wanted)


def test_repeated_passages_go_and_odd_rows_stay(spark):
    notice = "this site is not responsible for what others write here"
    rows = [(i, f"http://Host.example/{i}", f"<div>{notice}</div><p>own text number {i} of this page {'x' * i}</p>") for i in range(8)]
    rows += [(100, "https://host.example/a", f"<article>{notice}</article>"), (101, "http://other.example/", f"<p>{notice}</p>")]
    rows += [(None, None, None), (5, None, ""), (102, "x", "<p>" + "long " * 50_000), (102, "x", "<p>" + "long " * 50_000)]
    pages = spark.createDataFrame([(*r, "t", 1, []) for r in rows], "page_id long, url string, html string, text string, blocks int, open array<int>")
    got = sorted(map(tuple, html.main_text(pages).collect()), key=repr)
    wanted = [(i, f"http://Host.example/{i}", f"own text number {i} of this page {'x' * i}".strip()) for i in range(8)]
    wanted += [(100, "https://host.example/a", notice), (101, "http://other.example/", notice), (None, None, ""), (5, None, "")]
    wanted += [(102, "x", ("long " * 50_000).strip())] * 2
    assert got == sorted([(*w, len(w[2])) for w in wanted], key=repr)
    assert html.main_text(pages.limit(0)).count() == 0


def test_passages_are_counted_over_the_whole_host_and_copies_once(spark):
    notice = "this site is not responsible for what others write here"
    rows = [(i, f"http://a.example/{i}", f"<div>{notice}</div><p>own{i}</p>") for i in range(12)]
    rows += [(100 + i, "http://b.example/", "<p>a copied page that has more than six tokens</p>") for i in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.main_text(pages, group_pages=2).collect()}
    assert got == {i: f"own{i}" for i in range(12)} | {100 + i: "a copied page that has more than six tokens" for i in range(4)}


def page_rows(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def texts(pages, **settings):
    return {r["page_id"]: r["text"] for r in html.main_text(pages, **settings).collect()}


def test_the_suffix_array_decides_on_pages_with_articles(spark):
    teaser = "<article><h2>ten ways to paint a garden fence in spring</h2></article>"
    story = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(5)]
    notice = "all rights to these words are with their authors"
    rows = [(i, "http://a.example/", f"<article><p>{story[i]}</p></article>{teaser}") for i in range(4)]
    rows += [(4, "http://a.example/", f"<article>{story[4]}</article><article>a teaser on no other page</article>")]
    rows += [(10 + i, "http://b.example/", f"<article>{story[i]}</article><footer>{notice}</footer>") for i in range(2)]
    rows += [(12, "http://b.example/", f"<p>{notice}</p><p>{story[2]}</p>")]
    rows += [(20 + i, "http://c.example/", f"<div class='no-sidebar'><article>{story[i]}</article>{teaser}</div>") for i in range(3)]
    rows += [(30, "http://d.example/", f"<div class='no-sidebar'><div class='ad'>buy</div></div><article>{notice}</article>")]
    rows += [(31, "http://d.example/", "<div class='ad'>buy</div>")]
    wanted = {i: story[i] for i in range(4)} | {4: f"{story[4]}\na teaser on no other page", 10: story[0], 11: story[1], 12: story[2]}
    wanted |= {20 + i: story[i] for i in range(3)} | {30: notice, 31: ""}
    assert texts(page_rows(spark, rows)) == wanted == texts(page_rows(spark, rows), group_pages=1)


def test_articles_inside_main():
    page = "<main><h1>t</h1><article>story</article><article class='comment'>said</article><article>next<article>reply</article></article>end</main>"
    assert html.streams_of(page) == [("a", 1, "t"), ("a", 1, "story"), ("m", 3, "said"), ("a", 4, "next"), ("m", 5, "reply"), ("a", 1, "end")]
    menu = "<nav><ul><li>a<li>b</ul><p>c</nav><div class=ad>d<article>e</article>f</div>g"
    assert html.streams_of(menu) == [("m", 1, "a b c"), ("m", 2, "d"), ("n", 3, "e"), ("m", 2, "f"), ("o", 0, "g")]
    assert html.unpacked(html.packed(html.streams_of(menu))) == html.streams_of(menu) and html.unpacked(html.packed([])) == []


def test_suffix_array_of_ties_that_are_long():
    for ids in ([], [3], [5] * 300, [1, 2] * 100 + [1], list(range(9)) * 20, [-1, 7, 7, -4, 7, 7]):
        assert list(html.suffix_array(np.array(ids, dtype=np.int64))) == sorted(range(len(ids)), key=lambda i: ids[i:])


def test_extraction_against_brute_force(spark):
    draw = random.Random(7)
    words = [f"w{i}" for i in range(9)]
    pieces = [" ".join(draw.choice(words) for _ in range(draw.randrange(1, 9))) for _ in range(30)]
    marks = {"o": "<p>{}</p>", "m": "<footer>{}</footer>", "a": "<article>{}</article>"}
    rows, made = [], []
    for i in range(60):
        kinds = "om" if draw.random() < 0.7 else "ooma"
        blocks = [(kind, draw.choice(pieces)) for kind in (draw.choice("om") for _ in range(5))]
        if "a" in kinds:
            blocks.insert(draw.randrange(6), ("a", draw.choice(pieces)))
        # A page in eight is another page over again, with other marked text.
        blocks = [(k, t if k != "m" else draw.choice(pieces)) for k, t in draw.choice(made)[1]] if i % 8 == 7 else blocks
        made.append((f"h{i % 3}", blocks))
        rows.append((2**60 + i, f"http://h{i % 3}.example/", "".join(marks[kind].format(text) for kind, text in blocks)))
    rows.append((None, "http://h0.example/", ""))
    pages_of: dict = {}
    for host, blocks in made:
        content = tuple(text for kind, text in blocks if kind != "m")
        for kind, text in blocks:
            tokens = text.split()
            for j in range(len(tokens) - 2 if kind != "a" else 0):
                pages_of.setdefault((host, *tokens[j : j + 3]), set()).add(content)
    wanted: dict = {None: ""}
    for (i, _, _), (host, blocks) in zip(rows, made, strict=False):
        left = [text for kind, text in blocks if kind == "a"]
        for kind, text in blocks if not left else []:
            tokens = text.split()
            gone = {k for j in range(len(tokens) - 2) if len(pages_of[(host, *tokens[j : j + 3])]) >= 6 for k in range(j, j + 3)} if kind == "o" else set(range(99))
            left.append(" ".join(t for k, t in enumerate(tokens) if k not in gone))
        wanted[i] = "\n".join(text for text in left if text)
    for group_pages in (4, 256):
        assert texts(page_rows(spark, rows), least_tokens=3, least_pages=6, group_pages=group_pages) == wanted
    plain = {i: "\n".join(text for kind, text in blocks if kind == ("a" if "a" in dict(blocks) else "o")) for (i, _, _), (_, blocks) in zip(rows, made, strict=False)}
    assert sum(wanted[i] != plain[i] for i in plain) > 10
