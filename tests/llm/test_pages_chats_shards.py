import random

import pytest
from pyspark.sql import functions as F

from callsift.llm import chat_format, html_content, sharding

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><p>Site name, and a slogan, here.</p></header><nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
<div class="cookie-notice">We use cookies, yes. We do, always, and gladly.</div><!-- <p>not this</p> -->
<div id="content"><article class="post"><h1>Title &amp;&nbsp;more</h1><p><b>First   sentence, with &quot;marks&quot;.<br><p>Second one,
with a <a href="x">link</a> inside, and more text.</p><ul><li>Item one, of some<li>Item two</ul><p>Short.</p>
<blockquote>Quoted, at length, by someone.</blockquote><div class="ad">Buy now, cheap.</div><script>var x = "</p>";</script>
<section id="comments"><p>A reader says a lot, quite a lot, really. And on, and on, and on it goes.</p></section></article></div>
<aside><p>Elsewhere, other things happen.</p></aside><form><p>Your name, please.</p></form><footer>&copy; all rights, reserved.</footer></body></html>"""


def test_article_without_the_rest():
    assert html_content.extract(PAGE).split("\n") == [
        "Title & more",
        'First sentence, with "marks".',
        "Second one, with a link inside, and more text.",
        "Item one, of some",
        "Item two",
        "Short.",
        "Quoted, at length, by someone.",
    ]


def test_page_without_an_article_element():
    text = html_content.extract(
        "<div id=menu><a href=a>Home</a> <a href=b>News</a></div><div id=main><h2>Head</h2><p>Words, many of them, here.<p>More of them, too.</div>"
        "<div class='comment-list'><p>Great, long comment here, isn't it? Yes, it is, surely.</p></div>"
    )
    assert text == "Head\nWords, many of them, here.\nMore of them, too."


LONG = "".join(f"<p>Paragraph {i} says this, and that, and a good deal more of it.</p>" for i in range(6))


@pytest.mark.parametrize("names", ["class='content-sidebar-wrap'", "class='site no-sidebar'", "id=related class=comments", "class=hidden"])
@pytest.mark.parametrize("tag", ["main", "article", "div"])
def test_wrapper_with_a_name_of_boilerplate(names, tag):
    page = f"<body><nav>Home</nav><div {names}><{tag}><h1>Head</h1>{LONG}</{tag}></div><div class=sidebar><p>Other, things.</p></div></body>"
    assert html_content.extract(page).split("\n") == ["Head", *html_content.extract(LONG).split("\n")]


@pytest.mark.parametrize("tag", ["article", "div"])
@pytest.mark.parametrize(
    "part", ["<section id='discussion'>{}</section>", "<h2 id='related-work'>{}</h2>", "<div class='side-by-side'>{}</div>"]
)
def test_parts_of_an_article_with_a_name_of_boilerplate(tag, part):
    said = "It is discussed here, at some length, by those who did it."
    page = f"<div id=menu><a href=a>Home</a></div><{tag}><h1>Head</h1>{LONG}{part.format(said)}{LONG}</{tag}><div class='related-posts'><p>Another, post.</p></div>"
    whole = html_content.extract(LONG).split("\n")
    assert html_content.extract(page).split("\n") == ["Head", *whole, said, *whole]


@pytest.mark.parametrize("names", ["class=comments", "id=sidebar", "class='cookie-notice'", "class='share-buttons'", "class='ad-slot'"])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_names_of_boilerplate_lower_scores(names, tag):
    page = f"<{tag}>{LONG}<div {names}><p>Words that belong to others, and are of no use, here.</p></div></{tag}>"
    assert html_content.extract(page) == html_content.extract(LONG)


@pytest.mark.parametrize("n", [1, 3, 10, 40, 200])
@pytest.mark.parametrize("around", ["{}", "<html><body><nav><p>Go, there.</p></nav>{}<footer><p>All, reserved.</p></footer></body></html>"])
def test_headline_and_lede_beside_a_body_of_any_length(n, around):
    body = "".join(f"<p>Paragraph {i} says this, and that, and a good deal more of it.</p>" for i in range(n))
    page = f"<div id=post><h1>Headline</h1><p>Lede, of some words.</p><div class=entry>{body}</div><div class=more><p>Afterword, in short.</p></div></div>"
    lines = html_content.extract(around.format(page)).split("\n")
    assert lines[:2] == ["Headline", "Lede, of some words."] and lines[-1] == "Afterword, in short." and len(lines) == n + 3


def test_selected_blocks_outside_the_longest_part():
    part = "<div><h2>Part</h2><section><p>{}</p></section></div>"
    texts = ["Short, but chosen.", "Long, and longer, and on it goes. " * 60, "Short, at the end."]
    page = "<body><div id=top><a href=a>Home</a></div>" + "".join(map(part.format, texts)) + "</body>"
    assert html_content.extract(page).split("\n") == [x for t in texts for x in ("Part", t.strip())]


def test_formulas_drawings_and_fallback_text():
    formula = "<math><semantics><mrow><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup><mspace/></mrow><annotation>E</annotation></semantics></math>"
    drawing = "<svg aria-hidden=true><path d='M0'/><title>Icon</title></svg><svg><g><text>up</text><text>down</text></g></svg>"
    fallback = "<object data=x><param name=y>a film</object> or <canvas>a curve</canvas>"
    page = f"<article><p>It is {formula}, he said.</p><p>Go{drawing}, and see {fallback}.</p><script>x</script><select><option>y</select></article>"
    assert html_content.extract(page) == "It is E=mc2, he said.\nGo up down, and see a film or a curve."


@pytest.mark.parametrize("page", ["", "   ", "<", "<p", "<!--", "<script>x", "</p></p>", "<div class=\"a", "&am", "<nav><p>x</p></nav>", "\x00"])
def test_odd_pages(page):
    assert isinstance(html_content.extract(page), str)


def test_plain_text_and_long_pages():
    assert html_content.extract("just text &lt;here&gt;") == "just text <here>"
    words = "<p>" + "word, " * 50_000 + "</p>"
    assert len(html_content.extract("<article>" + words * 2 + "</article>")) == 2 * len(("word, " * 50_000).strip()) + 1
    deep = "<div>" * 3000 + "<p>Deep, down.</p>"
    assert html_content.extract(deep) == "Deep, down."


def test_pages_as_a_table(make):
    rows = make([(1, PAGE, "x"), (2, None, "y"), (2, None, "y"), (3, "", None)], "page_id long, html string, text string")
    got = html_content.extract_content(rows, "html").collect()
    assert [len(r["text"]) > 0 for r in got] == [True, False, False, False]
    assert html_content.extract_content(make([], "html string"), "html").collect() == []


ALPHABET = ["a", " ", "\n", "\\", "[INST]", "[/INST]", "</s>", "<s>", "<ans>", "<role ", "</role>", ">", "<", "/", "]", "<<SYS>>", "<</SYS>>", "</chat>", "INST]", "🙂"]


def test_any_turns_read_back():
    random.seed(3)
    roles = ["user", "assistant", "system", "", "tool", "a>b", "\\"]
    for _ in range(3000):
        turns = [(random.choice(roles), "".join(random.choices(ALPHABET, k=random.randint(0, 7)))) for _ in range(random.randint(0, 5))]
        made = chat_format.render(turns)
        assert chat_format.parse(made.text) == turns
        learned = [chat_format.unescaped(made.text[a:b], chat_format.Template()) for a, b in made.loss]
        assert learned == [text for role, text in turns if role == "assistant"]


def test_parser_rejects_what_it_did_not_write():
    for text in ["", "<s>", "<s>[INST] x", "<s></chat>x", "<s>nothing</chat>", "<s><role x</role></chat>"]:
        with pytest.raises(chat_format.Conflict):
            chat_format.parse(text)


def test_plain_texts_are_not_escaped():
    made = chat_format.render([("user", "hi < there > [1]"), ("assistant", "yes")])
    assert made.text == "<s>[INST] hi < there > [1] [/INST]<ans>yes</s></chat>" and made.escapes == 0


def test_conversations(make):
    rows = [(1, 1, "assistant", "b </s>"), (1, 0, "user", "a"), (1, 2, None, None), (2, 0, "assistant", None), (2, 0, "assistant", None), (None, 0, "user", "x"), (3, None, "user", "y" * 200_000)]
    df = make([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_conversations(df, "conv_id", "turn", "role", "text"), "conv_id").collect()}
    assert got[1]["turns_sha256"] == chat_format.turns_digest([("user", "a"), ("assistant", "b </s>"), ("", "")])
    assert (got[1]["n_turns"], got[1]["loss_chars"]) == (3, 6)
    assert (got[2]["n_turns"], got[2]["loss_chars"]) == (2, 0)
    assert got[None]["n_turns"] == 1 and got[3]["formatted_chars"] > 200_000
    assert chat_format.format_conversations(df.limit(0), "conv_id", "turn", "role", "text").collect() == []


def naive_best_fit(sizes, capacity):
    bins, placed = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [(room, b) for b, room in enumerate(bins) if room >= sizes[i]]
        if not fits:
            bins.append(capacity)
            fits = [(capacity, len(bins) - 1)]
        room, b = min(fits)
        bins[b] = room - sizes[i]
        placed[i] = b
    return placed


def test_packing_is_best_fit_decreasing():
    random.seed(9)
    for _ in range(100):
        sizes = [random.randint(1, 1200) for _ in range(random.randint(0, 150))]
        assert sharding.pack(sizes, 1000) == naive_best_fit(sizes, 1000)


def test_shards(make):
    random.seed(8)
    rows = [(i, "w" * random.randint(0, 300), 7) for i in range(2000)] + [(5000 + i, "hot" * 30, 7) for i in range(900)]
    rows += [(None, "no id", 7), (None, None, 7), (9000, None, 7), (9001, "", 7), (9002, "same", 7), (9002, "same", 7)]
    df = make(rows, "doc_id long, text string, shard int")
    text = F.coalesce("text", F.lit(""))
    args = (df, "doc_id", text, F.octet_length(text) + 16)
    got = sharding.shard(*args, shards=7, carry={"group": text}).collect()
    assert len(got) == len(rows)
    by_shard, by_text = {}, {}
    for r in got:
        by_shard.setdefault(r["shard"], []).append(r)
        by_text.setdefault(r["group"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(r["slot"] for r in rs) == list(range(len(rs))) for rs in by_shard.values())
    sizes = sorted(sum(r["size"] for r in rs) for rs in by_shard.values())
    # the group of copies is larger than a shard; the others are even
    assert len(sizes) == 7 and sizes[-2] - sizes[0] <= 0.03 * sizes[0]
    capacity = sizes[0] // 2
    tight = sharding.shard(*args, capacity=capacity).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    assert sum(r["n"] > capacity for r in tight) <= 1
    with pytest.raises(ValueError):
        sharding.shard(*args)


def test_no_rows_no_shards(make):
    df = make([], "doc_id long, text string")
    assert sharding.shard(df, "doc_id", F.col("text"), F.octet_length("text"), shards=3).collect() == []


def paragraphs(n, word="Paragraph"):
    return "".join(f"<p>{word} {i} says this, and that, and a good deal more of it.</p>" for i in range(n))


def lines(n, word="Paragraph"):
    return [f"{word} {i} says this, and that, and a good deal more of it." for i in range(n)]


@pytest.mark.parametrize("sizes", [(5, 5), (5, 4), (9, 1), (1, 9), (4, 4, 4), (20, 1, 3)])
def test_every_article_of_a_page(sizes):
    parts = "".join(f"<article><h2>Head {i}</h2>{paragraphs(n, f'Part {i}')}</article>" for i, n in enumerate(sizes))
    want = [x for i, n in enumerate(sizes) for x in (f"Head {i}", *lines(n, f"Part {i}"))]
    for page in (parts, f"<main>{parts}</main>", f"<body><nav>Home</nav><div id=list>{parts}</div><footer>x</footer></body>"):
        assert html_content.extract(page).split("\n") == want


def test_page_inside_a_form():
    page = f"<body><form id=aspnetForm action=x><input type=hidden name=state><div id=top><a href=a>Home</a></div><h1>Head</h1>{paragraphs(4)}</form></body>"
    assert html_content.extract(page).split("\n") == ["Head", *lines(4)]
    page = f"<body><div id=main><h1>Head</h1>{paragraphs(4)}<form><p>Tell us what you think, please, and how.</p><input name=q><textarea>x</textarea></form></div></body>"
    assert html_content.extract(page).split("\n") == ["Head", *lines(4)]


@pytest.mark.parametrize("names", ["id=comments", "class='reader-comments'", "class=feedback", "class='comment-list user-comments'"])
@pytest.mark.parametrize("tag", ["div", "section"])
@pytest.mark.parametrize("n", [0, 1, 10, 40, 300])
@pytest.mark.parametrize("size", [1, 3, 8])
def test_comments_of_any_length_are_no_article(names, tag, n, size):
    if tag == "section" and names.startswith("class=f"):
        pytest.skip("a section may be about feedback")
    said = "".join(f"<article><p>Reader {i} says a lot, quite a lot, and on and on, really, with many words more.</p></article>" for i in range(n))
    around = "<body><nav>Home</nav>{}<footer>All, reserved.</footer></body>"
    for post in ("<div id=post><h1>Head</h1>{}</div>", "<h1>Head</h1>{}", "<article><h1>Head</h1>{}</article>"):
        page = around.format(post.format(paragraphs(size)) + f"<{tag} {names}>{said}</{tag}>")
        assert html_content.extract(page).split("\n") == ["Head", *lines(size)]


def test_layout_tables_and_related_links():
    page = f"<table><tr><td>Home</td><td><h1>Head</h1>{paragraphs(4)}</td><td>Elsewhere</td></tr></table>"
    assert html_content.extract(page).split("\n") == ["Head", *lines(4)]
    data = "<table><tr><th>Year</th><th>Sum</th></tr><tr><td>1</td><td>2</td></tr></table>"
    page = f"<div id=x><h1>Head</h1>{paragraphs(3)}{data}{paragraphs(3)}</div>"
    assert html_content.extract(page).split("\n") == ["Head", *lines(3), "Year", "Sum", "1", "2", *lines(3)]
    page = f"<article><h1>Head</h1>{paragraphs(4)}<div class=related><p>Another story, that says this and that.</p></div></article>"
    assert html_content.extract(page).split("\n") == ["Head", *lines(4)]


@pytest.mark.parametrize(
    "page",
    ["<b>x " * 40_000, "<div>" * 20_000 + "x", "<div>x" * 20_000, "<ul><li>" * 5_000 + "x", "<p><i>" * 20_000 + "</p></i>" * 20_000, "<a href=x>" * 30_000 + "x " * 1000, "</b></i></div>" * 30_000 + "x"],
)
def test_bad_markup_takes_linear_time(page):
    import time

    start = time.process_time()
    html_content.extract(page)
    assert time.process_time() - start < 6


def test_scores_of_paths_match_plain_loops():
    import math
    import statistics

    random.seed(9)
    tags = ["div", "p", "section", "li", "span", "a href=x"]
    for _ in range(60):
        page = "".join(f"<{random.choice(tags)}>" + random.choice(["", "Some, words. ", "more ", "x" * 30]) + random.choice(["", "</p>", "</div>", "</a>"]) for _ in range(40))
        nodes, tree = html_content.blocks(page)
        if not nodes:
            continue
        paths = []
        for node in nodes:
            path, at = [], node.element
            while at:
                path, at = [tree.tag[at], *path], tree.parent[at]
            paths.append("/".join(t for t in path if t not in html_content.INLINE))
        assert len(set(paths)) == len({n.path for n in nodes}) and len(set(zip(paths, (n.path for n in nodes), strict=True))) == len(set(paths))
        text, marks = [], []
        for path in paths:
            mine = [n for n, p in zip(nodes, paths, strict=True) if p == path]
            text.append(sum(len(n.text) - n.links for n in mine) / len(mine))
            marks.append(sum(sum(c in ".,;:!?" for c in n.text) for n in mine if n.links * 2 < len(n.text)) / len(mine))
        window = [math.exp(-d * d / 2) for d in range(-2, 3)]

        def smooth(values):
            return [sum(w * values[min(max(i + d, 0), len(values) - 1)] for w, d in zip(window, range(-2, 3), strict=True)) / sum(window) for i in range(len(values))]

        want = [t * (1 + m) for t, m in zip(smooth(text), smooth(marks), strict=True)]
        got = html_content.path_scores(nodes)
        assert got.tolist() == pytest.approx(want)
        best = {p: max(w for w, q in zip(want, paths, strict=True) if q == p) for p in paths}
        least = statistics.pstdev(want)
        if all(abs(b - least) > 1e-9 for b in best.values()):
            chosen = [n.text for n, p in zip(nodes, paths, strict=True) if best[p] >= least]
            assert [n.text for n in html_content.select(nodes, got)] == (chosen or [n.text for n in nodes])
