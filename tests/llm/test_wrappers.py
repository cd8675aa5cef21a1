import itertools
import random
import time
from collections import Counter

from daybook.llm import wrappers
from daybook.llm.html import leaves, read


def page(body, host="a.example.com", key=0):
    return (key, f"https://{host}/{key}", f"<!DOCTYPE html><html><head><title>t</title></head><body>{body}</body></html>")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x") for r in rows], "page_id long, url string, html string, host string, template string")


def test_main_text_leaves_out_what_mark_up_sets_apart():
    text = wrappers.main_text(
        "<html><head><title>T</title><style>p{}</style></head><body><header>Head</header><nav><ul><li>Menu</ul></nav>"
        "<div class='cookie-notice'>Cookies</div><article><header><h1>Title &amp; more</h1></header><p>One<br>two  <b>th</b>ree"
        "<p>Four &lt;5&gt; &#x41;&nbsp;b<script>var x='</p>';</script><!-- note --><form>Search</form>"
        "<ul><li>six<li>seven</ul><section id=comments><p>Comment</p></section></article><aside>Side</aside>"
        "<div class=ad>Buy</div><footer>&copy; me</footer>",
    )
    assert text == "Title & more One two three Four <5> A b six seven"


def test_pages_without_an_article_give_their_body():
    assert wrappers.main_text("<p>a<div>b<p>c</div>d") == "a b c d"
    assert wrappers.main_text("<main><p>a</p></main><p>b</p>") == "a"
    assert wrappers.main_text("plain < text & more") == "plain < text & more"
    for odd in (None, "", "<", "<p", "</p>", "<!--", "<script>x", "<a title=\"x>y", "<b></i></b>"):
        assert isinstance(wrappers.main_text(odd), str)
    assert wrappers.main_text("<p title='a>b'>c</p>") == "c"


def test_constant_slots_become_template_and_varying_ones_content(spark):
    draw = random.Random(11)
    words = lambda n: " ".join(f"w{draw.randrange(999)}" for _ in range(n))
    rows, expected = [], {}
    for i in range(20):
        own, more = words(20), [words(15) for _ in range(i % 4)]
        body = f"<div>Welcome to our site</div><div><h1>{own}</h1></div><div>{''.join(f'<p>{m}</p>' for m in more)}</div><div>All rights kept</div>"
        rows.append(page(body, key=i))
        expected[i] = " ".join([own, *more])
    rows.append(page("<div>Welcome to our site</div><div><h1>x</h1></div>", host="b.example.com", key=99))
    expected[99] = "Welcome to our site x"
    rows += [(100, None, rows[0][2]), (101, "https://a.example.com/n", None), (None, None, None), rows[0]]
    found = wrappers.extract(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        if r["page_id"] in expected:
            assert r["text"] == expected[r["page_id"]]
    assert {r["text"] for r in found if r["page_id"] == 100} == {"Welcome to our site " + expected[0] + " All rights kept"}
    assert {r["text"] for r in found if r["page_id"] in (101, None)} == {""}
    assert wrappers.extract(frame(spark, [])).count() == 0


def test_copies_of_an_article_are_not_its_template(spark):
    text = "the same long story told again and again on every page of this host"
    same = [page(f"<article><h1>story</h1><p>{text}</p></article>", key=i) for i in range(30)]
    near = [page(f"<article><h1>story</h1><p>{text}</p><div>{i}</div></article>", host="c.d", key=100 + i) for i in range(30)]
    found = {r["page_id"]: r["text"] for r in wrappers.extract(frame(spark, same + near)).collect()}
    assert all(found[i] == f"story {text}" for i in range(30))
    assert all(found[100 + i] == f"story {text} {i}" for i in range(30))


def article(draw, n):
    words = lambda k: " ".join(f"w{draw.randrange(999)}" for _ in range(k))
    return words(8), [words(20 + draw.randrange(20)) for _ in range(n)]


def test_only_other_pages_tell_template_from_content(spark):
    """Names say nothing here: menus and adverts vary, and a constant block stands among the article's own."""
    draw, rows, expected = random.Random(13), [], {}
    for i in range(40):
        title, own = article(draw, 2 + i % 5)
        advert = f"<div class=q{i}>buy v{draw.randrange(999)} now</div>" if i % 3 else ""
        menu = "".join(f"<li><a href=/{j}>m{draw.randrange(999)}</a>" for j in range(6))
        told = [*own[: len(own) // 2], "Sign up for our letter", *own[len(own) // 2 :]]
        body = f"<div class=a><ul>{menu}</ul></div>{advert}<div class=b><h1>{title}</h1>{''.join(f'<p>{t}</p>' for t in told)}</div>"
        rows.append(page(f"{body}<div class=c>&copy; nobody {draw.randrange(999)}</div>", key=i))
        expected[i] = " ".join([title, *own])
    # A second layout on the same host, whose article is named like a comment.
    for i in range(40, 60):
        title, own = article(draw, 3)
        rows.append(page(f"<div class=k>top {i}</div><section class=comment><h1>{title}</h1><p>{'<p>'.join(own)}</section>", key=i))
        expected[i] = " ".join([title, *own])
    found = wrappers.extract(frame(spark, rows)).collect()
    assert {r["page_id"]: r["text"] for r in found} == expected
    assert all(r["decided"] for r in found)


def test_the_article_of_an_odd_page_stays_whole(spark):
    """What repeats on few pages is content; so is a heading beside the text, and a page without fellows."""
    draw, rows, expected = random.Random(14), [], {}
    for i in range(30):
        title, own = article(draw, 3)
        more = ["see also the other one"] if i % 10 == 0 else []
        rows.append(page(f"<div><h1>{title}</h1></div><div class=x><p>{'<p>'.join([*own, *more])}</div>", key=i))
        expected[i] = " ".join([title, *own, *more])
    rows.append(page("<div>one</div><div><p>two</div>", host="lonely.example.com", key=99))
    expected[99] = "one two"
    assert {r["page_id"]: r["text"] for r in wrappers.extract(frame(spark, rows)).collect()} == expected


def test_given_pages_are_decided_by_their_fellows(table):
    pages = table("pages")
    found = {r["page_id"]: r for r in wrappers.extract(pages).collect()}
    fellows = Counter(wrappers.layout(read(r["html"])) + r["url"].split("/")[2] for r in pages.where("html is not null").collect())
    assert sum(r["decided"] for r in found.values()) > sum(n for n in fellows.values() if n > 3) / 2 > 0
    assert all(found[r["page_id"]]["text"] == wrappers.main_text(r["html"]) for r in pages.collect())


def test_equal_blocks_meet_among_varying_siblings():
    mine = [0] * 5, ["#"] * 5, [1, 2, 9, 3, 4]
    other = [0] * 3, ["#"] * 3, [5, 9, 6]
    assert (2, 1) in wrappers.Matcher(mine, other).match()


def test_deep_and_odd_pages_have_skeletons(spark):
    deep = "<div>" * 3000 + "x%d" + "</div>" * 3000
    rows = [page(deep % i, key=i) for i in range(4)]
    rows += [page(odd, host="o.example.com", key=10 + i) for i, odd in enumerate(("", "<", "<p", "</p>", "<a>x", "<a><p>y</a>z</p>"))]
    found = {r["page_id"]: r["text"] for r in wrappers.extract(frame(spark, rows)).collect()}
    assert len(found) == len(rows) and all(found[i] == f"x{i}" for i in range(4))


def brute_match(a, b):
    """Size of the largest match of two (label, children) trees with equal roots."""
    best = 0
    n, m = len(a[1]), len(b[1])
    for k in range(min(n, m) + 1):
        for left in itertools.combinations(a[1], k):
            for right in itertools.combinations(b[1], k):
                if all(x[0] == y[0] for x, y in zip(left, right, strict=True)):
                    best = max(best, sum(1 + brute_match(x, y) for x, y in zip(left, right, strict=True)))
    return best


def flat(trees, depth=0):
    depths, labels, texts = [], [], []
    for label, children in trees:
        d, x, t = flat(children, depth + 1)
        depths += [depth, *d]
        labels += [label, *x]
        texts += [0, *t]
    return depths, labels, texts


def test_tree_matching_is_largest(monkeypatch):
    draw = random.Random(12)

    def tree(depth):
        return draw.choice("ab"), [tree(depth - 1) for _ in range(draw.randrange(4) if depth else 0)]

    for _ in range(60):
        a, b = ("r", [tree(2) for _ in range(3)]), ("r", [tree(2) for _ in range(3)])
        pairs = wrappers.Matcher(flat(a[1]), flat(b[1])).match()
        assert len(pairs) == brute_match(a, b)
    long = [("a", []), *[("b", [])] * 5, ("c", [])]
    monkeypatch.setattr(wrappers, "CELLS", 4)
    assert len(wrappers.Matcher(flat(long), flat(long)).match()) == 7


def test_long_lists_are_aligned_as_short_ones_are(monkeypatch):
    draw = random.Random(15)

    def tree(depth):
        if draw.random() < 0.4 or not depth:
            return "#", [], draw.choice((0, 1, 2, 3, 4, draw.randrange(10, 10**6)))
        return draw.choice("ab"), [tree(depth - 1) for _ in range(draw.randrange(5))], 0

    def told(trees, depth=0):
        depths, labels, said = [], [], []
        for label, children, text in trees:
            below = told(children, depth + 1)
            depths, labels, said = depths + [depth, *below[0]], labels + [label, *below[1]], said + [text, *below[2]]
        return depths, labels, said

    for n in range(80):
        common = [tree(2) for _ in range(draw.randrange(4))]
        a, b = (told([*common, *[tree(3) for _ in range(draw.randrange(14))]]) for _ in "ab")
        monkeypatch.setattr(wrappers, "CELLS", 1 << 20)
        matcher = wrappers.Matcher(a, b)
        expected = matcher.weigh(-1, -1)[0], matcher.match()
        monkeypatch.setattr(wrappers, "PARTS", 2 + n % 3)
        monkeypatch.setattr(wrappers, "KNOWN", 1 + n)
        monkeypatch.setattr(wrappers, "FEW", 1 + n % 4)
        for cells in (0, 3, 20):
            monkeypatch.setattr(wrappers, "CELLS", cells)
            matcher = wrappers.Matcher(a, b)
            assert (matcher.weigh(-1, -1)[0], matcher.match()) == expected


def test_what_differs_in_the_middle_of_long_lists_leaves_the_rest_matched():
    def rows(cells):  # each a row of two cells
        depths, labels, said = [0, 1, 2, 1, 2] * len(cells), ["tr", "td", "#", "td", "#"] * len(cells), []
        for cell in cells:
            said += [0, 0, cell, 0, 7]
        return depths, labels, said

    draw = random.Random(16)
    cells = [draw.randrange(100, 10**9) for _ in range(3000)]
    near = [x for i, x in enumerate(cells) if i % 500 != 3]
    odd = [0], ["hr"], [0]
    mine = tuple(x + y + z for x, y, z in zip(rows(cells[:1500]), odd, rows(cells[1500:]), strict=True))
    found = set(wrappers.Matcher(mine, rows(near)).match())
    places = {cell: 5 * i for i, cell in enumerate(near)}
    assert all((5 * i + (i >= 1500), places[cell]) in found for i, cell in enumerate(cells) if cell in places)
    begun = time.perf_counter()
    other = rows([draw.randrange(100, 10**9) for _ in range(5000)])
    assert len(wrappers.Matcher(other, rows(cells)).match()) == 5 * 3000
    assert time.perf_counter() - begun < 5


def test_long_pages_are_read_whole():
    body = "".join(f"<p>p{i}</p><div>d{i}</div>" for i in range(3000))
    text = wrappers.main_text(f"<article>{body}</article>")
    assert text.split() == [x for i in range(3000) for x in (f"p{i}", f"d{i}")]
    assert sum(1 for _ in leaves(read("<div>" * 5000 + "x" + "</div>" * 5000))) == 1


def texts(node):
    return [node.text] if node.text is not None else [t for child in node.children for t in texts(child)]


def test_a_tag_cut_off_among_quotes_is_read_at_once():
    begun = time.perf_counter()
    for rest in ('"' * 10_001, "'\"" * 10_000, "a='b' " * 10_000, "\"'" * 10_000 + ">x", "x" * 100_000 + " = >y"):
        read("<p>kept <a " + rest)
    assert time.perf_counter() - begun < 2
    assert texts(read("<p title=\"a>b\">one <b class='x>y'>two</b> <i id=\"z>three</p>")) == ["one two three"]
