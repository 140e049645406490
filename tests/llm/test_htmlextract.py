import random
import re

from lodewerk.llm import htmlextract as h


def brute(parts, weights):
    value = lambda p: p[1] * weights[h.WORD] if not p[0] else 0.0 if p[0].lstrip("/") == h.LABEL else weights.get(p[0], weights[""])
    scores = [value(p) for p in parts]
    return max((sum(scores[i:j]) for i in range(len(parts)) for j in range(i, len(parts) + 1)), default=0.0)


def test_scan_equals_all_regions():
    r = random.Random(1)
    for _ in range(200):
        page = "".join(r.choice(["<p>", "</p>", "<div>", "<a href='x>'>", "word ", "two words ", "<!-- c -->", "<script>if(a<b)</script>"]) for _ in range(r.randrange(0, 15)))
        parts = h.tokens(page)
        score, a, b = h.best(parts, h.DEFAULT)
        assert abs(score - max(0.0, brute(parts, h.DEFAULT))) < 1e-9
        assert abs(score - brute(parts[a:b], h.DEFAULT)) < 1e-9 or not score


def test_held_out_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").toPandas()
    train, held = pages.html[:120], pages.html[120:]
    weights = h.fit(list(train))
    assert weights[h.WORD] > 0 and all(w < 0 for n, w in weights.items() if n != h.WORD)
    f1 = []
    for page in held:
        want = re.sub(r"<[^>]*>", " ", re.search(r"<article>(.*)</article>", page, re.S)[1])
        got = h.region(page.replace("<article>", "").replace("</article>", ""), weights)[0]
        a, b = set(h.html.unescape(want).split()), set(got.split())
        f1.append(2 * len(a & b) / max(1, len(a) + len(b)))
    assert sum(f1) / len(f1) > 0.95


def test_cases(spark):
    rows = [(1, None, "t"), (2, "", "t"), (None, "<p>some words here</p>", "t"), (3, "<br><br>", "t"), (4, "<p>" + "long " * 300_000 + "</p>", None), (4, "<p>&lt;b&gt; x</p>", None), (5, "<!-- open " * 3000, "t"), (6, "no end <script> x < y", "t")]
    pages = spark.createDataFrame(rows, "page_id bigint, html string, text string")
    got = sorted(((r.page_id or 0, r.words, r.text[:20]) for r in h.extract(pages, h.train(pages)).collect()))
    assert got == [(0, 3, "some words here"), (1, 0, ""), (2, 0, ""), (3, 0, ""), (4, 2, "<b> x"), (4, 300_000, "long long long long "), (5, 0, ""), (6, 2, "no end")]
    empty = pages.limit(0)
    assert h.extract(empty, h.train(empty)).count() == 0


def test_pages_with_open_ends():
    """What is never closed is dropped to the end, whether or not tags follow; what looks like a tag without an end is text."""
    text = lambda page: [page[a:b] for tag, _, a, b in h.tokens(page) if not tag]
    assert text("a <b>b</b> <!-- c <i>d</i> e") == ["a ", "b", " "]
    assert text("a <title>b</b> c") == ["a "] and text("a <title>b</title> c") == ["a ", " c"]
    assert text("a <b>b</b> c <i d") == ["a ", "b", " c <i d"]
    assert text("a <b>b</b> c <!-- d") == ["a ", "b", " c "]
    assert text("<!--> x --> y <p>z") == [" y ", "z"]


def test_time_grows_with_the_page():
    import time

    def seconds(n):
        began = time.process_time()
        h.tokens("<a " * n)
        h.tokens("<a " * n + ">" + "<script x" * n + "<!-- " * n)
        return time.process_time() - began

    seconds(1000)
    assert seconds(400_000) < 3
