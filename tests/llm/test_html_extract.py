import random

import pytest

from docketlab.llm import html_extract as H

BODY = "<h1>Title &amp; more</h1><p>First  para\n with <b>bold</b>text and <a href='x'>a link</a>.<p>Second &lt;p&gt; &eacute;<br>line</p><ul><li>one<li>two</ul><p>End.</p>"
TEXT = "Title & more\nFirst para with boldtext and a link.\nSecond <p> é line\none\ntwo\nEnd."
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="<p>no</p>";</script></head><body class="has-sidebar">
<header><p>Site name of some words</p></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice"><p>We use cookies on this site.</p></div>
<!-- <p>comment</p> -->{0}<aside><p>Some words aside</p></aside><div id="sidebar"><p>Side words in here</p></div><form><label>Name</label><input></form>
<section class="comments"><h2>Comments</h2><p>Nice article, thank you for all of it</p></section><footer>&copy; all rights</footer></body></html>"""
AD = "<div class='ad-banner'><p>Buy this now</p></div>"


@pytest.mark.parametrize("content", [f"<article>{BODY}</article>", f"<main><div>{BODY}</div></main>", f"<article>{BODY.replace('<ul>', AD + '<ul>')}</article>", f"<div class='post'>{BODY}</div>", f"<article><header class='entry-header'>{BODY}</header></article>"])
def test_content_alone(content):
    assert H.extract_text(PAGE.format(content), H.Weights()) == TEXT


@pytest.mark.parametrize("page", ["", "plain < 3 words", "<p>unclosed <b", "<p class='x>odd quote</p><p>more</p>", "<!-- open", "<script>never closed", "<p></p>", "</div></p>", "<" * 5_000, "<p a='" * 2_000])
def test_broken_pages_do_not_fail(page):
    assert isinstance(H.extract_text(page, H.Weights()), str)


def test_best_region_is_the_best_contiguous_sum():
    rng = random.Random(1)
    for _ in range(500):
        s = [rng.randrange(-5, 6) for _ in range(rng.randrange(12))]
        lo, hi = H.best_region([float(x) for x in s])
        assert sum(s[lo:hi]) == max([0, *(sum(s[a:b]) for a in range(len(s)) for b in range(a + 1, len(s) + 1))])


def test_table(spark):
    pages = [(i, f"u{i}", PAGE.format(f"<article>{BODY}<p>page {i}</p></article>"), "x") for i in range(30)] + [(99, "n", None, "x"), (98, None, "", "x"), (None, "u", PAGE.format(f"<div>{BODY}</div>"), "x"), (1, "u1", "<p>" + "word " * 100_000, "x")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, text string")
    got = {(r.page_id, r.url): r.text for r in H.extract(df).collect()}
    assert got[1, "u1"] in (TEXT + "\npage 1", ("word " * 100_000).strip()) and len(H.extract(df).where("page_id = 1").collect()) == 2
    assert sorted(len(r.text) for r in H.extract(df.union(df)).where("page_id = 1").collect())[2:] == [499_999] * 2
    assert got[99, "n"] == got[98, None] == "" and got[None, "u"] == TEXT and got[3, "u3"] == TEXT + "\npage 3"
    assert H.extract(df.limit(0)).collect() == []


def test_learnt_weights_have_their_signs():
    runs = {(("in p",), True): 900, (("in p",), False): 10, (("in li", "<a>"), False): 50, (("in div", ".zq"), False): 80, (("in li",), True): 30}
    w = H.learn(runs, {("p", True): 50, ("li", False): 40})
    assert w.content(("in p",)) > 0.7 > 0.5 > w.content(("in div", ".zq")) and w.names[".zq"] < 0 and w.content(("in li",)) > 0.5
    assert w.tags["li"] < w.tags["p"] < 0
    assert H.learn({}, {}).names == {}


STORY = "<h1>The title</h1>" + "".join(f"<p>Paragraph {k} of a story that has some length, with words enough to count.</p>" for k in range(6))
TOLD = "The title\n" + "\n".join(f"Paragraph {k} of a story that has some length, with words enough to count." for k in range(6))


@pytest.mark.parametrize(
    "inside, more",
    [
        ('<h2 id="related-work">Related work</h2><p>Others did it.</p>', "\nRelated work\nOthers did it."),
        ('<section class="search-results-analysis"><p>Analysis of results.</p></section>', "\nAnalysis of results."),
        ("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> hold.</p>", "\nLet x=2 hold."),
        ("<table><tr><th>a<th>b<tr><td>1<td>2</table>", "\na b\n1 2"),
        ('<p>Words <span class="advert">buy me</span> go on.</p>', "\nWords go on."),
        ('<ul class="social-share"><li>Share</li></ul><p>The end.</p>', "\nThe end."),
        ('<div class="newsletter-signup"><p>Get our mail</p></div><pre>code  here</pre>', "\ncode here"),
    ],
)
@pytest.mark.parametrize("tag", ["article", "div"])
def test_matter_inside_the_story(inside, more, tag):
    assert H.extract_text(PAGE.format(f"<{tag}>{STORY}{inside}</{tag}>"), H.Weights()) == TOLD + more


def test_matter_around_the_story():
    two = f"<main>{STORY}</main><p>Between them are words.</p><main><p>The second part of it.</p></main>"
    assert H.extract_text(PAGE.format(two), H.Weights()) == TOLD + "\nBetween them are words.\nThe second part of it."
    teaser = f"<article>{STORY}</article><article class='teaser'><h2>Another story</h2><p>It begins here.</p></article>"
    assert H.extract_text(PAGE.format(teaser), H.Weights()) == TOLD


def marked_pages(n, landmark):
    """Pages with their text marked by hand: a class that no list has, and a tag line and links that nothing marks."""
    rng, out = random.Random(n), []
    words = [f"w{k}" for k in range(200)]
    say = lambda k: " ".join(rng.choices(words, k=k))
    for _ in range(n):
        ps = [say(rng.randrange(8, 40)) for _ in range(rng.randrange(3, 9))]
        body = f"<h1>{(h := say(5))}</h1>" + "".join(f"<p>{x}</p>" for x in ps)
        links = "<ul>" + "".join(f"<li><a href='/{k}'>{say(1)}</a></li>" for k in range(30)) + "</ul>"
        page = f"<html><body><p>{say(4)}</p>{links}<div class='zq'>{say(25)}</div><{landmark}>{body}</{landmark}><div class='zq'>{say(30)}</div>{links}<p>{say(5)}</p></body></html>"
        out.append((page, "\n".join([h, *ps])))
    return out


def without_scan(page, weights):
    lines = (" ".join("".join(s for s, _, around, _ in b.runs if weights.content(around) >= 0.5).split()) for b in H.blocks_of(page)[0])
    return "\n".join(x for x in lines if x)


def test_the_scan_and_the_weights_both_matter(spark):
    train = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(marked_pages(60, "article"))], "page_id long, html string")
    learnt = H.fit(train)
    pages = marked_pages(50, "div")  # no landmark is left
    right = lambda f: sum(f(page) == text for page, text in pages)
    assert right(lambda x: H.extract_text(x, learnt)) == 50
    assert right(lambda x: H.extract_text(x, H.Weights())) == 0 == right(lambda x: without_scan(x, learnt))
    renamed = [(a.replace("article>", "div>"), a) for a, _ in marked_pages(60, "article")]
    assert all(H.extract_text(a, learnt) == H.extract_text(b, learnt) for a, b in renamed)


def test_sample_is_of_the_labelled_pages(spark, monkeypatch):
    plain = [(i, f"<p>plain {i}</p>") for i in range(3_000)]
    labelled = [(4_000 + i, f"<article><p>words of page</p></article><nav><p>n{i}</p></nav>") for i in range(30)]
    copies = [(5_000 + i, "<main><section><p>one copy</p></section></main>") for i in range(30)]
    df = spark.createDataFrame(plain + labelled + copies + labelled, "page_id long, html string")
    seen = []
    monkeypatch.setattr(H, "learn", lambda runs, tags: seen.append(runs) or H.Weights())
    H.fit(df, limit=20)
    assert sum(n for (_, inside), n in seen[0].items() if inside) == 20 and 0 < sum(n for (_, inside), n in seen[0].items() if not inside) <= 20
