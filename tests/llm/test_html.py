import random

import pytest

from taxaframe.llm import html_extract as H


def page(draw, noise=""):
    para = lambda: " ".join(draw.choice("alpha beta gamma delta eps zeta".split()) for _ in range(draw.randrange(5, 60))) + "."
    title, paras = para(), [para() for _ in range(draw.randrange(1, 9))]
    nav = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("home", "news", "about"))
    body = f"<h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in paras)
    html = f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul>{nav}</ul></nav><!-- x --><div class=\"ad\">{para()}</div><article>{body}{noise}</article><footer>&copy; {para()}</footer></body></html>"
    return html, "\n".join([title, *paras])


@pytest.fixture(scope="module")
def fitted(spark):
    draw = random.Random(1)
    rows = [(i, f"u{i}", page(draw)[0], "x") for i in range(60)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    return H.fit_extractor(frame, sample_pages=40)


def test_pages(spark, fitted):
    draw = random.Random(2)
    cases = [page(draw) for _ in range(40)]
    cases += [page(draw, n) for n in ('<div class="comments"><p>A reader says hello to all.</p></div>', "<aside><p>Read more of this elsewhere.</p></aside>", "<form><p>Sign up now please.</p><input></form>", '<div class="cookie-notice">We use cookies.</div>')]
    rows = [(i, f"u{i}", h, "x") for i, (h, _) in enumerate(cases)] + [(None, None, None, None), (100, "u", "", "x"), (101, "u", "just text", "x"), (102, "u", "<" * 3000 + "a", "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r["page_id"]: r["text"] for r in H.extract_pages(frame, fitted).collect()}
    assert len(got) == len(rows) and got[None] == got[100] == ""
    assert sum(got[i] == want for i, (_, want) in enumerate(cases)) == len(cases)
    assert H.extract_pages(frame.limit(0), fitted).count() == 0
    assert H.fit_extractor(frame.limit(0)).trees


def test_parser():
    texts = lambda h: [n.text for n in H.parse(h)[1] if n.text]
    assert texts("<p><b>One&amp;two.<br><p>Thr\n  ee</p>four<ul><li>a<li>b</ul>") == ["One&two.", "Thr ee", "four", "a", "b"]
    assert texts("<div>a<!-- <p>no</p> -->b<script>if (a<b) '</p>'</script>c</div><p title='x>y'>d") == ["abc", "d"]
    assert texts("a < b <p>c") == ["a < b", "c"]


def test_elements_that_are_no_raw_text(spark, fitted):
    texts = lambda h: [n.text for n in H.parse(h)[1] if n.text]
    assert texts("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn><mspace/></math> holds</p><p><object data=a><b>a picture</b></object> of it") == ["so x=2 holds", "a picture of it"]
    for tag in ("svg", "select", "noscript", "template"):
        assert texts(f"<p>one <{tag}><g/><p>no</p><title>no</title><{tag}>no</{tag}></{tag}> two</p><p>three<{tag}/> four") == ["one two", "three four"], tag
        assert texts(f"<p>one <{tag}></p><p>two<p>three <{tag}>no</{tag}>four") == ["one", "two", "three four"], tag
    assert texts("<p>a<svg><title>no</svg>b</p><p>c <object><p>d</p><p>e") == ["ab", "c", "d", "e"]
    assert texts("<noscript><div><p>no</div></noscript><select><option>no<option>no</select><p>a") == ["a"] and len(H.parse("<noscript><p>no</p></noscript><p>a")[1]) == 3
    pages = []
    for open_tag in ('<object data="x.swf">', "<svg>", "<select>", "<noscript>", "<template>", "<math>"):
        html, want = page(random.Random(7))
        cut = html.index("</h1>") + 5
        pages.append((html[:cut] + open_tag + html[cut:], want))
    html, want = page(random.Random(8))
    first = want.split("\n")[1]
    pages.append((html.replace(f"<p>{first}", f"<p><math><mi>m</mi><mo>+</mo><mi>n</mi></math> {first}"), want.replace(first, f"m+n {first}", 1)))
    frame = spark.createDataFrame([(i, "u", h) for i, (h, _) in enumerate(pages)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in H.extract_pages(frame, fitted).collect()}
    assert [got[i] for i in range(len(pages))] == [want for _, want in pages]


def test_siblings_of_the_same_tag_in_long_articles():
    for n in (10, 58, 59, 60, 300):
        nodes = H.parse("<article><h1>a</h1>" + "<p>b</p>" * n + "</article>")[1]
        same = {x.tag: f[8] for x, f in zip(nodes, H.features(nodes))}
        assert (same["h1"], same["p"], same["article"]) == (1, n, 1)


def test_decoding_has_no_contradiction():
    import numpy as np

    draw = random.Random(4)
    nodes = H.parse(page(draw)[0])[1]
    for seed in range(30):
        odds = np.random.default_rng(seed).normal(0, 3, len(nodes))
        kept = dict(zip((n.order for n in nodes), H.decode(nodes, odds)))
        assert all(kept[n.parent.order] or not kept[n.order] for n in nodes if n.parent)
