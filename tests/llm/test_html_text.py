"""HTML extraction: hand-made pages, and the given ones against their known template."""

from __future__ import annotations

import html
import random
import re
from collections import Counter

from clickweave.llm import html_text
from clickweave.llm.common import table
from clickweave.llm.url_filter import address

PAGES = "page_id LONG, url STRING, html STRING, text INT, Host INT"


def texts(source):
    return [b.text for b in html_text.blocks(source) if b.marked is None]


def test_blocks():
    assert texts("<body><p>a &amp; <b>b</b>\n c&nbsp;&lt;<p>d<div>e</div>f<br>g") == [
        "a & b c <", "d", "e", "f g"]
    assert texts("<script>var a='</p><p>x';</script><style>p{}</style><p>y</p><script>open") == ["y"]
    assert texts("<!-- <p>no --><!doctype x><p title='a>b'>yes</p><p cla") == ["yes"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert texts("1 < 2 & 3 > 2") == ["1 < 2 & 3 > 2"] and texts("") == [] and texts("</p></div>") == []
    assert texts("<p hidden>x<p style='display: none'>y<p>z") == ["z"]
    assert len(texts("<div>" * 3000 + "deep")) == 1


def test_what_is_left_out():
    source = """<header><h1>Site</h1></header><nav>menu</nav><div class="cookie-notice">ok</div>
    <article><header><h1>Title</h1></header><p>Text one.<div class=ad>buy</div><p>Two.
    <form><p>mail</form><section id="comments"><p>first!</section></article>
    <aside>x</aside><div role="banner">y</div><footer>z</footer>"""
    assert texts(source) == ["Title", "Text one.", "Two."]
    everything = [b.text for b in html_text.blocks(source, everything=True)]
    assert "menu" in everything and "z" in everything


def within(path, top):
    return path is not None and path != "" and (top == "" or path.startswith(top + ">"))


def plain(urls_and_sources):
    """The same extraction with dictionaries instead of Spark."""
    cut = [(address(u)[0], html_text.blocks(s or "")) for u, s in urls_and_sources]
    votes, found = {}, {}
    for host, page in cut:
        if page:
            votes.setdefault(host, Counter())[html_text.best_path(page)] += 1
        for b in page:
            found.setdefault((host, b.path), []).append(b.text)
    out = []
    for host, page in cut:
        tally = votes.get(host, Counter())
        winner = max(tally, key=lambda p: (tally[p], -len(p), p), default="")

        def once(b):
            same = found[host, b.path]
            return not (within(b.path, winner) and len(same) >= 5 and len(same) > 2 * len(set(same)))

        chosen = [b for b in page if b.path == winner or within(b.path, winner)]
        if chosen:
            chosen = [b for b in chosen if once(b) and not within(b.marked, winner)]
        else:
            own = html_text.best_path(page)
            chosen = [b for b in page if (b.path == own or within(b.path, own)) and once(b)
                      and b.marked is None]
        out.append("\n\n".join(b.text for b in chosen))
    return out


def neutral(number, article, aside="", words=80):
    """A page whose tags and classes say nothing."""
    rng = random.Random(number)
    links = "".join(f"<a href=/{i}>section {i}</a> " for i in range(8))
    text = "".join(f"<p>{' '.join(rng.choices(article, k=words))}</p>" for _ in range(3))
    notice = "<div class=q><p>This site may store what you read, see our terms.</p></div>"
    return (f"<html><body><div class=a>{links}</div><div class='b{number}'>{notice}{text}</div>"
            f"<div class=c><p>{aside or 'All rights reserved by the owner of this site.'}</p></div>")


ARTICLE = [f"word{i}" for i in range(200)]


def test_boilerplate_without_a_name_is_cut_by_votes(spark):
    """Menu, notice and footer are found by links and by what recurs on the host, not by names."""
    rows = [(i, f"http://n.org/{i}", neutral(i, ARTICLE), 1, 2) for i in range(12)]
    # Of this page the text below is longer than its article: alone, it would take that.
    rows.append((12, "http://n.org/12", neutral(12, ARTICLE, "long aside " * 200, 3), 1, 2))
    df = spark.createDataFrame(rows, PAGES)
    for row in html_text.report(df).collect():
        want = [p for p in re.findall("<p>(word.*?)</p>", rows[row.page_id][2])]
        assert row.text == "\n\n".join(want)
    alone = html_text.report(df.where("page_id = 12")).first().text
    assert alone.startswith("long aside")
    single = html_text.report(df.where("page_id = 3")).first().text
    assert single.startswith("This site may store")


def test_names_are_a_weak_feature(spark):
    """An article in a container called widget is taken all the same; comments below it are not."""
    page = ("<body><nav>a menu of some words</nav><div class='widget'><p>%s</p>"
            "<div class='comments'><p>first! %d</p></div></div><footer>owner %d</footer>")
    rows = [(i, f"http://w.org/{i}", page % ("text " * (60 + i), i, i), 1, 2) for i in range(4)]
    found = html_text.report(spark.createDataFrame(rows, PAGES)).collect()
    assert sorted(r.text for r in found) == sorted(" ".join(["text"] * (60 + i)) for i in range(4))


def test_deep_containers_are_told_apart():
    source = "<div>" * 100 + "<div class=x>one</div><div class=y>two</div>"
    a, b = html_text.blocks(source)
    assert a.path != b.path and len(a.path) < 1000
    deep = "".join(f"<div class=c{i}>t" for i in range(5000))
    assert max(len(b.path) for b in html_text.blocks(deep)) < 1000


def test_votes_of_a_host(spark):
    rng = random.Random(2)
    rows = []
    for i in range(60):
        body = "".join(f"<p>{'word ' * rng.randint(5, 60)}</p>" for _ in range(rng.randint(0, 5)))
        side = "<div class='box'>" + "<p>aside text here</p>" * rng.randint(0, 9) + "</div>"
        kind = rng.choice(["<div class='post-%d'>%s</div>%s", "<section class=s%d>%s</section>%s"])
        rows.append((i, f"http://h{i % 4}.org/{i}", f"<body>{kind % (i, body, side)}</body>", 1, 2))
    rows += [(100, None, "<p>lone", 1, 2), (101, "x", None, 1, 2), (102, "http://h1.org/", "", 1, 2),
             (None, "http://h1.org/", "<p>" + "x" * 100_000, 1, 2), rows[0]]
    df = spark.createDataFrame(rows, PAGES)
    want = sorted(map(str, ((r[0], t) for r, t in zip(rows, plain(r[1:3] for r in rows), strict=True))))
    for hosts in (1000, 1):
        found = html_text.extract(df, max_hosts=hosts)
        assert found.columns == ["page_id", "url", "html", "text"]
        assert sorted(str((r.page_id, r.text)) for r in found.collect()) == want
    assert html_text.report(df.limit(0)).collect() == []


def test_given_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    sources = {r.page_id: r.html for r in pages.collect()}
    for row in html_text.report(pages).collect():
        article = re.search("(?s)<article>(.*?)(</article>|$)", sources[row.page_id])[1]
        cut = re.split("</?(?:p|h1)>", re.sub("<(?:br|/?b)>", " ", article))
        want = "\n\n".join(t for t in (" ".join(html.unescape(p).split()) for p in cut) if t)
        assert (row.text, row.n_chars) == (want, len(want))
