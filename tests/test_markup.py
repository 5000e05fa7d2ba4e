"""The tag stream against a stack machine over the standard library's parser."""

import random
from html import unescape
from html.parser import HTMLParser

from pyspark.sql import functions as F

from trendlake.operators import markup, pages

VOID = {"br", "img", "hr", "meta", "input", "link"}


class Stack(HTMLParser):
    """(name, place of opening, text of all descendants) of every element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.done = [], []

    def handle_starttag(self, tag, attrs):
        if tag == "p":
            self.close("p")
        element = [tag, self.getpos(), "", dict(attrs).get("lang")]
        self.done.append(element)
        if tag not in VOID:
            self.open.append(element)

    def close(self, tag):
        if any(e[0] == tag for e in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_endtag(self, tag):
        self.close(tag)

    def handle_data(self, data):
        if not (self.open and self.open[-1][0] in ("script", "style")):
            for e in self.open:
                e[2] += data


def stack(html):
    machine = Stack()
    machine.feed(html)
    machine.close("")
    return [(e[0], e[2], e[3]) for e in machine.done if e[0] not in ("script", "style")]


def random_html(rng, depth=0):
    out = []
    for _ in range(rng.randint(1, 4)):
        kind = rng.random()
        if kind < 0.35 or depth > 4:
            out.append(rng.choice(["a word ", "R&amp;D ", "é&#233;&#xe9; ", "x < y ", "&copy;", "\n", "5 &gt; 4"]))
        elif kind < 0.45:
            out.append(rng.choice(["<br>", "<BR/>", "<img alt='a > b'>", "<!-- <div> -->", "<script>var d='</div>';</script>",
                                   "<style>p > b {}</style>"]))
        else:
            name = rng.choice(["div", "div", "span", "article", "b", "i"])
            attr = rng.choice(["", ' lang="en"', " lang='f&amp;r'", " LANG=de", ' title="x > y" lang="q"', " hidden"])
            shown = name.upper() if rng.random() < 0.2 else name
            out.append(f"<{shown}{attr}>{random_html(rng, depth + 1)}</{name}>")
    return "".join(out)


def parsed(spark, htmls):
    df = spark.createDataFrame([(i, h) for i, h in enumerate(htmls)], "i int, h string").select(
        "i", F.explode(F.array(markup.parse(F.col("h")))).alias("d"))
    d = F.col("d")
    rows = df.select("i", F.transform("d.els", lambda x: F.struct(
        x["name"], markup.text_of(d, x).alias("t"), markup.attribute(x, "lang").alias("l"))).alias("e"),
        markup.written(d).alias("w")).orderBy("i").collect()
    return [[tuple(e) for e in r.e] for r in rows], [r.w for r in rows]


def test_equals_a_stack_machine(spark):
    rng = random.Random(11)
    htmls = [random_html(rng) for _ in range(150)]
    htmls += ["<p>one<p>two</p>", "<div><p>a<b>b</div>c", "<div><span>u</div>v", "", "no tags", "<div", "<article><p>x</article>y",
              "<div>" * 300 + "deep" + "</div>" * 300]
    got, written = parsed(spark, htmls)
    assert written == htmls
    for html, elements in zip(htmls, got):
        if html != "<div":
            assert elements == stack(html), html


def test_references_as_browsers_read_them(spark):
    texts = ["&amp;lt;", "&lt&gt", "&notit;", "&#0;&#128;&#x110000;&#xD800;", "&#99999999999999999999;", "&unknown; &", "&#x1F600;",
             "&CounterClockwiseContourIntegral;", "a & b &; &#; &#x;", "&nbsp;&eacute;&AMP;", "&ampere", None, ""]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select(
        "i", markup.decode_references(F.col("t")).alias("d")).orderBy("i").collect()
    assert [r.d for r in rows] == [unescape(t) if t is not None else None for t in texts]


def test_every_selector_and_the_collectors_order(spark):
    post = "<article>{}</article>"
    htmls = {
        '<div data-testid="tweetText">one <div>two</div> three</div>': "one two three",
        "<div data-testid='tweetText'>q</div><div lang=en>not this</div>": "q",
        '<div lang="en" data-testid="card">card</div><div lang="en">text</div>': "text",
        '<div lang="en" data-testid="card">card</div>': "card",
        "<DIV DIR=auto>auto</DIV><p>par</p>": "auto",
        '<div dir="auto" data-testid="x">no</div><span lang="fr">span</span>': "span",
        "<P>upper</P>": "upper",
        "<b>short</b>": "",
        "<b>long enough text</b>": "long enough text",
    }
    df = spark.createDataFrame([(i, post.format(h)) for i, h in enumerate(htmls)], "page_id int, html string")
    got = {r.page_id: r.content for r in pages.page_posts(df).collect()}
    assert [got[i] for i in range(len(htmls))] == list(htmls.values())


def test_quoted_post_is_cut_by_its_own_end(spark):
    html = ('<article data-testid="tweet"><div data-testid="User-Name">Me @me</div><div data-testid="tweetText">mine</div>'
            '<div><div data-testid="tweet"><div data-testid="User-Name"><span>@other now</span></div>'
            '<div data-testid="tweetText">theirs <div>too</div></div></div></div><p>after</p></article>')
    r = pages.page_posts(spark.createDataFrame([(1, html)], "page_id int, html string")).first()
    assert (r.content, r.quoted_username, r.quoted_content, r.is_repost) == ("mine theirs too", "other", "theirs too", True)
