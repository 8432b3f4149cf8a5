import html.parser
import random

from pyspark.sql import functions as F

from grantsieve.functions import html as H
from grantsieve.functions.fixed_values import Profile
from grantsieve.operators.records import page_texts

P = Profile()


def seen(c):
    return H.visible_markup(c, P.hidden_elements)


def test_entities(apply):
    cases = {
        "a &amp; b": "a & b",
        "&amp;lt;": "&lt;",
        "&#38;lt;": "&lt;",
        "&lt;b&gt;": "<b>",
        "&#8217;&#x2019;&#X2019;&#146;": "\u2019" * 4,
        "&eacute;&Eacute;&hearts;&NotEqualTilde;": "\u00e9\u00c9\u2665\u2242\u0338",
        "AT&T and R&D;": "AT&T and R&D",
        "&#128512;": "\U0001f600",
        "&#1114112; &#xD800;": "\ufffd \ufffd",
        "&#0039;": "'",
        "& & &": "& & &",
        "&": "&",
        "no reference": "no reference",
        "&copy 2024": "\u00a9 2024",
        "&foo;": "&foo",
    }
    assert apply(list(cases), H.decode_entities) == list(cases.values())


def test_markup_text(apply):
    cases = {
        "<p>a<b>b</b>c</p>": "a b c",
        "<p title='x>y'>a</p>": "a",
        '<p title="x>y" class=z>a</p>': "a",
        "a < b and 5<6": "a < b and 5<6",
        "a&nbsp;&nbsp;b<br/>\n c": "a b c",
        "<?xml version='1'?><!DOCTYPE html>t": "t",
        "": "",
        "<a title=\"broken>x</a>": "x",
        "a<![CDATA[in > cd]]>b": "a in > cd b",
        "a<![CDATA[x ]] y]]]]>b<!DOCTYPE c>": "a x ]] y]] b",
        "a$1<b>$2</b>": "a$1 $2",
    }
    assert apply(list(cases), H.markup_text) == list(cases.values())
    assert apply([None], H.markup_text) == [""]


def test_visible_markup_hides_comments_and_code(apply):
    cases = {
        "a<!-- <p>x</p> -->b": "a b",
        "a<SCRIPT>if (a<b) '</p>'</SCRIPT>b": "a b",
        "a<style media='x'>p{}</style>b<script src=x></script>c": "a b c",
        "a<template><p>x</p></template>b": "a b",
        "a<script src='x'/>b": "a b",
        "a<!-- x -- y - -->b": "a b",
        "a<scripty>b</scripty>c": "a b c",
    }
    assert apply(list(cases), lambda c: H.markup_text(seen(c))) == list(cases.values())


def test_root_is_chosen_by_existence(apply):
    cases = {
        "<body>x<main id=m>y</main>z</body>": "y",
        "<body>x<main></main>z</body>": "",
        "<head><title>t</title></head><body>x</body>": "x",
        "<head><title>t</title></head><p>x</p>": "t x",
        "<body><!-- <main>no</main> -->x": "x",
        "<MAIN>a</MAIN>b": "a",
        "<mainly>a</mainly>b": "a b",
        "<body>a<main>b</body>c": "b",
    }
    got = apply(list(cases), lambda c: H.markup_text(H.root_markup(seen(c), P.root_elements)))
    assert got == list(cases.values())


def test_canonical_url(apply):
    cases = {
        '<link rel="canonical" href="https://a">': "https://a",
        "<LINK HREF=' https://b?x=1&amp;y=2 ' REL='shortlink canonical'/>": "https://b?x=1&y=2",
        "<link rel=canonical href=https://c>": "https://c",
        '<link rel="canonical" href=""><link rel="canonical" href="https://no">'
        '<meta content="https://d" property="og:url">': "https://d",
        '<link rel="canonical"><meta property="og:url" content="https://e">': "https://e",
        '<link rel="canonicals" href="https://no">': "",
        '<meta property="og:url" content=""><meta property="og:url" content="https://no">': "",
        '<!-- <link rel="canonical" href="https://no"> -->': "",
        '<link rel="canonical" href="  "><meta property="og:url" content="https://no">': "",
        '<link rel="alternate" href="https://no">': "",
        '<link data-rel="canonical" href="https://no">': "",
    }
    assert apply(list(cases), lambda c: H.canonical_url(seen(c))) == list(cases.values())


def test_heading(apply):
    cases = {
        '<title>t</title><h1 class="x solicitation__title y">A <b>B</b></h1>': "A B",
        "<title>t</title><h1 class='solicitation__title'> </h1>": "t",
        "<title>t &amp; u</title><h1>plain</h1>": "t & u",
        "<h1 class=solicitation__title--big>C</h1>": "C",
        "<h1 id='solicitation__title'>no</h1>": "",
        "<h1 class='a'>no</h1><h1 class='solicitation__title'>yes</h1>": "yes",
    }
    got = apply(list(cases), lambda c: H.heading(seen(c), P.title_class))
    assert got == list(cases.values())


def test_labelled_item(apply):
    label = '<span class="document-info_label">{}</span>'
    cases = {
        f"<ul><li>x</li><li>{label.format('Posted:')} May 4, 2026</li></ul>": "Posted: May 4, 2026",
        f"<li>{label.format(' <b>POSTED:</b> ')}soon</li>": "POSTED: soon",
        f"<li>{label.format('Updated:')} May 4, 2026</li>": "",
        f"<p>{label.format('Posted:')} May 4, 2026</p>": "",
        f"<li>{label.format('Due:')} x {label.format('Posted:')} y</li>": "Due: x Posted: y",
        f"<li>a<ul><li>{label.format('Posted:')} in</li></ul></li>": "Posted: in",
    }
    got = apply(
        list(cases), lambda c: H.markup_text(H.labelled_item(seen(c), P.posted_class, "Posted:"))
    )
    assert got == list(cases.values())


VOID = {"br", "img", "meta", "link", "hr", "input"}


class Tree(html.parser.HTMLParser):
    """Elements as [name, attributes, children]; a closing tag ends the last open element of its
    name with all that is open in it, and is ignored if there is none."""

    def __init__(self, source):
        super().__init__(convert_charrefs=True)
        self.root = ["", {}, []]
        self.open = [self.root]
        self.feed(source)
        self.close()

    def handle_starttag(self, tag, attrs):
        element = [tag, dict(attrs), []]
        self.open[-1][2].append(element)
        if tag not in VOID:
            self.open.append(element)

    def handle_startendtag(self, tag, attrs):
        self.open[-1][2].append([tag, dict(attrs), []])

    def handle_endtag(self, tag):
        at = max((i for i, e in enumerate(self.open) if e[0] == tag), default=0)
        if at:
            del self.open[at:]

    def handle_data(self, data):
        self.open[-1][2].append(data)


def walk(element, above=()):
    yield element, above
    for child in element[2]:
        if not isinstance(child, str):
            yield from walk(child, (*above, element))


def text_of(element):
    def parts(e):
        for child in e[2]:
            yield from [child] if isinstance(child, str) else parts(child)

    return " ".join(" ".join(parts(element)).split())


def plain_root(source):
    tree = Tree(source).root
    for name in ("main", "body"):
        for e, _ in walk(tree):
            if e[0] == name:
                return text_of(e)
    return text_of(tree)


def plain_item(source):
    for e, above in walk(Tree(source).root):
        if e[0] == "span" and "document-info_label" in e[1].get("class", "") and text_of(e).lower() == "posted:":
            for outer in reversed(above):
                if outer[0] == "li":
                    return text_of(outer)
    return ""


def agree(apply, sources):
    roots = apply(sources, lambda c: H.markup_text(H.root_markup(seen(c), P.root_elements)))
    items = apply(sources, lambda c: H.markup_text(H.labelled_item(seen(c), P.posted_class, "Posted:")))
    for source, root, item in zip(sources, roots, items, strict=True):
        assert root == plain_root(source), source
        assert item == plain_item(source), source


SPAN = '<span class="document-info_label">Posted:</span>'


def test_nested_elements(apply):
    agree(apply, [
        "<body>a<main>b<main id=x>c</main>d</main>e<main>f</main></body>",
        "<body>a<main>b<MAIN>c</main >d<p>e</main>f</body>",
        "<body>a<main>b<main>c</main>d</body>e",
        "<body>a<body>b</body>c</body>d",
        "<body><div>a<main><div>b<div>c</div></div>d</main></div>e</body>",
        f"<ul><li>a<ul><li>b</li><li>{SPAN} c<ul><li>d</li></ul> e</li></ul>f</li></ul>",
        f"<ul><li>a<ul><li>b</li></ul>{SPAN} c<ul><li>d</li><li>e</li></ul> f</li><li>g</li></ul>",
        f"<ul><li>a<li>{SPAN} b<li>c</ul>d",
        f"<ul><li>a<ul><li>{SPAN} b</ul>c</li><li>d</li></ul>",
        f"<p>{SPAN} a</p><ul><li>b<ol><li>{SPAN} c</li></ol></li></ul>",
        f"<ul><li>a</li></ul>{SPAN} b<ul><li>c<ul><li>d</li></ul></li></ul>",
        f"<li><li>a</li>{SPAN} b<br>c<p>d</li>e",
        f"<ul><li title='a>b'>a<ul><li>b</li></ul>{SPAN} c</li></ul>",
    ])


def test_random_nesting(apply):
    rng = random.Random(11)
    items = ["<li>", "</li>", "<li class=x>", "</LI>", "<ul>", "</ul>", "<ol>", "</ol>", SPAN, "<p>p</p>", "<br>", "t ", "<b>u</b>"]
    roots = ["<main>", "</main>", "<Main id='a>b'>", "<p>p</p>", "x ", "<div>y</div>", "<br/>", "z"]
    sources = []
    for _ in range(400):
        sources.append("<body>" + "".join(rng.choice(items) for _ in range(rng.randrange(2, 16))) + "</body>")
        sources.append("<body>a" + "".join(rng.choice(roots) for _ in range(rng.randrange(2, 14))) + "</body>")
    agree(apply, sources)


class Walker(html.parser.HTMLParser):
    """Visible text of the body, by the standard library's event parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hidden, self.body, self.parts = 0, False, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in P.hidden_elements
        self.body |= tag == "body"

    def handle_endtag(self, tag):
        self.hidden -= tag in P.hidden_elements
        self.body &= tag != "body"

    def handle_data(self, data):
        if self.body and not self.hidden:
            self.parts.append(data)


def test_page_text_agrees_with_a_parser_walk(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    rows = page_texts(pages, P, ("page_id", "html")).select("page_id", "html", "text").collect()
    assert len(rows) == pages.count() > 0
    for r in rows:
        w = Walker()
        w.feed(r.html)
        w.close()
        assert r.text == " ".join(" ".join(w.parts).split()), r.page_id


def test_large_pages_do_not_overflow(apply):
    big = (
        "<html><body><!--" + "-x" * 50_000 + "--><script>" + "a<b;" * 50_000 + "</script>"
        + "<td></td>" * 50_000 + " \n" * 50_000 + "<p a='" + "x" * 100_000 + "'>t</p>"
        + "<li>" + "<i>y</i>" * 20_000 + '<span class="document-info_label">' + " " * 50_000
        + "Posted:</span> May 4, 2026</li></body>"
    )
    text = apply([big], lambda c: H.markup_text(H.root_markup(seen(c), P.root_elements)))[0]
    assert text.startswith("t y y") and text.endswith("y Posted: May 4, 2026")
    item = apply([big], lambda c: H.markup_text(H.labelled_item(seen(c), P.posted_class, "Posted:")))[0]
    assert item.endswith("Posted: May 4, 2026")


def test_boilerplate(spark):
    rows = [
        (1, "<body>Skip to MAIN content a National Science Foundation \n Search b</body>"),
        (2, "<body>National Science FoundationSearch</body>"),
        (3, "<body>National Science Foundation Searching x</body>"),
        (4, "<body>skip to main contents</body>"),
    ]
    got = page_texts(spark.createDataFrame(rows, "i int, html string"), P, ("i",)).orderBy("i")
    assert [r.text for r in got.collect()] == [
        "a b", "National Science FoundationSearch", "ing x", "skip to main contents",
    ]
    assert [r.folded for r in got.collect()] == [r.text.lower() for r in got.collect()]
    assert got.filter(F.col("text").isNull()).count() == 0


def test_attribute_references(apply):
    values = ["?x=1&lang=en", "?x=1&order=2&top=5", "&foo;b", "a&amp;b", "?a=1&copy=2", "&copy 2", "&copyx", "&#65;&#x42", "&notit;"]
    want = ["?x=1&lang=en", "?x=1&order=2&top=5", "&foo;b", "a&b", "?a=1&copy=2", "\xa9 2", "&copyx", "AB", "&notit;"]
    assert apply(values, H.decode_attribute) == want


def test_quotes_and_unclosed_scripts(apply):
    hidden = ("script", "style")

    def text(c):
        return H.markup_text(H.visible_markup(c, hidden))

    values = [
        "<p title=it's>Hello <b>it's</b> lost? <i>it's</i></p> tail", '<a href="x"" title="a > b">in</a> out',
        'a<script>var x="National";</body>', "a<script>x</script foo>b", "a<scripty>b</scripty>c",
    ]
    assert apply(values, text) == ["Hello it's lost? it's tail", "in out", "a", "a b", "a b c"]
