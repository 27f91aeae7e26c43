"""Text functions against hand-written cases and against a parser from the standard library."""

import re
from html.entities import html5
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from msgflow import fixed_values as fv
from msgflow.functions import text

PAGES = "/root/testdata/sf0.01/pages.parquet"


def apply(spark, function, values):
    """function over values, one result per value, in order."""
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r["o"] for r in rows.select("i", function(F.col("v")).alias("o")).orderBy("i").collect()]


CASES = [
    ("Hi @bob see https://x.y/z 42!", "hi see "),
    ("Привет мир", " "),
    ("a<b>c</b>d", "acd"),
    ("x<!-- no -->y<script>var a='</p>'</script>z", "xyz"),
    ("fish &amp; chips &lt;b&gt;", "fish chips b "),
    ("caf&eacute; &copy 2020 &unknown;", "caf unknown"),
    ("1 < 2 and 3 > 2", " and "),
    ("&#65;&#x42; &#1087;", "ab "),
    ("say &commat;bob", "say "),
    ('<a title="a > b">in</a>', "in"),
    ("<a title=it's>in</a> out", "in out"),
    ("", ""),
    (None, None),
]


def test_clean_text_cases(spark):
    assert apply(spark, text.clean_text, [c[0] for c in CASES]) == [c[1] for c in CASES]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=200))
def test_clean_text_is_letters_and_idempotent(spark, values):
    once = apply(spark, text.clean_text, values)
    assert all(re.fullmatch("[a-z ]*", v) and "  " not in v for v in once)
    assert apply(spark, text.clean_text, once) == once


def reference_urls(value):
    return [u if u.startswith("http") else "https://" + u for u in re.findall(fv.URL_PATTERN, value)]


# One case for each part of the rule: scheme, top level of two to six letters, trailing dot, port, address, path, word boundary.
URLS = [
    f"{scheme}{host}{port}{path}{end}"
    for scheme in ("", "http://", "https://", "ftp://")
    for host in ("h0st.io", "H.io", "a-b.c.museum", "a.museums", "x.y", "7.7.7.7", "7.7.7.256", "Ö.at")
    for port in ("", ":1", ":99999", "65535", "65536")
    for path in ("", "/", "/p_1/q-2.z", "/é?k=v#f")
    for end in ("", ".", ",x", "!")
] + ["no link", "", "p@q.org", "one.ab two.cd/e three"]


def test_urls_equal_the_pattern_in_python(spark):
    assert apply(spark, text.extract_urls, URLS) == [reference_urls(u) for u in URLS]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="abzAZ019.:/-_ whtpsé", max_size=60), min_size=1, max_size=300))
def test_urls_random(spark, values):
    assert apply(spark, text.extract_urls, values) == [reference_urls(u) for u in values]


def test_ensure_protocol(spark):
    given_urls = ["www.a.com", "http://a.com", "httpbin.org"]
    once = apply(spark, text.ensure_protocol, given_urls)
    assert once == ["https://www.a.com", "http://a.com", "httpbin.org"]
    assert apply(spark, text.ensure_protocol, once) == once


def test_tokens(spark):
    words = ["L" * n for n in range(1, 13)] + ["Ünder", "x1y2"]
    sentence = "\t".join(words) + " \u2003\n"
    assert apply(spark, text.tokens, [sentence]) == [words]
    assert apply(spark, text.place_tokens, [sentence]) == [[w.lower() for w in words if 4 <= len(w) <= 10]]


def test_parts(spark):
    rows = spark.createDataFrame([(["a", "", " ", "b", "  "],)], "p array<string>")
    row = rows.select(
        text.keep_parts(F.col("p")).alias("k"), text.split_parts(text.join_parts(text.keep_parts(F.col("p")))).alias("s")
    ).first()
    assert row["k"] == ["a", "b", "  "] and row["s"] == ["a", "b", "  "]


class VisibleNodes(HTMLParser):
    """Text nodes with their parents; a text node ends at any tag, comment or declaration."""

    VOID = set("area base br col embed hr img input link meta source track wbr".split())
    NAMES = {n.rstrip(";"): c for n, c in html5.items()}

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.stack, self.nodes, self.open = ["[document]"], [], None

    def flush(self):
        if self.open is not None and self.stack[-1] not in ("style", "script", "head", "title", "meta", "[document]"):
            self.nodes.append(self.open.strip())
        self.open = None

    def add(self, data):
        self.open = (self.open or "") + data

    def handle_starttag(self, tag, attrs):
        self.flush()
        if tag not in self.VOID:
            self.stack.append(tag)

    def handle_endtag(self, tag):
        self.flush()
        if tag in self.stack[1:]:
            while self.stack.pop() != tag:
                pass

    def handle_comment(self, data):
        self.flush()

    def handle_decl(self, decl):
        self.flush()

    def handle_data(self, data):
        self.add(data)

    def handle_entityref(self, name):
        char = self.NAMES.get(name)
        self.add(f"&{name}" if char is None else char.replace("\xa0", " "))

    def handle_charref(self, name):
        code = int(name[1:], 16) if name[0] in "xX" else int(name)
        self.add(chr(code))


def parsed_text(page):
    parser = VisibleNodes()
    parser.feed(page)
    parser.close()
    parser.flush()
    return " ".join(parser.nodes)


HTML = [
    "<html>\n<head>\n<title>T</title></head><body>\n<p>one <b>two</b>\n three</p>\n</body>\n</html>\n",
    "<!DOCTYPE html>\n<html><body><p>x</p><!-- c --><style>p{}</style>y<br>z</body></html>",
    "plain text only",
    "lead <p>a &amp; b &lt;c&gt;</p>",
    "<div>one<script>if (a < b) '</p>'</script>two</div>",
    "<p>&nbsp;</p><p> a\tb </p>",
    '<a title="x > y">t</a>',
    "<html><head><noscript>seen</noscript></head><body>b</body></html>",
    "<html><head>lost<title>lost</title><div>one<p>two</div>lost</head>html<body>b</body></html>",
    "<html><head><meta name=x><title>lost<b>in</b>lost</title>lost<body>b<p>c",  # a head that is never closed
    "<html><head><title>never closed<body>lost?<p>seen</p></body></html>",
    "<p>a</p>outside<p>b</p>outside",
    "<html><head></head><body>x</body></html>after<p>seen</p>after",
    "<html><head></head><body>x<title>lost</title><svg><title>lost<i>in</i></title>y</svg></body></html>",
    "<div>a<br/>b<i/>c</i>d</span>e<SCRIPT>f</SCRIPT >g</DIV>h",
    "<html><head><!-- <title> --><title>t</title></head><body>1 < 2<head>lost<b>x</b></head>z</body></html>",
]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from(
    ["<html>", "</html>", "<head>", "</head>", "<body>", "</body>", "<title>", "</title>", "<p>", "</p>", "<b>", "</b>", "<br>", "<meta x=1>", "<i/>", "<!-- c -->", "<style>s</style>",
     "<!DOCTYPE html>", "text", " t ", "\n", "&amp;"]), max_size=25).map("".join), min_size=1, max_size=120))
def test_visible_text_of_any_nesting(spark, pages):
    assert apply(spark, text.visible_text, pages) == [parsed_text(p) for p in pages]


@pytest.mark.parametrize("page", HTML)
def test_visible_text_cases(spark, page):
    assert apply(spark, text.visible_text, [page]) == [parsed_text(page)]


def test_visible_text_of_all_pages_equals_a_parser(spark):
    rows = spark.read.parquet(PAGES).select("html", text.visible_text(F.col("html")).alias("v")).collect()

    def squeeze(value):
        return re.sub(r"\s+", " ", value)

    assert len(rows) == 250
    assert [squeeze(r["v"]) for r in rows] == [squeeze(parsed_text(r["html"])) for r in rows]


def test_long_and_broken_input_is_processed(spark):
    """Whole texts, without deep matcher stacks or quadratic work."""
    many_slashes = "x.com" + "/a" * 50_000 + " end"
    many_attributes = "<a " + "b=c " * 50_000 + ">t</a>"
    no_close = "a <b x=1 " * 50_000
    spaces = "<p>" + "a" + " " * 200_000 + "b</p>"
    assert apply(spark, text.extract_urls, [many_slashes]) == [["https://x.com" + "/a" * 50_000]]
    assert apply(spark, text.clean_text, [many_attributes]) == ["t"]
    assert apply(spark, text.clean_text, [no_close]) == ["a b x " * 50_000]
    assert apply(spark, text.visible_text, [spaces]) == ["a" + " " * 200_000 + "b"]


def test_character_references_become_their_characters(spark):
    given = ["caf&eacute; &#1080;&#x438;", "&#128;&#150;", "&#0;&#xD800;&#99999999999;", "&#0000065;&#x000041", "a&nbsp;b &unknown; & &amp;lt;", "&#128514;&fjlig;"]
    want = ["café ии", "€–", "�" * 3, "AA", "a b &unknown & &lt;", "😂fj"]
    assert apply(spark, text.decode_entities, given) == want
