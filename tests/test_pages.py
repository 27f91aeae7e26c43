"""Channel page markup, cases by hand."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from msgflow.functions import records
from msgflow.operators import pages


def wrap(inner, post="chan/7", classes="tgme_widget_message_wrap js-widget_message_wrap"):
    return f'<div class="{classes}"><div class="tgme_widget_message js-widget" data-post="{post}"><div class="tgme_widget_message_bubble">{inner}</div></div></div>'


def block(markup):
    return f'<div class="tgme_widget_message_text js-message_text" dir="auto">{markup}</div>'


def parse(spark, *bodies):
    frame = spark.createDataFrame([("c", "u", "<html>" + "\n".join(bodies) + "</html>")], "channel string, url string, html string")
    return pages.parse_channel_pages(frame).orderBy("id").collect()


def test_text_parts_are_direct_children(spark):
    markup = 'Hello <b>bold <a href="x">link</a> end</b> world<br/> <br>\n<i class="emoji"><b>☂</b></i><i></i> &amp; more'
    [row] = parse(spark, wrap(block(markup)))
    assert row["text"] == ["Hello ", "bold link end", " world", "\n", "☂", " & more"]


def test_fields_of_a_full_message(spark):
    inner = (
        '<div class="tgme_widget_message_author accent"><a class="o" href="https://t.me/a?b=1&amp;c=2"><span dir="auto">A &lt;b&gt;</span></a></div>'
        '<a class="tgme_widget_message_photo_wrap 1" href="#" style="width:800px;background-image:url(\'https://c/1.jpg\')"></a>'
        "<a style=\"background-image:url('https://c/2.jpg')\" class=\"x tgme_widget_message_photo_wrap\"></a>"
        '<a class="tgme_widget_message_video_player js" href="https://v/1"><div class="tgme_widget_message_video_wrap"></div></a>'
        + block("t")
        + '<span class="tgme_widget_message_views">1.2K</span><a class="tgme_widget_message_date" href="#"><time datetime="2022-03-01T10:00:00+00:00" class="time">10:00</time></a>'
    )
    [row] = parse(spark, wrap(inner))
    assert row.asDict() == {
        "id": "7", "channel": "c", "data": "2022-03-01T10:00:00+00:00", "authorName": "A <b>", "authorLink": "https://t.me/a?b=1&c=2",
        "images": ["https://c/1.jpg", "https://c/2.jpg"], "text": ["t"], "videos": ["https://v/1"], "views": "1.2K",
    }


def test_absent_classes_give_null(spark):
    [row] = parse(spark, wrap("no text here"))
    assert [row[c] for c in ("text", "images", "videos", "views", "data", "authorName", "authorLink")] == [None] * 7


def test_invalid_ids_are_dropped(spark):
    kept = parse(spark, wrap("a", "c/12"), wrap("b", "c/x"), wrap("c", "c/-4"), wrap("d", "c/1/2"), wrap("e", "9"), wrap("f", "c/0"))
    assert [r["id"] for r in kept] == ["0", "12", "9"]


def test_container_class_must_match_exactly(spark):
    assert parse(spark, wrap("a", classes="tgme_widget_message_wrap"), wrap("b", classes="x tgme_widget_message_wrap js-widget_message_wrap")) == []


def summary(spark, html):
    frame = spark.createDataFrame([("c", "u", html)], "channel string, url string, html string")
    return pages.page_summary(frame).first()


def test_page_summary(spark):
    row = summary(spark, wrap("a", "c/12") + wrap("b", "c/x") + wrap("c", "c/5", "service tgme_widget_message_wrap"))
    assert (row["messages"], row["ids"], row["max_id"]) == (3, [12, 5], 12)
    empty = summary(spark, '<div class="tgme_widget_message_wrap"><div>No posts found</div></div>')
    assert (empty["messages"], empty["ids"], empty["max_id"]) == (0, [], 0)
    none = summary(spark, "<html></html>")
    assert (none["messages"], none["max_id"]) == (0, 0)


def test_channel_addresses(spark):
    given = ["t.me/abc", "https://t.me/s/abc", "https://t.me/abc", "x.org", "t.me/s/abc", "https://www.t.me/abc", "http://t.me/a?u=t.me/b", "not.me/abc", "https://x.org/t.me/abc", "t.me/", None]
    frame = spark.createDataFrame(list(enumerate(given)), "i int, a string")
    url = records.channel_url(F.col("a"))
    got = frame.select("i", url.alias("u"), records.channel_name(url).alias("n")).orderBy("i").collect()
    full = "https://t.me/s/abc"
    assert [r["u"] for r in got] == [full, full, full, None, full, full, "http://t.me/s/a?u=t.me/b", None, None, None, None]
    assert [r["n"] for r in got] == ["abc", "abc", "abc", None, "abc", "abc", "a?u=t.me/b", None, None, None, None]


def test_options_and_counter(spark):
    frame = spark.createDataFrame([("False", None), ("FALSE", 9999), ("no", 3), ("None", 0)], "v string, n bigint")
    got = frame.select(records.option_flag(F.col("v")), records.option_text(F.col("v")), records.next_transaction(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [(False, "False", 1), (False, "FALSE", 0), (True, "no", 4), (True, None, 1)]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.text(alphabet="abZ <>&;\"'/=#é☂19", max_size=12), max_size=4), min_size=1, max_size=60))
def test_any_text_survives_render_and_parse(spark, messages):
    given_rows = [(str(i), parts) for i, parts in enumerate(messages)]
    frame = spark.createDataFrame(given_rows, "id string, text array<string>")
    fixed = {c: F.lit(c) for c in ("channel", "authorName", "authorLink", "views", "data")}
    html = frame.select(F.lit("c").alias("channel"), F.lit("u").alias("url"), pages.render_container({"id": F.col("id"), "text": F.col("text"), **fixed}).alias("html"))
    got = {r["id"]: r["text"] for r in pages.parse_channel_pages(html).collect()}
    assert got == {i: [p for p in parts if p not in ("", " ")] for i, parts in given_rows}


def test_render_and_parse_round_trip(spark):
    message = {
        "channel": "c&d", "id": "3", "authorName": 'A "q" <b>', "authorLink": "https://t.me/x?a=1&b=2", "text": ["one & two", "<three>", "&amp;"],
        "images": ["https://c/1?a=1&b=2"], "videos": ["https://v/2"], "views": "5", "data": "2024-01-01T00:00:00Z",
    }
    frame = spark.createDataFrame([tuple(message.values())], "channel string, id string, authorName string, authorLink string, text array<string>, images array<string>, videos array<string>, views string, data string")
    html = frame.select("channel", F.lit("u").alias("url"), pages.render_container({c: F.col(c) for c in message}).alias("html"))
    assert pages.parse_channel_pages(html).first().asDict() == message


def test_text_blocks_with_inner_and_unclosed_elements(spark):
    bodies = [
        block('<div class="q">inner <b>x</b></div> after') + "<div>not text</div>",
        block("first<br/><b>unclosed text"),
        block("<b><i>one</b>two</i> three") + "tail",
        block("a < b &lt; caf&eacute; &#1080;&#x438; x&nbsp;y"),
    ]
    got = parse(spark, *[wrap(b, f"c/{i}") for i, b in enumerate(bodies)])
    assert [r["text"] for r in got] == [["inner x", " after"], ["first", "unclosed text"], ["one", "two", " three"], ["a < b < café ии x\u00a0y"]]


def test_author_without_name_takes_nothing_from_behind(spark):
    inner = '<div class="tgme_widget_message_author"></div><a href="https://x/y"><span class="tgme_widget_message_views">9K</span></a>'
    [row] = parse(spark, wrap(inner))
    assert (row["authorName"], row["authorLink"], row["views"]) == (None, None, "9K")
