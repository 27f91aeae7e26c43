"""Channel pages to message records.

A page is one row, and everything is taken out of it by expressions on that row:
no shuffle, and no state larger than a page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from msgflow import fixed_values as fv
from msgflow.functions import records, text


# A tag, or text up to the next one; a "<" that begins no tag is text.
_MARKUP_PIECES = r"</?[A-Za-z!?][^>]*>|(?:[^<]|<(?![A-Za-z/!?]))[^<]*+(?:<(?![A-Za-z/!?])[^<]*+)*+|<"


def _class(name: str) -> str:
    """An attribute list in which `name` is one of the classes."""
    return rf"""[^>]*?\bclass="(?:[^"]*\s)?{name}(?:\s[^"]*)?"[^>]*"""


def _open(tags: str, name: str) -> str:
    return rf"<(?:{tags})\b{_class(name)}>"


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag, null when it is absent."""
    pattern = rf"""\s{name}="([^"]*)\""""
    found = lambda t: F.when(F.rlike(t, F.lit(pattern)), F.regexp_extract(t, pattern, 1))
    return text.decode_entities(text.let(tag, found))


def _first(html: Column, pattern: str, group: int = 1) -> Column:
    """First match, null when there is none."""
    pattern = "(?s)" + pattern
    return F.when(F.rlike(html, F.lit(pattern)), F.regexp_extract(html, pattern, group))


def _first_tag(html: Column, tag: str) -> Column:
    """First match of a pattern whose group 1 is a whole tag, null when there is none."""
    return F.nullif(F.regexp_extract(html, "(?s)" + tag, 1), F.lit(""))


def containers(html: Column) -> Column:
    """Markup of every message container of a page, in page order."""
    marker = rf"""<div\b[^>]*\bclass="{fv.CONTAINER_CLASSES}"[^>]*>"""
    return _pieces(html, marker)


def _pieces(html: Column, marker: str) -> Column:
    return text.let(F.split(html, marker), lambda p: F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))))


def post_id(container: Column) -> Column:
    """Id text of a container, null when it has none."""
    return records.message_id(_attribute(_first_tag(container, f"({_open('div', fv.MESSAGE_CLASS)})"), "data-post"))


def _author(container: Column) -> Column:
    """Markup of the author element; a search in it never reaches what follows."""
    return _first(container, rf"{_open('div', fv.AUTHOR_CLASS)}(.*?)(?:</div\s*>|\z)")


def author_name(container: Column) -> Column:
    return text.markup_text(_first(_author(container), r"<span\b[^>]*>(.*?)</span\s*>"))


def author_link(container: Column) -> Column:
    return _attribute(_first_tag(_author(container), r"(<a\b[^>]*>)"), "href")


def post_time(container: Column) -> Column:
    date = _first(container, rf"{_open('a', fv.DATE_CLASS)}(.*?)(?:</a\s*>|\z)")
    return _attribute(_first_tag(date, r"(<time\b[^>]*>)"), "datetime")


def views(container: Column) -> Column:
    return text.markup_text(_first(container, rf"{_open('span', fv.VIEWS_CLASS)}(.*?)</span\s*>"))


def text_parts(container: Column) -> Column:
    """Direct children of the text block: bare text as it is, an element as its whole text.

    Pieces of markup are folded left to right with the names of the open elements. A
    closing tag ends the newest open element of its name and all inside it, and is
    ignored when there is none; the `</div>` without one is the end of the block. Text
    of elements still open there is a part as well.
    """
    pieces = F.regexp_extract_all(_first(container, rf"{_open('div', fv.TEXT_CLASS)}(.*)"), F.lit(_MARKUP_PIECES), F.lit(0))
    none = F.array().cast("array<string>")
    start = F.struct(none.alias("within"), F.lit("").alias("open"), none.alias("parts"), F.lit(False).alias("ended"))

    def fold(acc: Column, piece: Column) -> Column:
        name = F.lower(F.regexp_extract(piece, r"^</?([A-Za-z][^\s/>]*)", 1))
        is_tag = F.rlike(piece, F.lit("^</?[A-Za-z!?]"))
        closing = is_tag & F.startswith(piece, F.lit("</"))
        alone = F.rlike(piece, F.lit(r"(?i)^<(?:!|\?|(?:br|img|hr|wbr|input|source)\b)|/>$"))
        # position of the element a closing tag ends, counted from the newest; 0 for none
        ended = F.array_position(F.reverse(acc["within"]), name).cast("int")
        size = F.size(acc["within"])
        within = (
            F.when(closing & (ended > 0), F.slice(acc["within"], F.lit(1), size - ended))
            .when(~is_tag | closing | alone, acc["within"])
            .otherwise(F.concat(acc["within"], F.array(name)))
        )
        grown = F.when(is_tag, acc["open"]).otherwise(F.concat(acc["open"], piece))

        def step(left: Column) -> Column:
            # a part is complete outside all elements: after bare text, or when an element closes
            done = (F.size(left) == 0) & (~is_tag | closing)
            return F.struct(
                left.alias("within"),
                F.when(done, F.lit("")).otherwise(grown).alias("open"),
                F.when(done, F.concat(acc["parts"], F.array(grown))).otherwise(acc["parts"]).alias("parts"),
                F.lit(False).alias("ended"),
            )

        end = F.struct(acc["within"].alias("within"), acc["open"].alias("open"), acc["parts"].alias("parts"), F.lit(True).alias("ended"))
        past = acc["ended"] | (closing & (name == "div") & (ended == 0))
        return F.when(past, end).otherwise(text.let(within, step))

    parts = F.aggregate(pieces, start, fold, lambda acc: F.concat(acc["parts"], F.array(acc["open"])))
    return text.keep_parts(F.transform(parts, text.decode_entities))


def image_links(container: Column) -> Column:
    """Background image addresses of the photo elements."""
    tags = F.regexp_extract_all(container, F.lit(f"({_open('div|a', fv.PHOTO_CLASS)})"), F.lit(1))
    return F.transform(tags, lambda tag: F.regexp_extract(_attribute(tag, "style"), r"\('([^']*)'\)", 1))


def video_links(container: Column) -> Column:
    """Targets of the video player anchors."""
    tags = F.regexp_extract_all(container, F.lit(f"({_open('a', fv.VIDEO_PLAYER_CLASS)})"), F.lit(1))
    return F.transform(tags, lambda tag: _attribute(tag, "href"))


def relevant_classes(container: Column) -> Column:
    """Which of the content classes occur on a div or anchor of the container, each once."""
    present = [
        F.when(F.rlike(container, F.lit(_open("div|a", name))), F.lit(name))
        for name in (fv.TEXT_CLASS, fv.PHOTO_CLASS, fv.VIDEO_CLASS)
    ]
    return F.array_distinct(F.filter(F.array(*present), lambda c: c.isNotNull()))


def parse_channel_pages(pages: DataFrame, min_id: int | Column = 0) -> DataFrame:
    """One row per message container with a valid id of at least `min_id`.

    `text`, `images` and `videos` are null unless their class occurs in the container.
    """
    boxes = pages.select("channel", F.explode(containers(F.col("html"))).alias("_box"))
    boxes = boxes.withColumn("id", post_id(F.col("_box")))
    # an id that is no number compares as null and is dropped
    kept = boxes.where(F.col("id").try_cast("bigint") >= F.greatest(F.lit(0), F.lit(min_id) if isinstance(min_id, int) else min_id))
    box = F.col("_box")
    found = kept.withColumn("_classes", relevant_classes(box))

    def when_present(name: str, value: Column) -> Column:
        return F.when(F.array_contains("_classes", name), value)

    return found.select(
        "id",
        post_time(box).alias("data"),
        "channel",
        author_name(box).alias("authorName"),
        author_link(box).alias("authorLink"),
        when_present(fv.PHOTO_CLASS, image_links(box)).alias("images"),
        when_present(fv.TEXT_CLASS, text_parts(box)).alias("text"),
        when_present(fv.VIDEO_CLASS, video_links(box)).alias("videos"),
        views(box).alias("views"),
    )


def _wraps(html: Column) -> Column:
    return _pieces(html, _open("div", fv.WRAP_CLASS))


def message_count(html: Column) -> Column:
    """Message containers of a page; the single no-posts notice counts as none."""

    def count(wraps: Column) -> Column:
        notice = F.trim(text.markup_text(F.get(wraps, F.lit(0)))) == fv.NO_POSTS_TEXT
        return F.when((F.size(wraps) == 1) & notice, 0).otherwise(F.size(wraps)).cast("bigint")

    return text.let(_wraps(html), count)


def page_ids(html: Column) -> Column:
    """Valid ids of a page as numbers, in page order."""
    ids = F.transform(_wraps(html), lambda w: post_id(w))
    return F.transform(F.filter(ids, records.valid_id), lambda i: i.try_cast("bigint"))


def max_page_id(html: Column) -> Column:
    """Largest id of a page, 0 when it has none."""
    return F.coalesce(F.array_max(page_ids(html)), F.lit(0).cast("bigint"))


def page_summary(pages: DataFrame) -> DataFrame:
    """Message count, ids and largest id of every page."""
    html = F.col("html")
    return pages.select(
        "channel", "url", message_count(html).alias("messages"), page_ids(html).alias("ids"), max_page_id(html).alias("max_id")
    )


def render_container(message: dict[str, Column]) -> Column:
    """Container markup of one message, the layout that `parse_channel_pages` reads.

    Needs channel, id, authorName, authorLink, text (array), data and views.
    Optional: images and videos (arrays, left out when empty).
    """

    def escape(value: Column) -> Column:
        for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
            value = F.replace(value, F.lit(char), F.lit(name))
        return value

    def listed(name: str, one) -> Column:
        if name not in message:
            return F.lit("")
        return F.array_join(F.transform(F.coalesce(message[name], F.array().cast("array<string>")), one), "")

    photo = lambda u: F.concat(
        F.lit(f'<a class="{fv.PHOTO_CLASS} grouped" href="#" style="width:100%;background-image:url(\''), escape(u), F.lit("')\"></a>")
    )
    video = lambda u: F.concat(
        F.lit(f'<a class="{fv.VIDEO_PLAYER_CLASS}" href="'), escape(u), F.lit(f'"><div class="{fv.VIDEO_CLASS}"></div></a>')
    )
    return F.concat(
        F.lit(f'<div class="{fv.CONTAINER_CLASSES}"><div class="{fv.MESSAGE_CLASS} js-widget_message" data-post="'),
        escape(message["channel"]), F.lit("/"), message["id"].cast("string"),
        F.lit(f'"><div class="{fv.BUBBLE_CLASS}"><div class="{fv.AUTHOR_CLASS}"><a class="owner" href="'),
        escape(message["authorLink"]), F.lit('"><span dir="auto">'), escape(message["authorName"]), F.lit("</span></a></div>"),
        listed("images", photo), listed("videos", video),
        F.lit(f'<div class="{fv.TEXT_CLASS} js-message_text" dir="auto">'),
        F.array_join(F.transform(message["text"], escape), "<br/>"),
        F.lit(f'</div><span class="{fv.VIEWS_CLASS}">'), escape(message["views"]),
        F.lit(f'</span><a class="{fv.DATE_CLASS}" href="#"><time datetime="'), escape(message["data"]),
        F.lit('" class="time"></time></a></div></div></div>'),
    )
