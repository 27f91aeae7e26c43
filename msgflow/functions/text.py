"""Text, link and markup functions. Column in, Column out; no Python runs per row."""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from msgflow import fixed_values as fv

# Unicode white space, spelled out because regex dialects disagree on \s.
WHITESPACE = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\p{Z}]+"
WHITESPACE_CHARACTERS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# One markup tag. A quote only opens an attribute value directly after "=", so
# stray quotes in a tag cannot swallow the text that follows it. The possessive
# loops keep the matcher's stack flat however many attributes a tag has.
_TAG = r"""</?[A-Za-z][^>=]*+(?:=\s*+(?:"[^"]*"|'[^']*'|)[^>=]*+)*+>"""
_COMMENT = r"<!--.*?-->"
_DECLARATION = r"<[!?][A-Za-z\[][^>]*>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), lambda bound: use(bound)), F.lit(0))


def _block(name: str, open_ended: bool = False) -> str:
    end = rf"(?:</{name}\s*>|\z)" if open_ended else rf"</{name}\s*>"
    return rf"<{name}\b[^>]*>.*?{end}"


# Markup that carries no text: used when the text nodes are simply concatenated.
_MARKUP = "(?is)" + "|".join(
    [_COMMENT, _block("script", True), _block("style", True), _block("template"), _DECLARATION, _TAG]
)
# Markup that separates visible text nodes, with whole invisible elements taken as one piece.
_INVISIBLE = "(?is)" + "|".join(
    [_COMMENT, _block("script", True), _block("style", True), _block("title"), _block("head"),
     r"<!doctype[^>]*>\s*", _DECLARATION, _TAG]
)
# Character references and the text between them; the closing semicolon may be missing.
_REFERENCE_PIECES = r"&#(?:[0-9]+|[xX][0-9A-Fa-f]+);?|&[A-Za-z][A-Za-z0-9.\-]*;?|[^&]+|&"
_NAMES = {name.rstrip(";"): characters for name, characters in html5.items()}
# What the numbers 128 to 159 stand for in pages: Windows characters where there are any.
_WINDOWS = "".join(bytes([code]).decode("cp1252", "ignore") or chr(code) for code in range(128, 160))


def _character(code: Column) -> Column:
    """The character of a code point, the replacement character where there is none."""
    exists = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return (
        F.when(code.between(128, 159), F.substring(F.lit(_WINDOWS), (code - 127).cast("int"), F.lit(1)))
        .when(exists, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        .otherwise("\ufffd")
    )


def _decode_name(name: Column) -> Column:
    hexadecimal = F.lower(F.substring(name, 2, 1)) == "x"
    # nine digits without leading zeros exceed every code point, so the rest of a longer number does not matter
    digits = F.substring(F.ltrim(F.regexp_replace(name, "^#[xX]?", ""), F.lit("0")), 1, 9)
    code = F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).try_cast("bigint")
    names = F.str_to_map(F.lit("\x1e".join(f"{n}\x1f{c}" for n, c in sorted(_NAMES.items()))), F.lit("\x1e"), F.lit("\x1f"))
    return (
        F.when(name == "", "&")
        .when(F.startswith(name, F.lit("#")), let(code, _character))
        .otherwise(F.coalesce(F.try_element_at(names, name), F.concat(F.lit("&"), name)))
    )


def _decode_piece(piece: Column) -> Column:
    return F.when(F.startswith(piece, F.lit("&")), let(F.regexp_replace(piece, "[&;]", ""), _decode_name)).otherwise(piece)


def decode_entities(text: Column) -> Column:
    """Character references to characters, in and outside ASCII.

    Every reference is decoded once, a missing semicolon is forgiven, and an
    unknown name stays as text without its semicolon.
    """

    def decode(bound: Column) -> Column:
        pieces = F.regexp_extract_all(bound, F.lit(_REFERENCE_PIECES), F.lit(0))
        decoded = F.array_join(F.transform(pieces, lambda piece: _decode_piece(piece)), "")
        return F.when(F.contains(bound, F.lit("&")), decoded).otherwise(bound)

    return let(text, decode)


def markup_text(text: Column) -> Column:
    """Text of a markup fragment: every text node, concatenated without a separator."""

    def strip(bound: Column) -> Column:
        has_tags = F.contains(bound, F.lit("<")) & F.contains(bound, F.lit(">"))
        return F.when(has_tags, F.regexp_replace(bound, _MARKUP, "")).otherwise(bound)

    return decode_entities(let(text, strip))


def letters_only(text: Column) -> Column:
    """ASCII letters in lower case, everything else collapsed to single spaces. Not trimmed."""
    return F.lower(F.regexp_replace(text, "[^a-zA-Z]+", " "))


def clean_text(text: Column) -> Column:
    """Markup text without mentions and links, reduced by `letters_only`. Null stays null."""

    def remove(bound: Column) -> Column:
        may_hold = F.contains(bound, F.lit("@")) | F.contains(bound, F.lit("http"))
        removed = F.regexp_replace(bound, f"{fv.MENTION_PATTERN}|{fv.LINK_PATTERN}", "")
        return F.when(may_hold, removed).otherwise(bound)

    return letters_only(let(markup_text(text), remove))


# A whole piece of a page: what carries no text, a tag, or text up to the next one.
_PIECES = "(?is)" + "|".join(
    [_COMMENT, _block("script", True), _block("style", True), _DECLARATION, _TAG,
     r"(?:[^<]|<(?![A-Za-z/!?]))[^<]*+(?:<(?![A-Za-z/!?])[^<]*+)*+", "<"]
)
# A page whose head holds only what heads hold, closed, and that has neither a head nor a title behind it, nor anything but text behind its end.
_PLAIN_HEAD = (
    r"(?is)\A\s*+(?:<!doctype[^>]*>\s*+)?<html\b[^>]*>\s*+<head\b[^>]*>(?:[^<]++|<!--.*?-->|<(?:meta|link|base)\b[^>]*>|"
    r"<title\b[^>]*>[^<]*+</title\s*>|<style\b[^>]*>.*?</style\s*>|<script\b[^>]*>.*?</script\s*>)*+</head\s*>"
)
_LATE_HEAD = r"(?is)</head\s*>.*?<(?:head|title)\b|</html\s*>[^<]*+<"


def visible_text(html: Column) -> Column:
    """Visible text nodes of a page, each stripped, joined with one space.

    A node is visible unless its own element is one of head, title, style, script or meta, or it lies outside
    all elements. So text of an element inside the head is visible. Elements end where they are closed, or where one
    around them is; a page with a plain head needs no look at the open elements.
    """
    page = F.replace(html, F.lit("&nbsp;"), F.lit(" "))
    plain = F.rlike(page, F.lit(_PLAIN_HEAD)) & ~F.rlike(page, F.lit(_LATE_HEAD))
    nodes = F.when(plain, _nodes_of_plain_page(page)).otherwise(_nodes_by_element(page))
    stripped = F.transform(nodes, lambda n: F.trim(n, F.lit(WHITESPACE_CHARACTERS)))
    return decode_entities(F.array_join(stripped, " "))


def _nodes_of_plain_page(page: Column) -> Column:
    ended = F.regexp_replace(page, r"(?is)(</html\s*>)[^<]*\z", "$1")
    # the first piece is the text before the first tag
    inner = let(F.split(ended, _INVISIBLE), lambda n: F.slice(n, F.lit(2), F.greatest(F.size(n) - 1, F.lit(0))))
    return F.filter(inner, lambda n: n != "")


def _nodes_by_element(page: Column) -> Column:
    """Visible nodes by a fold over the pieces of the page with the names of the open elements."""
    none = F.array().cast("array<string>")
    start = F.struct(none.alias("open"), none.alias("nodes"))

    def fold(acc: Column, piece: Column) -> Column:
        name = F.lower(F.regexp_extract(piece, r"^</?([A-Za-z][^\s/>]*)", 1))
        is_text = ~F.rlike(piece, F.lit("^<[A-Za-z/!?]"))
        closing = F.startswith(piece, F.lit("</"))
        # script and style come as whole pieces, with their text
        alone = (name == "") | name.isin(*fv.VOID_ELEMENTS, "script", "style") | F.endswith(piece, F.lit("/>"))
        # position of the element a closing tag ends, counted from the newest; 0 for none
        ended = F.array_position(F.reverse(acc["open"]), name).cast("int")
        size = F.size(acc["open"])
        own = F.when(size > 0, F.element_at(acc["open"], -1)).otherwise(F.lit(""))
        visible = is_text & (size > 0) & ~own.isin("head", "title", "meta")
        within = (
            F.when(~is_text & closing & (ended > 0), F.slice(acc["open"], F.lit(1), size - ended))
            .when(is_text | closing | alone, acc["open"])
            .otherwise(F.concat(acc["open"], F.array(name)))
        )
        nodes = F.when(visible, F.concat(acc["nodes"], F.array(piece))).otherwise(acc["nodes"])
        return F.struct(within.alias("open"), nodes.alias("nodes"))

    return F.aggregate(F.regexp_extract_all(page, F.lit(_PIECES), F.lit(0)), start, fold, lambda acc: acc["nodes"])


def extract_links(text: Column) -> Column:
    """All links of a text in order, duplicates kept.

    A link needs a dot before a lower-case letter or a digit; text without one skips the pattern.
    """
    found = F.regexp_extract_all(text, F.lit("(?U)" + fv.URL_PATTERN), F.lit(1))
    return F.when(F.rlike(text, F.lit(r"(?U)\.[a-z\d]")), found).otherwise(F.array().cast("array<string>"))


def ensure_protocol(url: Column, protocol: str = "https") -> Column:
    """Prefix the protocol unless the first four characters are already `http`."""
    return F.when(F.startswith(url, F.lit("http")), url).otherwise(F.concat(F.lit(f"{protocol}://"), url))


def extract_urls(text: Column) -> Column:
    """`extract_links` with the protocol ensured on every element."""
    return F.transform(extract_links(text), lambda link: ensure_protocol(link))


def tokens(text: Column) -> Column:
    """Tokens between runs of white space; empty ones dropped."""
    return F.filter(F.split(text, WHITESPACE), lambda t: t != "")


def fits_place(token: Column) -> Column:
    """Length allows a place name."""
    return F.length(token).between(fv.MIN_PLACE_LENGTH, fv.MAX_PLACE_LENGTH)


def place_tokens(text: Column) -> Column:
    """Lower-cased tokens whose length allows a place name."""
    return F.transform(F.filter(F.split(text, WHITESPACE), lambda t: fits_place(t)), F.lower)


def keep_parts(parts: Column) -> Column:
    """Text parts that are neither empty nor a single space."""
    return F.filter(parts, lambda p: ~p.isin(fv.BLANK_PARTS))


def join_parts(parts: Column) -> Column:
    """Text parts as one text, one part per line (null parts skipped)."""
    return F.array_join(parts, "\n")


def split_parts(text: Column) -> Column:
    """A text back to its parts, one per line."""
    return F.split(text, "\n")
