"""SQL text for the functions the queries share."""

from __future__ import annotations

from html.entities import name2codepoint

from msgflow import fixed_values as fv

# Patterns of this module's own, for the markup that the given tables hold.
_ANY_TAG = r"""</?[a-z](?:"[^"]*"|'[^']*'|[^'">])*>"""
_NO_TEXT = r"<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
_FRAGMENT = rf"(?is){_NO_TEXT}|<template\b[^>]*>.*?</template\s*>|{_ANY_TAG}|<![a-z\[][^>]*>"
_PAGE = rf"(?is){_NO_TEXT}|<head\b[^>]*>.*?</head\s*>|<title\b[^>]*>.*?</title\s*>|<![a-z][^>]*>\s*|{_ANY_TAG}"
# White space of Unicode: controls, the space, the next line, and the separators.
_BLANKS = [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_BLANK_CLASS = "[" + "".join(rf"\x{{{code:X}}}" for code in _BLANKS) + "]+"


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def decode(x: str) -> str:
    names = sorted(name2codepoint)
    codes = f"map([{', '.join(quoted(n) for n in names)}], [{', '.join(str(name2codepoint[n]) for n in names)}])"
    name = "rtrim(substr(p, 2), ';')"
    one = (
        "CASE WHEN NOT starts_with(p, '&') OR p = '&' THEN p "
        f"WHEN regexp_matches(p, '^&#[xX]') THEN chr(CAST('0x' || substr({name}, 3) AS INTEGER)) "
        f"WHEN starts_with(p, '&#') THEN chr(CAST(substr({name}, 2) AS INTEGER)) "
        f"WHEN {codes}[{name}] IS NULL THEN '&' || {name} ELSE chr({codes}[{name}]) END"
    )
    pieces = r"regexp_extract_all({x}, '&#[xX][0-9A-Fa-f]+;?|&#[0-9]+;?|&[A-Za-z][A-Za-z0-9.\-]*;?|[^&]+|&')".format(x=x)
    return f"CASE WHEN contains({x}, '&') THEN array_to_string(list_transform({pieces}, lambda p: {one}), '') ELSE {x} END"


def markup(x: str) -> str:
    return decode(f"regexp_replace({x}, {quoted(_FRAGMENT)}, '', 'g')")


def letters(x: str) -> str:
    return f"lower(regexp_replace({x}, '[^a-zA-Z]+', ' ', 'g'))"


def clean(x: str, has_markup: bool = True) -> str:
    """Cleaned text; `has_markup=False` leaves out the markup step for text that holds none."""
    inner = markup(x) if has_markup else x
    return letters(f"regexp_replace({inner}, {quoted(fv.MENTION_PATTERN + '|' + fv.LINK_PATTERN)}, '', 'g')")


def visible(x: str) -> str:
    page = f"replace(regexp_replace({x}, '(?is)(</html\\s*>)[^<]*\\z', '\\1'), '&nbsp;', ' ')"
    nodes = f"list_filter(list_slice(string_split_regex({page}, {quoted(_PAGE)}), 2, 1000000000), lambda n: n <> '')"
    edge = ' || '.join(f'chr({code})' for code in _BLANKS)
    return decode(f"array_to_string(list_transform({nodes}, lambda n: trim(n, {edge})), ' ')")


def links(x: str) -> str:
    return f"regexp_extract_all({x}, {quoted(fv.URL_PATTERN)}, 1)"


def protocol(x: str) -> str:
    return f"CASE WHEN starts_with({x}, 'http') THEN {x} ELSE 'https://' || {x} END"


def page_key(x: str) -> str:
    return f"regexp_replace({x}, '(?s)/*(?:[?#].*)?\\z', '')"


def domain(x: str) -> str:
    host = f"lower(regexp_extract({x}, '^(?:https?://)?([^/:?#]+)', 1))"
    return f"array_to_string(list_slice(string_split({host}, '.'), -2, -1), '.')"


def words(x: str) -> str:
    return f"string_split_regex({x}, {quoted(_BLANK_CLASS)})"


def place_words(x: str) -> str:
    return f"list_transform(list_filter({words(x)}, lambda w: length(w) BETWEEN 4 AND 10), lambda w: lower(w))"


def md5_number(x: str, seed: int) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || CAST({x} AS VARCHAR)), 1, 8) AS BIGINT)"


def gazetteer() -> str:
    """Cleaned gazetteer rows (pos, name, population, latitude, longitude as text)."""
    word_list = place_words(clean("text", False))
    number = (
        "CASE WHEN ends_with(rtrim({v}, '0'), '.') THEN rtrim({v}, '0') || '0' ELSE rtrim({v}, '0') END"
    )
    lat = "CAST(item_id % 10 + 40 AS VARCHAR) || '.' || lpad(CAST((i - 1) % 100 AS VARCHAR), 2, '0')"
    lon = "CAST(item_id % 7 + 22 AS VARCHAR) || '.' || lpad(CAST((i - 1) % 10 * 10 AS VARCHAR), 2, '0')"
    return f"""
  SELECT item_id * 10000 + i - 1 AS pos, w AS name, length(w) * 1000 + item_id AS population,
         {number.format(v='lat')} AS latitude, {number.format(v='lon')} AS longitude
  FROM (SELECT *, {lat} AS lat, {lon} AS lon
        FROM (SELECT item_id, unnest({word_list}) AS w, generate_subscripts({word_list}, 1) AS i FROM benchmark))"""


def first_places() -> str:
    return f"""
  SELECT name AS city, 'POINT(' || longitude || ' ' || latitude || ')' AS location
  FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY pos) AS r FROM ({gazetteer()})) WHERE r = 1"""
