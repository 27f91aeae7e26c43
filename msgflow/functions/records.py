"""Small functions over ids, options, channel addresses and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from msgflow import fixed_values as fv


def message_id(data_post: Column) -> Column:
    """Id part of `channel/123`: everything after the first slash."""
    return F.regexp_replace(data_post, r"^[^/]*/", "")


def valid_id(text_id: Column) -> Column:
    """True when the id is an integer that is not negative."""
    return F.coalesce(text_id.try_cast("bigint") >= 0, F.lit(False))


def option_flag(value: Column) -> Column:
    """Only `false`, in any case, is false."""
    return F.lower(value) != "false"


def option_text(value: Column) -> Column:
    """`none`, in any case, is null."""
    return F.when(F.lower(value) != "none", value)


def channel_url(address: Column) -> Column:
    """Canonical preview address of a channel; null for anything that is not a channel address.

    An address is an optional scheme (https without one), the channel host, and a path, whose
    leading preview step is optional. Only the part before the path is looked at for the host.
    """
    parts = rf"^(?:([A-Za-z][A-Za-z0-9+.-]*)://)?(?:www\.)?{fv.CHANNEL_HOST.replace('.', '[.]')}/(?:s/)?(.+)$"
    scheme, path = (F.regexp_extract(address, parts, n) for n in (1, 2))
    return F.when(path != "", F.concat(F.coalesce(F.nullif(scheme, F.lit("")), F.lit("https")), F.lit(f"://{fv.CHANNEL_HOST}/s/"), path))


def channel_name(url: Column) -> Column:
    """Channel name: what follows the preview path of a canonical address."""
    return F.regexp_extract(url, rf"{fv.CHANNEL_HOST.replace('.', '[.]')}/s/(.*)$", 1)


def channel_page_url(channel: Column, message: Column | None, parameters: list[tuple[str, Column]]) -> Column:
    """Address of one page of a channel: optional message id, then the non-null parameters."""
    base = F.concat(F.lit(f"https://{fv.CHANNEL_HOST}/s/"), channel)
    if message is not None:
        base = F.concat_ws("/", base, message.cast("string"))
    pairs = [F.concat(F.lit(f"{name}="), value.cast("string")) for name, value in parameters]
    query = F.concat_ws("&", *pairs) if pairs else F.lit("")
    return F.when(query == "", base).otherwise(F.concat(base, F.lit("?"), query))


def query_text(keywords: Column) -> Column:
    """Keyword query as sent in an address: spaces become plus signs."""
    return F.replace(keywords, F.lit(" "), F.lit("+"))


def binary_label(sentiment: Column) -> Column:
    return F.when(sentiment == 4, 1).otherwise(0)


def emotion(prediction: Column) -> Column:
    """1.0 is positive; everything else, null included, is negative."""
    return F.when(prediction == 1.0, fv.POSITIVE).otherwise(fv.NEGATIVE)


def next_transaction(current: Column) -> Column:
    """Counter after one more write; a missing counter starts at its first value."""
    return F.coalesce(F.pmod(current + 1, F.lit(fv.TRANSACTION_MODULUS)), F.lit(fv.FIRST_TRANSACTION)).cast("bigint")


def page_key(url: Column) -> Column:
    """Address without query, fragment and trailing slashes: what a cited link and a crawled page share."""
    return F.regexp_replace(url, r"(?s)/*(?:[?#].*)?\z", "")
