"""All registered queries and SQL texts by name."""

from __future__ import annotations

from registered import channels, places, scored, streams, texts, training

MODULES = [texts, places, channels, training, streams, scored]


def all_queries():
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_sql():
    return {name: text for module in MODULES for name, text in module.SQL.items()}
