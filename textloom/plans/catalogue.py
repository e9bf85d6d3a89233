"""All queries of the engine, by name, with their SQL counterparts."""

from __future__ import annotations

from textloom.plans import articles, convert, ledgers, markdown, prose, records, search, selection, sinks, streams, structure, style

_PARTS = (search, ledgers, prose, structure, markdown, selection, articles, style, records, convert, sinks, streams)


def merged(dicts) -> dict:
    """All entries of the dicts; a name that two of them have is an error."""
    out = {}
    for one in dicts:
        if twice := out.keys() & one.keys():
            raise ValueError(f"queries of the same name: {sorted(twice)}")
        out |= one
    return out


QUERIES = merged(part.QUERIES for part in _PARTS)
ORACLES = merged(part.ORACLES for part in _PARTS)
