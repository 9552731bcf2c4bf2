"""Every operator exercised on the star-schema tables, each with an equivalent SQL statement."""

from __future__ import annotations

from plumbline.plans.star.base import Query


def all_queries() -> dict[str, Query]:
    from plumbline.plans.star import epochs, events, indicators, layout, literacy, operations, rows, search, summaries

    out: dict[str, Query] = {}
    for module in (rows, indicators, events, epochs, layout, summaries, operations, search, literacy):
        duplicate = out.keys() & module.QUERIES.keys()
        if duplicate:
            raise ValueError(f"query names used twice: {sorted(duplicate)}")
        out.update(module.QUERIES)
    return out
