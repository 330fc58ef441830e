"""Helpers of the tests; a module name of its own, so that no other folder's
conftest can stand before it."""

from __future__ import annotations

SF_SMALL = "/root/testdata/sf0.001"


def rows(df, *cols):
    """Collected rows as sorted tuples (of the given columns, or all)."""
    picked = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
