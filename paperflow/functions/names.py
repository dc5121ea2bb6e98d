"""Names of columns."""

from __future__ import annotations

from collections.abc import Iterable


def fresh(name: str, taken: Iterable[str]) -> str:
    """A column name that is not taken, in any case."""
    known = {t.lower() for t in taken}
    while name.lower() in known:
        name += "_"
    return name
