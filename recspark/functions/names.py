"""Names for helper columns."""

from __future__ import annotations

from collections.abc import Iterable


def fresh(columns: Iterable[str], *names: str) -> list[str]:
    """``names``, each with as many underscores before it as it takes to differ from all ``columns``, whatever the case."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
