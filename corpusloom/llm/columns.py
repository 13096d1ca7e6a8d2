"""Column names that cannot clash."""

from __future__ import annotations


def free_name(taken: list[str], name: str) -> str:
    """``name``, lengthened until no column is called so (names differ by more than case)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name
