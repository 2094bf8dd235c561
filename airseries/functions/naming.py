"""Column names from labels."""

from __future__ import annotations


def slug(label: str) -> str:
    """Lower-case name of a category label: words joined by ``_``, without ``for`` and ``Groups``."""
    words = [w for w in label.replace("_", " ").split() if w not in ("for", "Groups")]
    return "_".join(words).lower()
