"""Signals over text fields, and ordered rules over signals. Rules are data; code
holds none. :mod:`siftloom.operators.scan` looks for them."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass


@dataclass(frozen=True)
class Signal:
    """Fires when at least ``least`` of its patterns (case counts) and keyword
    terms (whole words, any case) occur in some field."""

    name: str
    keywords: tuple[str, ...] = ()
    patterns: tuple[str, ...] = ()
    least: int = 1


@dataclass(frozen=True)
class Composite:
    """Fires when all its components do."""

    name: str
    all_of: tuple[str, ...]


@dataclass(frozen=True)
class Rule:
    """Gives its topic and category when all of ``all_of`` fire and none of ``none_of``."""

    rule_id: str
    order: int
    topic: str
    category: str
    all_of: tuple[str, ...] = ()
    none_of: tuple[str, ...] = ()


def term_pattern(term: str) -> str | None:
    """Whole words of a term next to each other; ``*`` at its end stands for any
    ending. None for a term without a word character."""
    stem = term.endswith("*")
    words = re.findall(r"\w+", term)
    if not words:
        return None
    return r"(?iuU)(?<!\w)" + r"\W+".join(re.escape(w) for w in words) + (r"\w*" if stem else "") + r"(?!\w)"


def unusable(terms: Sequence[str]) -> list[str]:
    """Terms that no text can match."""
    return [t for t in terms if term_pattern(t) is None]
