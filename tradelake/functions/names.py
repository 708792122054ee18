"""Driver-side helpers on column names (metadata only, never data)."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable


def _select(columns, patterns, exclude, test) -> list[str]:
    # pattern-major order: all matches of the first pattern (in column order),
    # then new matches of the next one, like a tidy selection helper
    pats = [patterns] if isinstance(patterns, str) else list(patterns)
    cols = [c for c in columns if c not in set(exclude)]
    out: list[str] = []
    for p in pats:
        for c in cols:
            if test(c.lower(), p.lower()) and c not in out:
                out.append(c)
    return out


def match_prefix(columns: Iterable[str], prefixes: Iterable[str] | str, exclude: Iterable[str] = ()) -> list[str]:
    """Columns whose name starts with a prefix, ignoring case; grouping keys excluded."""
    return _select(list(columns), prefixes, exclude, str.startswith)


def match_suffix(columns: Iterable[str], suffixes: Iterable[str] | str, exclude: Iterable[str] = ()) -> list[str]:
    """Columns whose name ends with a suffix, ignoring case."""
    return _select(list(columns), suffixes, exclude, str.endswith)


def snake_name(name: str) -> str:
    """ASCII snake_case: accents dropped, camelCase split, non-alphanumerics to '_'."""
    s = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    s = re.sub(r"[^0-9A-Za-z]+", "_", s).strip("_").lower()
    if not s:
        s = "x"
    if s[0].isdigit():
        s = "x" + s
    return s


def clean_names(columns: Iterable[str]) -> list[str]:
    """snake_case names; a repeated name gets ``_2``, ``_3`` ... appended."""
    out, seen = [], {}
    for c in columns:
        n = snake_name(c)
        if n in seen:
            seen[n] += 1
            n = f"{n}_{seen[n]}"
        else:
            seen[n] = 1
        out.append(n)
    return out
