"""Text equality that does not depend on how accents are stored.

``é`` may be one code point or an ``e`` and a combining accent; Unicode calls both canonically
equivalent, a byte comparison does not.  The values this library compares with are few and known, so every
equivalent spelling of one is listed once: an ``IN`` over these literals stays in the JVM, reaches the
Parquet scan as a filter, and a null stays null.
"""

from __future__ import annotations

import unicodedata
from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F


def equivalent_forms(text: str) -> list[str]:
    """Every canonically equivalent spelling of ``text``, the composed one first.

    Each letter with its accents is composed, decomposed or in between (one accent after another joined to its letter).
    """
    composed = unicodedata.normalize("NFC", text)
    per_letter = []
    for letter in composed:
        parts = unicodedata.normalize("NFD", letter)
        between = [unicodedata.normalize("NFC", parts[:k]) + parts[k:] for k in range(2, len(parts) + 1)]
        per_letter.append(list(dict.fromkeys([letter, *between, parts])))
    return ["".join(p) for p in product(*per_letter)]


def same_text(c: Column, text: str) -> Column:
    """``c = text`` for every canonically equivalent spelling (null: null)."""
    forms = equivalent_forms(text)
    return c.isin(forms) if len(forms) > 1 else c == F.lit(text)


def one_spelling(c: Column, values: tuple[str, ...]) -> Column:
    """``c`` with each equivalent spelling of one of ``values`` replaced by the composed one; all else as it is."""
    out = None
    for v in values:
        others = equivalent_forms(v)[1:]
        if others:
            hit = c.isin(others)
            out = F.when(hit, F.lit(unicodedata.normalize("NFC", v))) if out is None else out.when(
                hit, F.lit(unicodedata.normalize("NFC", v)))
    return c if out is None else out.otherwise(c)
