"""Code -> label decoding for the victim-descent code.

The 19-entry table is a literal map inside the expression (no join, no
broadcast, stays in codegen); unknown codes decode to themselves, NULL stays
NULL.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lenient import _col

# Descent code -> label, as published with the incident data.
DESCENT_LABELS = (
    ("A", "Other Asian"),
    ("B", "Black"),
    ("C", "Chinese"),
    ("D", "Cambodian"),
    ("F", "Filipino"),
    ("G", "Guamanian"),
    ("H", "Hispanic/Latin/Mexican"),
    ("I", "American Indian/Alaskan Native"),
    ("J", "Japanese"),
    ("K", "Korean"),
    ("L", "Laotian"),
    ("O", "Other"),
    ("P", "Pacific Islander"),
    ("S", "Samoan"),
    ("U", "Hawaiian"),
    ("V", "Vietnamese"),
    ("W", "White"),
    ("X", "Unknown"),
    ("Z", "Asian Indian"),
)


def label_map(pairs=DESCENT_LABELS) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs)])


def decode(c: str | Column, pairs=DESCENT_LABELS) -> Column:
    """Label of the code, or the code itself when it is not in the table."""
    code = _col(c)
    return F.coalesce(F.try_element_at(label_map(pairs), code), code)
