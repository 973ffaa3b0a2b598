"""Part-of-day labels for an ``HHmm`` time text.

Two rules exist in the reference and they disagree on unpadded text, so
both are offered:

* ``by_hour``  - integer hour from the first two characters
  (5-11 morning, 12-16 afternoon, 17-20 evening, >=21 or <=4 night,
  anything else, NULL included, the unknown label);
* ``by_text`` - lexicographic ranges on the raw text
  ('0500'-'1159', '1200'-'1659', '1700'-'2059', >='2100' or <='0459').

``pad=True`` left-pads the text to four digits first (off by default, as in
the reference).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lenient import _col, text_prefix, to_int

# Label sets, in the order
# (morning, afternoon, evening, night, unknown).
ENGLISH = ("Morning", "Afternoon", "Evening", "Night", "Unknown")
GREEK = ("Πρωί", "Απόγευμα", "Βράδυ", "Νύχτα", "Unknown")
GREEKLISH = ("PRWI", "APOGEVMA", "VRADY", "NIXTA", "UNKNOWN")

# The day-part boundaries (hours, inclusive).
MORNING_HOURS = (5, 11)
AFTERNOON_HOURS = (12, 16)
EVENING_HOURS = (17, 20)
NIGHT_FROM, NIGHT_TO = 21, 4

# The same boundaries as HHmm text.
MORNING_TEXT = ("0500", "1159")
AFTERNOON_TEXT = ("1200", "1659")
EVENING_TEXT = ("1700", "2059")
NIGHT_TEXT_FROM, NIGHT_TEXT_TO = "2100", "0459"


def _time(c: str | Column, pad: bool) -> Column:
    t = _col(c)
    return F.lpad(t, 4, "0") if pad else t


def hour_of(c: str | Column, pad: bool = False) -> Column:
    """Integer hour from the first two characters of ``HHmm`` text."""
    return to_int(text_prefix(_time(c, pad), 2))


def by_hour(c: str | Column, labels=ENGLISH, pad: bool = False) -> Column:
    h = hour_of(c, pad)
    morning, afternoon, evening, night, unknown = labels
    return (
        F.when(h.between(*MORNING_HOURS), morning)
        .when(h.between(*AFTERNOON_HOURS), afternoon)
        .when(h.between(*EVENING_HOURS), evening)
        .when((h >= NIGHT_FROM) | (h <= NIGHT_TO), night)
        .otherwise(unknown)
    )


def by_text(c: str | Column, labels=ENGLISH, pad: bool = False) -> Column:
    t = _time(c, pad)
    morning, afternoon, evening, night, unknown = labels
    return (
        F.when((t >= MORNING_TEXT[0]) & (t <= MORNING_TEXT[1]), morning)
        .when((t >= AFTERNOON_TEXT[0]) & (t <= AFTERNOON_TEXT[1]), afternoon)
        .when((t >= EVENING_TEXT[0]) & (t <= EVENING_TEXT[1]), evening)
        .when((t >= NIGHT_TEXT_FROM) | (t <= NIGHT_TEXT_TO), night)
        .otherwise(unknown)
    )
