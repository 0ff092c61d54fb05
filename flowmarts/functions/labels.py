"""Label text repair and label-to-category lookup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowmarts.functions.lookups import mapped
from flowmarts.schema import LABEL_CATEGORIES, OTHER

# What counts as surrounding white space, as a damaged run and as the web-attack prefix.
_BLANK = r"[\s\p{Z}\x0B\x1C-\x1F\x85]"
_EDGES = rf"^{_BLANK}+|{_BLANK}+$"
_DAMAGED = r"[^\x00-\x7F–—]+"
_WEB_ATTACK = r"Web Attack[\s\x0B\x1C-\x1F]*[–-][\s\x0B\x1C-\x1F]*"


def normalise_label(label: Column) -> Column:
    """Trim, turn each damaged run into one hyphen, unify the web-attack dash.

    Null stays null.
    """
    trimmed = F.regexp_replace(label, _EDGES, "")
    repaired = F.translate(F.regexp_replace(trimmed, _DAMAGED, "-"), "—", "–")
    return F.regexp_replace(repaired, _WEB_ATTACK, "Web Attack – ")


def category_of(label: Column) -> Column:
    """Attack category of a normalised label; unknown or null gives ``Other``."""
    return mapped(label, LABEL_CATEGORIES, OTHER)
