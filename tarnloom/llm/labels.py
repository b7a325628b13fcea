"""Language labels as pages carry them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LANGS = ("en", "de", "fr", "es", "it")
# Two- and three-letter codes and English names of the languages.
NAMES = {
    "en": ("en", "eng", "english"),
    "de": ("de", "deu", "ger", "german"),
    "fr": ("fr", "fra", "fre", "french"),
    "es": ("es", "spa", "spanish", "castilian"),
    "it": ("it", "ita", "italian"),
}


def language_code(label: Column) -> Column:
    """Two-letter code that a label names, whatever its case and region; NULL for none of LANGS."""
    base = F.regexp_extract(F.lower(F.trim(label)), r"^([a-z]+)(?:[-_.\s(].*)?$", 1)
    out = F.lit(None).cast("string")
    for code, names in NAMES.items():
        out = F.when(base.isin(*names), F.lit(code)).otherwise(out)
    return out
