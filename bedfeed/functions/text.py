"""Text cleaning and payload archiving."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# ASCII stand-ins for common non-ASCII characters.
ASCII_TABLE = {
    "‘": "'",
    "’": "'",
    "‚": "'",
    "′": "'",
    "“": '"',
    "”": '"',
    "„": '"',
    "″": '"',
    "®": "(R)",
    "©": "(C)",
    "™": "(TM)",
    "…": "...",
    "�": "?",
    "–": "-",
    "—": "-",
    "‹": "<",
    "›": ">",
    "˜": "~",
    "ˆ": "^",
}

_NON_ASCII = "[^\\x00-\\x7F]"
_CODECS = ("zlib", "none")


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def sanitize_ascii(text: Column, table: Mapping[str, str] = ASCII_TABLE) -> Column:
    """Replace mapped characters by their stand-ins and every other non-ASCII character by ``?``.

    ASCII text, the usual case, is passed through after a length check.
    """
    table = {k: v for k, v in table.items() if len(k) == 1 and ord(k) > 127}
    if not all(v.isascii() for v in table.values()):
        # A stand-in may itself be non-ASCII here, so each character is mapped exactly once.
        pairs = [F.lit(x) for kv in table.items() for x in kv]
        stand_ins = F.create_map(*pairs)
        chars = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
        cleaned = F.array_join(
            F.transform(
                chars,
                lambda c: F.when(is_ascii(c), c).otherwise(
                    F.coalesce(F.try_element_at(stand_ins, c), F.lit("?"))
                ),
            ),
            "",
        )
        return F.when(is_ascii(text), text).otherwise(cleaned)
    single = {k: v for k, v in table.items() if len(v) == 1}
    cleaned = text
    if single:
        cleaned = F.translate(cleaned, "".join(single), "".join(single.values()))
    for char, stand_in in table.items():
        if char not in single:
            cleaned = F.replace(cleaned, F.lit(char), F.lit(stand_in))
    return F.when(is_ascii(text), text).otherwise(F.regexp_replace(cleaned, _NON_ASCII, "?"))


def non_ascii_chars(text: Column) -> Column:
    """The distinct non-ASCII characters of a text."""
    return F.when(is_ascii(text), F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.regexp_extract_all(text, F.lit(f"({_NON_ASCII})"), F.lit(1)))
    )


@F.pandas_udf(StringType())
def _deflate(texts: pd.Series) -> pd.Series:
    return texts.map(
        lambda t: base64.b64encode(zlib.compress(t.encode("utf-8"), level=1)).decode("ascii"),
        na_action="ignore",
    )


@F.pandas_udf(StringType())
def _inflate(texts: pd.Series) -> pd.Series:
    return texts.map(
        lambda t: zlib.decompress(base64.b64decode(t)).decode("utf-8"), na_action="ignore"
    )


def _codec(name: str) -> str:
    if name.lower() not in _CODECS:
        raise ValueError(f"unsupported compression {name!r}: use one of {_CODECS}")
    return name.lower()


def archive_payload(text: Column, compression: str = "zlib") -> Column:
    """Text to base64 of its zlib level 1 stream, or unchanged for ``none``."""
    return text if _codec(compression) == "none" else _deflate(text)


def restore_payload(text: Column, compression: str = "zlib") -> Column:
    return text if _codec(compression) == "none" else _inflate(text)
