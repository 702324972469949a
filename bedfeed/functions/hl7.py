"""HL7 text as column expressions.

The default separators apply (``|`` field, ``~`` repetition, ``^`` component, ``&`` subcomponent), also to messages
that name others, unless these are brought to the default form first; escapes are not decoded. All expressions are null-safe: a missing field is ``''``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the content of MSH.2, which is never split.
ENCODING_CHARS = "^~\\&"

# The characters 4 to 8 of a message: field, component, repetition, escape and subcomponent separator.
SEPARATORS = "|" + ENCODING_CHARS
_SPLITTING = SEPARATORS.replace("\\", "")
# Characters that no text has: they stand for characters that are separators by default but not in their message.
HELD = "".join(chr(0xFDD0 + i) for i in range(len(_SPLITTING)))


def with_default_separators(message: Column) -> Column:
    """A message with its own separators, as its first segment names them, replaced by the default ones.

    One pass over the text. Characters that are separators by default but not in this message are held back as values;
    ``held_values`` brings them back after the splitting. MSH.2 reads as the default characters; escapes stay as they are.
    A text that does not start with ``MSH`` and five separators stays as it is; of a character named twice, the first
    use counts.
    """
    own = F.substring(message, 4, len(SEPARATORS))
    splitting = F.concat(F.substring(own, 1, 3), F.substring(own, 5, 1), F.lit(_SPLITTING))
    named = message.startswith("MSH") & (F.length(own) == len(SEPARATORS)) & ~own.rlike("[\\r\\n]")
    rest = F.call_function("translate", F.substring(message, 4 + len(SEPARATORS), 2**31 - 1), splitting, F.lit(_SPLITTING + HELD))
    return F.when(named & (own != SEPARATORS), F.concat(F.lit("MSH" + SEPARATORS), rest)).otherwise(message)


def held_values(value: Column) -> Column:
    """A value with the characters that ``with_default_separators`` held back."""
    return F.translate(value, HELD, _SPLITTING)


def label(segment: Column) -> Column:
    """Segment name: the text before the first field separator."""
    return F.substring_index(segment, "|", 1)


def is_named(segment: Column, name: str) -> Column:
    """Whether a segment has a name, without cutting the name out."""
    return F.startswith(segment, F.lit(name + "|")) | (segment == name)


def fields(segment: Column) -> Column:
    """Fields of one segment; index 0 is the segment name."""
    return F.split(segment, "\\|", -1)


def field(segment_fields: Column, index: int) -> Column:
    """Field at a list index, ``''`` when the segment is shorter."""
    return F.coalesce(F.get(segment_fields, F.lit(index)), F.lit(""))


def repetitions(text: Column) -> Column:
    return F.split(text, "~", -1)


def subcomponents(text: Column) -> Column:
    return F.split(text, "&", -1)


def components(text: Column) -> Column:
    """Components of the first repetition, each cut to its first subcomponent.

    Used for structured fields (identifiers, names, locations). A field that mixes repetitions or
    subcomponents with components has no flat form, so the first of each is taken.
    """
    first = F.substring_index(text, "~", 1)
    parts = F.split(first, "\\^", -1)
    return F.when(
        first.contains("&"), F.transform(parts, lambda c: F.substring_index(c, "&", 1))
    ).otherwise(parts)


def top_level_list(text: Column) -> Column:
    """Elements of a field at its outermost separator; a plain field is a list of one."""
    return (
        F.when(text == ENCODING_CHARS, F.array(text))
        .when(text.contains("~"), repetitions(text))
        .when(text.contains("^"), F.split(text, "\\^", -1))
        .when(text.contains("&"), subcomponents(text))
        .otherwise(F.array(text))
    )


def is_list(text: Column) -> Column:
    """True when a field holds more than one element at some level."""
    return (text != ENCODING_CHARS) & (
        text.contains("^") | text.contains("~") | text.contains("&")
    )


def flat_text(text: Column) -> Column:
    """A field read as one string: the elements of a flat list are joined with ``^``.

    Fields that nest separators have no flat form and keep their raw text.
    """
    comp, rep, sub = text.contains("^"), text.contains("~"), text.contains("&")
    joined = F.when(rep & ~sub, F.replace(text, F.lit("~"), F.lit("^"))).when(
        sub & ~rep, F.replace(text, F.lit("&"), F.lit("^"))
    )
    return F.when((rep | sub) & ~comp, F.coalesce(joined, text)).otherwise(text)
