"""Column functions over utterance texts: words, symbols, n-grams, durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The signs stripped from both ends of a word.
PUNCTUATION = ".,;-/!?:\\—()[]{}\"'"
#: Symbols spoken in a second.
READING_SPEED = 13.7


def is_blank(text: Column) -> Column:
    """No character but Unicode white space (with the separators U+001C-1F that Java's class leaves out)."""
    return text.rlike(r"(?U)^[\s\x1c-\x1f]*$")


def split_words(text: Column) -> Column:
    """Pieces between single spaces: two spaces in a row hold an empty word."""
    return F.split(text, " ")


def strip_punctuation(word: Column) -> Column:
    return F.btrim(word, F.lit(PUNCTUATION))


def stripped_words(text: Column) -> Column:
    """Words without punctuation at their ends, without empty ones."""
    return F.filter(F.transform(split_words(text), strip_punctuation), lambda w: w != "")


def stripped_text(text: Column) -> Column:
    return F.array_join(stripped_words(text), " ")


def is_upper(word: Column) -> Column:
    """At least one cased letter and no lower-case or title-case one."""
    return word.rlike(r"\p{IsUppercase}") & ~word.rlike(r"[\p{IsLowercase}\p{Lt}]")


#: Characters whose capital form is several characters, and the one character that stands for it where there is one.
_WIDE = "".join(chr(c) for c in range(0xDF, 0xFB18) if not 0xD800 <= c < 0xE000 and len(chr(c).upper()) > 1)
_WIDE_UPPER = "".join({"ß": "ẞ"}.get(c, c.title() if len(c.title()) == 1 else c) for c in _WIDE)
_PLACES = "".join(chr(0x10FE00 + i) for i in range(len(_WIDE)))


def upper_signs(text: Column) -> Column:
    """Capital letters character by character: none becomes several, as ß does in upper()."""
    return F.when(F.octet_length(text) == F.length(text), F.upper(text)).otherwise(F.translate(F.upper(F.translate(text, _WIDE, _PLACES)), _PLACES, _WIDE_UPPER))


def graphemes(text: Column) -> Column:
    """Every character a symbol; an empty text has none."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ""))


def phones(text: Column) -> Column:
    """Symbols written with single spaces between them."""
    return F.filter(F.split(text, " "), lambda s: s != "")


def symbols_text(symbols: Column) -> Column:
    return F.array_join(symbols, "")


def ngrams(symbols: Column, n: int) -> Column:
    """Arrays of n neighbouring symbols; none where there are fewer.

    The symbols are bound to a variable first: inside a lambda their expression would be evaluated anew for every window.
    """
    if n == 1:
        return F.transform(symbols, lambda s: F.array(s))

    def windows(s: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(s) - (n - 1)), lambda i: F.slice(s, i, n))

    none = F.array().cast("array<array<string>>")
    return F.flatten(F.transform(F.array(symbols), lambda s: F.when(F.size(s) >= n, windows(s)).otherwise(none)))


def duration_s(symbols: Column, speed: float = READING_SPEED) -> Column:
    return F.size(symbols) / F.lit(float(speed))


def zero_filled(number: Column, largest: Column) -> Column:
    """The number with zeros before it, as long as the largest one."""
    return F.lpad(number.cast("string"), F.length(largest.cast("string")), "0")
