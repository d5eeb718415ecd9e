"""ARPAbet and IPA as column functions."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: ARPAbet phones in IPA.
ARPA_IPA = {
    "AA": "ɑ", "AE": "æ", "AH": "ʌ", "AO": "ɔ", "AW": "aʊ", "AY": "aɪ", "B": "b", "CH": "tʃ", "D": "d", "DH": "ð",
    "EH": "ɛ", "ER": "ɝ", "EY": "eɪ", "F": "f", "G": "ɡ", "HH": "h", "IH": "ɪ", "IY": "i", "JH": "dʒ", "K": "k",
    "L": "l", "M": "m", "N": "n", "NG": "ŋ", "OW": "oʊ", "OY": "ɔɪ", "P": "p", "R": "ɹ", "S": "s", "SH": "ʃ",
    "T": "t", "TH": "θ", "UH": "ʊ", "UW": "u", "V": "v", "W": "w", "Y": "j", "Z": "z", "ZH": "ʒ",
}
VOWELS = ("AA", "AE", "AH", "AO", "AW", "AY", "EH", "ER", "EY", "IH", "IY", "OW", "OY", "UH", "UW")
STRESS = {"0": "", "1": "ˈ", "2": "ˌ"}
TONES, ARCS = "˥˦˧˨˩", "͜͡"
DIPHTHONGS = ("aʊ", "aɪ", "eɪ", "oʊ", "ɔɪ", "tʃ", "dʒ")
#: Graphemes that stand for phones when a word is in no lexicon, longest first.
SPELLINGS = {
    "tch": "CH", "sch": "SH", "igh": "AY1", "ch": "CH", "sh": "SH", "th": "TH", "ph": "F", "wh": "W", "ck": "K", "ng": "NG", "qu": "K W",
    "ee": "IY1", "ea": "IY1", "oo": "UW1", "ou": "AW1", "ow": "OW1", "ai": "EY1", "ay": "EY1", "oi": "OY1", "oy": "OY1", "au": "AO1", "er": "ER0",
    "a": "AE1", "b": "B", "c": "K", "d": "D", "e": "EH1", "f": "F", "g": "G", "h": "HH", "i": "IH1", "j": "JH", "k": "K", "l": "L", "m": "M",
    "n": "N", "o": "AA1", "p": "P", "q": "K", "r": "R", "s": "S", "t": "T", "u": "AH1", "v": "V", "w": "W", "x": "K S", "y": "Y", "z": "Z",
}


def _table(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def arpa_ipa_table() -> dict[str, str]:
    """Phones with and without stress digits."""
    return ARPA_IPA | {v + d: mark + ARPA_IPA[v] for v in VOWELS for d, mark in STRESS.items()}


def map_symbols(symbols: Column, table: dict[str, str]) -> Column:
    """Symbol by symbol; what the table lacks stays."""
    mapping = _table(table)
    return F.transform(symbols, lambda s: F.coalesce(F.element_at(mapping, s), s))


def arpa_to_ipa(symbols: Column) -> Column:
    return map_symbols(symbols, arpa_ipa_table())


def spelled_phones(word: Column) -> Column:
    """Phones of a word by its spelling alone; letters without a rule have none."""
    table = _table(SPELLINGS)
    parts = F.regexp_extract_all(F.lower(word), F.lit("(" + "|".join(SPELLINGS) + ")"), F.lit(1))
    return F.flatten(F.transform(parts, lambda p: F.split(F.element_at(table, p), " ")))


#: Between the symbols of a row that is one text, and what goes from there where n-thongs are built.
_PART = "\uffff"
_BUILT = re.compile("|".join(f"(?<={d[0]}){_PART}(?={d[1]})" for d in DIPHTHONGS))


class _Changes(dict):
    """What becomes of a symbol: symbols parted by _PART. Each is found once."""

    def __init__(self, drop: str, breaks: bool, arcs: bool, builds: bool) -> None:
        self.drop, self.breaks, self.arcs, self.builds = str.maketrans("", "", drop), breaks, str.maketrans("", "", ARCS * arcs), builds

    def __missing__(self, symbol: str) -> str:
        made = [symbol.translate(self.drop)]
        if self.breaks:
            parts = re.split(f"[{ARCS}\u0001]", made[0])
            made = [x for p in parts for x in ((p[:-1], p[-1]) if re.sub("[ˈˌ]", "", p) in DIPHTHONGS else (p,))]
        if self.builds:
            made = made[0].split("\u0001")
        self[symbol] = found = _PART.join(x.translate(self.arcs) for x in made)
        return found

    def of(self, text: str) -> str:
        out = _PART.join([self[s] for s in text.split(_PART)])
        return _BUILT.sub("", out) if self.builds else out

    def shown(self, text: str, between: str) -> str:
        """As of(), without empty symbols and with a sign between the others."""
        return between.join(filter(None, self.of(text).split(_PART)))


def changes_ipa(ignore_tones: bool = False, ignore_arcs: bool = False, ignore_stress: bool = False, break_n_thongs: bool = False, build_n_thongs: bool = False) -> Callable[[], _Changes]:
    """What makes the five changes in a Python worker."""
    if break_n_thongs and build_n_thongs:
        raise ValueError("n-thongs can be broken or built, not both")
    return functools.partial(_Changes, TONES * ignore_tones + "ˈˌ" * ignore_stress, break_n_thongs, ignore_arcs, build_n_thongs)


def change_ipa(symbols: Column, ignore_tones: bool = False, ignore_arcs: bool = False, ignore_stress: bool = False, break_n_thongs: bool = False, build_n_thongs: bool = False) -> Column:
    """The five changes in this order; symbols that become empty go. A row's symbols are one text on their way to Python and back; where n-thongs are broken or built, U+0001 parts symbols too."""
    made = changes_ipa(ignore_tones, ignore_arcs, ignore_stress, break_n_thongs, build_n_thongs)

    @F.pandas_udf("string")
    def changed(texts: pd.Series) -> pd.Series:
        changes = made()
        return texts.map(lambda t: None if t is None else changes.of(t))

    return F.array_remove(F.split(changed(F.array_join(symbols, _PART)), _PART), "")
