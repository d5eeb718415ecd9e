"""The two ready-made sequences of operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.phonetics import spelled_phones
from lectern.operators import filters, greedy, transforms
from lectern.operators.selection import remove_deselected
from lectern.plans.corpus import Corpus
from lectern.saving import saved_table

#: What the first pass finds undesired.
UNDESIRED = ("/", "\\", "-", ":", "@", ";", "*", "%", '"', "(", ")", "[", "]", "{", "}", "quote", "oswald", "ye", "hath", "pp.")
#: The bands of durations in their order, and the speed at which they are read.
BANDS = ((8.0, float("inf")), (4.0, 8.0), (0.0, 4.0))
BAND_SPEED = 14.0


def remove_duplicates(corpus: Corpus) -> Corpus:
    return corpus.keep(filters.first_of_duplicates(corpus.utterances, "repr"))


def remove_rare_words(corpus: Corpus, least: int) -> Corpus:
    return corpus.keep(filters.without_rare_words(corpus.utterances, "repr", least))


def remove_unknown_words(corpus: Corpus, lexicon: DataFrame, most: int, rules: list | None = None) -> Corpus:
    return corpus.keep(filters.without_unknown_words(corpus.utterances, "repr", lexicon, most, corpus.language, rules=rules))


def to_arpa(corpus: Corpus, lexicon: DataFrame, target: str = "repr", spelled=spelled_phones) -> Corpus:
    rows = transforms.eng_to_arpa(corpus.utterances.drop(f"{target}_syms"), target, lexicon, f"{target}_syms", spelled=spelled)
    rows = rows.withColumn(target, F.array_join(f"{target}_syms", " "))
    return corpus.changed(rows.select(*corpus.utterances.columns), **{f"{target}_format": "arpa"})


def to_ipa(corpus: Corpus, target: str = "repr") -> Corpus:
    from lectern.functions.phonetics import arpa_to_ipa

    return corpus.map_symbols(target, arpa_to_ipa, "ipa")


def prepare(corpus: Corpus, lexicon: DataFrame, pronunciations: DataFrame) -> Corpus:
    """Acronyms go, texts are normalised, then duplicates, rare words, names, undesired texts, short and unknown ones go; the rest is made phones.

    The order matters: frequencies are those of the corpus that is left. After normalisation symbols are those of the texts, so rows
    go without them until they are phones. Steps that read their rows several times find them saved.
    """
    r = F.col("repr")
    stored = lambda c: c.changed(saved_table(c.utterances))
    return corpus.then(
        lambda c: c.remove(filters.has_acronym(r, 3)),
        lambda c: c.map("both", transforms.normalize),
        Corpus.without_symbols,
        remove_duplicates,
        stored,
        lambda c: remove_rare_words(c, 2),
        lambda c: c.remove(filters.has_proper_name(r, c.language)),
        lambda c: c.remove(filters.has_undesired(r, UNDESIRED)),
        lambda c: c.remove(filters.word_count_outside(r, 3)),
        stored,
        lambda c: remove_unknown_words(c, lexicon, 0),
        stored,
        Corpus.with_symbols,
        lambda c: to_arpa(c, pronunciations),
        lambda c: c.remove(filters.has_undesired(r, ("'",))),
        to_ipa,
    )


def select_bands(corpus: Corpus, minutes: float = 1.0, bands=BANDS, n: int = 1, ignore: frozenset[str] = frozenset(), speed: float = BAND_SPEED) -> Corpus:
    """For each band of durations so many minutes, every band on what is selected already; what is not selected goes."""
    for band in bands:
        corpus = greedy.select_greedy(corpus, "kld", n, minutes, ignore=ignore, band=band, speed=speed)
    return remove_deselected(corpus)
