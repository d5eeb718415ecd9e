"""Changes of texts and symbols, row by row."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lectern.functions import phonetics as ph
from lectern.functions import text as tx
from lectern.operators.filters import most_frequent
from lectern.saving import saved
from lectern.shipping import small_batches

#: A text without any of these is in normal form C: marks, Hangul vowels and finals, and blocks with characters that have another form.
MAYBE_DECOMPOSED = r"[\p{M}\u1161-\u1175\u11A8-\u11C2\u0340-\u037E\u0387\u0958-\u0A5E\u0B5C\u0B5D\u0F43-\u0FB9\u1F71-\u1FFD\u2000\u2001\u2126-\u212B\u2329\u232A\u2ADC\uF900-\uFB4E\x{1D15E}-\x{1D1C0}\x{2F800}-\x{2FA1D}]"

#: The steps of normalize() after normal form C: signs and what they become (all of a step at once), then white space.
SIGN_STEPS = {"double quotes": ("“”„«»", '"'), "single quotes": ("‘’‚‹›", "'"), "dashes": ("‐‑‒–—", "-")}
CONTROLS = "".join(map(chr, [*range(0x09), *range(0x0E, 0x20), 0x7F]))
WHITE = "\t\n\x0b\f\r\xa0"


def normal_form(text: Column) -> Column:
    """Unicode's normal form C. Only texts that may not be in it go to Python; the others are sent as nulls."""

    @F.pandas_udf("string")
    def composed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))

    maybe = (F.octet_length(text) != F.length(text)) & text.rlike(MAYBE_DECOMPOSED)
    return F.when(maybe, composed(F.when(maybe, text))).otherwise(text)


def normalize(text: Column) -> Column:
    """Normal form C, no control characters, plain quotes, dashes and ellipses, single spaces inside and none at the ends. ASCII texts skip the steps that can't concern them."""
    signs, become = "".join(x for x, _ in SIGN_STEPS.values()), "".join(to * len(x) for x, to in SIGN_STEPS.values())
    wide = F.replace(F.translate(normal_form(text), signs, become), F.lit("…"), F.lit("..."))
    text = F.when(F.octet_length(text) == F.length(text), text).otherwise(wide)
    text = F.when(text.rlike(r"[\x00-\x1f\x7f\xa0]"), F.translate(text, WHITE + CONTROLS, " " * len(WHITE))).otherwise(text)
    return F.btrim(F.when(F.contains(text, F.lit("  ")), F.regexp_replace(text, " {2,}", " ")).otherwise(text), F.lit(" "))


def replace(text: Column, target: str, to: str) -> Column:
    """Every occurrence of a literal string."""
    return F.replace(text, F.lit(target), F.lit(to))


def tighten_punctuation(text: Column) -> Column:
    """No space around signs that end or divide sentences."""
    return F.regexp_replace(text, r" *([.,;:!?…]) *", "$1")


def to_symbols(text: Column, symbols: str = "graphemes") -> Column:
    return tx.graphemes(text) if symbols == "graphemes" else tx.phones(text)


#: Distinct words whose phones every task may hold; of more, the most frequent ones.
IN_PLACE = 200_000
#: Around words in a text, and between symbols of a text of symbols (a code that stands for no character).
_MARK = "\uffff"
#: Letters, marks and digits with apostrophes, at least one of them none.
_TOKEN = r"(?<!')'*+[\p{L}\p{M}\p{N}][\p{L}\p{M}\p{N}']*+"
#: Signs that are a symbol each; apostrophes side by side are one.
_SIGNS = re.compile("'+|[^']", re.S)


def _with_words(df: DataFrame, column: str, lexicon: DataFrame, key: str, spelled, in_place: int) -> tuple[DataFrame, Broadcast]:
    """df with the text, marks around its words (marked_), and its rare words with their phones (rare_); and the phones of the other words."""
    text = F.translate(F.col(column), _MARK, "")
    found = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    words = df.select(F.explode(found).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    known = lexicon.select(F.col("word").alias("listed"), F.col("phones").alias("known")).dropDuplicates(["listed"])
    other = spelled(F.when(F.col("known").isNull(), F.lower("word")))
    met = words.join(known, F.lower("word") == F.col("listed"), "left").sortWithinPartitions(F.lower("word"))  # words that begin alike are spelled one after the other
    joined = met.select("word", "n", F.coalesce("known", other).alias("said"))
    said = saved(joined.select("word", "n", F.coalesce(F.array_join("said", _MARK), F.lit("")).alias("said")))
    rows, common, rare_of = df, said, F.lit(None).cast("array<string>")
    if said.count() > in_place:
        common, rare_of = saved(most_frequent(said, in_place)), F.col("rare_")
        rare = df.select(key, F.explode(F.array_distinct(found)).alias("word")).join(F.broadcast(common.select("word")), "word", "left_anti").join(said, "word")
        rows = df.join(rare.groupBy(key).agg(F.collect_list(F.concat("word", F.lit(_MARK), "said")).alias("rare_")), key, "left")
    held = df.sparkSession.sparkContext.broadcast({r["word"]: r["said"] for r in common.select("word", "said").toLocalIterator()})
    return rows.withColumns({"marked_": F.regexp_replace(text, _TOKEN, f"{_MARK}$0{_MARK}"), "rare_": rare_of}), held


def _pieces(text: str | None, rare, phones: dict[str, str]) -> Iterator[str]:
    """The symbols of each word, and of the signs between two, as a text; none is empty."""
    own = dict(x.split(_MARK, 1) for x in rare) if rare is not None else {}
    for k, piece in enumerate(text.split(_MARK) if text else ()):
        if k % 2:
            piece = own[piece] if piece in own else phones[piece]
        elif piece:
            piece = _MARK.join(_SIGNS.findall(piece) if "''" in piece else piece)
        if piece:
            yield piece


def eng_to_arpa(df: DataFrame, column: str, lexicon: DataFrame, out: str, key: str = "utt_id", spelled=ph.spelled_phones, in_place: int = IN_PLACE) -> DataFrame:
    """df with the phones of an English text; none for a null one. lexicon: word (lower case), phones. spelled: a column of words to phones, for words that it lacks.

    Only distinct words meet the lexicon and what spells; their phones are then looked up where the rows lie, in a table of a
    counted size, so no occurrence of a frequent word is shuffled. Where there are more distinct words than that, rare ones
    and their phones come to their rows by a join. Symbols go to Python and back as one text a row. U+FFFF, which is no character, goes.
    Words part at spaces and hyphens and lose the signs around them, which stay as symbols of their own; a space stands between words.
    """
    rows, held = _with_words(df, column, lexicon, key, spelled, in_place)

    @F.pandas_udf("string")
    def looked_up(texts: pd.Series, rare: pd.Series) -> pd.Series:
        phones = held.value
        return pd.Series([_MARK.join(_pieces(*x, phones)) for x in zip(texts, rare, strict=True)], dtype=object)

    spoken = rows.withColumn(out, looked_up("marked_", "rare_")).drop("marked_", "rare_")
    return spoken.withColumn(out, F.when(F.col(out) == "", F.array().cast("array<string>")).otherwise(F.split(out, _MARK)))


#: Texts of symbols whose changes a worker keeps, their length, and signs of a batch that goes back.
KEPT, KEPT_LENGTH, SENT = 1 << 16, 200, 1 << 20


class _Changed(dict):
    """What becomes of a word's symbols, or of signs, in each way. Each is found once, but for those beyond kept."""

    def __init__(self, ways: list[ph._Changes], between: str, kept: int) -> None:
        self.ways, self.between, self.kept = ways, between, kept

    def __missing__(self, text: str) -> tuple[str, ...]:
        same: dict[str, str] = {}
        found = tuple(same.setdefault(x, x) for x in (w.shown(text, self.between) for w in self.ways))
        if len(self) < self.kept and len(text) <= KEPT_LENGTH:
            self[text] = found
        return found


def eng_to_changed_ipa(df: DataFrame, column: str, lexicon: DataFrame, ways: dict[str, dict[str, bool]], between: str, key: str = "utt_id", spelled=ph.spelled_phones, in_place: int = IN_PLACE, kept: int = KEPT, sent: int = SENT) -> DataFrame:
    """key, and a text of symbols for each way, a sign between them: as change_ipa of eng_to_arpa, where the lexicon and spelled say IPA.

    Signs stand between any two words and none is half of an n-thong, so each word is changed for itself, once, and rows are put together
    of changed words. All ways are made in the pass that looks words up. It gives rows back as soon as they have so many signs as sent says, so
    a worker holds a few MB of them however long they and their batch are; batches come small.
    """
    small_batches(df.sparkSession)
    rows, held = _with_words(df, column, lexicon, key, spelled, in_place)
    rows = rows.select(key, "marked_", "rare_")
    made = [ph.changes_ipa(**how) for how in ways.values()]
    schema = StructType([rows.schema[key], *[StructField(name, StringType()) for name in ways]])

    def changed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phones, words = held.value, _Changed([m() for m in made], between, kept)
        for batch in batches:
            texts, rare, start, signs, out = batch.column(1), batch.column(2), 0, 0, [[] for _ in made]
            for i in range(batch.num_rows):
                parts = [words[p] for p in _pieces(texts[i].as_py(), rare[i].as_py(), phones)]
                for to, column in zip(out, zip(*parts) if parts else [()] * len(made), strict=True):
                    to.append(between.join(filter(None, column)))
                    signs += len(to[-1])
                if signs >= sent or i + 1 == batch.num_rows:
                    yield pa.record_batch([batch.column(0).slice(start, i + 1 - start), *[pa.array(x, pa.string()) for x in out]], names=[key, *ways])
                    start, signs, out = i + 1, 0, [[] for _ in made]

    return rows.mapInArrow(changed, schema)


def split_sentences(text: Column) -> Column:
    """Sentences of a text: a part ends after . ! or ? with white space behind."""
    return F.split(text, r"(?<=[.!?])\s+")
