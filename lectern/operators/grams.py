"""N-grams of symbols, counted in Arrow batches where the rows lie, so that only counts are shuffled."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Between the symbols of an n-gram that is written as one string.
SEPARATOR = "\u0001"
#: Numbers of symbols of more than one character begin here; the others are their code points.
_LONG = 0x110000


def joined_symbols(symbols: Column) -> list[Column]:
    """A row's symbols as one string, and whether each is one character (then nothing is between them)."""
    single = (F.length(F.array_join(symbols, "")) == F.size(symbols)) & ~F.array_contains(symbols, "")
    return [F.when(single, F.array_join(symbols, "")).otherwise(F.array_join(symbols, SEPARATOR)).alias("text_"), single.alias("single_")]


class Batch:
    """Symbols of rows in a row, as numbers."""

    def __init__(self, texts: Iterable[str], single: Iterable[bool]) -> None:
        self.names: list[str] = []
        known: dict[str, int] = {}
        parts = []
        for text, one in zip(texts, single, strict=True):
            if one:
                parts.append(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64))
            else:
                parts.append(np.array([ord(s) if len(s) == 1 else _LONG + known.setdefault(s, len(known)) for s in text.split(SEPARATOR)], dtype=np.int64))
        self.names = list(known)
        self.symbols = np.concatenate(parts) if parts else np.array([], dtype=np.int64)
        self.row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        self.rows = len(parts)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each n-gram its row and its kind; for each kind the place of its first symbol."""
        size = max(len(self.symbols) - n + 1, 0)
        on = np.flatnonzero(self.row[:size] == self.row[n - 1 : n - 1 + size])
        kinds, first, kind = np.unique(self.symbols[on], return_index=True, return_inverse=True)
        _, code = np.unique(self.symbols, return_inverse=True)
        several = int(code.max(initial=0)) + 1
        for k in range(1, n):
            kinds, first, kind = np.unique(kind * several + code[on + k], return_index=True, return_inverse=True)
        return self.row[on], kind, on[first]

    def name(self, symbol: int) -> str:
        return chr(symbol) if symbol < _LONG else self.names[symbol - _LONG]

    def text(self, first: int, n: int) -> str:
        return SEPARATOR.join(self.name(s) for s in self.symbols[first : first + n].tolist())


def gram_counts(rows: DataFrame, n: int, column: str, flag: str) -> DataFrame:
    """gram (symbols joined by SEPARATOR) and its numbers in rows with and without the flag: yes, no."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            batch = Batch(pdf["text_"], pdf["single_"])
            row, kind, first = batch.grams(n)
            marked = pdf["flag_"].to_numpy(dtype=bool)[row] if len(row) else np.array([], dtype=bool)
            yes, no = (np.bincount(kind[m], minlength=len(first)) for m in (marked, ~marked))
            yield pd.DataFrame({"gram": [batch.text(f, n) for f in first.tolist()], "yes": yes, "no": no})

    slim = rows.select(F.coalesce(F.col(flag), F.lit(False)).alias("flag_"), *joined_symbols(F.col(column)))
    return slim.mapInPandas(run, "gram string, yes long, no long").groupBy("gram").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))


def symbols_of_gram(gram: Column) -> Column:
    return F.split(gram, SEPARATOR)


def _hashed(batch: Batch, first: np.ndarray, n: int) -> np.ndarray:
    """64 bits of each kind, the same in every batch."""
    names, where = np.unique(batch.symbols, return_inverse=True)
    own = np.array([s if s < _LONG else int.from_bytes(hashlib.blake2b(batch.name(s).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for s in names.tolist()], dtype=np.uint64)
    key = np.full(len(first), n, dtype=np.uint64)
    for k in range(n):
        key = (key ^ (own[where[first + k]] if len(first) else own[:0])) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(32)
        key *= np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def gram_texts(utterances: DataFrame, ignore: Iterable[str], column: str = "repr_syms") -> DataFrame:
    """What n-grams are counted in, as short as texts: utt_id, symbols (of the reading), and the row's symbols without ignored ones as one string. To be made before rows are shuffled."""
    symbols = reduce(F.array_remove, sorted(ignore), F.col(column))
    return utterances.select("utt_id", F.size("reading_syms").cast("long").alias("symbols"), *joined_symbols(symbols))


def gram_rows(utterances: DataFrame, n: int, ignore: Iterable[str], column: str = "repr_syms") -> DataFrame:
    """utt_id, symbols (of the reading), and the row's kinds of n-grams without ignored symbols: grams (64-bit numbers, rising) and counts. No shuffle."""
    return counted_grams(gram_texts(utterances, ignore, column), n)


def counted_grams(texts: DataFrame, n: int, passes: Callable[[pd.Series], np.ndarray] | None = None, only: bool = False) -> DataFrame:
    """gram_rows of gram_texts. passes: what is asked of their hash_ in the same batch, answered as passed; only: no other rows."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            if passes:
                pdf = pdf.assign(passed=passes(pdf["hash_"]))
                pdf = pdf[pdf["passed"]].reset_index(drop=True) if only else pdf
            if not len(pdf):
                continue
            batch = Batch(pdf["text_"], pdf["single_"])
            row, kind, first = batch.grams(n)
            names, place = np.unique(_hashed(batch, first, n), return_inverse=True)
            pairs, counts = np.unique(row * max(len(names), 1) + place[kind], return_counts=True) if len(row) else (row, row)
            owner = pairs // max(len(names), 1)
            cuts = np.searchsorted(owner, np.arange(1, batch.rows))
            grams = np.split(names[pairs % max(len(names), 1)], cuts) if batch.rows else []
            out = pd.DataFrame({"utt_id": pdf["utt_id"], "symbols": pdf["symbols"], "grams": grams, "counts": np.split(counts.astype(np.int64), cuts) if batch.rows else []})
            yield out.assign(passed=pdf["passed"]) if passes else out

    return texts.mapInPandas(run, "utt_id long, symbols long, grams array<long>, counts array<long>" + (", passed boolean" if passes else ""))
