"""Toxicity by a subsequence string kernel, a support vector machine and Nystrom landmarks, learned from sentences.

Strings are compared by the subsequences of three letters that they share, each weighed by GAP to the power of the letters
skipped, within SPAN letters, and divided by both strings' lengths in that feature space; a word's begin and end count as
letters. So an insult keeps most of its value with letters inserted ("stuxpid") or gaps ("s.t.u.p.i.d", "s t u p i d").
Letters lose case and accents; look-alike digits, signs, and Greek, Cyrillic and full-width letters become the a-z they stand
for; what is no letter is dropped inside a word. Letters beyond a-z are their code points, and triples with such a letter are
hashed.

The examples are sentences: what ends at a full stop, "!", "?" or a line's end, cut after WORDS words. A sentence's margin is
that of the word in it that the machine holds for most toxic, so learning chooses that word too (a support vector machine
with latent variables). It starts from words with a character 5-gram that is ODDS times as frequent in sentences of toxic
texts as in those of clean ones, counts smoothed, and in more toxic texts than chance explains among as many 5-grams; no
word needs to be absent from clean texts, so wrong labels weaken the odds and do no more. Sentences of clean texts are examples by
their worst words. The machine is linear on the kernel's values at LANDMARKS words (Nystrom: times the inverse root of the
landmarks' own kernel) and is trained ROUNDS times, each with the words that the last one chose. As the kernel is a product
of explicit features, the machine is one table of weights of letter triples, which scores a whole text at a few nanoseconds a
letter and triple.

A text's probability is a logistic function of its best sentence's margin, of the number of its toxic sentences and of their
share, fitted on texts that the machine behind their margins has not learned from. So a long text isn't toxic for one
doubtful word.

The fit takes at most TOXIC and CLEAN labelled rows, those with the least hash of their id, of at most LONGEST characters;
scoring takes whole texts of any length. Of the words, the machine takes at most EXAMPLES of either class, the most frequent
or worst ones.

Cases: null and empty texts, and texts without letters, get the score of a text with no sign of toxicity; without toxic or
clean labelled rows, or without a word that tells them apart, every score is 0; labels without an id or value are left out,
and of contradicting ones the toxic one holds; repeated rows get a row each, and of an id's different texts the least one is
learned from; a column that has the result's name is replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
import unicodedata
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.shipping import ship

from .common import small_batches, table
from .minhash import band_keys, signatures
from .words import shingle_hashes, word_hashes

TOXIC, CLEAN, LONGEST = 1500, 6000, 20_000
GAP, SPAN, LANDMARKS = 0.6, 6, 512
#: Probability from which a text is toxic.
CUT = 0.3
#: How much more frequent a 5-gram must be in sentences of toxic texts.
ODDS = 4.0
#: Words of a sentence, at most.
WORDS = 32
#: Weight of the insults with an inserted letter that learning sees, as a share of the insults'.
VARIED = 0.3
#: Weight of all clean words, as a multiple of the insults', shared by this power of their number of sentences.
CAUTION, TEMPER = 10.0, 0.5
#: Trainings, and words of a class in each.
ROUNDS, EXAMPLES = 3, 8000
#: Parts that the labelled texts are cut into, each scored by a machine of the others.
FOLDS = 2
#: Single letters in a row that are read as one word.
SPELLED = 4
#: Letters scored at once.
CHUNK = 1 << 18

_OFFSETS = [(a, b, GAP ** (b - 2)) for a, b in combinations(range(1, SPAN), 2)]
#: Signs and digits read as letters.
LOOKS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
#: Letters of other scripts that look like a-z, after folding.
_TWINS = dict(zip("аеікорсухѕјԁһԛԝαικνορτυχɡıłß", "aeikopcyxsjdhqwaiknoptuxgils", strict=True))
#: Letters: 1-26 a-z, EDGE a word's begin or end, 0 dropped, code points of others. White space ends a word. Triples: those up to EDGE, then hashed ones.
EDGE = 27
_UNKNOWN, _LATIN, _HASHED = 0xFFFFFFFF, 32**3, 1 << 16
TRIPLES = _LATIN + _HASHED


_LETTERS, _SPACES = np.full(0x110000, _UNKNOWN, dtype=np.uint32), np.zeros(0x110000, dtype=bool)
_STOPS = np.zeros(0x110000, dtype=bool)
_STOPS[[ord(c) for c in ".!?\u2026\u3002\uff01\uff1f"]] = True


def _folded(ch: str) -> str:
    """Without case, accent and form; look-alikes as a-z."""
    while True:
        base = unicodedata.normalize("NFKD", LOOKS.get(ch, ch) if ch != "!" else ch).lower()[:1]
        if "\u1100" <= base <= "\u11ff":
            base = ch  # of Hangul, a syllable is a letter
        base = _TWINS.get(base, base)
        if base == ch:
            return ch
        ch = base


def _learn_letters(codes: np.ndarray) -> None:
    """Sets the tables at codes."""
    for code in codes.tolist():
        base = _folded(chr(code))
        _LETTERS[code] = ord(base) - 96 if "a" <= base <= "z" else ord(base) if base.isalpha() else 0
        _SPACES[code] = chr(code).isspace()


_learn_letters(np.arange(0x250))


def _triple(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Numbers of triples of letters."""
    index = ((a << 10) + (b << 5) + c).astype(np.int64)
    wide = np.flatnonzero((a > EDGE) | (b > EDGE) | (c > EDGE))
    if len(wide):
        mixed = (a[wide].astype(np.uint64) * 0x9E3779B1 + b[wide]) * 0x85EBCA6B + c[wide]
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15)
        index[wide] = _LATIN + (mixed >> np.uint64(48)).astype(np.int64) % _HASHED
    return index


def letters_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Letters of all words in a row, each between two EDGEs; for each word its text, its sentence and its first place."""
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letters = _LETTERS[codes]
    if len(new := np.unique(codes[letters == _UNKNOWN])):
        _learn_letters(new)
        letters = _LETTERS[codes]
    spaces = _SPACES[codes]
    place = np.flatnonzero(letters)
    none = np.array([], dtype=np.int64)
    if not len(place):
        return letters[:0], none, none, none
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    word, letters = np.cumsum(spaces, dtype=np.int64)[place], letters[place]
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    length = np.diff(np.concatenate([first, [len(word)]]))
    at = place[first]
    text = np.searchsorted(text_ends, at, "right")
    # runs of single letters of a text are one word
    single = length == 1
    joins = np.concatenate([[False], single[1:] & single[:-1] & (text[1:] == text[:-1])])
    if joins.any():
        run = np.cumsum(~joins)
        long_run = np.bincount(run)[run] >= SPELLED
        starts = ~(joins & long_run)
        first, text, at = first[starts], text[starts], at[starts]
    # a sentence ends at a line's end, or at a stop before white space
    ends = codes == 10
    ends[:-1] |= _STOPS[codes[:-1]] & spaces[1:]
    sentence = np.cumsum(ends, dtype=np.int64)[at]
    new = np.concatenate([[True], sentence[1:] != sentence[:-1]])
    numbers = np.arange(len(first))
    new |= (numbers - np.maximum.accumulate(np.where(new, numbers, 0))) % WORDS == 0
    number = np.zeros(len(letters), dtype=np.int64)
    number[first[1:]] = 1
    out = np.full(len(letters) + 2 * len(first), EDGE, dtype=letters.dtype)
    out[np.arange(len(letters)) + 2 * np.cumsum(number) + 1] = letters
    return out, text, np.cumsum(new) - 1, first + 2 * numbers


def _owners(first: np.ndarray, n: int) -> np.ndarray:
    """The word of each letter."""
    return np.repeat(np.arange(len(first)), np.diff(np.concatenate([first, [n]])))


def word_margins(texts: list[str], weights: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The margin of each word, its text and its sentence. weights: a value for each of TRIPLES."""
    letters, text, sentence, first = letters_of(texts)
    if not len(first):
        return np.array([], dtype=np.float32), first, first
    n, word = len(letters), _owners(first, len(letters)).astype(np.int32)
    latin = letters.max() <= EDGE
    c = letters.astype(np.int32)
    sums = np.zeros(n, dtype=np.float32)
    head = c << 10
    for a, b, gap in _OFFSETS:
        if n <= b:
            continue
        index = head[: n - b] + (c[a : n - b + a] << 5) + c[b:] if latin else _triple(letters[: n - b], letters[a : n - b + a], letters[b:])
        sums[: n - b] += np.where(word[: n - b] == word[b:], weights[index], 0) * np.float32(gap)
    total = np.add.reduceat(sums, first)
    length = np.diff(np.concatenate([first, [n]]))
    return total / _norms(length) + np.float32(bias), text, sentence


def _norms(length: np.ndarray) -> np.ndarray:
    """The length of a word of so many letters in feature space, its triples counted as different ones; at least 1."""
    out = np.zeros(len(length))
    for _, b, gap in _OFFSETS:
        out += np.maximum(length - b, 0) * gap * gap
    return np.sqrt(np.maximum(out, 1.0)).astype(np.float32)


def triples(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse features: word, triple and value."""
    c, _, _, first = letters_of(words)
    word = _owners(first, len(c))
    rows, columns, values = [], [], []
    norm = _norms(np.diff(np.concatenate([first, [len(c)]]))) if len(first) else np.array([1.0])
    for a, b, gap in _OFFSETS:
        if (n := len(c) - b) > 0:
            on = np.flatnonzero(word[:n] == word[b:])
            rows.append(word[on])
            columns.append(_triple(c[on], c[on + a], c[on + b]))
            values.append(gap / norm[word[on]])
    empty = [np.array([], dtype=np.int64)]
    return tuple(np.concatenate(x or empty) for x in (rows, columns, values))


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Each word with each landmark. Each must be a word: letters and no white space."""
    row, column, value = triples(landmarks)
    known, own = np.unique(column, return_inverse=True)
    dense = np.zeros((len(known) + 1, len(landmarks)), dtype=np.float32)  # and a row for triples that no landmark has
    np.add.at(dense, (own, row), value.astype(np.float32))
    place = np.full(TRIPLES, len(known), dtype=np.int32)
    place[known] = np.arange(len(known))
    out = np.zeros((len(words), len(landmarks)), dtype=np.float32)
    for at in range(0, len(words), 4096):
        row, column, value = triples(words[at : at + 4096])
        order = np.argsort(row, kind="stable")
        row, column, value = row[order], place[column[order]], value[order].astype(np.float32)
        if len(row):
            starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            for block in range(0, len(landmarks), 32):
                out[at + row[starts], block : block + 32] = np.add.reduceat(dense[column, block : block + 32] * value[:, None], starts, axis=0)
    return out


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-6, steps: int = 20) -> np.ndarray:
    """Squared hinge loss with a constant as last column, by Newton's method; x is read in blocks."""
    size = x.shape[1] + 1
    w = np.zeros(size)
    ridge = np.full(size, penalty)
    ridge[-1] = 1e-8
    weight = weight / weight.sum()
    for _ in range(steps):
        h, slope = np.diag(ridge), np.zeros(size)
        for at in range(0, len(x), 4096):
            part = np.column_stack([x[at : at + 4096], np.ones(len(x[at : at + 4096]))]).astype(np.float64)
            on = y[at : at + 4096] * (part @ w) < 1
            part, some = part[on], weight[at : at + 4096][on]
            h += (part * some[:, None]).T @ part
            slope += (part * some[:, None]).T @ y[at : at + 4096][on]
        new = np.linalg.solve(h, slope)
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w


@dataclass
class Model:
    """weights and bias: the machine; logistic: factors of what facts() gives, and a constant."""

    weights: np.ndarray
    bias: float
    logistic: np.ndarray

    def facts(self, texts: list[str | None]) -> np.ndarray:
        """For each text the margin of its best sentence (of texts without words, and at least, -1: what a clean word has), the logarithm of one more than its toxic sentences, and that of all sentences to a toxic one (0 without any)."""
        out, at = np.tile([-1.0, 0.0, 0.0], (len(texts), 1)), 0
        batch, held = [], 0

        def add(first: int, pieces: list[str]) -> None:
            margin, text, sentence = word_margins(pieces, self.weights, self.bias)
            if len(text):
                starts = np.flatnonzero(np.concatenate([[True], sentence[1:] != sentence[:-1]]))
                best, of = np.maximum.reduceat(margin, starts), text[starts]
                rows = first + of
                np.maximum.at(out[:, 0], rows, best)
                np.add.at(out[:, 1], rows, best > 0)
                np.add.at(out[:, 2], rows, 1)

        for i, text in enumerate([*texts, None]):
            if batch and (i == len(texts) or held + len(text or "") > CHUNK):
                add(at, batch)
                at, batch, held = i, [], 0
            if i < len(texts):
                if len(text or "") > 2 * CHUNK:  # by pieces between words, each a batch
                    for piece in _pieces(text):
                        add(i, [piece])
                    text = ""
                batch.append(text or "")
                held += len(text or "")
        out[:, 2] = np.log(np.maximum(out[:, 2], 1) / np.where(out[:, 1] > 0, out[:, 1], np.maximum(out[:, 2], 1)))
        out[:, 1] = np.log1p(out[:, 1])
        return out

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.facts(texts) @ self.logistic[:-1] + self.logistic[-1])))


def _pieces(text: str):
    """Pieces of about CHUNK letters that end between words."""
    at = 0
    while at < len(text):
        end = min(at + CHUNK, len(text))
        while end < len(text) and not text[end].isspace():
            end += 1
        yield text[at:end]
        at = end


def _inserted(word: str, rng: np.random.Generator) -> list[str]:
    """The word with a letter more, at each place inside it."""
    any_letter = (lambda: chr(97 + int(rng.integers(26)))) if word.isascii() else (lambda: word[int(rng.integers(len(word)))])
    return [word[:i] + any_letter() + word[i:] for i in range(1, len(word))]


@dataclass
class _Examples:
    """Sentences as numbers of words (strings would be hundreds of MB on the driver): a pair of text and sentence for each distinct word in it."""

    words: list[str]
    word: np.ndarray
    sentence: np.ndarray
    text: np.ndarray

    @staticmethod
    def of(texts: list[str]) -> _Examples:
        names: dict[str, int] = {}
        parts, done = [], 0
        for at in range(0, len(texts), 64):
            letters, text, sentence, first = letters_of(texts[at : at + 64])
            if len(first):
                raw = np.where(letters < EDGE, letters + 96, letters).astype("<u4").tobytes().decode("utf-32-le")
                ends = [*first[1:].tolist(), len(raw)]
                word = np.array([names.setdefault(raw[a + 1 : b - 1], len(names)) for a, b in zip(first.tolist(), ends, strict=True)], dtype=np.int64)
                pairs = np.unique((sentence << 32) + word)
                owner = np.zeros(sentence[-1] + 1, dtype=np.int32)
                owner[sentence] = text + at
                sentence = pairs >> 32
                parts.append(((pairs & 0xFFFFFFFF).astype(np.int32), (sentence + done).astype(np.int32), owner[sentence]))
                done += len(owner)
        word, sentence, text = (np.concatenate([p[i] for p in parts] or [np.array([], dtype=np.int32)]) for i in range(3))
        return _Examples(list(names), word, sentence, text)

    def without(self, gone: np.ndarray) -> _Examples:
        on = ~gone[self.text]
        return _Examples(self.words, self.word[on], self.sentence[on], self.text[on])


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of 5-grams of words with their edges (of a shorter one, of all), and the word of each."""
    letters, _, _, first = letters_of(words)
    n = len(letters)
    owner = np.concatenate([_owners(first, n), np.full(4, -1)]).astype(np.int32)
    letters = np.concatenate([letters, np.zeros(4, dtype=letters.dtype)])
    key = np.zeros(n, dtype=np.uint64)
    for k in range(5):
        key = (key + np.where(owner[k : n + k] == owner[:n], letters[k : n + k], 0).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    whole = owner[4 : n + 4] == owner[:n]
    whole[first] = True
    return key[whole], owner[:n][whole]


#: Passes over all 5-grams and words at once in each, so that the driver never holds all of them.
PASSES, WORDS_AT_ONCE = 8, 20_000


def _frequent_grams(words: list[str], in_toxic: np.ndarray, in_clean: np.ndarray, odds) -> tuple[np.ndarray, np.ndarray, int]:
    """Numbers of the 5-grams whose odds are high enough and the word of each, in the order of words; and how many 5-grams occur more than twice."""
    grams, owners, found, kinds = [], [], 0, 0
    for turn in range(PASSES):
        parts = []
        for at in range(0, len(words), WORDS_AT_ONCE):
            key, owner = _grams(words[at : at + WORDS_AT_ONCE])
            mine = key >> np.uint64(40) & np.uint64(PASSES - 1) == turn
            parts.append((key[mine], owner[mine] + np.int32(at)))
        key, owner = (np.concatenate([p[i] for p in parts]) for i in range(2))
        del parts
        _, gram = np.unique(key, return_inverse=True)
        t, c = (np.bincount(gram, x[owner]) for x in (in_toxic, in_clean))
        kinds += int((t + c > 2).sum())
        maybe = (odds(t, c) >= ODDS) & (t >= 3)
        number = np.cumsum(maybe) - 1 + found
        found += int(maybe.sum())
        on = maybe[gram]
        grams.append(number[gram[on]])
        owners.append(owner[on])
    grams, owners = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return grams[order], owners[order], kinds


def _g2(a, b, n, m):
    """The log-likelihood ratio that a of n and b of m are no accident; 0 where a's share isn't the larger one."""
    share = (a + b) / (n + m)
    part = lambda x, e: x * np.log(np.maximum(x, 1e-12) / np.maximum(e, 1e-12))
    out = 2 * (part(a, n * share) + part(b, m * share) + part(n - a, n * (1 - share)) + part(m - b, m * (1 - share)))
    return np.where(a * m > b * n, out, 0.0)


def _unlike(texts: list[str], toxic: list[bool]) -> list[int]:
    """Places of the texts without near copies in their class, of which one counts: else a word of a text that was copied often would seem telling."""
    order = sorted(range(len(texts)), key=lambda i: (texts[i], toxic[i]))
    seen, out, at = (set(), set()), [], 0
    for words, counts in word_hashes([texts[i] for i in order]):
        shingles, runs = shingle_hashes(words, counts, 2)
        keys = iter(band_keys(signatures(shingles, runs)).tolist())
        for r in runs:
            i = order[at]
            at += 1
            known = seen[toxic[i]]
            if r and known.isdisjoint(own := next(keys)):
                out.append(i)
            if r:
                known.update(own)
    return out


def fit(texts: list[str], toxic: list[bool]) -> Model | None:
    """None without texts of both kinds, or without a word that tells them apart."""
    order = _unlike(texts, list(map(bool, toxic)))
    texts, y = [texts[i] for i in order], np.array([bool(toxic[i]) for i in order], dtype=bool)
    examples = _Examples.of(texts)
    machine = fit_machine(examples, y)
    if machine is None:
        return None
    model = Model(*machine, np.array([2.0, 0.0, 0.0, 0.0]))
    fold = np.random.default_rng(7).permutation(len(texts)) % FOLDS
    facts, seen = np.zeros((len(texts), 3)), np.zeros(len(texts), dtype=bool)
    for k in range(FOLDS):
        part = fit_machine(examples.without(fold == k), np.where(fold == k, False, y), left=fold != k)
        if part is not None:
            mine = np.flatnonzero(fold == k)
            facts[mine], seen[mine] = Model(*part, model.logistic).facts([texts[i] for i in mine]), True
    if not seen.any():
        facts, seen = model.facts(texts), np.ones(len(texts), dtype=bool)
    model.logistic = calibrated(facts[seen], y[seen].astype(float))
    return model


def calibrated(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Factors of the logistic fit and its constant, a little ridge keeps them finite; margins and toxic sentences never count against toxicity."""
    free = np.array([True, True, True, True])
    x = np.column_stack([x, np.ones(len(x))])
    ridge = np.array([1.0, 1.0, 1.0, 1e-3]) * 0.5 / len(y)
    while True:
        w = np.zeros(4)
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
            h = (x * (p * (1 - p) / len(y))[:, None]).T @ x + np.diag(ridge)
            slope = x.T @ (y - p) / len(y) - ridge * w
            step = np.zeros(4)
            step[free] = np.linalg.solve(h[np.ix_(free, free)], slope[free])
            w += np.clip(step, -3, 3)
            if np.abs(step).max() < 1e-9:
                break
        wrong = free & (w < 0) & np.array([True, True, False, False])
        if not wrong.any():
            return w
        free &= ~wrong


def _spread(words: list[str], most: int) -> list[str]:
    """Landmarks: words far from each other, by pivots of the kernel's Cholesky factors; frequent ones come first in words and win ties."""
    words = words[: 8 * most]
    own = kernel(words, words).astype(np.float64)
    left, rows, out = own.diagonal().copy(), [], []
    for _ in range(min(most, len(words))):
        at = int(np.argmax(left))
        if left[at] < 1e-3:
            break
        row = own[at].copy()
        for r in rows:
            row -= r[at] * r
        rows.append(row := row / np.sqrt(left[at]))
        left = np.maximum(left - row * row, 0)
        left[at] = 0
        out.append(words[at])
    return out


def fit_machine(examples: _Examples, y: np.ndarray, left: np.ndarray | None = None, seed: int = 3) -> tuple[np.ndarray, float] | None:
    """Weights of triples and a constant. y: which texts are toxic; left: which texts there are (default all)."""
    n = int((y if left is None else y & left).sum()), int((~y if left is None else ~y & left).sum())
    if not all(n):
        return None
    words, size = examples.words, len(examples.words)
    of_toxic = y[examples.text]
    in_toxic, in_clean = (np.bincount(examples.word[on], minlength=size) for on in (of_toxic, ~of_toxic))
    sentences = [len(np.unique(examples.sentence[on])) for on in (of_toxic, ~of_toxic)]
    odds = lambda t, c: (t + 0.5) / (sentences[0] + 1) * (sentences[1] + 1) / (c + 0.5)

    gram_of, word_of, kinds = _frequent_grams(words, in_toxic, in_clean, odds)
    starts, ends = np.searchsorted(word_of, np.arange(size)), np.searchsorted(word_of, np.arange(size), "right")
    several = int(gram_of.max(initial=-1)) + 1
    texts = []
    for kind in (of_toxic, ~of_toxic):  # in how many texts is each of these 5-grams
        on = kind & (ends > starts)[examples.word]
        pair = np.unique((examples.text[on].astype(np.int64) << 32) + examples.word[on])
        text, word = pair >> 32, pair & 0xFFFFFFFF
        many = ends[word] - starts[word]
        text, place = np.repeat(text, many), np.repeat(starts[word] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        texts.append(np.bincount(np.unique((text << 32) + gram_of[place]) & 0xFFFFFFFF, minlength=several))
    kinds = max(kinds, 3)
    telling = _g2(texts[0], texts[1], *n) >= 2 * np.log(kinds) - np.log(2 * np.log(kinds))
    witness = np.zeros(size, dtype=bool)
    witness[word_of[telling[gram_of]]] = True
    witness &= (in_toxic > 0) & (odds(in_toxic, in_clean) >= ODDS)
    if not witness.any():
        return None

    rng = np.random.default_rng(seed)
    falling = lambda count, of: of[np.lexsort((of, -count[of]))]
    positive = falling(in_toxic, np.flatnonzero(witness))[:EXAMPLES]
    vocabulary = np.flatnonzero((in_clean > 0) & ~witness)
    if not len(vocabulary):
        return None
    frequent = falling(in_clean, vocabulary)
    half = EXAMPLES // 2
    negative = np.concatenate([frequent[:half], frequent[half:][np.sort(rng.permutation(max(len(frequent) - half, 0))[:half])]])
    named = lambda of: [words[i] for i in of]
    landmarks = _spread(named(positive), LANDMARKS // 2)
    landmarks += named(frequent[: LANDMARKS - len(landmarks)])
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    row, column, value = triples(landmarks)
    varied = [v for i in positive[:64] if len(words[i]) > 4 for v in _inserted(words[i], rng)]

    def train(positive: np.ndarray, negative: np.ndarray) -> tuple[np.ndarray, float]:
        every = [*named(positive), *varied, *named(negative)]
        x = np.concatenate([kernel(every[at : at + 2048], landmarks) @ root.astype(np.float32) for at in range(0, len(every), 2048)])
        mark = np.concatenate([np.ones(len(positive) + len(varied)), -np.ones(len(negative))])
        counts = in_toxic[positive].astype(float)
        often = in_clean[negative] ** TEMPER
        weight = np.concatenate([counts / counts.sum(), np.full(len(varied), VARIED / max(len(varied), 1)), CAUTION * often / often.sum()])
        w = fit_svm(x, mark, weight)
        dense = np.zeros(TRIPLES)
        np.add.at(dense, column, (root @ w[:-1])[row] * value)
        return dense.astype(np.float32), float(w[-1])

    weights, bias = train(positive, negative)
    for _ in range(ROUNDS - 1):
        margin = np.concatenate([word_margins(words[at : at + 20_000], weights, bias)[0] for at in range(0, size, 20_000)])
        best = np.full(int(examples.sentence[-1]) + 1, -np.inf, dtype=np.float32)
        np.maximum.at(best, examples.sentence, margin[examples.word])
        chosen = np.zeros(size, dtype=bool)  # the worst words of clean texts' sentences
        chosen[examples.word[~of_toxic & (margin[examples.word] == best[examples.sentence])]] = True
        worst = np.flatnonzero(chosen & ~witness)
        negative = np.unique(np.concatenate([negative, worst[np.argsort(-margin[worst], kind="stable")][:half]]))
        weights, bias = train(positive, negative)
    return weights, bias


def held_out(doc_id):
    """Rows that learning leaves out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC, clean: int = CLEAN, longest: int = LONGEST) -> Model | None:
    """The model of a bounded sample of labelled rows, none of them held out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id"]
    short = docs.where(F.length("text") <= longest).select("doc_id", "text")
    chosen = known.where("toxic = 1").orderBy(*order).limit(toxic).union(known.where("toxic <> 1").orderBy(*order).limit(clean))
    rows = short.join(F.broadcast(chosen), "doc_id")  # at most toxic + clean ids are broadcast

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "text"]).drop_duplicates("doc_id")
        return pd.DataFrame({"model": [pickle.dumps(fit(rows["text"].tolist(), (rows["toxic"] == 1).tolist()))]})

    ship(docs.sparkSession)
    found = rows.groupBy(F.lit(1).alias("one")).applyInPandas(run, "model binary").first()  # in a task: the fit holds hundreds of MB, which the driver would keep
    return pickle.loads(bytes(found["model"])) if found else None


def scored(docs: DataFrame, model: Model | None, text: str = "text", out: str = "score") -> DataFrame:
    """docs with the probability that the text is toxic."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.zeros(len(texts)) if model is None else model.probabilities(texts.tolist()))

    return docs.withColumn(out, run(F.col(text)))


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, sf_dir, "labels"))
    out = scored(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
