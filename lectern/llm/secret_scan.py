"""Secret scans: fixed patterns, and a linear-chain conditional random field for what they don't name.

The field tags every word (a run of anything but white space) as begin of a secret, inside of one, or outside. A word's
features are its shape (length, kinds of characters, changes between them, vowels, prefix, ...), the two words before it and the one
after it, and its file (words of many kinds a thousand words, key words, patterns found). All but the file's depend on one word
each, so distinct words are scored once and texts are sums of what their words say.

Viterbi's best path is found exactly without a visit to each word: a word can only raise a path above the all-outside one
where its score and its best transitions are above 0, so texts without such a word have no span. Around such words the
path is decoded up to words that are outside in every best path: those whose score as begin and as inside lies so low that
no change of neighbouring tags makes up for it.

The field is trained here, from sentences made by a seeded generator: keys of many forms, of letters only too, and
passwords of any length behind words that announce them, beside prose, addresses, numbers, dates, paths, names and code of the same length, and beside markup, data and logs. Leads are English, German,
French, Spanish, Portuguese and Italian words.
It needs no table and gives the same model in each run. Phrases of several plain words are not among the secrets.

Cases: null and empty texts have no spans; spans are in code points, end exclusive; punctuation at a word's ends does not
belong to a span; a span of the field is left out only where patterns' spans cover all of it, so what lies beyond a pattern's end is
reported too; repeated rows get a row each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from math import log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, table

#: The patterns and the least length of what they must have found (of the whole or of group 2).
PATTERNS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"[0-9a-f]{32,}"), 0, 32),
}
KINDS = (*PATTERNS, "crf")
#: The words without which assign finds nothing.
_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Hashed features; sentences, epochs, step and size of a batch of training.
SPACE, SENTENCES, EPOCHS, STEP, TOGETHER = 1 << 15, 4000, 8, 0.25, 32
#: Distinct words that are remembered with their scores, and their characters together.
KNOWN, KNOWN_CHARACTERS = 400_000, 16_000_000
SPANS = "array<struct<kind:string,start:int,end:int>>"
_MARKS = "\"'`.,;:!?()[]{}<>|"
_EDGE = _MARKS + "*#%&$"
OUT, BEGIN, INSIDE = 0, 1, 2
_WORD = re.compile(r"\S+")
_SAME = re.compile(r"(.)\1+", re.S)
_CONSONANTS = re.compile(r"[^aeiouyAEIOUY\W\d_]+")
_PARTS = re.compile(r"[^A-Za-z0-9]+")
_CREDENTIALS = re.compile(r"://[^/@:]*:[^/@]+@")
_HEX, _BASE64 = re.compile(r"[0-9a-fA-F]+"), re.compile(r"[A-Za-z0-9+/_=-]+")


class _Kinds(dict):
    """Kinds of characters, for str.translate."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = out = "d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else c if c in "._-/+=:@%?&#$" else "x"
        return out


_KINDS = _Kinds()


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns, leftmost and without overlap in a kind."""
    found = []
    for kind, (pattern, group, least) in PATTERNS.items():
        if kind == "access" and "AKIA" not in text:
            continue
        if kind == "assign" and not any(h in lower for lower in [text.lower()] for h in _HINTS):
            continue
        found.extend((m.start(), m.end(), kind) for m in pattern.finditer(text) if len(m[group]) >= least)
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def core(word: str) -> str:
    """A word without signs at its ends; of signs only, the word."""
    return word.strip(_EDGE) or word


def _crc(named: list[str]) -> list[int]:
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % SPACE for x in named]


def plain_shape(word: str) -> tuple | None:
    """Of a short word of lower-case letters, of such ones after a capital, or of digits, that isn't among NEIGHBOURS: all that its features depend on. Else None."""
    own = word.strip(_EDGE)
    n = len(own)
    if not 0 < n < 12:
        return None
    kind = "d" if own.isdigit() else "l" if own.isalpha() and own.islower() else "ul" if n > 1 and own.isalpha() and own[0].isupper() and own[1:].islower() else None
    return None if kind is None or own.lower() in NEIGHBOURS else (kind, n, word[-1] if word[-1] in _ENDS else "")


def word_features(word: str) -> tuple[list[int], list[int], list[int], list[int], int]:
    """Features that a word gives to itself, to the next word, to the one after that, and to the word before; and its class of changes.

    Of neighbours, NEIGHBOURS are known by name and all by their last sign, if that is one of _ENDS.
    """
    own = core(word)
    n, kinds, plain = len(own), own.translate(_KINDS), own.lower().rstrip("=")
    short = _SAME.sub(r"\1", kinds)
    changes = len(short) - 1
    digits, upper = kinds.count("d"), kinds.count("u")
    named = ["bias", f"n{min(n, 8) if n < 8 else 8 + min(n // 4, 16)}", f"c{min(changes, 24)}", f"s{short[:8]}", f"k{''.join(sorted(set(short)))}", f"d{int(digits / n * 6)}|{n > 7}|{n > 15}"]
    if n > 11 or short not in ("l", "u", "d", "ul"):
        vowels, letters = sum(map(plain.count, "aeiouy")), max(n - digits, 1)
        named += [
            f"v{int(8 * vowels / letters)}|{min(n // 8, 4)}", f"r{int(10 * changes / n)}|{min(n // 8, 4)}", f"p{own[:4]}", f"q{kinds[:3]}", f"u{int(upper / n * 6)}|{min(n // 8, 4)}",
            f"y{min(max(map(len, _CONSONANTS.findall(own)), default=0), 10)}|{bool(digits)}", f"h{bool(_HEX.fullmatch(own))}|{min(n // 8, 5)}", f"w{bool(_BASE64.fullmatch(own))}|{min(n // 8, 5)}",
            f"g{min(max(map(len, _PARTS.split(own))) // 6, 8)}", f"e{int(_entropy(own) * 2)}", f"m{min(changes // 2, 8)}|{min(n // 8, 4)}",
            f"t{'<' in own or '>' in own}|{'://' in own}|{'@' in own}|{'=' in own}", f"j{bool(_CREDENTIALS.search(own))}", f"i{own.count(chr(34))}|{own.count('&') > 0}|{own.count(';') > 0}",
        ]
    # whether a password may follow is said by these together with the word's own shape
    shape = min(changes, 3) + 4 * (n > 5) + 8 * bool(digits)
    about = [f"b{plain}"] * (plain in NEIGHBOURS) + [f"=b{word[-1]}"] * (word[-1] in _ENDS)
    return _crc(named), _crc(about), _crc([f"b{x}" for x in about]), _crc([f"a{plain}"] * (plain in NEIGHBOURS)), min(changes // 4, 6) + 7 * shape


def _entropy(word: str) -> float:
    n = len(word)
    return -sum(k / n * log2(k / n) for k in map(word.count, set(word)))


#: Words that announce a secret; the pair of whether one stands before, and a word's shape, is a feature.
LEADS = frozenset("password passwd pass pwd passphrase pin secret token key apikey api_key auth authorization bearer credential credentials private access login passwort kennwort schl\u00fcssel geheimnis zugang passe clef clave contrase\u00f1a senha parola".split())
SHAPES = 7 * 16
NEIGHBOURS = LEADS | frozenset("api is was are as my your the a use uses using with set export header value = : => -> || |".split())
_ENDS = ":=\"'"


#: Leads that the generator uses by name.
_NAMED = "pass pwd passphrase pin key auth bearer credential credentials login passwort kennwort zugang passe clave contrase\u00f1a senha".split()


def lead_of(word: str) -> bool:
    return core(word).lower().rstrip("=:") in LEADS


def file_features(words: int, odd: int, found: int, named: bool) -> tuple[str, ...]:
    """words of a text, those with many changes, patterns found, and whether it speaks of keys."""
    return f"F{min(int(1000 * odd / max(words, 1)), 40) // 10}", f"G{bool(found)}", f"H{named}"


@lru_cache(maxsize=64)
def _cross(file: tuple[str, ...]) -> np.ndarray:
    """Features of the file with each class of changes: SHAPES rows."""
    return np.array([_crc([*(f"{x}|c{k % 7}" for x in file), *file]) for k in range(SHAPES)])


@lru_cache(maxsize=1)
def _led() -> np.ndarray:
    """Features of shapes without and with an announcing word within two words before."""
    return np.array([[_crc([f"L{k}|{c // 7}"])[0] for c in range(SHAPES)] for k in range(3)])


class Field:
    """Weights of each feature for begin and inside (outside has 0), and of tag pairs; inside follows begin or inside only."""

    def __init__(self) -> None:
        self.weights = np.zeros((SPACE, 3))
        self.pairs = np.zeros((3, 3))
        self.pairs[OUT, INSIDE] = -1e9

    def best_path(self, scores: np.ndarray) -> list[int]:
        """Viterbi, with outside before and after. scores: three a word."""
        pairs = self.pairs.tolist()
        first = scores[0].tolist()
        best, back = [pairs[OUT][t] + first[t] for t in range(3)], []
        for s in scores[1:].tolist():
            from_ = [max(range(3), key=lambda a: best[a] + pairs[a][t]) for t in range(3)]  # noqa: B023
            best = [best[from_[t]] + pairs[from_[t]][t] + s[t] for t in range(3)]
            back.append(from_)
        tags = [max(range(3), key=lambda a: best[a] + pairs[a][OUT])]
        for b in reversed(back):
            tags.append(b[tags[-1]])
        return tags[::-1]

    def bounds(self) -> tuple[np.ndarray, float]:
        """For begin and inside, the most that transitions add to a tagged word against all outside; and the most that three transitions differ."""
        p = self.pairs - self.pairs[OUT, OUT]
        most = np.array([max(p[OUT, BEGIN], p[BEGIN, BEGIN], p[INSIDE, BEGIN]), max(p[BEGIN, INSIDE], p[INSIDE, INSIDE])]) + np.maximum(p[[BEGIN, INSIDE], OUT], 0)
        finite = self.pairs[self.pairs > -1e8]
        return most, float(3 * (finite.max() - finite.min()))

    def tagged(self, scores: np.ndarray) -> list[tuple[int, int]]:
        """The secrets of the best path through a whole text, as places of their first and last word."""
        most, spread = self.bounds()
        hot = np.flatnonzero((scores[:, 1:] + most).max(1) > 0)
        if not len(hot):
            return []
        turn = float(np.maximum(scores[:, INSIDE] - scores[:, BEGIN], 0).max())  # an inside that becomes a begin
        outside = np.flatnonzero(scores[:, 1:].max(1) < -(turn + spread))
        out, done = [], -1
        for at in hot.tolist():
            if at <= done:
                continue
            k = np.searchsorted(outside, at)
            a = int(outside[k - 1]) + 1 if k else 0
            done = b = int(outside[k]) if k < len(outside) else len(scores)
            tags = self.best_path(scores[a:b])
            begin = None
            for i, tag in enumerate([*tags, OUT]):
                if begin is not None and tag != INSIDE:
                    out.append((a + begin, a + i - 1))
                    begin = None
                if tag == BEGIN:
                    begin = i
        return out

    def learn(self, batch: list[tuple[np.ndarray, np.ndarray, list[int]]], slopes: np.ndarray, slopes_pairs: np.ndarray) -> None:
        """One step (AdaGrad) up the likelihood's slope: what is there less what forward and backward sums expect. A sentence: all its words' features, their numbers, and the tags."""
        sizes = [len(tags) for *_, tags in batch]
        n, size, pairs = max(sizes), len(batch), self.pairs
        flat, many = np.concatenate([f for f, *_ in batch]), np.concatenate([m for _, m, _ in batch])
        at, of = np.concatenate([np.arange(k) for k in sizes]), np.repeat(np.arange(size), sizes)
        tag = np.concatenate([t for *_, t in batch])
        scores = np.zeros((n, size, 3))
        scores[:, :, 1:] = -1e9  # past a sentence's end all is outside
        scores[at, of] = np.add.reduceat(self.weights[flat], np.cumsum(many) - many, axis=0)
        add = np.logaddexp.reduce
        ahead, behind = np.zeros((n, size, 3)), np.zeros((n, size, 3))
        ahead[0] = pairs[OUT] + scores[0]
        for i in range(1, n):
            ahead[i] = add(ahead[i - 1][:, :, None] + pairs, axis=1) + scores[i]
        behind[-1] = pairs[:, OUT]
        for i in range(n - 2, -1, -1):
            behind[i] = add(pairs + (scores[i + 1] + behind[i + 1])[:, None, :], axis=2)
        total = add(ahead[-1] + behind[-1], axis=1)
        expected = np.zeros((3, 3))
        expected[OUT] -= np.exp(ahead[0] + behind[0] - total[:, None]).sum(0)
        for i in range(1, n):
            expected -= np.exp(ahead[i - 1][:, :, None] + pairs + (scores[i] + behind[i])[:, None, :] - total[:, None, None]).sum(0)
        expected[:, OUT] -= np.exp(ahead[-1] + behind[-1] - total[:, None]).sum(0)
        for *_, tags in batch:
            np.add.at(expected, ([OUT, *tags], [*tags, OUT]), 1)
            expected[OUT, OUT] += n - len(tags)
        slope = -np.exp(ahead + behind - total[:, None])[at, of]
        slope[np.arange(len(tag)), tag] += 1
        step = np.zeros((SPACE, 3))
        for k in (BEGIN, INSIDE):
            step[:, k] = np.bincount(flat, np.repeat(slope[:, k], many), SPACE)
        expected[OUT, INSIDE] = 0
        step -= 1e-5 * size * self.weights
        slopes += step * step
        slopes_pairs += expected * expected
        self.weights += STEP * step / np.sqrt(slopes + 1e-8)
        self.pairs += STEP * expected / np.sqrt(slopes_pairs + 1e-8)
        self.pairs[OUT, INSIDE] = -1e9


def features(words: list[str], found: int) -> list[list[int]]:
    """All features of each word of a text."""
    parts = [word_features(w) for w in words]
    leads = [lead_of(w) for w in words]
    cross, led = _cross(file_features(len(words), sum(p[4] % 7 > 0 for p in parts), found, any(leads))), _led()
    out = []
    for i, p in enumerate(parts):
        f = [*p[0], *cross[p[4]].tolist(), int(led[1 if i and leads[i - 1] else 2 if i > 1 and leads[i - 2] else 0, p[4]])]
        f += parts[i - 1][1] if i else []
        f += parts[i - 2][2] if i > 1 else []
        f += parts[i + 1][3] if i + 1 < len(parts) else []
        out.append(f)
    return out


def sentences(n: int, seed: int = 9) -> list[tuple[list[str], list[int], int]]:
    """Words, tags and number of patterns of made sentences, with keys and with what only looks like them."""
    rng = np.random.default_rng(seed)
    pick = lambda s, k: "".join(s[int(i)] for i in rng.integers(len(s), size=k))
    low, up, dig = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    size = lambda a, b: int(rng.integers(a, b))
    any_of = lambda *xs: xs[size(0, len(xs))]
    syllables = "an the ti on er ou re st la do ch ver en sch ung keit lich heit au eux \u00e9r \u00e8le tion ment ci\u00f3n ado ue mente boca \u00f1a os que ie pf \u00e4 \u00f6 ing nd wh sh ly ka mi so zu po ba lo ri te na".split()
    word = lambda: "".join(syllables[int(i)] for i in rng.integers(len(syllables), size=size(1, 6)))
    small = lambda: "".join(any_of("an", "the", "ti", "on", "er", "re", "st", "la", "do", "en") for _ in range(size(1, 4)))
    host = lambda: any_of(f"{small()}{size(1, 99)}.{small()}.com", f"{small()}.{small()}", f"{small()}-{size(0, 9)}", f"{size(10, 256)}.{size(0, 256)}.{size(0, 256)}.{size(1, 256)}")

    def prose() -> str:
        w, kind = word(), rng.random()
        w = w.capitalize() if kind < 0.12 else w.upper() if kind < 0.17 else f"{w}-{word()}" if kind < 0.2 else f"{w}'{any_of('s', 't', 'll')}" if kind < 0.22 else str(size(0, 10000)) if kind < 0.25 else w
        kind = rng.random()
        return f"{w}{any_of('.', ',', ';', ':', '!', '?', '!!')}" if kind < 0.15 else f"({w})" if kind < 0.16 else f"{w}{pick(any_of('*', '#', '$', '%', '&'), 3)}" if kind < 0.18 else any_of("|", "-", "=", "\u2013", "*") if kind < 0.2 else f'"{w}"' if kind < 0.21 else w

    mixed = low + up + dig
    long_secrets = [
        lambda: [pick(mixed, size(20, 64))], lambda: ["ghp_" + pick(mixed, 36)], lambda: ["sk-" + pick(mixed, size(28, 48))], lambda: [small() + any_of("-", "_") + pick(dig, size(9, 14)) + "-" + pick(any_of(mixed, low), size(10, 28))], lambda: ["glpat-" + pick(mixed, 20)],
        lambda: [pick(mixed + "+/", size(30, 88)) + any_of("", "=", "==")], lambda: ["eyJ" + pick(mixed, 18) + "." + pick(mixed + "_-", 40) + "." + pick(mixed + "_-", 24)], lambda: ["AIza" + pick(mixed + "_-", 35)],
        lambda: [pick(up + dig, size(13, 16)) for _ in range(size(2, 4))], lambda: [pick(dig + "abcdef", 40)], lambda: [pick(low + up, size(20, 48))], lambda: [pick(low + up, size(24, 40))],
        lambda: [any_of("password", "token", "secret", "api_key", "key", small()) + any_of("=", ":") + pick(mixed + "!$%", size(12, 30)) + any_of("", "!", "7")],
    ]
    address = lambda: [f"{any_of('https', 'http', 'ftp', 'mysql', 'amqp', 'ldap', f'{small()}+{small()}')}://{any_of(small(), '')}:{any_of(pick(mixed, size(6, 16)), word() + pick(dig, size(1, 4)), pick(mixed + '!$%*-_', size(6, 14)))}@{host()}{any_of('', f':{size(80, 65536)}')}{any_of('', '/', f'/{small()}')}"]
    long_secrets += [address] * 4
    led_secrets = [
        lambda: [pick(low, size(20, 40))], lambda: [pick(up, size(20, 40))], lambda: ["".join(small().capitalize() + word().capitalize() for _ in range(size(2, 4)))], lambda: [pick(mixed + "!$%&*-_+", size(6, 16)) + any_of("!", "7", "$", "9x")],
        lambda: [word().capitalize() + pick(dig, size(1, 5)) + any_of("", "!", "$", "#1")], lambda: [word() + pick(dig, size(1, 5))], lambda: ["-".join(word() for _ in range(size(3, 6))) + any_of("", str(size(1, 99)))], lambda: [pick(mixed, size(8, 20))],
    ]
    others = [
        lambda: f"{small()}.{size(1, 999)}@mail{size(1, 99)}.{small()}.com", lambda: f"{small()}.{small()}@{small()}.org", lambda: f"https://{host()}/{small()}/{size(1, 99999)}", lambda: f"http://www.{small()}.org/{small()}/{small()}-{small()}-{small()}.html?{small()}={size(1, 999)}", lambda: f"{size(1990, 2030)}-{size(10, 13)}-{size(10, 29)}T{size(10, 24)}:{size(10, 60)}:{size(10, 60)}Z",
        lambda: f"{size(10, 256)}.{size(100, 256)}.{size(100, 256)}.{size(10, 256)}", lambda: f"+{size(1, 99)}-{pick(dig, 3)}-{pick(dig, 3)}-{pick(dig, 4)}", lambda: pick(dig, size(5, 20)), lambda: f"{small()}_{small()}_{size(1, 999)}.txt", lambda: f"/usr/{small()}/{small()}{size(1, 99)}/{small()}", lambda: f"{pick(dig, 4)}-{pick(dig, 4)}-{pick(dig, 4)}-{pick(dig, 4)}",
        lambda: f"{word()}{word()}{word()}{size(1, 99)}", lambda: f"{word().upper()}{word().upper()}-{size(100, 9999)}", lambda: f"{size(1, 99)},{pick(dig, 3)},{pick(dig, 3)}.{pick(dig, 2)}", lambda: f"DE{pick(dig, 20)}", lambda: f"978-{size(0, 9)}-{pick(dig, 4)}-{pick(dig, 4)}-{size(0, 9)}", lambda: f"v{size(0, 20)}.{size(0, 20)}.{size(0, 99)}-beta.{size(1, 9)}",
        lambda: f"{small()}{small()}!!{small()}{size(1, 99)}{small()}", lambda: f"{pick(dig + 'abcdef', 8)}-{pick(dig + 'abcdef', 4)}-{pick(dig + 'abcdef', 4)}-{pick(dig + 'abcdef', 4)}-{pick(dig + 'abcdef', 12)}", lambda: "".join(word() for _ in range(size(4, 9))), lambda: "".join(small().capitalize() for _ in range(size(2, 6))) + "()", lambda: f"self.{small()}_{small()}[{size(0, 99)}]",
        lambda: f"#{pick(dig + 'abcdef', 6)}", lambda: f"{size(1, 2000)}{any_of('px', 'kg', 'm2', 'GB', 'th', '%')}", lambda: f"[{size(1, 99)}]", lambda: f"$${small()}^{size(1, 9)}$$", lambda: "".join(any_of("!", "?", ".", "*", "$", "#") for _ in range(size(3, 12))), lambda: f"{small().capitalize()}{pick(up, 1)}.{small()}{pick(dig, 2)}", lambda: f"{word()}/{word()}", lambda: f"{small()}{small()}123",
        lambda: f"https://{host()}{any_of('', f':{size(80, 65536)}')}/{any_of('', small() + '/')}{small()}@{any_of('2x', small())}{any_of('', '.png')}", lambda: f"http://{host()}:{size(80, 65536)}/{small()}?{small()}={size(1, 99)}",
        lambda: f"{small()}={small()}", lambda: f"{small()}:{size(1, 99)}", lambda: f'{small()}="{small()}-{small()}"',
    ]
    tag = lambda: any_of("p", "b", "i", "h1", "h2", "div", "td", "tr", "li", "ul", "body", "html", "head", "span", "footer", "nav", "br/", "title", small())
    pair = lambda: f"{any_of('class', 'id', 'lang', 'charset', 'name', 'type', 'rel', 'content', small())}={any_of(chr(34), chr(39))}{any_of(small(), f'{small()}-{small()}', f'{small()}-{size(0, 99)}', str(size(0, 5000)), 'utf-8', f'{small()}/{small()}', f'#{small()}')}"
    closing = lambda: "".join(f"</{tag()}>" for _ in range(size(1, 4)))
    markup = [
        lambda: f"<{tag()}>{prose()}", lambda: f"{prose()}{closing()}", lambda: f"{prose()}{closing()}<{tag()}>{prose()}", lambda: f"<{tag()}>{prose()}{closing()}", lambda: f"<{tag()}", lambda: f'{pair()}"', lambda: f'{pair()}">', lambda: f'{pair()}"><{tag()}>{prose()}', lambda: f'{pair()}">{prose()}{closing()}',
        lambda: f'href="{any_of("", "https://" + host())}/{small()}/{small()}-{size(0, 999)}{any_of("", ".html")}">{prose()}{any_of("", closing())}', lambda: f'style="{small()}:#{pick(dig + "abcdef", any_of(3, 6))};{small()}-{small()}:{size(0, 99)}{any_of("px", "em", "%")}{any_of("", ";")}"', lambda: f'xmlns:{small()}="http://{host()}/{small()}/{size(1990, 2030)}"', lambda: f"<!--{small()}-->",
        lambda: f"<{tag()}>" * size(1, 4), lambda: closing() + any_of("", prose()), lambda: f"&{any_of('nbsp', 'amp', 'quot', f'#{size(30, 9999)}')};{prose()}", lambda: f'{{"{small()}":{size(0, 999)},"{small()}":"{word()}"}}', lambda: f'"{small()}_{small()}":{any_of(str(size(0, 99999)), "true", "null", "[]")},', lambda: f'"{small()}":"{word()}",', lambda: f"{small()}_{small()}={any_of(str(size(0, 9999)), small())}{any_of('', 'ms', ',', ';')}",
        lambda: f"[{small()}-{size(0, 99)}]", lambda: f"{small()}.{small()}.{small().capitalize()}:{size(1, 999)}", lambda: f"{small()}={pick(dig + 'abcdef', size(4, 9))}", lambda: any_of("INFO", "WARN", "DEBUG", "ERROR", "GET", "POST", "HTTP/1.1", "200", "{", "}", "},", "[", "]"), lambda: f"{small()}.{small()}({small()},{size(0, 99)});", lambda: f"{small()}:{size(0, 99)}px;", lambda: f"var(--{small()}-{small()})",
    ]
    leads = _NAMED
    named = lambda w: any_of(f"{w}:", f"{w} :", f"{w}", f"{w} =", f"{w.capitalize()}:", f"{w} is", f"{w}=").split()
    out = []
    for _ in range(n):
        marked = rng.random() < 0.3  # a text of markup, data or logs
        plain = lambda: any_of(*markup)() if marked and rng.random() < 0.6 else prose()  # noqa: B023, E731
        words, tags, kind = [plain() for _ in range(size(2, 14))], [], rng.random()
        tags = [OUT] * len(words)
        if kind < 0.3:
            lead, secret = named(any_of("key", "auth", "bearer", "credential", "private key", "access key", "using", "Authorization: Bearer", small())), any_of(*long_secrets)()
        elif kind < 0.5:
            lead, secret = named(any_of(*leads)), any_of(*led_secrets)()
        elif kind < 0.54:
            lead, secret = any_of(f"{any_of('pin', 'PIN')}:", f"{any_of('pin', 'PIN')} =", "PIN :").split(), [pick(dig, size(4, 9))]
        elif kind < 0.63:
            lead, secret = named(any_of(*leads)), []  # the word alone announces nothing
        else:
            lead, secret = [], []
        words += lead + secret
        tags += [OUT] * len(lead) + ([BEGIN, *[INSIDE] * (len(secret) - 1)] if secret else [])
        if secret and rng.random() < 0.3:
            words[-1] += any_of(".", ",", '"', ")")
        for _ in range(size(1, 14)):
            words.append(any_of(*others)() if rng.random() < 0.25 else plain())
            tags.append(OUT)
        out.append((words, tags, int(rng.random() < 0.3)))
    return out


def examples(n: int, seed: int = 9) -> list[tuple[list[list[int]], list[int]]]:
    return [(features(words, found), tags) for words, tags, found in sentences(n, seed)]


@lru_cache(maxsize=1)
def trained() -> Field:
    field, order = Field(), np.random.default_rng(1)
    known = [(np.array([x for f in run for x in f]), np.array([len(f) for f in run]), tags) for run, tags in examples(SENTENCES)]
    slopes, slopes_pairs = np.zeros((SPACE, 3)), np.zeros((3, 3))
    for _ in range(EPOCHS):
        rows = order.permutation(len(known))
        for at in range(0, len(rows), TOGETHER):
            field.learn([known[i] for i in rows[at : at + TOGETHER]], slopes, slopes_pairs)
    return field


def _inner(word: str) -> tuple[int, int]:
    """Start and end of a word without what punctuation cuts off at its ends: pa$$ is whole, of "key"### the key is."""
    if not word.strip(_EDGE):
        return 0, len(word)
    start, end = len(word) - len(word.lstrip(_EDGE)), len(word.rstrip(_EDGE))
    while start and word[start - 1] not in _MARKS:
        start -= 1
    while end < len(word) and word[end] not in _MARKS:
        end += 1
    return start, end


class Scanner:
    """A field with the scores of the words that it has met."""

    def __init__(self, field: Field) -> None:
        self.field, self.led, self.cross = field, field.weights[_led(), 1:], {}
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.plain: dict[tuple, int] = {}
        self.rows = 0
        self.scores, self.shapes, self.leads, self.characters = np.zeros((1024, 4, 2)), np.zeros(1024, dtype=np.int64), np.zeros(1024, dtype=bool), 0

    def _learn(self, new: list[str]) -> None:
        """Rows of new words; plain ones of a shape share theirs."""
        odd = []
        for w in new:
            shape = plain_shape(w)
            row = None if shape is None else self.plain.get(shape)
            if row is None:
                row = self.rows + len(odd)
                odd.append(w)
                if shape is not None:
                    self.plain[shape] = row
            self.places[w] = row
        first, n = self.rows, self.rows + len(odd)
        self.rows = n
        while n > len(self.scores):
            self.scores, self.shapes, self.leads = (np.concatenate([x, np.zeros_like(x)]) for x in (self.scores, self.shapes, self.leads))
        parts = [word_features(w) for w in odd]
        for k in range(4):
            owner = np.repeat(np.arange(first, n), [len(p[k]) for p in parts])
            np.add.at(self.scores, (owner, k), self.field.weights[[f for p in parts for f in p[k]], 1:]) if len(owner) else None
        self.shapes[first:n], self.leads[first:n] = [p[4] for p in parts], [lead_of(w) for w in odd]
        self.characters += sum(map(len, new))

    def word_scores(self, words: list[str], found: int) -> np.ndarray:
        """Three scores of each word."""
        if len(self.places) > KNOWN or self.characters > KNOWN_CHARACTERS:
            self.forget()
        if new := [w for w in dict.fromkeys(words) if w not in self.places]:
            for at in range(0, len(new), 10_000):
                self._learn(new[at : at + 10_000])
        place = np.fromiter(map(self.places.__getitem__, words), dtype=np.int64, count=len(words))
        shape, lead = self.shapes[place], self.leads[place]
        file = file_features(len(words), int((shape % 7 > 0).sum()), found, bool(lead.any()))
        if file not in self.cross:
            self.cross[file] = self.field.weights[_cross(file), 1:].sum(1)
        out = np.zeros((len(words), 3))
        says = self.scores[place]
        out[:, 1:] = says[:, 0] + self.cross[file][shape]
        led = np.zeros(len(words), dtype=np.int64)
        led[2:][lead[:-2]] = 2
        led[1:][lead[:-1]] = 1
        out[:, 1:] += self.led[led, shape]
        out[1:, 1:] += says[:-1, 1]
        out[2:, 1:] += says[:-2, 2]
        out[:-1, 1:] += says[1:, 3]
        return out

    def secrets(self, text: str, found: int) -> list[tuple[int, int]]:
        """Start and end of each secret that the field tags."""
        words = text.split()
        tagged = self.field.tagged(self.word_scores(words, found)) if words else []
        if not tagged:
            return []
        at = [m.start() for m in _WORD.finditer(text)]
        return [(at[a] + _inner(words[a])[0], at[b] + _inner(words[b])[1]) for a, b in tagged]


def spans_of(text: str, scanner: Scanner) -> list[tuple[int, int, str]]:
    """All spans by start, then kind."""
    base = base_spans(text)
    starts, ends = [], []  # what patterns cover together
    for start, end, _ in base:
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    found = []
    for a, b in scanner.secrets(text, len(base)):
        k = bisect_right(starts, a)
        if not k or ends[k - 1] < b:
            found.append((a, b, "crf"))
    return sorted([*base, *found], key=lambda s: (s[0], KINDS.index(s[2])))


def secret_spans(text: Column) -> Column:
    """Spans of a text as an array of kind, start, end."""
    field = trained()

    @F.pandas_udf(SPANS)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(field)
        for texts in parts:
            yield texts.map(lambda t: [{"kind": k, "start": a, "end": b} for a, b, k in spans_of(t, scanner)])

    return run(F.coalesce(text, F.lit("")))


def without_spans(text: str, spans: list[tuple[int, int, str]], mark: str) -> str:
    """The text with each stretch that spans cover, alone or together, replaced by the mark."""
    out, at = [], 0
    for a, b, _ in sorted(spans):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redacted(text: Column, mark: str = "[SECRET]") -> Column:
    """text without its secrets, and their number; a null text stays null and has none. One pass to Python."""
    field = trained()

    @F.pandas_udf("text string, secrets int")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(field)
        for texts in parts:
            found = [spans_of(t, scanner) if t else [] for t in texts]
            clean = [without_spans(t, s, mark) if s else t for t, s in zip(texts, found, strict=True)]
            yield pd.DataFrame({"text": pd.Series(clean, dtype=object), "secrets": [len(s) for s in found]})

    return run(text)


def op2_secret_scan(spark, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", secret_spans(F.col("text")).alias("found"))
    line = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("found", lambda s: s["kind"] != "crf")
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return docs.select("doc_id", *[count(k) for k in PATTERNS], F.sha2(line(base).cast("binary"), 256).alias("base_sha256"), line(F.col("found")).alias("spans"))
