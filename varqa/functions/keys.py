"""Comparison keys that need Unicode tables or state: Arrow-batched pandas UDFs over plain Python functions, and tables for many texts at once."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import STYLE_PAIRS

# Letters of the Arabic script that count as one.
ARABIC_FOLD = {"ي": "ی", "ى": "ی", "ك": "ک", "ۀ": "ہ", "ة": "ہ", "آ": "ا", "أ": "ا", "إ": "ا", "ؤ": "و", "ئ": "ی"}
TATWEEL = "ـ"

# Latin renderings of Devanagari letters and signs.
VIRAMA, NUKTA = "्", "़"
VOWELS = {
    "अ": "a", "आ": "a", "इ": "i", "ई": "i", "उ": "u", "ऊ": "u", "ऋ": "ri", "ॠ": "ri", "ऌ": "li",
    "ए": "e", "ऐ": "ai", "ओ": "o", "औ": "au", "ऑ": "o", "ऍ": "e", "ऎ": "e", "ऒ": "o",
}
VOWEL_SIGNS = {
    "ा": "a", "ि": "i", "ी": "i", "ु": "u", "ू": "u", "ृ": "ri", "ॄ": "ri", "ॅ": "e", "ॆ": "e", "े": "e",
    "ै": "ai", "ॉ": "o", "ॊ": "o", "ो": "o", "ौ": "au",
}
CONSONANTS = {
    "क": "k", "ख": "kh", "ग": "g", "घ": "gh", "ङ": "n", "च": "ch", "छ": "chh", "ज": "j", "झ": "jh", "ञ": "n",
    "ट": "t", "ठ": "th", "ड": "d", "ढ": "dh", "ण": "n", "त": "t", "थ": "th", "द": "d", "ध": "dh", "न": "n",
    "प": "p", "फ": "ph", "ब": "b", "भ": "bh", "म": "m", "य": "y", "र": "r", "ल": "l", "ळ": "l", "व": "v",
    "श": "sh", "ष": "sh", "स": "s", "ह": "h", "ऱ": "r", "ऴ": "l", "ऩ": "n",
}
SIGNS = {"ं": "n", "ँ": "n", "ः": "h", "ऽ": "", "।": " ", "॥": " ", "॰": " "}
WITH_NUKTA = {"k": "q", "j": "z", "ph": "f", "d": "r", "dh": "rh"}


_MARKS = regex.compile(r"\p{Mn}+")
_NO_LETTER = regex.compile(r"[^\p{L}\p{N}]+|[ʿʾʻ]+")
_NO_ARABIC = regex.compile(r"[\p{M}\p{P}\p{C}\p{Z}]+")
_FOLDED = str.maketrans(ARABIC_FOLD | {TATWEEL: ""})


def slugify(text: str) -> str:
    """ASCII words joined by underscores, letters that decompose to ASCII counted in."""
    letters = regex.sub(r"[^\x00-\x7f]+", "", unicodedata.normalize("NFKD", text or "")).lower()
    return "_".join(regex.findall("[a-z0-9]+", letters)) or "untitled"


def strip_marks(text: str) -> str:
    return _MARKS.sub("", unicodedata.normalize("NFKD", text or ""))


class _Each(dict):
    """A table for str.translate that asks a function for each character once."""

    def __init__(self, function):
        super().__init__()
        self.function = function

    def __missing__(self, code: int) -> str:
        self[code] = found = self.function(chr(code))
        return found


_LATIN = _Each(lambda c: _NO_LETTER.sub("", _MARKS.sub("", c).casefold()))
_ARABIC = _Each(lambda c: _NO_ARABIC.sub("", c.translate(_FOLDED)))
_LONG_A = re.compile("aa+")


def latin_key(text: str) -> str:
    """Letters and digits without marks, case or the signs for ain; doubled vowels are one letter (a run of a is one a)."""
    key = unicodedata.normalize("NFKD", text or "").translate(_LATIN)
    return _LONG_A.sub("a", key).replace("ee", "i").replace("oo", "u")


def arabic_key(text: str) -> str:
    """Letters of one form each, without marks, punctuation and blanks."""
    return unicodedata.normalize("NFKC", text or "").translate(_ARABIC)


def devanagari_to_latin(text: str) -> str:
    """A consonant carries an `a` until a vowel sign or virama follows; what isn't Devanagari is kept."""
    out: list[str] = []
    open_consonant = False
    for c in unicodedata.normalize("NFC", text or ""):
        if c in VOWEL_SIGNS or c == VIRAMA:
            out.append(VOWEL_SIGNS.get(c, ""))
            open_consonant = False
            continue
        if c == NUKTA:
            if out:
                out[-1] = WITH_NUKTA.get(out[-1], out[-1])
            continue
        if open_consonant:
            out.append("a")
        open_consonant = c in CONSONANTS
        if "०" <= c <= "९":
            out.append(str(ord(c) - ord("०")))
        else:
            out.append(CONSONANTS.get(c, VOWELS.get(c, SIGNS.get(c, c))))
    return "".join(out) + ("a" if open_consonant else "")


def devanagari_key(text: str) -> str:
    return latin_key(devanagari_to_latin(text))


#: What ends a line, as in `text.LINE_BREAK`; no key has any of it.
_BREAKS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
_BREAK, _HARD, _MANY, _NEW = -1, -2, -3, -4


class Letters:
    """Keys of many texts at once, as code points: a table has what each character adds to a key, filled as they occur.

    Lines with a character for which `each` is None (it may combine with what stands before it) go to the function itself.
    """

    def __init__(self, key: Callable[[str], str], each: Callable[[str], str | None], fold: Callable[[np.ndarray], np.ndarray] = lambda x: x):
        self.key, self.each, self.fold = key, each, fold
        self.table: np.ndarray | None = None
        self.many: dict[int, list[int]] = {}

    def _looked_up(self, raw: np.ndarray) -> np.ndarray:
        if self.table is None:
            self.table = np.full(0x110000, _NEW, np.int32)
            self.table[[ord(c) for c in _BREAKS]] = _BREAK
        out = self.table[raw]
        if (new := out == _NEW).any():
            for c in np.unique(raw[new]).tolist():
                said = self.each(chr(c))
                self.table[c] = _HARD if said is None else 0 if not said else ord(said) if len(said) == 1 else _MANY
                if said and len(said) > 1:
                    self.many[c] = [ord(x) for x in said]
            out = self.table[raw]
        return out

    def keys(self, texts: list[str | None], lines: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The non-empty keys of the texts, or of each of their lines: code points of all, each key's size and text."""
        size = np.array([len(t or "") + 1 for t in texts], np.int64)
        raw = np.frombuffer("".join([(t or "") + "\n" for t in texts]).encode("utf-32-le", "surrogatepass"), "<u4")
        out, ends = self._looked_up(raw), np.cumsum(size) - 1
        if not lines:
            out[out == _BREAK] = 0
            out[ends] = _BREAK
        breaks = np.flatnonzero(out == _BREAK)
        of, own = np.searchsorted(ends, breaks), []
        for i in np.unique(np.searchsorted(breaks, np.flatnonzero(out == _HARD))).tolist():
            here = slice(breaks[i - 1] + 1 if i else 0, breaks[i])
            own.append((self.key(raw[here].tobytes().decode("utf-32-le", "surrogatepass")), of[i]))
            out[here] = 0
        if len(at := np.flatnonzero(out == _MANY)):
            said = [self.many[c] for c in raw[at].tolist()]
            out[at] = [x[0] for x in said]
            out = np.insert(out, np.repeat(at + 1, [len(x) - 1 for x in said]), [c for x in said for c in x[1:]])
        out = self.fold(out[out != 0])
        size = np.diff(np.flatnonzero(out == _BREAK), prepend=-1) - 1
        own = [(k, i) for k, i in own if k]
        code = np.concatenate((out[out != _BREAK].astype(np.uint32), np.frombuffer("".join(k for k, _ in own).encode("utf-32-le", "surrogatepass"), "<u4")))
        return code, np.concatenate((size[size > 0], np.array([len(k) for k, _ in own], np.int64))), np.concatenate((of[size > 0], np.array([i for _, i in own], np.int64)))


def _fold_doubles(code: np.ndarray) -> np.ndarray:
    """A run of a is one a, two e are an i, two o a u, as in latin_key."""
    twice = np.flatnonzero(code[1:] == code[:-1])
    a = twice[code[twice] == ord("a")] + 1
    for letter, one in (("e", "i"), ("o", "u")):
        at = twice[code[twice] == ord(letter)]
        turn = np.arange(len(at))
        at = at[(turn - np.maximum.accumulate(np.where(np.diff(at, prepend=-2) != 1, turn, 0))) % 2 == 0]
        code[at], code[at + 1] = ord(one), 0
    code[a] = 0
    return code[code != 0]


def _latin_each(c: str) -> str:
    # What the decomposition puts into another order are marks, and no key has marks.
    return unicodedata.normalize("NFKD", c).translate(_LATIN)


_seconds: set[str] = set()


def _arabic_each(c: str) -> str | None:
    if not _seconds:  # what may be composed with a character before it
        pairs = [unicodedata.decomposition(chr(x)).split() for x in range(0x110000)]
        _seconds.update(chr(int(p[1], 16)) for p in pairs if len(p) == 2 and not p[0].startswith("<"))
        _seconds.update(map(chr, (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))))
    first = unicodedata.normalize("NFKD", c)[0]
    return None if unicodedata.combining(first) or first in _seconds else arabic_key(c)


#: By the name of the key function.
LETTERS = {"latin_key": Letters(latin_key, _latin_each, _fold_doubles), "arabic_key": Letters(arabic_key, _arabic_each)}


_STYLE = dict(STYLE_PAIRS)
# Small doubled vowels go first, then those that begin with a capital, then capitals.
_STYLED = [regex.compile("|".join(x for x in _STYLE if shape(x))) for shape in (str.islower, str.istitle, str.isupper)]
_NAMES = re.compile(r"'(?P<ain>(?=[Aa]in\b))|'?\b(?P<g>[gG])h(?=ain\b)")
_LINE_START = regex.compile(r"(?m)^[^\p{L}\p{Nl}\p{No}\n]*\K[\p{L}\p{Nl}\p{No}]")


def latin_style(text: str) -> str:
    """The house transliteration style: macrons, one nasal mark, ain and ghain, a capital at each line's first letter."""
    for pairs in _STYLED:
        text = pairs.sub(lambda m: _STYLE[m[0]], text)
    named = _NAMES.sub(lambda m: "ʿ" if m["g"] is None else "Ġ" if m["g"] == "G" else "ġ", text)
    return _LINE_START.sub(lambda m: m[0].upper() if m[0].islower() else m[0], "\n".join(named.splitlines()))


def similarity(left: str, right: str) -> float:
    """Ratcliff-Obershelp ratio with difflib's defaults; 0 where either is empty, 1 where equal. Order matters."""
    if not left or not right:
        return 0.0
    return 1.0 if left == right else SequenceMatcher(None, left, right).ratio()


def _text_udf(function):
    """A column function; the UDF is made when used, so workers can import this module without a session."""

    def column(c):
        def run(s: pd.Series) -> pd.Series:
            return s.map(lambda t: function(t) if t is not None else None)

        run.__annotations__ = {"s": pd.Series, "return": pd.Series}
        return F.pandas_udf(run, "string")(c)

    return column


slugify_udf = _text_udf(slugify)
strip_marks_udf = _text_udf(strip_marks)
_other_latin_key = _text_udf(latin_key)


def latin_key_udf(text: Column | str) -> Column:
    """latin_key: compiled for ASCII texts; only the others go to Python."""
    t = F.col(text) if isinstance(text, str) else text
    ascii_only = F.octet_length(t) == F.length(t)
    letters = F.regexp_replace(F.regexp_replace(F.lower(t), "[^a-z0-9]+", ""), "aa+", "a")
    folded = F.replace(F.replace(letters, F.lit("ee"), F.lit("i")), F.lit("oo"), F.lit("u"))
    return F.when(ascii_only, folded).otherwise(_other_latin_key(F.when(~ascii_only, t)))


arabic_key_udf = _text_udf(arabic_key)
devanagari_key_udf = _text_udf(devanagari_key)
latin_style_udf = _text_udf(latin_style)


def similarity_udf(left, right):
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([similarity(x, y) for x, y in zip(a, b)], dtype="float64")

    run.__annotations__ = {"a": pd.Series, "b": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "double")(left, right)
