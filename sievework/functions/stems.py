"""Porter's suffix stripping (M. F. Porter, 1980) for English ROUGE."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, StringType

# Suffix tables of steps 2, 3 and 4.
STEP2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("bli", "ble"), ("alli", "al"),
    ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"),
    ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"), ("logi", "log"))
STEP3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", ""))
STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def _shape(stem: str) -> str:
    """The stem as a string of ``c`` and ``v``; ``y`` after a consonant is a vowel."""
    shape = ""
    for letter in stem:
        vowel = letter in "aeiou" or (letter == "y" and shape.endswith("c"))
        shape += "v" if vowel else "c"
    return shape


def _measure(stem: str) -> int:
    return len(re.findall("v+c+", _shape(stem)))


def _double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _short_end(word: str) -> bool:
    return _shape(word).endswith("cvc") and word[-1] not in "wxy"


def _longest(word: str, table) -> tuple[str, str] | None:
    found = [(s, r) for s, r in table if word.endswith(s)]
    return max(found, key=lambda pair: len(pair[0])) if found else None


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    if len(word) <= 2:
        return word
    # plurals
    if word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    # past and progressive forms
    cut = None
    if word.endswith("eed"):
        word = word[:-1] if _measure(word[:-3]) > 0 else word
    else:
        for ending in ("ed", "ing"):
            if word.endswith(ending) and "v" in _shape(word[:-len(ending)]):
                cut = word[:-len(ending)]
                break
    if cut is not None:
        if cut.endswith(("at", "bl", "iz")):
            word = cut + "e"
        elif _double(cut) and cut[-1] not in "lsz":
            word = cut[:-1]
        elif _measure(cut) == 1 and _short_end(cut):
            word = cut + "e"
        else:
            word = cut
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    # double, then single suffixes
    for table in (STEP2, STEP3):
        match = _longest(word, table)
        if match and _measure(word[:-len(match[0])]) > 0:
            word = word[:-len(match[0])] + match[1]
    match = _longest(word, [(s, "") for s in STEP4])
    if match:
        left = word[:-len(match[0])]
        if _measure(left) > 1 and (match[0] != "ion" or left.endswith(("s", "t"))):
            word = left
    # final e and ll
    if word.endswith("e"):
        left = word[:-1]
        if _measure(left) > 1 or (_measure(left) == 1 and not _short_end(left)):
            word = left
    if word.endswith("ll") and _measure(word[:-1]) > 1:
        word = word[:-1]
    return word


def stem_token(word: str | None) -> str | None:
    """The stem; tokens of three letters or fewer stay."""
    return word if word is None or len(word) <= 3 else stem(word)


@F.arrow_udf(ArrayType(StringType()))
def _stems(words: pa.Array) -> pa.Array:
    """Each different token of a batch is stemmed once."""
    coded = words.flatten().dictionary_encode()
    stems = pa.array([stem_token(w) for w in coded.dictionary.to_pylist()], pa.string())
    lengths = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), stems.take(coded.indices), mask=words.is_null())


def porter_stems(words: Column) -> Column:
    """Stems of an array of tokens; tokens of three letters or fewer stay."""
    return _stems(words)


#: What it does to one token, for counts that number the tokens of a batch anyway.
porter_stems.word = stem_token
