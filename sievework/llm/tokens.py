"""Token ids of whole texts under the two public byte-pair vocabularies of the tokenizers library.

White space bounds pre-tokens, and most words of a corpus come again. So a text is cut at spaces, a chunk
met before takes its ids from memory, and a new one is split into pre-tokens that the library's model
encodes; a word before marks or a line break shares the memory of the word alone. The cut is taken only
for texts where it cannot change a pre-token (plain and accented Latin letters, ASCII, common punctuation,
no doubled or trailing space, no special token's string); any other text is given to the library whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable
from functools import lru_cache

_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ſ"
_MARKS = "!-/:-@\\[-`{-~¡-©«¬®-±´¶-¸»¿×÷‐-‧"
_PLAIN = re.compile(f"[{_LETTERS}0-9{_MARKS} \\t\\n\\r]*")
_CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
_BYTE_LEVEL = re.compile(rf"{_CONTRACTIONS}| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s0-9{_LETTERS}]+|\s+(?!\S)|\s+")
_WORD_END = re.compile(rf"{_CONTRACTIONS}|[{_LETTERS}]+|[0-9]|[^\s0-9{_LETTERS}]+")
_ENDED = re.compile(rf"([{_LETTERS}]+)([^\s0-9{_LETTERS}]+)")  # a word and the marks after it
#: Chunks, and words, kept between slices: half of them, or 32 bytes of text for each, are one of two generations.
KEPT = 400_000


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte: itself if it prints, else the next free one above 255."""
    prints = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    return {b: chr(b) for b in prints} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in prints)}


class _Memory(dict):
    """Chunks and their ids; a new chunk is encoded when it is first looked up.

    Beyond half of ``kept`` a new generation begins; what is not met again during it is forgotten.
    """

    def __init__(self, encode: Callable[[str], bytes], kept: int):
        self.encode, self.half, self.older, self.held = encode, kept // 2, {}, 0

    def __missing__(self, chunk: str) -> bytes:
        out = self.older.get(chunk)
        if out is None:
            out = self.encode(chunk)
        self[chunk] = out
        self.held += len(chunk)
        return out

    def age(self) -> None:
        if len(self) > self.half or self.held > 32 * self.half:
            self.older, self.held = dict(self), 0
            self.clear()


class Encoder:
    """Encodes lists of texts to bytes of little-endian unsigned 32-bit ids.

    ``spaces`` tells that a pre-token has the space before it (byte-level vocabularies);
    else white space is dropped and letters are lower-cased.
    """

    def __init__(self, path: str, spaces: bool, kept: int = KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.spaces = spaces
        self.letters = {b: ord(c) for b, c in byte_alphabet().items()}
        self.words = _Memory(self._word, kept)
        # with ``spaces`` a text's first chunk has no space before it, the others have
        self.firsts = _Memory(self._chunk, kept)
        self.chunks = _Memory(lambda c: self._chunk(c, " "), kept) if spaces else self.firsts

    def whole(self, texts: list[str]) -> list[bytes]:
        """The library's ids of whole texts."""
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, word: str) -> bytes:
        """The model's ids of one pre-token."""
        tokens = self.model.tokenize(word.encode().decode("latin-1").translate(self.letters))
        return array("I", [t.id for t in tokens]).tobytes()

    def _chunk(self, chunk: str, before: str = "") -> bytes:
        if not self.spaces and chunk != (small := chunk.lower()):
            return self.firsts[small]
        if chunk.isalpha():  # a chunk of letters is one pre-token
            return self._word(before + chunk)
        same = self.chunks if before else self.firsts
        if ended := _ENDED.fullmatch(chunk):
            return same[ended[1]] + self.words[ended[2]]
        lines = chunk.split("\n")
        if len(lines) == 2 and lines[0] and lines[1] and "\t" not in chunk and "\r" not in chunk:
            # white space of one character before a word is a pre-token, what follows stands as at a text's start
            return same[lines[0]] + self.words["\n"] + self.firsts[lines[1]]
        return b"".join([self.words[w] for w in (_BYTE_LEVEL if self.spaces else _WORD_END).findall(before + chunk)])

    def __call__(self, texts: list[str]) -> list[bytes]:
        for memory in (self.words, self.firsts, self.chunks):
            memory.age()
        ids, first, out, odd = self.chunks.__getitem__, self.firsts.__getitem__, [b""] * len(texts), []
        for k, text in enumerate(texts):
            if "<|" in text or not _PLAIN.fullmatch(text) or self.spaces and ("  " in text or text[-1:] == " "):
                odd.append(k)
            elif self.spaces:
                chunks = text.split(" ")
                out[k] = b"".join([first(chunks[0]), *map(ids, chunks[1:])])
            else:
                out[k] = b"".join(map(ids, text.split()))
        for k, found in zip(odd, self.whole([texts[k] for k in odd])):
            out[k] = found
        return out


@lru_cache(1)
def worker_encoder(path: str, spaces: bool, kept: int, job: str) -> Encoder:
    """The encoder that the tasks of one job share in a Python worker; another job begins with an empty memory."""
    return Encoder(path, spaces, kept)
