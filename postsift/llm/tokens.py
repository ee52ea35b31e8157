"""Token ids of whole texts by a public tokenizer file, with repeated words encoded once per task."""

import os
import re
import zlib

import numpy as np

# Words whose ids a Python worker keeps. Others are encoded each time they come up.
KEPT = 1_000_000
# Characters handled at a time: few enough that their words stay in the processor's cache.
AT_ONCE = 200_000

# Unicode white space, as the tokenizers' own patterns see it.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# White space other than blank and line feed.
_ODD = re.compile(f"(?![ \\n])[{_SPACE}]")

_ENCODERS: dict[tuple, "Encoder"] = {}


class Encoder:
    """Ids as little-endian 32-bit bytes.

    A text is cut where the tokenizer itself always cuts, at white space, with one blank left in
    front of the next word where the tokenizer is byte-level (``spaced``). So the ids of a text are
    those of its words in turn, and a word that comes again is not encoded again. New words are
    encoded together, with a break between them that is one id and in none of them. A
    tokenizer that is not ``spaced`` drops white space and lowers letters, so ASCII letters are
    lowered before the look-up.
    """

    def __init__(self, path: str, spaced: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.spaced = spaced
        (self.break_id,) = self._ids("\n" if spaced else "\x01")
        self.break_bytes = np.array([self.break_id], "<u4").tobytes()
        self.first: dict = {"": b""}  # words at the start of a line, or any word where white space is dropped
        self.later: dict = {}  # words after one blank

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, kept: dict, words: set, head: str, at_once: int = 2048) -> None:
        """Keep the ids of new words. Words with white space inside are left out."""
        words = list(words)
        for i in range(0, len(words), at_once):
            some = words[i: i + at_once]
            if self.spaced:
                text = head + f"\n{head}".join(some)
                if _ODD.search(text):
                    some = [w for w in some if not _ODD.search(w)]
                    text = head + f"\n{head}".join(some)
            else:
                text = b" \x01 ".join(some).decode()
                if text.count("\x01") > len(some) - 1:
                    for word in (w for w in some if b"\x01" in w):
                        kept[word] = self._ids(word.decode()).tobytes()
                    some = [w for w in some if b"\x01" not in w]
                    text = b" \x01 ".join(some).decode()
            if not some:
                continue
            ids = self._ids(text)
            data, ends = ids.tobytes(), (4 * np.flatnonzero(ids == self.break_id)).tolist()
            if len(ends) != len(some) - 1:
                raise ValueError("a word holds the break")
            for word, start, end in zip(some, [0] + [e + 4 for e in ends], ends + [len(data)]):
                kept[word] = data[start:end]

    def _whole(self, text: str) -> bytes:
        """A text with unusual white space as a whole."""
        return self._ids(text).tobytes()

    def encode(self, texts: list) -> list:
        """The id bytes of each text; None counts as empty."""
        out, start, size = [], 0, 0
        for i, text in enumerate(texts):
            size += len(text or "")
            if size > AT_ONCE or i == len(texts) - 1:
                out += self._encode(texts[start: i + 1])
                start, size = i + 1, 0
        return out

    def _encode(self, texts: list) -> list:
        if self.spaced:
            rows = [[line.split(" ") for line in (t or "").split("\n")] for t in texts]
            lines = [words for row in rows for words in row]
            self._learn(self.first, {w[0] for w in lines}.difference(self.first), "")
            self._learn(self.later, set().union(*[w[1:] for w in lines]).difference(self.later, [""]), " ")
            first, later = self.first, self.later
            out = []
            for text, row in zip(texts, rows):
                try:
                    if row != [[""]] and any("" in words for words in row):
                        raise KeyError("blanks side by side")
                    out.append(self.break_bytes.join([
                        first[words[0]] + b"".join(map(later.__getitem__, words[1:])) for words in row]))
                except KeyError:
                    out.append(self._whole(text))
        else:
            rows = [(t or "").encode().lower().split() for t in texts]
            self._learn(self.first, set().union(*rows).difference(self.first), "")
            out = [b"".join(map(self.first.__getitem__, row)) for row in rows]
        for kept in (self.first, self.later):
            while len(kept) > KEPT:
                kept.popitem()
        return out


def encoder(path: str, spaced: bool) -> Encoder:
    """One encoder per Python worker and file."""
    key = (path, spaced)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, spaced)
    return _ENCODERS[key]


def crc(ids: bytes) -> int:
    return zlib.crc32(ids)
