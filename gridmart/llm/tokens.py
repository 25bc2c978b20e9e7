"""Token ids of whole texts from a tokenizer file of the ``tokenizers`` library.

The library's byte-level BPE splits a text before every single space, around line feeds, and
between letters and the marks ``. , ; : ! ?``, so a text in which no white space but space and line
feed occurs, and none of them side by side, is the sequence of such parts.  A batch of texts is split and its
distinct parts are found by Arrow; each distinct part is put together from its words and the marks behind them, which the library
encodes once or the worker's bounded cache holds, and numpy puts the ids in order.  A text with any other white
space, or with a special token's string, is given to the library whole (which gives that token's id for the string).
"""

from __future__ import annotations

import functools
import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 0
CACHE_WORDS = 250_000     # per worker, of words behind a space and of others each; about 90 MB in all
CACHE_MARKS = 10_000
TEXTS_AT_ONCE = 64        # whose ids are put in order at once, in a core's own cache
LONGEST_CACHED = 32       # characters

# White space other than space and line feed, or two of those side by side, or a line feed at an end.
_ODD_SPACE = ("[\\t\\r\\x0b\\x0c\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}"
              "\\x{202f}\\x{205f}\\x{3000}]|[ \\n][ \\n]|\\n\\z|\\A\\n")
_MARKS = ".,;:!?"
_LETTERS = [chr(c) for c in range(0x250) if chr(c).isalpha()]


class _Words(dict):
    """Ids by what stands between two spaces, ``space`` in front.  Words alone are held: a part that ends in marks or has line feeds is put
    together from them."""

    def __init__(self, encoder: Encoder, space: str, most: int):
        super().__init__()
        self.encoder, self.space, self.most = encoder, space, most

    def __missing__(self, part: str) -> bytes:
        if "\n" in part:
            first, *rest = part.split("\n")
            feed, firsts = self.encoder.marks["\n"], self.encoder.firsts
            return self[first] + b"".join([feed + firsts[p] for p in rest])
        if part[-1:] in _MARKS and part:
            word = part.rstrip(_MARKS)
            if word.isalpha():
                return self[word] + self.encoder.marks[part[len(word):]]
        ids = self.encoder.word(part, self.space)
        if len(part) <= LONGEST_CACHED and len(self) < self.most:
            self[part] = ids
        return ids


class _Marks(dict):
    """Ids of marks behind a word, and of a line feed."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, part: str) -> bytes:
        ids = self.encoder.whole(part)
        if len(part) <= LONGEST_CACHED and len(self) < CACHE_MARKS:
            self[part] = ids
        return ids


class Encoder:
    def __init__(self, path: str, words: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.parts, self.firsts, self.marks = _Words(self, " ", words), _Words(self, "", words), _Marks(self)
        # one word alone needs no pre-tokenizer, only its bytes in the model's alphabet
        alphabet = ByteLevel(add_prefix_space=False, use_regex=False)
        self.model = self.tokenizer.model
        self.letters = frozenset(_LETTERS)
        self.bytes = {ord(c): alphabet.pre_tokenize_str(c)[0][0] for c in [" ", *_LETTERS]}

    def whole(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers, by one call of the library."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes() if text else b""

    def word(self, part: str, space: str) -> bytes:
        if part.isalpha() and (part.isascii() or self.letters.issuperset(part)):
            tokens = self.model.tokenize(self.bytes[32] * len(space) + (part if part.isascii() else part.translate(self.bytes)))
            return array("I", [t.id for t in tokens]).tobytes()
        return self.whole(space + part)

    def documents(self, texts: pa.Array) -> list[bytes]:
        """For each text its ids, then the end id; null is empty."""
        end = END_ID.to_bytes(4, "little")
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _ODD_SPACE)
        for s in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, s))
        out = [self.whole(t.as_py()) + end if o.as_py() else b"" for t, o in zip(texts, odd, strict=True)]
        plain = texts.filter(pc.invert(odd))
        if not len(plain):
            return out
        lists = pc.split_pattern(plain, " ")
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        parts = lists.flatten().dictionary_encode()
        codes, known = parts.indices.to_numpy().copy(), parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        firsts = bounds[:-1]                                # a text's first part has no space in front
        parts, first = self.parts, self.firsts
        blobs = [parts[p] for p in known] + [first[known[c]] for c in codes[firsts]]
        codes[firsts] = np.arange(len(known), len(blobs))
        sizes = np.fromiter(map(len, blobs), np.int32, len(blobs)) // 4
        flat = np.frombuffer(b"".join(blobs), "<u4")
        begins = np.cumsum(sizes, dtype=np.int32) - sizes       # a batch's text is bounded, so this is enough
        rows = np.flatnonzero(~np.array(odd.to_pylist(), bool)).tolist()
        for low in range(0, len(rows), TEXTS_AT_ONCE):
            edges = bounds[low: low + TEXTS_AT_ONCE + 1]
            some = codes[edges[0]: edges[-1]]
            n = sizes[some]
            ends = np.cumsum(n)
            places = np.repeat(begins[some] - (ends - n), n)
            places += np.arange(len(places))
            ids = flat.take(places)
            stops = ends[edges[1:] - edges[0] - 1].tolist()
            for row, start, stop in zip(rows[low: low + TEXTS_AT_ONCE], [0, *stops[:-1]], stops, strict=True):
                out[row] = ids[start:stop].tobytes() + end
        return out


@functools.lru_cache(maxsize=1)
def encoder(path: str, words: int = CACHE_WORDS) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(path, words)
