"""Token ids of the public word BPE vocabulary, looked up word by word.

The vocabulary's pre-tokenizer never joins text across white space, so a text's ids are the
ids of its words in order. Words repeat, hence each worker keeps the ids of those it has seen.
"""

from __future__ import annotations

import os
import sys
import unicodedata
from array import array
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
CACHED_WORDS = 800_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


# The vocabulary's alphabet: printable Latin-1 bytes stand for themselves, others follow from 256.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_ALPHABET = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}


def _is_plain_word(text: str) -> bool:
    """Lower-case Latin letters only, composed: one piece that no rule changes or splits."""
    if not text.isalpha():
        return False
    return text.isascii() or (
        max(text) < "\u0250" and text == text.lower() and unicodedata.is_normalized("NFC", text)
    )


def _kept_by_worker(key: tuple) -> dict:
    """A dict that later tasks of the same Python worker find again."""
    module = sys.modules.setdefault("_word_ids_of_worker", ModuleType("_word_ids_of_worker"))
    return module.__dict__.setdefault(key, {})


# Marks that are tokens of their own after a letter. Angle brackets may end a special token, and
# an apostrophe may begin an ending such as 's.
_MARKS = b"!\"#$%&()*+,-./:;=?@[\\]^_`{|}~"
TOGETHER = 4 << 20  # characters looked up at a time


class WordIds:
    def __init__(self, path: str, code: str = "I", special_tokens_are_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.code = code  # "I": 32 bits, "H": 16 bits
        self.tokenizer.encode_special_tokens = special_tokens_are_text
        self.seen: dict[bytes, bytes] = _kept_by_worker((path, code, special_tokens_are_text))

    def _learn(self, words: list[bytes]) -> None:
        """The vocabulary lower-cases all text, so a word is its lower case, and where that is a
        plain word before marks, the ids of both."""
        seen, split, code = self.seen, self.tokenizer.model.tokenize, self.code
        lower = b"\n".join(words).lower().split(b"\n")  # words hold no white space
        cores = [w.rstrip(_MARKS) for w in lower]
        distinct = list(set(cores))  # also those seen: a word of marks may have been, as a whole
        joined = b"\n".join(distinct)
        texts = joined.decode("utf-8", "replace").split("\n")
        letters = joined.decode("latin-1").translate(_ALPHABET | {10: 10}).split("\n")
        mixed = set()
        for core, text, own in zip(distinct, texts, letters):
            if not _is_plain_word(text):
                mixed.add(core)
            elif core not in seen:  # straight to the merges
                seen[core] = array(code, [t.id for t in split(own)]).tobytes()
        whole = set()
        for word, core in zip(lower, cores):
            if core in mixed or not core:
                whole.add(word)
            elif len(core) < len(word):
                whole.add(word[len(core) :])
        whole = [w for w in whole if w not in seen]
        texts = [w.decode("utf-8", "replace") for w in whole]
        for word, encoded in zip(whole, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            seen[word] = array(code, encoded.ids).tobytes()
        for word, small, core in zip(words, lower, cores):
            if core in mixed or not core:
                seen[word] = seen[small]
            else:
                seen[word] = seen[core] + seen[small[len(core) :]] if len(core) < len(small) else seen[core]

    def _together(self, texts: list[str]) -> list[bytes]:
        parts = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        words = parts.flatten().dictionary_encode()
        known = words.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        if len(self.seen) > CACHED_WORDS:
            self.seen.clear()
        own = list(map(self.seen.get, known))
        if None in own:
            self._learn([w for w, ids in zip(known, own) if ids is None])
            own = [self.seen[w] if ids is None else ids for w, ids in zip(known, own)]
        sizes = np.fromiter(map(len, own), np.int64, len(own)) // array(self.code).itemsize
        ids = gathered(np.frombuffer(b"".join(own), self.code), sizes, words.indices.to_numpy())
        ends = np.r_[0, np.cumsum(sizes[words.indices.to_numpy()])][parts.offsets.to_numpy()]
        return [ids[low:high].tobytes() for low, high in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def raws(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids as little-endian integers, without an end id; empty for a null."""
        out, held, size = [], [], 0
        for text in texts:
            held.append(text or "")
            size += len(held[-1])
            if size >= TOGETHER:
                out += self._together(held)
                held, size = [], 0
        return out + self._together(held) if held else out

    def raw(self, text: str | None) -> bytes:
        return self.raws([text])[0]


def gathered(flat: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Pieces of ``flat`` (of given sizes, one after the other) in the order of ``which``."""
    counts = sizes[which]
    starts = (np.cumsum(sizes) - sizes)[which]
    return flat[np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())]
