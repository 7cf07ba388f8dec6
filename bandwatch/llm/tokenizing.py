"""Token ids of whole texts, word by word through a bounded cache.

A tokenizer of the ``tokenizers`` library first cuts a text into pieces that never
cross certain white space, so the ids of a text are those of its words one after
the other. Words repeat, so texts are cut in Arrow, some megabytes at a time, and
each word of a lot is looked up once, without the marks after it; what was encoded
is kept. Texts that this does not hold for are encoded whole.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
CACHED_WORDS = 200_000
KEPT_WORDS = 50_000  # outlast a task, some 10 MB
LONGEST_CACHED = 48
MARKS = ".,;:!?|#$%&*()"  # a run of them after letters is a piece of its own
ROWS = 2000  # texts that operators give at a time
LOT_BYTES = 4 << 20  # of texts cut into words at a time, or one text that is larger


def vocabulary(name: str) -> str:
    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """How byte-level models write a byte: itself where printable, else the next free letter from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


LETTERS = _byte_letters()

# white space beside white space, at the ends, or other than space and line end
ODD_SPACE = r"\A[ \n]|[ \n]\z|[ \n]{2}|[" + "".join(
    rf"\x{{{i:x}}}" for i in range(sys.maxunicode + 1) if chr(i).isspace() and chr(i) not in " \n") + "]"


class _Words(dict):
    """Word to ids as bytes; at the limit the older generation goes. Words without ids are not kept."""

    def __init__(self, encode: Callable[[str], bytes | None], limit: int):
        super().__init__()
        self.encode, self.limit, self.old = encode, limit, {}

    def __missing__(self, word: str) -> bytes | None:
        ids = self.old.get(word)
        if ids is None:
            ids = self.encode(word)
        if ids is not None and len(word) <= LONGEST_CACHED:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def settle(self) -> None:
        kept = dict(islice((self.old or self).items(), KEPT_WORDS))
        self.old = {}
        self.clear()
        self.update(kept)


class TextEncoder:
    """``encode_all(texts)`` gives little-endian unsigned 32-bit ids, equal to those of the tokenizer on the whole texts."""

    def __init__(self, path: str, cached_words: int = CACHED_WORDS):
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self._added = [a.content for a in added]  # found in the text before it is cut into pieces
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre = spec["pre_tokenizer"] or {}
        self._stem = None  # texts are encoded whole
        if any(a.normalized for a in added):  # looked for in normalized text
            pass
        elif pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not spec["normalizer"]:
            self._stem, self._word, self._cut, self._odd_space = self._spaced_stem, self._spaced_word, self._spaced, ODD_SPACE
        elif [p.get("type") for p in pre.get("pretokenizers", [])] == ["Split", "ByteLevel"] and pre["pretokenizers"][0]["invert"] \
                and pre["pretokenizers"][0]["behavior"] == "Removed":
            self._stem, self._word, self._cut, self._odd_space = self._bare_stem, self._whole, self._bare, None
        if self._stem:
            self.stems, self.words = _Words(self._stem, cached_words), _Words(self._word, cached_words // 2)
            self._marks = _Words(self._whole, 1000)
        self._pieces = self.tokenizer.model.tokenize
        self._bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]

    def settle(self) -> None:
        """At a task's end: keep the words that came first, the frequent ones, since the process goes on to other work."""
        if self._stem:
            self.stems.settle()
            self.words.settle()
        pa.default_memory_pool().release_unused()

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text], pa.large_string()))[0]

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Ids of every text; null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        out, start = [], 0
        while start < len(texts):
            before = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, before + LOT_BYTES, "right")))
            out += self._lot(texts.slice(start, end - start))
            start = end
        return out

    def _lot(self, texts: pa.Array) -> list[bytes]:
        whole = self._odd(texts)
        out = [b""] * len(texts)
        at = np.flatnonzero(~whole).tolist()
        for i in np.flatnonzero(whole).tolist():
            out[i] = self._whole(texts[i].as_py())
        if at:
            words = self._cut(texts.filter(pa.array(~whole)))
            distinct = words.flatten().dictionary_encode()
            ids = self._ids(distinct.dictionary).take(distinct.indices)
            _, ends, data = ids.buffers()
            raw = data.to_pybytes() if data else b""
            places = np.frombuffer(ends, np.int64, len(ids) + 1)[words.offsets.to_numpy()].tolist()
            for i, a, b in zip(at, places, places[1:]):
                out[i] = raw[a:b]
        return out

    def _odd(self, texts: pa.Array) -> np.ndarray:
        """Which texts are encoded whole."""
        if not self._stem:
            return np.ones(len(texts), bool)
        odd = np.zeros(len(texts), bool)
        if self._odd_space:
            odd |= pc.match_substring_regex(texts, self._odd_space).to_numpy(zero_copy_only=False)
        for added in self._added:
            odd |= pc.match_substring(texts, added).to_numpy(zero_copy_only=False)
        return odd

    def _ids(self, words: pa.Array) -> pa.Array:
        """Ids of distinct words: those of a stem of letters and those of the marks after it, or of the whole word."""
        cut = pc.utf8_rtrim(words, MARKS)
        distinct = cut.dictionary_encode()
        kept = self.stems
        stems = pa.array([kept[x] for x in _strings(distinct.dictionary)], pa.large_binary())
        n_marks = pc.subtract(pc.binary_length(words), pc.binary_length(cut)).to_numpy(zero_copy_only=False)
        marked = np.flatnonzero(n_marks)
        ends = pa.array([x[-n:] for x, n in zip(_strings(words.take(pa.array(marked))), n_marks[marked].tolist())], pa.large_string()).dictionary_encode()
        marks = pa.array([b"", *[self._marks[x] for x in ends.dictionary.to_pylist()]], pa.large_binary())
        which = np.zeros(len(words), np.int64)
        which[marked] = ends.indices.to_numpy() + 1
        ids = pc.binary_join_element_wise(stems.take(distinct.indices), marks.take(pa.array(which)), pa.scalar(b"", pa.large_binary()))
        if ids.null_count:
            other = ids.is_null()
            kept = self.words
            ids = pc.replace_with_mask(ids, other, pa.array([kept[x] for x in words.filter(other).to_pylist()], pa.large_binary()))
        return ids

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, letters: str) -> bytes:
        known = self._bytes
        return b"".join([known[t.id] for t in self._pieces(letters)])

    @staticmethod
    def _plain(word: str) -> bool:
        """Letters up to U+00FF only: one piece, whatever Unicode version a library knows."""
        return word.isalpha() and (word.isascii() or max(word) <= "ÿ")

    @staticmethod
    def _spell(word: str) -> str:
        return word if word.isascii() else word.encode().decode("latin1").translate(LETTERS)

    # words that carry the space before them; a carriage return, which is never part of one, marks the text's first
    @staticmethod
    def _spaced(texts: pa.Array) -> pa.ListArray:
        marked = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar("\r", pa.large_string()))
        return pc.split_pattern(pc.replace_substring(marked, "\n", " \n"), " ")

    def _spaced_stem(self, word: str) -> bytes | None:
        """Letters after a space; after a line end, with it; the text's first. None for other words."""
        if word.isalpha() and word.isascii():
            return self._piece(LETTERS[32] + word)
        head = word[:1]
        body = word[1:] if head and head in "\r\n" else word
        if not self._plain(body):
            return None
        if head == "\n":
            return self._marks["\n"] + self._piece(self._spell(body))
        return self._piece(("" if head == "\r" else LETTERS[32]) + self._spell(body))

    def _spaced_word(self, word: str) -> bytes:
        return self._whole({"\r": word[1:], "\n": word}.get(word[0], " " + word))

    # words without any white space
    @staticmethod
    def _bare(texts: pa.Array) -> pa.ListArray:
        return pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")

    def _bare_stem(self, word: str) -> bytes | None:
        """Nothing stands between white space, and before a word that is all marks."""
        if not word:
            return b""
        return self._piece(self._spell(word.lower())) if self._plain(word) else None


def _strings(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()  # quicker than to_pylist


_ENCODERS: dict[tuple[str, int], TextEncoder] = {}


def encoder(path: str, cached_words: int = CACHED_WORDS) -> TextEncoder:
    """One encoder per worker process, so its words outlast a task."""
    if (path, cached_words) not in _ENCODERS:
        _ENCODERS[path, cached_words] = TextEncoder(path, cached_words)
    return _ENCODERS[path, cached_words]
