"""Token ids of whole texts inside tasks: distinct words of many texts at once, and a bounded memo of words."""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER = "word_bpe_49k.json"
#: Words that a worker remembers, about 250 bytes each; beyond it the memo starts anew.
MEMO_WORDS = 1_200_000
#: Characters of texts that are taken together, or one longer text.
CHUNK = 8_000_000
#: Fixed values of the tokenizer file: how it cleans a text and splits it into words.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: Texts of these characters need no normalising but lower case, which keeps letters among these letters
#: (of İ it makes two characters), and the split below equals the tokenizer's.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-įı-ſ“”‘’–—…«»¿¡€°]*")
#: What is a word though no blank parts it from its neighbours; of the rest letters are words.
_APART = r"('(?:s|t|re|ve|m|ll|d)|[0-9]|[^\sa-zß-öø-ſ0-9]+)"


def default_path() -> str:
    return public_tokenizers.path(TOKENIZER)


class Encoder:
    """``ids(text)``: the token ids as little-endian unsigned 32-bit integers.

    With a tokenizer that treats every word alone, texts are split many at a time, their distinct
    words are looked up once, and each new one is tokenized once. Texts with other characters,
    and all texts of other tokenizers, go to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already uses every core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self._by_word = (
            (spec.get("normalizer") or {}).get("normalizers") == _NORMALIZERS
            and steps[0].get("pattern") == {"Regex": _SPLIT}
        )
        self._special = [t["content"] for t in spec.get("added_tokens", [])]
        self._forget()
        if self._by_word:
            suffix, vocabulary = spec["model"]["end_of_word_suffix"], spec["model"]["vocab"]
            self._last = np.zeros(max(vocabulary.values()) + 1, bool)
            model = self._tokenizer.model
            model._resize_cache(0)  # each word is asked for once; the library's own memo would only cost
            self._tokenizer.model = model
            self._tokenize = self._tokenizer.model.tokenize
            self._last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _forget(self) -> None:
        """Word n has the ids from ``_ends[n]`` to before ``_ends[n + 1]``; word 0 is empty."""
        self._memo: dict[str, int] = {"": 0}
        self._ids, self._ends = np.zeros(0, "<u4"), np.zeros(2, np.int64)

    def _whole(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str | None) -> bytes:
        return next(self.each([text]))

    def each(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of every text, in order."""
        held: list[str | bytes] = []
        size = 0
        for text in texts:
            if not text:
                held.append(b"")
            elif not self._by_word or not _PLAIN.fullmatch(text) or any(s in text for s in self._special):
                held.append(self._whole(text))
            else:
                held.append(text.lower())
                size += len(text)
            if size >= CHUNK or len(held) >= CHUNK:
                yield from self._together(held)
                held, size = [], 0
        yield from self._together(held)

    def _together(self, held: list[str | bytes]) -> Iterator[bytes]:
        texts = pa.array([h for h in held if isinstance(h, str)], pa.large_string())
        words = pc.ascii_split_whitespace(pc.replace_substring_regex(texts, _APART, r" \1 "))
        coded = words.flatten().dictionary_encode()
        number = self._numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        first, n = self._ends[number], self._ends[number + 1] - self._ends[number]
        place = np.concatenate([[0], np.cumsum(n)])
        ids = self._ids[np.repeat(first - place[:-1], n) + np.arange(place[-1])]
        bounds = iter(place[words.offsets.to_numpy()].tolist())
        start = next(bounds, 0)
        for h in held:
            if isinstance(h, bytes):
                yield h
            else:
                end = next(bounds)
                yield ids[start:end].tobytes()
                start = end

    def _numbers(self, words: list[str]) -> np.ndarray:
        """The number of each of the words, which are distinct."""
        found = list(map(self._memo.get, words))
        new = [w for w, n in zip(words, found) if n is None]
        if new:
            if len(self._memo) + len(new) > MEMO_WORDS:
                self._forget()
                new = [w for w in words if w]
            self._learn(new)
            found = list(map(self._memo.__getitem__, words))
        return np.array(found, np.int64)

    def _learn(self, words: list[str]) -> None:
        # The steps before the model leave a word of ASCII as it is.
        plain = [w for w in words if w.isascii()]
        other = [w for w in words if not w.isascii()]
        ids = [[t.id for t in self._tokenize(w)] for w in plain]
        sizes = [len(i) for i in ids]
        found = np.fromiter((i for own in ids for i in own), "<u4", sum(sizes))
        if other:
            # Blanks part words, so one call serves them all; the last token of each says so.
            more = np.array(self._tokenizer.encode(" ".join(other), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(self._last[more]) + 1
            if len(ends) != len(other):
                raise ValueError("the tokenizer does not end each word")
            found = np.concatenate([found, more])
            sizes += np.diff(ends, prepend=0).tolist()
        self._memo.update(zip([*plain, *other], range(len(self._ends) - 1, len(self._ends) - 1 + len(words))))
        self._ends = np.concatenate([self._ends, self._ends[-1] + np.cumsum(sizes)])
        self._ids = np.concatenate([self._ids, found])


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process; the memo outlives a task."""
    return Encoder(path)
