"""Encoders over the public vocabulary files, one per worker and file."""

from __future__ import annotations

import base64
import json
import os
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import regex

END_ID = 1


def pattern() -> str:
    """The pattern that cuts a text into the pieces a byte-level BPE encodes one by one."""
    import public_tokenizers

    return public_tokenizers.PATTERN


@lru_cache
def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    shown = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def ranks_of(path: str) -> dict[bytes, int]:
    """Token bytes and their rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@lru_cache
def byte_level_encoder(path: str) -> Callable[[str], np.ndarray]:
    """Ids of a text as the tokenizers library gives them for the byte-level BPE in `path`.

    In such a vocabulary a token's id is also the rank of the merge that makes
    it, so tiktoken finds the same ids several times faster. A text that holds
    the string of a special token goes to the tokenizers library itself, which
    is loaded when the first such text comes.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    special = [token["content"] for token in spec["added_tokens"]]
    alphabet = byte_alphabet()
    ranks = {
        bytes(alphabet[c] for c in token): rank
        for token, rank in spec["model"]["vocab"].items()
        if token not in special
    }
    fast = tiktoken.Encoding("byte-level", pat_str=pattern(), mergeable_ranks=ranks, special_tokens={})

    @lru_cache
    def whole():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(path)

    def encode(text: str) -> np.ndarray:
        if any(token in text for token in special):
            return np.array(whole().encode(text, add_special_tokens=False).ids, np.uint32)
        return fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32, copy=False)

    return encode


class _WordIds(dict):
    """Numbers words as they are first met."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class WordEncoder:
    """Ids as the tokenizers library gives them for a BPE with word ends, each distinct word encoded once.

    Such a vocabulary cuts a normalised text into words and drops the rest, and
    a word's ids do not depend on its neighbours. Texts for which the short form
    of the normalisation might differ go to the library whole.
    """

    KNOWN_WORDS = 1 << 20

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core already
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self._special = [token["content"] for token in spec["added_tokens"]]
        steps = [step["type"] for step in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if steps != ["NFC", "Replace", "Lowercase"] or split["type"] != "Split" or not split["invert"]:
            raise ValueError(f"{path} is not a BPE of lower-case words")
        self._find = regex.compile(split["pattern"]["Regex"]).findall
        self._forget()

    def _forget(self) -> None:
        self._numbers = _WordIds()
        self._ids: list[bytes] = []

    def _words(self, text: str) -> list[str] | None:
        if any(token in text for token in self._special) or "Σ" in text:  # Python lowers a final sigma by its place
            return None
        return self._find((text if text.isascii() else unicodedata.normalize("NFC", text)).lower())

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if len(self._numbers) > self.KNOWN_WORDS:
            self._forget()
        known, number = len(self._ids), self._numbers.__getitem__
        cut = [self._words(text) for text in texts]
        used = [None if words is None else list(map(number, words)) for words in cut]
        fresh = list(self._numbers)[known:] if len(self._numbers) > known else []
        found = self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False) if fresh else []
        self._ids += [np.array(word.ids, "<u4").tobytes() for word in found]
        part = self._ids.__getitem__
        return [
            np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            if of is None
            else b"".join(map(part, of))
            for text, of in zip(texts, used, strict=True)
        ]


@lru_cache
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)
