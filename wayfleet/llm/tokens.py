"""Exact token ids of whole texts by a vocabulary file of the tokenizers library.

Ordinary texts are encoded by tiktoken from the same vocabulary, four times as fast and to the same ids: a test compares the
two. Two kinds of text go to tokenizers piece by piece: those with a special string, which it reads as one
id, and those with a very long run of white space, which tiktoken's pattern cannot walk. A piece begins before white space:
the splitting pattern never joins a character that is not white space with white space after it, so the ids of the pieces
in a row are the ids of the whole.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

# White space as the splitting pattern of the vocabulary understands it, and that pattern.
_WHITE = "\t-\r \x85\xa0  -     　"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PIECE = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
# Runs of white space from this length on are not given to tiktoken.
LONG_RUN = 10_000


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Where a vocabulary file of the installed tokenizer package is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def read_vocabulary(path: str | None = None) -> str:
    """The vocabulary file as text; the driver reads it and broadcasts it, a fixed file of a few megabytes."""
    with open(path or vocabulary_path(), encoding="utf-8") as file:
        return file.read()


def _byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """``ids(text)``: what the vocabulary's ``encode(text, add_special_tokens=False)`` gives for the whole text; without ``special``, special strings are ordinary text."""

    def __init__(self, vocabulary: str, special: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        whole = Tokenizer.from_str(vocabulary)
        whole.encode_special_tokens = not special
        declared = json.loads(vocabulary)
        names = [t["content"] for t in declared["added_tokens"]] if special else []
        byte_of = _byte_characters()
        ranks = {bytes(byte_of[c] for c in token): i for token, i in declared["model"]["vocab"].items() if all(c in byte_of for c in token)}
        self._whole = whole.encode
        self._fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_to_numpy
        self._odd = re.compile("|".join([*map(re.escape, names), f"[{_WHITE}]{{{LONG_RUN},}}"]))

    def ids(self, text: str | None) -> np.ndarray:
        """Unsigned 32-bit ids; none for null and empty texts."""
        text = text or ""
        if not self._odd.search(text):
            return self._fast(text, disallowed_special=())
        return np.concatenate([self._piece(p) for p in PIECE.findall(text)])

    def _piece(self, piece: str) -> np.ndarray:
        if self._odd.search(piece):
            return np.array(self._whole(piece, add_special_tokens=False).ids, np.uint32)
        return self._fast(piece, disallowed_special=())


_ENCODERS: dict[tuple[int, bool], Encoder] = {}


def encoder_of(vocabulary: str, special: bool = True) -> Encoder:
    """One encoder for a vocabulary in each Python worker."""
    key = hash(vocabulary), special
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(vocabulary, special)
    return _ENCODERS[key]
