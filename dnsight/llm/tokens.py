"""Byte-level BPE ids of texts by the vocabulary of a tokenizers file."""

from __future__ import annotations

import json

import numpy as np
import tiktoken
from tokenizers import Tokenizer

#: Fixed value: the pre-token pattern of the byte-level vocabulary.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def default_tokenizer() -> str:
    """Path of the public vocabulary that the registered queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _ranks(path: str, special: list[str]) -> dict[bytes, int]:
    """Token bytes and ids of a byte-level vocabulary; ids are in the order of the merges."""
    with open(path, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    # In the file, printable Latin-1 characters stand for themselves, other bytes for U+0100 and up.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    return {
        bytes(byte[c] for c in token): number
        for token, number in vocabulary.items() if token not in special
    }


class Encoder:
    """Ids as the tokenizers library gives them with add_special_tokens=False.

    Texts are encoded by the same vocabulary and merges in tiktoken, which is several times faster;
    a text that contains a special token goes to the tokenizers library itself.
    """

    def __init__(self, path: str):
        self.plain = Tokenizer.from_file(path)
        self.special = [t.content for t in self.plain.get_added_tokens_decoder().values()]
        self.fast = tiktoken.Encoding(
            "vocabulary", pat_str=PATTERN, mergeable_ranks=_ranks(path, self.special),
            special_tokens={},
        )

    def ids(self, text: str) -> np.ndarray:
        """Ids of a text, little-endian unsigned 32 bits."""
        if any(s in text for s in self.special):
            return np.array(self.plain.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.fast.encode_ordinary(text), "<u4")
