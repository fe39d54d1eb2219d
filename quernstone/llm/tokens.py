"""Token ids by a public byte-level vocabulary; the strings of its special tokens are these tokens."""

from __future__ import annotations

import base64
import json
import os
from functools import lru_cache

import numpy as np


class Encoder:
    """Encodes by the tokenizer file, or by the same vocabulary as ranks where that file lies beside it.

    The rank file gives equal ids several times as fast.
    """

    def __init__(self, path: str):
        beside = os.path.splitext(path)[0] + ".tiktoken"
        self._ranked = _ranked(path, beside) if os.path.exists(beside) else None
        if self._ranked is None:
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_file(path)

    def ids(self, text: str | None) -> np.ndarray:
        """Ids as unsigned 32-bit numbers."""
        if not text:
            return np.empty(0, np.uint32)
        if self._ranked is not None:
            return self._ranked.encode_to_numpy(text, allowed_special="all")
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


def _ranked(tokenizer: str, path: str):
    import public_tokenizers
    import tiktoken

    with open(tokenizer, encoding="utf-8") as file:
        special = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(path)
