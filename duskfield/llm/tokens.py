"""Encoders that give the ids of a tokenizer file, by quicker ways where these are known to give the same."""

from __future__ import annotations

import base64
import os
from functools import lru_cache
from pathlib import Path

import numpy as np
import public_tokenizers
import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
os.environ.setdefault("RAYON_NUM_THREADS", "1")

#: Characters on whose classes all Unicode versions agree, none of which composes with another: up to Latin Extended-A,
#: and the common dashes, quotes and currency signs. Texts with others go to the tokenizer itself.
PLAIN = regex.compile(r"[\x00-ſ‐-‧‰-⁞€\n]*+")


@lru_cache(maxsize=4)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _ranked(path: str):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(path).read_bytes().splitlines())}
    return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class ByteEncoder:
    """Ids of a byte-level tokenizer file without added tokens. ``ranks_path`` may name the same vocabulary as ranks."""

    def __init__(self, path: str, ranks_path: str | None = None):
        self.own = tokenizer(path)
        self.ranked = _ranked(ranks_path) if ranks_path else None
        self.special = [t.content for t in self.own.get_added_tokens_decoder().values()]

    def __call__(self, text: str) -> np.ndarray:
        if self.ranked and not any(s in text for s in self.special) and (text.isascii() or PLAIN.fullmatch(text)):
            return self.ranked.encode_to_numpy(text, allowed_special=set(), disallowed_special=()).astype(np.uint32)
        return np.array(self.own.encode(text, add_special_tokens=False).ids, np.uint32)
