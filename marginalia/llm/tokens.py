"""Byte-level BPE ids, shared by the operators that count or pack tokens."""

from __future__ import annotations

import base64
import json
from functools import lru_cache
from pathlib import Path

import numpy as np


def default_vocabulary() -> str:
    """Path of the public 50k byte-level BPE ranks (the vocabulary of byte_bpe_50k.json)."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _description(path: str | None) -> Path:
    """The vocabulary's file for the ``tokenizers`` library, which stands beside its ranks."""
    return Path(path or default_vocabulary()).with_suffix(".json")


@lru_cache(maxsize=2)
def encoding(path: str | None):
    """One encoder a worker process, with the added tokens of the vocabulary's description."""
    import public_tokenizers
    import tiktoken

    with open(path or default_vocabulary(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    added = json.loads(_description(path).read_text())["added_tokens"] if _description(path).exists() else []
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={x["content"]: x["id"] for x in added})


@lru_cache(maxsize=2)
def _library(path: str | None):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(str(_description(path)))


def encode(text: str | None, path: str | None = None) -> np.ndarray:
    """The ids of a whole text as uint32, as ``tokenizers`` gives them without added specials (a null text has none).

    An added token's string in a text becomes its id, as there.  A text whose runs of white space
    are too long for this encoder's regular expressions (some 700,000 characters) goes to that library.
    """
    if not text:
        return np.empty(0, np.uint32)
    try:
        return encoding(path).encode_to_numpy(text, allowed_special="all").astype(np.uint32, copy=False)
    except ValueError:
        return np.array(_library(path).encode(text, add_special_tokens=False).ids, np.uint32)
