"""Byte-level tokenizers from files of merge ranks. The driver reads the file; tasks get its bytes."""

from __future__ import annotations

import base64
import hashlib

import tiktoken

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed: how the public vocabulary's words are found, in the form that does not backtrack.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


def read_ranks(path: str = RANKS) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encoder(ranks: bytes) -> tiktoken.Encoding:
    """The encoder of these ranks, made once in each Python worker."""
    from tiktoken.registry import ENCODINGS  # here, so that it does not travel with this function

    name = hashlib.sha256(ranks).hexdigest()
    if name not in ENCODINGS:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        ENCODINGS[name] = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
    return ENCODINGS[name]
