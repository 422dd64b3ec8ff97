"""The public tokenizer whose tokens measure texts. Its files are read from a path and never copied."""

from __future__ import annotations

import base64
from functools import lru_cache
from pathlib import Path

#: Where the vocabulary files of the public tokenizers lie on every executor.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: the public pattern that cuts a text before byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoder(path: str = VOCABULARY):
    """The tokenizer of a vocabulary file, once per process."""
    import tiktoken

    ranks = {}
    for line in Path(path).read_bytes().splitlines():
        if line:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return tiktoken.Encoding("cauce", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
