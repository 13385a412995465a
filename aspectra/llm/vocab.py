"""Public tokenizer files, loaded once per Python worker; paths are parameters."""

from __future__ import annotations

import base64
from functools import lru_cache


def default_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=4)
def rank_encoding(path: str):
    """A tiktoken encoding over a rank file, without special tokens."""
    import tiktoken
    return tiktoken.Encoding("ranks", pat_str=split_pattern(), mergeable_ranks=ranks(path), special_tokens={})


@lru_cache(maxsize=4)
def hf_tokenizer(path: str):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


@lru_cache(maxsize=4)
def special_ids(path: str) -> dict[str, int]:
    """Added tokens of a tokenizers file: they are cut out of a text before anything else."""
    import json
    with open(path, encoding="utf-8") as f:
        return {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
