"""Byte-level BPE with the public vocabulary files: fast ids of whole texts."""

from __future__ import annotations

import base64
import json
import re
from functools import lru_cache

import public_tokenizers
import tiktoken

VOCABULARY = "byte_bpe_50k"
_GAP = re.compile(r" (?=\S)")
_ODD = re.compile(r" \s| $")


def rank_table(path: str | None = None) -> dict[bytes, int]:
    with open(path or public_tokenizers.path(f"{VOCABULARY}.tiktoken"), "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


@lru_cache(2)
def encoding(path: str | None = None) -> tiktoken.Encoding:
    return tiktoken.Encoding(VOCABULARY, pat_str=public_tokenizers.PATTERN, mergeable_ranks=rank_table(path), special_tokens={})


def pieces(text: str) -> list[str]:
    """text cut before each single space that a non-space follows: no match of PATTERN crosses such a place.

    The pattern takes such a space only as the start of a match, so the pieces can be encoded, and remembered, one by one.
    """
    parts = _GAP.split(text) if _ODD.search(text) else text.split(" ")
    return [parts[0], *(" " + p for p in parts[1:])]


@lru_cache(1)
def added(path: str | None = None) -> tuple[re.Pattern, dict[str, int]]:
    """The tokens that the `tokenizers` file takes out of a text before anything else, as a splitting pattern and by id."""
    with open(path or public_tokenizers.path(f"{VOCABULARY}.json")) as f:
        found = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    return re.compile("(" + "|".join(map(re.escape, found)) + ")"), found
