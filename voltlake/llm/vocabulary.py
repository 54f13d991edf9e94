"""A byte-level BPE vocabulary, read from a tokenizer file in the library's JSON format.

The path is always a parameter; the file must be readable at the same path on every executor
(an installed package, or a file shipped with the job).
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import regex

# Fixed value: the pre-tokenization rule of this family of vocabularies.
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary file."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


# Ids and ranks are packed into one integer each: comparing and hashing those is what merging does.
BITS = 20
ID = (1 << BITS) - 1
NONE = 1 << 62


def pair_key(left: int, right: int) -> int:
    return left << BITS | right


@dataclass(frozen=True)
class Vocabulary:
    id_of: dict[bytes, int]  # every token that merging can produce, by its bytes
    merges: dict[int, int]  # pair_key(left, right): rank << BITS | id of the merged token
    bytes_of: list[bytes]  # by id, special tokens included
    special: dict[str, int]
    byte_ids: list[int]  # the id of each single byte
    sorted_pairs: np.ndarray  # the keys of merges in order, for look-ups of many at once
    sorted_merges: np.ndarray  # and what belongs to them
    special_pattern: re.Pattern | None

    def find_merges(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``merges`` of many pairs; NONE where there is none, as for negative ids."""
        key = left.astype(np.int64) << BITS | right
        at = np.searchsorted(self.sorted_pairs, key)
        at[at == len(self.sorted_pairs)] = 0
        return np.where(self.sorted_pairs[at] == key, self.sorted_merges[at], NONE)

    def cut_specials(self, text: str) -> list[str]:
        """The text in turns of ordinary text (possibly empty) and special string."""
        return self.special_pattern.split(text) if self.special_pattern else [text]


@lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    model, splitter = told["model"], told["pre_tokenizer"]
    if model["type"] != "BPE" or splitter["type"] != "ByteLevel" or splitter["add_prefix_space"]:
        raise ValueError(f"{path} is not a byte-level BPE file without prefix space")
    if told.get("normalizer") or model.get("ignore_merges") or model.get("dropout"):
        raise ValueError(f"{path} has settings that are not supported")
    if len(model["vocab"]) > ID:
        raise ValueError(f"{path} has more than {ID} tokens")
    special = {t["content"]: t["id"] for t in told["added_tokens"]}
    alphabet, ids = byte_alphabet(), model["vocab"]
    as_bytes = {t: bytes(alphabet[c] for c in t) for t in ids if t not in special}
    bytes_of = [b""] * (max([*ids.values(), *special.values()]) + 1)
    for token, number in ids.items():
        bytes_of[number] = as_bytes.get(token, token.encode())
    for token, number in special.items():
        bytes_of[number] = token.encode()
    merges = {}
    for rank, pair in enumerate(model["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges.setdefault(pair_key(ids[left], ids[right]), rank << BITS | ids[left + right])
    id_of = {b: ids[t] for t, b in as_bytes.items()}
    return Vocabulary(
        id_of=id_of,
        merges=merges,
        bytes_of=bytes_of,
        special=special,
        byte_ids=[id_of[bytes([b])] for b in range(256)],
        sorted_pairs=np.array(sorted(merges), dtype=np.int64),
        sorted_merges=np.array([merges[k] for k in sorted(merges)], dtype=np.int64),
        special_pattern=re.compile(
            "(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")"
        )
        if special
        else None,
    )
