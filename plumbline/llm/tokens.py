"""Token ids of whole texts, by a tokenizer file of the `tokenizers` library."""

from __future__ import annotations

import json
from functools import cached_property, lru_cache
from pathlib import Path

import numpy as np

#: How a byte-level vocabulary cuts a text before it merges bytes. Fixed value, as in the tokenizer files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Settings under which a file is a plain byte-level BPE: the pre-tokenizer's, and what else must not be there.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
ABSENT = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")


def byte_letters() -> dict[str, int]:
    """How a byte-level vocabulary writes bytes: those that print stand for themselves, the others in order for the
    characters from 256 on."""
    printing = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in printing]
    return {chr(b): b for b in printing} | {chr(256 + i): b for i, b in enumerate(others)}


def merge_ranks(file: dict) -> dict[bytes, int] | None:
    """Ids by the bytes they stand for, if the file is a plain byte-level BPE whose ids are in the order of its merges;
    else None."""
    model, before = file["model"], file["pre_tokenizer"] or {}
    if model.get("type") != "BPE" or any(model.get(name) for name in ABSENT) or file["normalizer"] or file["post_processor"]:
        return None
    if any(before.get(name) != value for name, value in BYTE_LEVEL.items()):
        return None
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [model["vocab"].get(a + b, -1) for a, b in merges]
    letters = byte_letters()
    if len(made) + len(letters) != len(model["vocab"]) or made != sorted(set(made)) or made[:1] < [len(letters)]:
        return None
    return {bytes(letters[c] for c in word): i for word, i in model["vocab"].items()}


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers.

    A plain byte-level BPE is handed to `tiktoken`, which gives the same ids in a third of the time; texts that hold one of the
    file's added tokens, and all texts of other files, are encoded by `tokenizers`, which is kept from the first of them on.
    """

    def __init__(self, path: str):
        self.path = path
        self.vocabulary = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        file = json.loads(Path(path).read_text(encoding="utf-8"))
        self.added = [token["content"] for token in file["added_tokens"]]
        ranks = merge_ranks(file)
        self.fast = None
        if ranks is not None:
            from tiktoken import Encoding

            self.fast = Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            del self.tokenizer  # held once more than is needed

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def one(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.fast is None or any(token in text for token in self.added):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; those of null are empty."""
        return [self.one(text) for text in texts]


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One for each tokenizer and Python worker."""
    return Encoder(path)
