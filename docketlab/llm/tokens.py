"""Token ids of a byte-level BPE file, the same as the ``tokenizers`` library gives for it, by a faster library where both must agree."""

from __future__ import annotations

import json
import re

import numpy as np

#: Splitting pattern of byte-level BPE vocabularies with 50,257 ids (a fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters whose classes every Unicode version and either library agrees on; other texts take the slower library.
COMMON = re.compile("[\t\n\r\x20-\x7e¡-ɏ‐-‧€]*")


def _byte_of_char() -> dict[str, int]:
    """The characters that stand for bytes in such vocabularies: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """``encode(text)`` gives an array of unsigned 32-bit ids. ``source`` is the vocabulary file's content."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_str(source)
        spec = json.loads(source)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.quick = self._quick(spec)

    def _quick(self, spec: dict):
        """The faster library's encoding, if the file is of the kind whose merges follow the order of the ids."""
        import tiktoken

        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        kind = (model["type"], pre.get("type"), pre.get("add_prefix_space"), pre.get("use_regex", True), spec["normalizer"], model.get("dropout"))
        vocab = model["vocab"]
        order = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        if kind != ("BPE", "ByteLevel", False, True, None, None) or order != sorted(order):
            return None
        byte = _byte_of_char()
        ranks = {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in self.special}
        return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self.quick and (text.isascii() and text.isprintable() or COMMON.fullmatch(text)) and not any(s in text for s in self.special):
            return np.array(self.quick.encode_ordinary(text), dtype="<u4")
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype="<u4")


_known: dict[int, Encoder] = {}


def encoder(source: str) -> Encoder:
    """One encoder in each Python worker for each file."""
    key = hash(source)
    if key not in _known:
        _known[key] = Encoder(source)
    return _known[key]
