"""Token ids by public tokenizer files, loaded once per worker process.

``.json`` files mean what the ``tokenizers`` library makes of them, ``.model`` files what
``sentencepiece`` does and ``.tiktoken`` files what ``tiktoken`` does. A ``.json`` file that
holds a plain byte-level BPE whose ids are its merge ranks is run by ``tiktoken``, which
gives the same ids in a quarter of the time (tests compare both); where its pattern engine
gives up on a text, as on very long runs of white space, ``tokenizers`` itself encodes it.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Callable, Sequence
from functools import lru_cache
from pathlib import Path

import numpy as np

Encode = Callable[[Sequence[str]], list[np.ndarray]]

# Fixed value: the pre-tokenizer pattern of byte-level BPE.
BYTE_LEVEL_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def version(path: str) -> str:
    """A digest of all that a count depends on besides the text."""
    return hashlib.sha256(Path(path).suffix.encode() + Path(path).read_bytes()).hexdigest()


@lru_cache(maxsize=4)
def load(path: str) -> Encode:
    kind = Path(path).suffix
    if kind == ".json":
        return _json(path)
    if kind == ".model":
        return _sentencepiece(path)
    if kind == ".tiktoken":
        return _tiktoken(path)
    raise ValueError(f"no tokenizer library for {path}")


def _json(path: str) -> Encode:
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)

    def by_library(texts: Sequence[str]) -> list[np.ndarray]:
        found = slow.encode_batch_fast(list(texts), add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in found]

    parts = _byte_level(json.loads(Path(path).read_text()))
    if parts is None:
        return by_library
    import tiktoken

    ranks, special = parts
    fast = tiktoken.Encoding(
        "json", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens=special
    )

    def one(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # the pattern needs more stack than it may take
            return by_library([text])[0]

    return lambda texts: [one(x) for x in texts]


def _byte_level(spec: dict) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """(ranks, special tokens) if the file is byte-level BPE without further settings."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE"
        and spec.get("normalizer") is None
        and pre.get("type") == "ByteLevel"
        and not pre.get("add_prefix_space")
        and pre.get("use_regex", True)
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    )
    if not plain:
        return None
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    # Byte-level files spell each byte as a printable character: the printable ones as
    # themselves, the others from U+0100 on.
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    byte_of = {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(others)}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    vocab = {t: i for t, i in model["vocab"].items() if t not in special}
    if [vocab.get(a + b) for a, b in merges] != list(range(256, 256 + len(merges))):
        return None
    return {bytes(byte_of[c] for c in t): i for t, i in vocab.items()}, special


def _sentencepiece(path: str) -> Encode:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [np.array(x, np.uint32) for x in model.encode(list(texts), num_threads=1)]


def _tiktoken(path: str) -> Encode:
    import tiktoken

    lines = (line.split() for line in Path(path).read_bytes().splitlines() if line)
    ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
    own = tiktoken.Encoding(
        "file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return lambda texts: [np.array(own.encode_ordinary(x), np.uint32) for x in texts]
