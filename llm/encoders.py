"""Public tokenizers inside tasks."""

from __future__ import annotations

import hashlib
import json
import os
from functools import lru_cache

import numpy as np

#: How a byte-level BPE splits text before merging. A fixed value of that tokenizer.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def resolve(name: str) -> str:
    """A path as it is; a bare file name is looked up among the public tokenizers of this machine."""
    if os.path.basename(name) != name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def version(name: str) -> str:
    """Digest of the tokenizer's file."""
    with open(resolve(name), "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


@lru_cache(maxsize=4)
def encoder(name: str, plain: bool = False) -> "Encoder":
    return Encoder(resolve(name), plain)


class Encoder:
    """Ids of texts, without begin, end or other added ids.

    A .json file is read by tokenizers, a .model file by sentencepiece. Where the
    .json file describes a plain byte-level BPE, the same merges run in tiktoken,
    several times as fast, for texts without characters on which the two
    libraries' classes could differ; all others stay with tokenizers. With `plain`
    the strings of special tokens inside a text are text like any other.
    """

    def __init__(self, path: str, plain: bool = False):
        self.fast = self.special = None
        self.plain = plain
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._encode = lambda text: model.encode(text, num_threads=1)
            return
        self._path, self._slow = path, None
        with open(path, encoding="utf-8") as file:
            ranks, self.special = _plain_ranks(json.load(file))
        if ranks:
            import tiktoken

            self.fast = tiktoken.Encoding("plain", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def _encode(self, text: str) -> list[int]:
        if self._slow is None:  # loaded only where a text needs it
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self._path)
            self._slow.no_truncation()
            self._slow.no_padding()
            self._slow.encode_special_tokens = self.plain
        return self._slow.encode(text, add_special_tokens=False).ids

    def ids(self, text: str | None) -> np.ndarray:
        text = text or ""
        if self.fast is not None and (self.plain or not any(s in text for s in self.special)) and _alike(text):
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self._encode(text), np.uint32)


@lru_cache(maxsize=4)
def token_bytes(name: str) -> tuple[bytes, ...]:
    """The bytes that each id of a byte-level .json tokenizer or of a .model stands for; U+2581 is a space."""
    path = resolve(name)
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return tuple(
            bytes([int(model.id_to_piece(i)[1:-1], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("\u2581", " ").encode()
            for i in range(model.vocab_size())
        )
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    known = _byte_signs()
    out = [b""] * (1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec.get("added_tokens") or [])]))
    for word, i in spec["model"]["vocab"].items():
        out[i] = bytes(known[c] for c in word) if all(c in known for c in word) else word.encode()
    for token in spec.get("added_tokens") or []:
        out[token["id"]] = token["content"].encode()
    return tuple(out)


def _alike(text: str) -> bool:
    """Only letters, digits and signs below U+0250 but for control characters that are not white space."""
    return text.isascii() and text.isprintable() or not _ODD.search(text)


def _odd():
    import re

    return re.compile("[\x1c-\x1f\x85ɐ-\U0010ffff]")


_ODD = _odd()


def _plain_ranks(spec: dict) -> tuple[dict[bytes, int] | None, list[str]]:
    """Bytes to ids if these are merge ranks of a plain byte-level BPE; and the added tokens' strings."""
    model, before = spec.get("model") or {}, spec.get("pre_tokenizer") or {}
    added = [t["content"] for t in spec.get("added_tokens") or []]
    plain = (
        model.get("type") == "BPE"
        and not model.get("dropout")
        and not model.get("continuing_subword_prefix")
        and not model.get("end_of_word_suffix")
        and not model.get("ignore_merges")
        and spec.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space", True)
    )
    if not plain:
        return None, added
    known = _byte_signs()
    try:
        vocab = {bytes(known[c] for c in word): i for word, i in model["vocab"].items() if word not in added}
    except KeyError:
        return None, added
    ids = []
    for merge in model["merges"]:
        a, b = merge.split(" ") if isinstance(merge, str) else merge
        ids.append(model["vocab"].get(a + b, -1))
    # Merges must be tried in the order of the ids they make.
    ordered = all(x < y for x, y in zip(ids, ids[1:])) and all(bytes([i]) in vocab for i in range(256))
    return (vocab if ordered and len(vocab) == 256 + len(ids) else None), added


def _byte_signs() -> dict[str, int]:
    """The printable sign that stands for each byte: itself if visible in Latin-1, else the next from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
