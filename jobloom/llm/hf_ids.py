"""Ids of whole texts as a `tokenizers` file gives them.

A byte-level BPE file whose token numbers are its merge ranks defines the same ids as
its rank table does, which the tiktoken library reads several times faster. So such a file's ids
are computed from its ranks; any other file, or one whose probes differ, is
left to `tokenizers` itself.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from typing import TYPE_CHECKING

import numpy as np

if TYPE_CHECKING:
    from tokenizers import Tokenizer

_PROBES = ("", " ", "a b  c\n\n d", "It's 12 o'clock, we'll\tsee it .", "été 漢字 \U0001f600 ٣٤ ² é", "<|endoftext|> x<|endoftext|>", "=====  ---\r\n\x1c\x85 'S 'LL", "x" * 300)
#: The split that byte-level files with "use_regex" apply (fixed value).
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The faster library's split cannot take a longer run of white space.
_BLANKS = 5_000
_LONG_BLANKS = re.compile(rf"\s{{{_BLANKS}}}")
_LOADED: dict[tuple[str, bool], Callable[[str], np.ndarray]] = {}
_SPANS: dict[tuple[str, bool], Callable[[str], tuple[np.ndarray, np.ndarray]]] = {}


def _alphabet() -> dict[str, int]:
    """Byte of each character that stands for a byte in byte-level files: visible Latin-1 for itself, the rest from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _ranks(path: str) -> dict[bytes, int] | None:
    """Token bytes to ids, if ids are ranks and nothing but byte-level splitting comes before the merges."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = not spec.get("normalizer") and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    if not plain or model.get("type") != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return None
    pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
    vocab = model["vocab"]
    if [vocab.get(a + b) for a, b in pairs] != list(range(256, 256 + len(pairs))):
        return None
    byte = _alphabet()
    special = {x["content"] for x in spec.get("added_tokens", [])}
    return {bytes(byte[c] for c in token): number for token, number in vocab.items() if token not in special}


def _added(exact: Tokenizer, special: bool) -> list[str]:
    """Strings that the library takes out of a text before it splits it."""
    return [x.content for x in exact.get_added_tokens_decoder().values() if special or not x.special]


def reader(path: str, special: bool = False) -> Callable[[str], np.ndarray]:
    """A function from a text to its ids, one per worker process and file.

    With `special`, strings of added tokens in a text are those tokens, as the library reads them unless told otherwise;
    without, special ones are ordinary text.
    """
    if (path, special) not in _LOADED:
        import tiktoken
        from tokenizers import Tokenizer

        exact = Tokenizer.from_file(path)
        exact.encode_special_tokens = not special
        added = _added(exact, special)

        def slow(text: str) -> np.ndarray:
            return np.array(exact.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

        ranks = _ranks(path)
        chosen = slow
        if ranks:
            encoding = tiktoken.Encoding("file", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})

            def chosen(text: str) -> np.ndarray:
                if any(x in text for x in added) or len(text) >= _BLANKS and _LONG_BLANKS.search(text):
                    return slow(text)
                return np.array(encoding.encode_ordinary(text), np.uint32)

            if any(chosen(x).tolist() != slow(x).tolist() for x in _PROBES):
                chosen = slow

        _LOADED[path, special] = chosen
    return _LOADED[path, special]


def spans(path: str, special: bool = False) -> Callable[[str], tuple[np.ndarray, np.ndarray]]:
    """A function from a text to the starts and ends of its tokens in code points; a token of part of a character has all of it. `special` as in `reader`."""
    if (path, special) in _SPANS:
        return _SPANS[path, special]
    from tokenizers import Tokenizer

    read, ranks = reader(path, special), _ranks(path)
    exact = Tokenizer.from_file(path)
    exact.encode_special_tokens = not special
    added = _added(exact, special)

    def by_library(text: str) -> tuple[np.ndarray, np.ndarray]:
        found = np.array(exact.encode(text, add_special_tokens=False).offsets, np.int64).reshape(-1, 2)
        return found[:, 0], found[:, 1]

    if ranks is None:
        _SPANS[path, special] = by_library
        return by_library
    width = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, number in ranks.items():
        width[number] = len(token)

    def by_width(text: str) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all tokens are the bytes of the text, so their widths are their places; not so where an added token may take blanks beside it."""
        if any(x in text for x in added):
            return by_library(text)
        ends = np.cumsum(width[read(text)])
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        if text.isascii():
            return starts, ends
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        point = np.cumsum((data & 0xC0) != 0x80) - 1
        return point[starts], point[ends - 1] + 1

    _SPANS[path, special] = by_width
    return by_width
