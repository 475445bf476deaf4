"""Encode whole texts through a vocabulary of chunks met before.

A byte-level pre-tokenizer never joins characters across a space that a plain
character follows, so a text may be cut before each such space and the chunks
encoded by themselves. Natural text repeats its chunks: only new ones are encoded.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def _plain(part: str) -> bool:
    return bool(part) and (" " < part[0] <= "~" or part[0].isalpha())


def cut(parts: list[str]) -> list[str]:
    """Chunks from a text split at spaces; a part that does not begin plainly stays with the one before it.

    Every chunk but the first is given without its leading space.
    """
    out = parts[:1]
    for part in parts[1:]:
        if _plain(part):
            out.append(part)
        else:
            out[-1] += " " + part
    return out


def runs(values: np.ndarray, bounds: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen runs of `values` (run i lies between bounds i and i+1) one after another, and their bounds, 0 first."""
    lengths = bounds[chosen + 1] - bounds[chosen]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(int(ends[-1]), dtype=np.int64) + np.repeat(bounds[chosen] - ends[:-1], lengths)
    return values[at], ends


class ChunkEncoder:
    """Token ids of texts; `encode_new(chunks)` gives flat ids and the token count of each new chunk.

    At most `limit` chunks (about) are kept between calls; then the store starts anew.
    """

    def __init__(self, encode_new: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 600_000):
        self.encode_new, self.limit = encode_new, limit
        self._clear()

    def _clear(self) -> None:
        self.first: dict[str, int] = {}
        self.rest: dict[str, int] = {}
        self.ids, self.offsets = np.empty(0, np.int32), np.zeros(1, np.int64)

    def _code(self, chunk: str, place: int, new: list[str]) -> int:
        """The number of a chunk; an unknown one is added to `new`."""
        store = self.rest if place else self.first
        code = store.get(chunk)
        if code is None:
            code = store[chunk] = len(self.offsets) - 1 + len(new)
            new.append(" " + chunk if place else chunk)
        return code

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and the bounds of each text in them (one more than texts)."""
        if len(self.first) + len(self.rest) > self.limit:
            self._clear()
        new: list[str] = []
        codes, counts = [], []
        for text in texts:
            if not text:
                counts.append(0)
                continue
            parts = text.split(" ")
            found = list(map(self.rest.get, parts))
            found[0] = self.first.get(parts[0])
            if None in found:
                unknown = [i for i, code in enumerate(found) if code is None]
                if all(_plain(parts[i]) for i in unknown if i):
                    for i in unknown:
                        found[i] = self._code(parts[i], i, new)
                else:
                    found = [self._code(chunk, i, new) for i, chunk in enumerate(cut(parts))]
            codes.append(np.array(found, np.int64))
            counts.append(len(found))
        if new:
            ids, lengths = self.encode_new(new)
            self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(lengths, dtype=np.int64)])
        ids, ends = runs(self.ids, self.offsets, np.concatenate(codes) if codes else np.empty(0, np.int64))
        return ids, ends[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]
