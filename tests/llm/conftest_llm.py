"""Texts for the tests of this folder."""

from __future__ import annotations

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec romeo sierra tango".split()


def texts(rng, n: int, least: int = 5, most: int = 60) -> list[str]:
    return [" ".join(rng.choices(WORDS, k=rng.randint(least, most))) for _ in range(n)]
