"""Texts for the tests."""

import random

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
PROSE = "the quick brown fox jumps over a lazy dog while seven wizards quietly brew strong coffee near old harbour walls"


def prose(seed, n):
    """n words drawn from a vocabulary of 3,000."""
    draw = random.Random(seed)
    return " ".join(f"{PROSE.split()[draw.randrange(18)]}{draw.randrange(167)}" for _ in range(n))
