"""Texts for the tests of the pipeline operators."""

import random

SYLLABLES = ["ba", "co", "di", "fu", "ge", "hi", "jo", "ka", "lu", "me", "né", "po", "ru", "sö", "ta"]


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3))) for _ in range(n)]


def corpus(seed: int = 1, n: int = 60) -> list[str | None]:
    """Texts with copies, near copies, shared passages, repeated lines, empties, nulls, short and long ones."""
    rng = random.Random(seed)
    texts: list[str | None] = [None, "", " \n\t ", "One", "one two", "ONE two"]
    passage = " ".join(words(rng, 60))
    while len(texts) < n:
        base = words(rng, rng.randint(3, 200))
        texts.append(" ".join(base))
        kind = rng.random()
        if kind < 0.2:
            texts.append(" ".join(base))
        elif kind < 0.6:
            for _ in range(rng.randint(1, 4)):
                near = list(base)
                for _ in range(rng.randint(1, 3)):
                    near[rng.randrange(len(near))] = rng.choice(SYLLABLES)
                texts.append(" ".join(near))
        elif kind < 0.8:
            texts.append(" ".join(base) + "\n" + passage + "\n" + " ".join(words(rng, 20)))
    texts.append(" ".join(words(rng, 6000)))
    return texts


def rows_of(texts, first: int = 0) -> list[tuple]:
    return [(first + i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts)]
