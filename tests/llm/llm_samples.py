"""Made-up texts for the tests."""

import random


def words(seed, count, vocabulary=400):
    """Made-up prose."""
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}{'.' if rng.random() < .1 else ''}" for _ in range(count)]


ODD_ROWS = [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (4, "one"), (None, "no id here at all"), (5, "é" * 3)]
