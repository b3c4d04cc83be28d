import random


def prose(seed, words, vocabulary="abcdefgh"):
    """Repeatable words of two to five letters."""
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(vocabulary) for _ in range(draw.randint(2, 5))) for _ in range(words))
