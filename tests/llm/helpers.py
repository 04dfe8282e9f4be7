import random

WORDS = ["the", "tiger", "house", "über", "été", "and", "river", "stone", "glass", "of", "paper", "light", "naïve", "green", "seven", "moon", "ox", "quick", "lazy", "dog"]


def prose(rng: random.Random, n: int, sentences: bool = True) -> str:
    out = []
    for k in range(n):
        w = rng.choice(WORDS) + rng.choice(["", "", "s", "ing", "ed", "er"]) + rng.choice(["", "", "a", "o", "ine"])
        out.append(w + (".\n" if sentences and k % 17 == 16 else " "))
    return "".join(out).strip()


def edited(rng: random.Random, text: str, share: float) -> str:
    return " ".join(prose(rng, 1, False) if rng.random() < share else w for w in text.split(" "))
