"""Made texts."""

#: Words without meaning.
SYLLABLES = "ka lo mi ne pu ra se ti vo xu".split()


def prose(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES, rng.integers(1, 4))) for _ in range(n))
