"""Made-up words for fixtures."""

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    """Words that differ from seed to seed."""
    return " ".join(WORDS[(seed * 7 + k * k + k * seed) % len(WORDS)] + str((seed * 31 + k * 17) % 97) for k in range(n))
