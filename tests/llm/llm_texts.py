"""Texts for tests."""

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"


def prose(n, seed=0):
    """Words in an order that depends on the seed, ``n`` of them."""
    words = WORDS.split()
    return " ".join(words[(i * (seed * 2 + 5) + i * i * (seed + 1)) % len(words)] for i in range(n))
