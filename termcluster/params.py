"""Parameters and fixed term lists."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

# The language names whose order defines the term index
# (index 0 = JavaScript ... index 14 = Groovy).
LANGUAGES = (
    "JavaScript", "Java", "PHP", "Python", "C#", "C++", "Ruby", "CSS",
    "Objective-C", "Perl", "Scala", "Haskell", "MATLAB", "Clojure", "Groovy",
)

# K-means defaults (spread between term strata, number of
# centres, stop threshold on the summed squared movement, iteration cap).
DEFAULT_SPREAD = 50000
DEFAULT_KERNELS = 45
DEFAULT_ETA = 20.0
DEFAULT_MAX_ITERATIONS = 120
DEFAULT_SEED = 42


@dataclass(frozen=True)
class ClusterParams:
    """Parameters of the question clustering.

    ``terms`` gives the stratum of a question (its tag's index in the
    list); ``spread`` separates the strata on the x axis; ``kernels`` is
    the number of centres, drawn ``kernels / len(terms)`` per stratum.
    """

    terms: tuple[str, ...] = LANGUAGES
    spread: int = DEFAULT_SPREAD
    kernels: int = DEFAULT_KERNELS
    eta: float = DEFAULT_ETA
    max_iterations: int = DEFAULT_MAX_ITERATIONS
    seed: int = DEFAULT_SEED

    def __post_init__(self) -> None:
        object.__setattr__(self, "terms", tuple(self.terms))
        check_terms(self.terms)
        if self.spread <= 0:
            raise ValueError("spread must be positive, or the term index "
                             "cannot be recovered from x")
        if self.kernels <= 0:
            raise ValueError("kernels must be positive")
        if self.max_iterations <= 0:
            raise ValueError("max_iterations must be positive")

    @property
    def per_stratum(self) -> int:
        if self.kernels % len(self.terms) != 0:
            raise ValueError(
                f"kernels ({self.kernels}) must be a multiple of the number "
                f"of terms ({len(self.terms)})")
        return self.kernels // len(self.terms)

    @property
    def samples_by_stratum(self) -> bool:
        """Stratified sampling unless the strata are too close (< 500)."""
        return self.spread >= 500


def check_terms(terms) -> tuple[str, ...]:
    """Validate a term list: non-empty, no empty or repeated term."""
    terms = tuple(terms)
    if not terms:
        raise ValueError("the term list is empty")
    for t in terms:
        if not isinstance(t, str) or t == "":
            raise ValueError(f"invalid term {t!r}")
    if len(set(terms)) != len(terms):
        dup = sorted(t for t, n in Counter(terms).items() if n > 1)
        raise ValueError(f"repeated terms: {dup}")
    return terms
