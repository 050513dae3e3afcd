"""All queries of the subpackage, in the order of their numbers."""

from offermart.llm import (  # noqa: F401
    diagonals, fingerprints, lattice, packing, postings, quality, ring, rollup, simhash, toxicity, turns, vector_codes,
    wrapper,
)
from offermart.llm.registry import ORACLES, QUERIES  # noqa: F401
