"""Every query of this folder with its SQL."""

from haulage.llm import chat, embeddings, jaccard, lines, mixing, packing, pieces, pii, quality, rules, secretscan, variants, whitening  # noqa: F401
from haulage.llm.base import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
