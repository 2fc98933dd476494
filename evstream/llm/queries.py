"""All queries of this subpackage."""

from evstream.llm import (  # noqa: F401  (register)
    bitpack,
    conversations,
    embeddings,
    lines,
    minhash,
    packing,
    pieces,
    quality,
    scoring,
    secrets,
    sharding,
    suffixes,
    whitening,
)
from evstream.llm.common import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
