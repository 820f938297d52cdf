"""The registered queries of the text operators."""

from . import (  # noqa: F401
    bpe,
    collocations,
    decontaminate,
    hmm,
    jaccard,
    lines,
    pii,
    prefix_trie,
    quality,
    simhash,
    token_cache,
    toxicity,
    warc,
)
from .shared import ORACLE, QUERIES  # noqa: F401
