"""All queries and SQL of this subpackage."""

from tallyworks.llm import bpe, covertree, fill_middle, lines, mixing, multi_index, ngram_join, piece_bpe, secrets, sharded_lloyd, toxicity, warc, wordpiece  # noqa: F401
from tallyworks.llm.common import QUERIES, SQL  # noqa: F401
