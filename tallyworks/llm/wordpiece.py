"""Greedy longest-match token counts by a linear automaton, without building the pieces.

The vocabulary is a trie. Each node has a failure link: where matching goes on after the longest tokens of what has
been read are split off, and how many tokens that splits off. Reading a word then takes one move a symbol, with at
most as many failure moves in all; the pieces themselves are never made, only their number.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallyworks.llm.bytelevel import Vocabulary, ended, read_file, stand_ins
from tallyworks.llm.common import TwoAges, kept, over_texts, query, table

#: Words remembered with their count by a Python worker (twice as many at most).
KEPT = 500_000


class Automaton:
    def __init__(self, tokens: Iterable[str]) -> None:
        self.moves: list[dict[str, int]] = [{}]
        final = [False]
        for token in tokens:
            node = 0
            for c in token:
                if c not in self.moves[node]:
                    self.moves[node][c] = len(self.moves)
                    self.moves.append({})
                    final.append(False)
                node = self.moves[node][c]
            final[node] = node != 0
        #: Where a node goes when no symbol fits (-1: nowhere, the word has no pieces), and the tokens split off then.
        self.fail, self.popped = [-1] * len(final), [0] * len(final)
        todo = deque([0])
        while todo:
            parent = todo.popleft()
            for c, node in self.moves[parent].items():
                todo.append(node)
                if final[node]:
                    self.fail[node], self.popped[node] = 0, 1
                    continue
                at, popped = self.fail[parent], self.popped[parent]
                while at >= 0 and c not in self.moves[at]:
                    at, popped = self.fail[at], popped + self.popped[at]
                if at >= 0:
                    self.fail[node], self.popped[node] = self.moves[at][c], popped

    def count(self, symbols: str) -> int:
        """Number of greedy longest pieces; 1, the unknown token, where some stretch has no piece; 0 for no symbols."""
        moves, fail, popped = self.moves, self.fail, self.popped
        node = out = 0
        for c in symbols:
            while (to := moves[node].get(c)) is None:
                out += popped[node]
                if (node := fail[node]) < 0:
                    return 1
            node = to
        while node > 0:
            out += popped[node]
            if (node := fail[node]) < 0:
                return 1
        return out


class Counts(TwoAges):
    """Number of pieces of words (bytes), worked out when first asked for."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__(KEPT)
        self.automaton = Automaton(vocabulary.ids)
        self.map = dict(enumerate(stand_ins()))
        self.mark = vocabulary.mark

    def work(self, word: bytes) -> int:
        symbols = word.decode("latin-1").translate(self.map)
        return self.automaton.count(ended(symbols) if self.mark else symbols)


def token_counts(docs: DataFrame, path: str, text: str = "text", keys: Iterable[str] = ("doc_id",)) -> DataFrame:
    """Key columns, n_words, n_tokens and most_in_word of each whole text.

    Words are stretches without white space, A-Z lower-cased; a word is cut into the longest pieces of the vocabulary
    from left to right, the last piece with the word's end mark. Null and empty texts have 0 words and 0 tokens. Every
    row is its own (repeated rows and null keys stay); an empty table gives an empty one; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_file(path))

    def make():
        counts = kept(f"pieces {path}", lambda: Counts(Vocabulary(shared.value)))

        def work(texts: list) -> dict:
            n_words, n_tokens, most = [], [], []
            for t in texts:
                each = [counts[w] for w in (t or b"").lower().split()]
                n_words.append(len(each))
                n_tokens.append(sum(each))
                most.append(max(each, default=0))
            return {"n_words": pa.array(n_words, pa.int64()), "n_tokens": pa.array(n_tokens, pa.int64()),
                    "most_in_word": pa.array(most, pa.int64())}

        return work

    return over_texts(docs, keys, text, "n_words long, n_tokens long, most_in_word long", make, as_bytes=True)


@query("op5_token_counts")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
