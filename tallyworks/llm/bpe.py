"""Byte-pair encoding as a streaming transducer with bounded lookahead, and incremental decoding.

Encoding of a word. Cutting a sequence of tokens that the merges produce leaves sequences they produce too, so the
encoding of a prefix ends with one token t for which (token before t, t) is stable: encoding the two together gives
them back. Going through a word symbol by symbol, the last token of each prefix is thus found from those of the
prefixes before it, at most `reach` symbols back, where reach is the longest token of the merge list. Any later
prefix goes on from one of the last `reach` prefixes. Once their chains of tokens have met, what lies before the
meeting point cannot change any more and is emitted. So memory is `reach` plus the unmet stretch, for any word length.

Decoding. Ids become the bytes of their tokens, and an incremental decoder keeps the bytes of an unfinished character
between chunks.
"""

from __future__ import annotations

import codecs
import hashlib
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from tallyworks.llm.bytelevel import ENDED, Vocabulary, ended, read_file, stand_ins
from tallyworks.llm.common import TwoAges, kept, over_texts, query, table

#: Words remembered with their ids by a Python worker (twice as many at most).
KEPT = 400_000
#: A rank after all merges.
NEVER = 1 << 60
#: Characters of a text, symbols of a word and ids of a document that are worked on at once.
CHUNK = 1 << 16

KINDS = {"n_tokens": "n_tokens long", "ids": "ids array<int>", "ids_sha256": "ids_sha256 string",
         "decoded": "decoded string", "decoded_sha256": "decoded_sha256 string"}


class Transducer:
    def __init__(self, ids: dict[str, int], ranks: dict[tuple[str, str], int]) -> None:
        self.ids, self.ranks = ids, ranks
        self.stable: dict[tuple[str, str], bool] = {}
        self.made: dict[str, tuple[int, str, str]] = {}
        self.reach = sufficient_lookahead(ids)

    def last_merge(self, token: str) -> tuple[int, str, str]:
        """Rank and two halves of the merge that completes a token; rank -1 for a symbol, -2 if merging never ends in it."""
        known = self.made.get(token)
        if known is None:
            parts, known = list(token), (-1, token, token)
            while len(parts) > 1:
                rank, at = min((self.ranks.get(p, NEVER), i) for i, p in enumerate(zip(parts, parts[1:])))
                if rank == NEVER:
                    known = (-2, "", "")
                    break
                known = (rank, parts[at], parts[at + 1])
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            self.made[token] = known
        return known

    def follows(self, before: str | None, token: str) -> bool:
        """Whether the two side by side are what merging makes of them.

        Merges are undone, latest first: the later made of the two tokens at the border is halved. If the pieces at
        the border could have merged before the halves did, merging would have crossed the border.
        """
        known = self.stable.get((before, token))
        if known is None:
            if len(self.stable) >= KEPT:
                self.stable.clear()
            known = self.last_merge(token)[0] > -2 if before is None else self._apart(before, token)
            self.stable[before, token] = known
        return known

    def _apart(self, a: str, b: str) -> bool:
        (rank_a, _, right), (rank_b, left, _) = self.last_merge(a), self.last_merge(b)
        if rank_a == -2 or rank_b == -2:
            return False
        until = NEVER
        while (crossing := self.ranks.get((a, b), NEVER)) == NEVER or crossing >= until:
            if rank_a < 0 and rank_b < 0:
                return True
            if rank_a > rank_b:
                until, a = rank_a, right
                rank_a, _, right = self.last_merge(a)
            else:
                # Of equal merges the left one comes first, so one across the border precedes the one inside b.
                until, b = rank_b + 1, left
                rank_b, left, _ = self.last_merge(b)
        return False

    def tokens(self, symbols: Iterable[str]) -> Iterator[str]:
        """Tokens of a word given as pieces of its symbols, each as soon as no later symbol can change it."""
        text, last = "", [None]  # last[i]: last token of the encoding up to i symbols of the open text
        ids, stable, follows, reach = self.ids, self.stable, self.follows, self.reach
        for piece in symbols:
            text += piece
            for i in range(len(last), len(text) + 1):
                # The whole beginning is one token, or a shorter one follows the encoding of what stands before it.
                for size in range(min(reach, i), 0, -1):
                    token = text[i - size:i]
                    if token in ids:
                        before = last[i - size]
                        known = stable.get((before, token))
                        if known or (known is None and follows(before, token)):
                            last.append(token)
                            break
                else:
                    raise ValueError(f"no token ends with {text[i - 1]!r}")
            if len(text) > 4 * reach:
                live = set(range(len(text) + 1 - reach, len(text) + 1))
                while len(live) > 1:
                    i = max(live)
                    live.discard(i)
                    live.add(i - len(last[i]))
                at = live.pop()
                yield from self._chain(last, at)
                text, last = text[at:], last[at:]
        yield from self._chain(last, len(text))

    @staticmethod
    def _chain(last: list, end: int) -> list[str]:
        out = []
        while end > 0:
            out.append(last[end])
            end -= len(last[end])
        return out[::-1]


def sufficient_lookahead(ids: Iterable[str]) -> int:
    """Symbols that must stay open: a later token reaches back over at most the longest token of the list."""
    return max(map(len, ids), default=1)


class Words(TwoAges):
    """Ids of words as little-endian bytes, worked out when first asked for."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__(KEPT)
        self.transducer = Transducer(vocabulary.ids, vocabulary.ranks)
        self.map = dict(enumerate(stand_ins()))
        self.mark = vocabulary.mark

    def symbols(self, word: str) -> Iterator[str]:
        for i in range(0, len(word), CHUNK):
            piece = word[i:i + CHUNK].encode("utf-8", "replace").decode("latin-1").translate(self.map)
            if self.mark and i + CHUNK >= len(word):
                piece = ended(piece)
            for j in range(0, len(piece), 256):
                yield piece[j:j + 256]

    def work(self, word: str) -> bytes:
        return array("I", map(self.transducer.ids.__getitem__, self.transducer.tokens(self.symbols(word)))).tobytes()


class Codec:
    """Encoding and decoding as the vocabulary file describes them: NFC, lower case, words by the file's pattern."""

    #: Fixed value: the words of the vocabulary file's splitter.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, text: str) -> None:
        self.vocabulary = Vocabulary(text)
        self.words = Words(self.vocabulary)
        # Spaces are Unicode's White_Space only; the pattern module also counts the four separators 1C-1F.
        blank = r"[\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
        inner = blank[1:-1]
        self.find = regex.compile(self.PATTERN.replace(r"\s", inner)).findall
        self.cut = regex.compile(blank).search
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.vocabulary.special)) + ")") if self.vocabulary.special else None
        self.bytes = {i: t.encode() for i, t in self.vocabulary.written.items()}

    def pieces(self, text: str) -> Iterator[str]:
        """The normalised text in pieces that end before white space, so no word is cut."""
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        start = 0
        while start < len(text):
            end = len(text)
            if end - start > 2 * CHUNK and (m := self.cut(text, start + CHUNK)):
                end = m.end()
            yield text[start:end]
            start = end

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out, words = [], self.words
        for part in self.special.split(text) if self.special else [text]:
            if part in self.vocabulary.special:
                out.append(array("I", [self.vocabulary.special[part]]).tobytes())
            else:
                for piece in self.pieces(part):
                    out.append(b"".join([words[w] for w in self.find(piece)]))
        return b"".join(out)

    def decode(self, ids: bytes) -> Iterator[str]:
        """The written tokens with a space between them (the file names no decoder), chunk by chunk."""
        state, numbers, written = codecs.getincrementaldecoder("utf-8")("replace"), memoryview(ids).cast("I"), self.bytes
        for i in range(0, len(numbers), CHUNK):
            yield state.decode(b" " * (i > 0) + b" ".join([written[n] for n in numbers[i:i + CHUNK].tolist()]))
        yield state.decode(b"", final=True)

    def plain_text(self, ids: bytes) -> Iterator[str]:
        """The text that the ids stand for: bytes of the tokens, the word's end as a space."""
        state, back = codecs.getincrementaldecoder("utf-8")("replace"), {c: b for b, c in enumerate(stand_ins())}
        numbers, mark = memoryview(ids).cast("I"), self.vocabulary.mark
        special = {i: t for t, i in self.vocabulary.special.items()}
        for n in numbers:
            if n in special:
                yield state.decode(special[n].encode())
                continue
            token = self.vocabulary.written[n]
            done = bool(mark) and token.endswith(mark)
            body = token[: len(token) - len(mark) * done]
            yield state.decode(bytes(back[c] for c in body) + b" " * done)
        yield state.decode(b"", final=True)


def encode_documents(docs: DataFrame, path: str, text: str = "text", keys: Iterable[str] = ("doc_id",),
                     outputs: Iterable[str] = ("ids", "decoded")) -> DataFrame:
    """Key columns and the chosen outputs of each whole text: n_tokens, ids, ids_sha256, decoded, decoded_sha256.

    A null text counts as empty: no ids, empty decoded text. Each row is its own, so repeated rows, ties and null keys
    come out as they went in; an empty table gives an empty one; other columns are not read.
    """
    outputs = list(outputs)
    shared = docs.sparkSession.sparkContext.broadcast(read_file(path))

    def make():
        codec = kept(f"codec {path}", lambda: Codec(shared.value))

        def work(texts: list) -> dict:
            out: dict[str, list] = {o: [] for o in outputs}
            for t in texts:
                ids = codec.encode(t or "")
                made = {"n_tokens": len(ids) // 4}
                if "ids" in out:
                    made["ids"] = memoryview(ids).cast("I").tolist()
                if "ids_sha256" in out:
                    made["ids_sha256"] = hashlib.sha256(ids).hexdigest()
                if "decoded_sha256" in out:
                    sha = hashlib.sha256()
                    for piece in codec.decode(ids):
                        sha.update(piece.encode())
                    made["decoded_sha256"] = sha.hexdigest()
                if "decoded" in out:
                    made["decoded"] = "".join(codec.decode(ids))
                for o in out:
                    out[o].append(made[o])
            types = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
            return {o: pa.array(v, types.get(o, pa.string())) for o, v in out.items()}

        return work

    return over_texts(docs, keys, text, ", ".join(KINDS[o] for o in outputs), make)


@query("op10_bpe_codec")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return encode_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                            outputs=("n_tokens", "ids_sha256", "decoded_sha256"))
