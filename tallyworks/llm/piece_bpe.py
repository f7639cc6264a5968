"""Exact merge-type piece encoding by backtracking, and decoding, as a SentencePiece model file of that type describes.

Merging joins, while any two neighbours form a piece, those whose piece has the best score, the leftmost first. Cutting
the result leaves results, so a sequence of tokens is the encoding exactly if every two neighbours are: merging the two
side by side again gives them back. Encoding therefore goes from the left. At each place the longest piece that starts
there (an Aho-Corasick automaton over reversed pieces, run from the right) is tried first, then shorter ones; a token is
taken if it is compatible with the one before it. Where none is, the last token is given up for a shorter one and the
place is marked in a bit field: the encoding of what stands before a place is unique, so a place that failed once fails
for every way to reach it. Hence each place is left at most once and the time is linear in the text.

No piece holds certain pairs of neighbours (a letter before a space, say). There texts are cut beforehand, so that the
stretches are short and those of common words are remembered.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallyworks.llm.common import TwoAges, kept, over_texts, query, table

SPACE = "▁"
#: Kinds of pieces in a model file, and the text that stands for a byte.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BYTE_TEXT = "<0x%02X>"
#: Stretches remembered by a Python worker (twice as many at most), and pairs known to be compatible or not.
KEPT, PAIRS = 400_000, 1_000_000
#: Places whose matches are worked out at once, and how many such windows are held.
WINDOW, WINDOWS = 4096, 4

KINDS = {"n_tokens": "n_tokens long", "ids": "ids array<int>", "ids_sha256": "ids_sha256 string",
         "decoded": "decoded string", "decoded_sha256": "decoded_sha256 string"}


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protocol buffer message; four and eight byte values come as bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind) or number()
        yield key >> 3, message[at:at + size]
        at += size


class Model:
    """Pieces, scores and kinds of a model file, and its rules for spaces."""

    def __init__(self, content: bytes) -> None:
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        trainer: dict[int, int | bytes] = {}
        normal: dict[int, int | bytes] = {}
        for number, value in fields(content):
            if number == 1:
                piece = dict(fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                normal = dict(fields(value))
        if trainer.get(3, 1) != 2 or normal.get(2) or trainer.get(24) or not normal.get(5, 1) or {USER, UNUSED} & {*self.kinds}:
            raise ValueError("a merge-type model without character map, space suffixes, user-defined and unused pieces is read")
        self.prefix, self.squeeze = bool(normal.get(3, 1)), bool(normal.get(4, 1))
        self.unknown_text = trainer.get(44, " ⁇ ".encode()).decode()
        by_text = {t: i for i, t in enumerate(self.pieces)}
        self.begin, self.end, self.unknown = (by_text[trainer.get(n, d).decode()] for n, d in ((46, b"<s>"), (47, b"</s>"), (45, b"<unk>")))
        self.bytes = [by_text[BYTE_TEXT % b] for b in range(256)] if BYTE in self.kinds else []


class Matches:
    """Pieces that start at each place of a text, longest first; worked out for a window of places at a time."""

    def __init__(self, automaton: ahocorasick.Automaton, text: str, reach: int) -> None:
        self.automaton, self.text, self.reach = automaton, text, reach
        self.windows: dict[int, list[list[str]]] = {}

    def of(self, start: int, size: int) -> list[list[str]]:
        part = self.text[start:start + size + self.reach - 1]
        found: list[list[str]] = [[] for _ in part]
        for end, piece in self.automaton.iter(part[::-1]):
            found[-1 - end].append(piece)
        return found[:size]

    def __getitem__(self, place: int) -> list[str]:
        k = place // WINDOW
        window = self.windows.get(k)
        if window is None:
            if len(self.windows) >= WINDOWS:
                self.windows.pop(next(iter(self.windows)))
            window = self.windows[k] = self.of(k * WINDOW, min(WINDOW, len(self.text) - k * WINDOW))
        return window[place - k * WINDOW]


class Encoder:
    """Tokens of a stretch of normalised text; characters that are no piece of their own come out as themselves."""

    def __init__(self, scores: dict[str, float]) -> None:
        self.scores = scores
        self.reach = max(map(len, scores), default=1)
        self.automaton = ahocorasick.Automaton()
        for piece in {*scores, *"".join(scores)}:
            self.automaton.add_word(piece[::-1], piece)
        if len(self.automaton):
            self.automaton.make_automaton()
        self.compatible: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """The encoding by merging itself, for the few characters of two tokens."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, before: str, token: str) -> bool:
        """Whether merging gives the two tokens back, or the one where nothing stands before it."""
        if len(self.compatible) >= PAIRS:
            self.compatible.clear()
        self.compatible[before, token] = known = self.merged(before + token) == ([before, token] if before else [token])
        return known

    def encode(self, text: str) -> list[str]:
        """Longest match first; back to a shorter one where no next token is compatible."""
        size, known, found = len(text), self.compatible.get, Matches(self.automaton, text, self.reach)
        if size <= WINDOW:
            found = found.of(0, size)
        failed = bytearray(size // 8 + 1)
        tokens, choice, place, tried, before = [], [], 0, 0, ""
        while place < size:
            here = found[place]
            for tried in range(tried, len(here)):
                token = here[tried]
                after = place + len(token)
                if failed[after >> 3] >> (after & 7) & 1:
                    continue
                fits = known((before, token))
                if fits or (fits is None and self.fits(before, token)):
                    tokens.append(token)
                    choice.append(tried)
                    place, tried, before = after, 0, token
                    break
            else:
                if not tokens:
                    raise ValueError("no piece starts with a character of the text")
                failed[place >> 3] |= 1 << (place & 7)
                place -= len(tokens.pop())
                tried, before = choice.pop() + 1, tokens[-1] if tokens else ""
        return tokens


class Stretches(TwoAges):
    """Ids of stretches as little-endian bytes, worked out when first asked for."""

    def __init__(self, model: Model) -> None:
        super().__init__(KEPT)
        self.model = model
        self.ids = {t: array("I", [i]).tobytes() for i, (t, kind) in enumerate(zip(model.pieces, model.kinds)) if kind == NORMAL}
        self.encoder = Encoder({model.pieces[i]: model.scores[i] for i, kind in enumerate(model.kinds) if kind == NORMAL})
        self.pairs = {p[i:i + 2] for p in self.encoder.scores for i in range(len(p) - 1)}

    def work(self, stretch: str) -> bytes:
        """A stretch is cut further wherever no piece holds the two neighbours."""
        text, pairs, ids, start, out = stretch.replace(" ", SPACE), self.pairs, self.ids, 0, []
        for i in [*[i for i in range(1, len(text)) if text[i - 1:i + 1] not in pairs], len(text)]:
            part = text[start:i]
            for token in self.encoder.encode(part) if i > start + 1 else [part]:
                out.append(ids.get(token) or self.written(token))
            start = i
        return b"".join(out)

    def written(self, token: str) -> bytes:
        """A character that is no piece: its bytes, or the unknown token where the model has no bytes."""
        model = self.model
        return array("I", [model.bytes[b] for b in token.encode("utf-8", "replace")] if model.bytes else [model.unknown]).tobytes()


class Codec:
    """Encoding with begin and end ids, and decoding, of whole texts."""

    def __init__(self, content: bytes) -> None:
        self.model = model = Model(content)
        if model.squeeze:
            raise ValueError("models that remove extra spaces are not read")
        self.stretches = Stretches(model)
        self.cut = self.cutter(self.stretches.pairs)
        self.ends = [array("I", [i]).tobytes() for i in (model.begin, model.end)]
        self.text = [t.replace(SPACE, " ") if k == NORMAL else "" if k == CONTROL else model.unknown_text for t, k in zip(model.pieces, model.kinds)]
        self.byte = {i: b for b, i in enumerate(model.bytes)}

    @staticmethod
    def cutter(pairs: set[str]) -> Callable[[str], list[str]]:
        """A function that cuts a text where no piece holds the two neighbours, as far as simple classes of ASCII tell.

        Characters that some piece holds side by side are of one group. The characters of the letters' group go
        together, so do other ASCII characters (punctuation), so do those of no pair at all (line ends, digits).
        Spaces go with what follows them, unless a piece holds a space after something else.
        """
        if any(p[0] != SPACE and p[1] == SPACE for p in pairs):
            return lambda text: [text] if text else []
        group = {c: c for p in pairs for c in p}

        def top(c: str) -> str:
            while group[c] != c:
                group[c] = c = group[group[c]]
            return c

        for a, b in sorted(p for p in pairs if p[0] != SPACE):
            group[top(a)] = top(b)
        ascii_ = [c for c in map(chr, range(128)) if c != " "]
        letters = top("e") if "e" in group else None
        alone = "".join(re.escape(c) for c in ascii_ if c not in group)
        other = "".join(re.escape(c) for c in ascii_ if c in group and top(c) != letters)
        return re.compile("|".join([rf" *[^ {alone}{other}]+", *[rf" *[{other}]+"] * bool(other), *[rf"[{alone}]+"] * bool(alone), " +"])).findall

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, begin and end ids included."""
        ids = self.stretches
        text = text.replace(SPACE, " ")
        if text and self.model.prefix:
            text = " " + text
        return b"".join([self.ends[0], *[ids[s] for s in self.cut(text)], self.ends[1]])

    def decode(self, ids: bytes) -> str:
        """The text of the ids: the space put before a text goes, bytes become characters, broken ones the mark U+FFFD."""
        out, run, first = [], bytearray(), self.model.prefix
        byte, texts = self.byte, self.text
        for n in memoryview(ids).cast("I"):
            if n in byte:
                run.append(byte[n])
                continue
            if run:
                out.append(characters(run))
                run, first = bytearray(), False
            piece = texts[n]
            if first and self.model.kinds[n] == NORMAL:
                piece, first = piece.removeprefix(" "), False
            elif piece:
                first = False
            out.append(piece)
        return "".join([*out, characters(run)])


def characters(run: bytes) -> str:
    """Bytes as text; each byte that starts no whole character becomes U+FFFD by itself."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(run):
            for size in (1, 2, 3, 4):
                try:
                    out.append(bytes(run[at:at + size]).decode())
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                size = 1
            at += size
        return "".join(out)


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode_documents(docs: DataFrame, path: str, text: str = "text", keys: Iterable[str] = ("doc_id",),
                     outputs: Iterable[str] = ("ids", "decoded")) -> DataFrame:
    """Key columns and the chosen outputs of each whole text: n_tokens, ids, ids_sha256, decoded, decoded_sha256.

    A null text counts as empty: the begin and end ids alone, an empty decoded text. Each row is its own, so repeated
    rows, ties and null keys come out as they went in; an empty table gives an empty one; other columns are not read.
    The model file is read by the driver (a vocabulary, not data) and sent to the tasks.
    """
    outputs = list(outputs)
    shared = docs.sparkSession.sparkContext.broadcast(read_model(path))

    def make():
        codec = kept(f"pieces {path}", lambda: Codec(shared.value))

        def work(texts: list) -> dict:
            out: dict[str, list] = {o: [] for o in outputs}
            for t in texts:
                ids = codec.encode(t or "")
                decoded = codec.decode(ids) if "decoded" in out or "decoded_sha256" in out else ""
                for o in out:
                    out[o].append(len(ids) // 4 if o == "n_tokens" else memoryview(ids).cast("I").tolist() if o == "ids"
                                  else hashlib.sha256(ids).hexdigest() if o == "ids_sha256" else decoded if o == "decoded"
                                  else hashlib.sha256(decoded.encode("utf-8", "replace")).hexdigest())
            types = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
            return {o: pa.array(v, types.get(o, pa.string())) for o, v in out.items()}

        return work

    return over_texts(docs, keys, text, ", ".join(KINDS[o] for o in outputs), make)


@query("op11_piece_codec")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return encode_documents(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
                            outputs=("n_tokens", "ids_sha256", "decoded_sha256"))
