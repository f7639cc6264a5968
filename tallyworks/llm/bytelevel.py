"""Vocabulary files whose tokens are written in the printable stand-ins for bytes, some with a mark of the word's end."""

from __future__ import annotations

import json
from pathlib import Path

#: A symbol with the word's end mark is its character moved up by this much, so every symbol is one character.
ENDED = 0x10000


def stand_ins() -> list[str]:
    """The character that stands for each byte: itself if printable in Latin-1, else the next free one from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def ended(symbols: str) -> str:
    """A word's symbols, the last one marked as the word's end."""
    return symbols[:-1] + chr(ord(symbols[-1]) + ENDED)


def read_file(path: str, most_mb: int = 64) -> str:
    """The vocabulary file's text, read on the driver and then broadcast; larger files than `most_mb` are refused."""
    if (size := Path(path).stat().st_size) > most_mb << 20:
        raise ValueError(f"{path} has {size >> 20} MB, more than the {most_mb} MB that may be broadcast")
    return Path(path).read_text(encoding="utf-8")


class Vocabulary:
    """Tokens as strings of symbols, their ids, their written form, and the merges' ranks."""

    def __init__(self, text: str) -> None:
        file = json.loads(text)
        model = file["model"]
        self.mark = model.get("end_of_word_suffix") or ""
        self.written = {i: t for t, i in model["vocab"].items()}
        self.ids = {self.symbols(t): i for t, i in model["vocab"].items()}
        pairs = [m if isinstance(m, list) else m.split(" ", 1) for m in model.get("merges", [])]
        self.ranks = {(self.symbols(a), self.symbols(b)): r for r, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.written |= {i: t for t, i in self.special.items()}
        self.longest = max(map(len, self.ids))

    def symbols(self, token: str) -> str:
        if self.mark and token.endswith(self.mark) and token != self.mark:
            return ended(token[: -len(self.mark)])
        return token
