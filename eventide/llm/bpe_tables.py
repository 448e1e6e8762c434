"""What both BPE operators read from a byte-level vocabulary file: merge
ranks, token bytes, special tokens and the pre-token pattern.

The file's path is a parameter (``path``); the vocabulary is read on each
Python worker once and never stored in the repository."""

from __future__ import annotations

import json

import regex

#: How byte-level vocabularies split texts before the merges.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """Letter -> byte: printable Latin-1 bytes stand for themselves, the other
    bytes in order for the letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in out.values()):
        out[chr(256 + k)] = b
    return out


class Vocabulary:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        ids = data["model"]["vocab"]
        self.bytes_of = {i: raw(t) for t, i in ids.items() if t not in self.special}
        self.bytes_of.update({i: t.encode() for t, i in self.special.items()})
        self.id_of = {b: i for i, b in self.bytes_of.items() if i not in self.special.values()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        self.merges = [(self.id_of[raw(a)], self.id_of[raw(b)], self.id_of[raw(a + b)]) for a, b in pairs]
        self.byte_ids = [self.id_of[bytes([b])] for b in range(256)]
        self.pattern = regex.compile(PRETOKEN)
        self.special_at = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) \
            if self.special else None
        self._check()

    def _check(self) -> None:
        """Each merge uses only symbols made by earlier merges, so applying
        all places of a sequence's lowest-rank pair at once equals applying
        them one by one: no new pair can have a lower rank."""
        made: dict[int, int] = {}
        for rank, (a, b, ab) in enumerate(self.merges):
            if max(made.get(a, -1), made.get(b, -1)) >= rank or ab in made:
                raise ValueError(f"merge {rank} uses a symbol that is made later or twice")
            made[ab] = rank

    def pieces(self, text: str):
        """(special id or None, text) in order."""
        at = 0
        if self.special_at is not None:
            for m in self.special_at.finditer(text):
                if m.start() > at:
                    yield None, text[at:m.start()]
                yield self.special[m[0]], m[0]
                at = m.end()
        if at < len(text):
            yield None, text[at:] if at else text


def vocabulary(path: str) -> Vocabulary:
    """Read a vocabulary (the operators keep what they build from it once per worker)."""
    return Vocabulary(path)
