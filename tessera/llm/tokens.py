"""Exact, memoised encoding by the libraries of the public tokenizers.

Neither library merges across a single space between two characters that are
not white space, so a text may be cut there and the parts encoded alone: the
ids, joined, are those of the whole text.  Words repeat, so each worker keeps
the codes of recent parts and asks the library for new ones only.
"""
from __future__ import annotations

import re

# How the byte-level vocabulary spells bytes (printable ones as themselves, others from U+0100 on).
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

# Marks that are a pre-token of their own when they end a word.
MARKS = frozenset(".,;:!?)")


class Recent(dict):
    """A memo of two generations: bounded, keeps what is in use."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= 48:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class ByteLevel:
    """Ids of a byte-level ``tokenizers`` file as little-endian unsigned 32-bit bytes."""

    #: a space beside other white space is no safe cut
    odd = re.compile(r" (?:\s|(?<=\s\s))")
    safe = re.compile(r"(?<=\S) (?=\S)")

    def __init__(self, path: str, most: int = 200_000, odd: int = 40_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.split = self.tokenizer.model, self.tokenizer.pre_tokenizer
        self.code = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        rest = iter(range(0x100, 0x200))
        spell = {b: chr(b) for b in PRINTABLE}
        self.spell = {b: spell.get(b) or chr(next(rest)) for b in range(256)}
        self.words = Recent(self._words, odd)
        self.parts = Recent(self._part, most)

    def _words(self, word: str) -> bytes:
        """One pre-token in the vocabulary's spelling."""
        code = self.code
        return b"".join([code[t.id] for t in self.model.tokenize(word)])

    def _part(self, part: str) -> bytes:
        """A part that follows a space."""
        words = self.words
        if part.isalpha():  # letters only: one pre-token, kept as a part alone
            return self._words((" " + part).encode().decode("latin-1").translate(self.spell))
        if part[-1:] in MARKS and part[:-1].isalpha():  # and one mark: two
            return self.parts[part[:-1]] + words[part[-1]]
        return b"".join([words[w] for w, _ in self.split.pre_tokenize_str(" " + part)])

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self._whole(text)
        if text[:1].isspace() or text[-1:].isspace() or self.odd.search(text):
            head, *rest = self.safe.split(text)
        else:
            head, *rest = text.split(" ")
        first = b"".join([self.words[w] for w, _ in self.split.pre_tokenize_str(head)])
        return first + b"".join(map(self.parts.__getitem__, rest))

    def count(self, text: str) -> int:
        return len(self.encode(text)) // 4


class Pieces:
    """Numbers of tokens of a ``sentencepiece`` model."""

    safe = re.compile("(?<=[^ ▁]) (?=[^ ▁])")

    def __init__(self, path: str, most: int = 400_000, batch_bytes: int = 1 << 18):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.batch_bytes, self.most = batch_bytes, most
        spaces = re.compile("[^▁]▁")
        probe = " a   　bﬁ\t"
        #: cuts are safe if no piece spans a space and texts are taken as they are
        self.cuts = (not any(spaces.search(self.model.id_to_piece(i)) for i in range(self.model.get_piece_size()))
                     and self.model.decode(self.model.encode(probe)) == probe)
        self.new: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def split(self, text: str) -> list[str]:
        if not self.cuts:
            return [text]
        odd = "  " in text or "▁" in text or text[:1] == " " or text[-1:] == " "
        return self.safe.split(text) if odd else text.split(" ")

    def _learn(self, parts: set[str]) -> dict[str, int]:
        """Lengths of parts not known yet, encoded in batches of about equal bytes."""
        out: dict[str, int] = {}
        batch, size = [], 0
        for p in sorted(parts):
            batch.append(p)
            size += len(p)
            if size >= self.batch_bytes:
                out.update(zip(batch, map(len, self.model.encode(batch, num_threads=1))))
                batch, size = [], 0
        if batch:
            out.update(zip(batch, map(len, self.model.encode(batch, num_threads=1))))
        return out

    def counts(self, texts: list[str]) -> list[int]:
        """Of texts that are in memory together; what is new in them is encoded at once."""
        parts = [self.split(t) for t in texts]
        fresh = set().union(*parts) - self.new.keys()
        again = {p: self.old[p] for p in fresh if p in self.old}
        if len(self.new) + len(fresh) > self.most:
            self.old, self.new = self.new, {}
            here = self.old | again | self._learn(fresh - again.keys())
            self.new = {p: n for p, n in ((p, here[p]) for p in set().union(*parts)) if len(p) <= 48}
        else:
            here = again | self._learn(fresh - again.keys())
            self.new.update((p, n) for p, n in here.items() if len(p) <= 48)
            long = {p: n for p, n in here.items() if len(p) > 48}
            here = self.new if not long else _Both(self.new, long)
        return [sum(map(here.__getitem__, p)) for p in parts]


class _Both(dict):
    def __init__(self, first: dict, second: dict):
        super().__init__(second)
        self.first = first

    def __missing__(self, key):
        return self.first[key]
