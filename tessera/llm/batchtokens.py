"""Exact encoding of whole Arrow batches by the libraries of the public tokenizers.

Neither library merges across a single space between two characters that are
not white space, so texts are cut there, in Arrow; each different part of a
batch is encoded once, and the ids are gathered by numpy.  The parts of a batch
are kept until the next, so that of those only new ones are encoded.
"""
from __future__ import annotations

import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space of either Unicode regex dialect, in RE2's spelling.
WHITE = (r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
#: how a byte-level vocabulary spells bytes (printable ones as themselves, others from U+0100 on)
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]

AFTER_SPACE, HEAD, WHOLE = range(3)
MOST_SEEN = 1 << 19  # parts kept at most, and eight times as many ids; of a batch with more none are


class Encoded(NamedTuple):
    """``ids[start[k]:stop[k]]`` are those of text k."""

    start: np.ndarray
    stop: np.ndarray
    ids: np.ndarray


def slices_by_bytes(texts: pa.Array, most: int = 8 << 20) -> Iterator[tuple[int, int]]:
    """Bounds of slices of about ``most`` bytes; a longer text is a slice of its own."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    at, held = 0, 0
    for k, n in enumerate(size.tolist()):
        if k > at and held + n > most:
            yield at, k
            at, held = k, 0
        held += n
    if at < len(size):
        yield at, len(size)


class _Encoder:
    odd: str  # texts in which not every space is a safe cut
    safe: re.Pattern  # the cuts of those
    one: str  # parts that may be encoded side by side, parted by spaces
    begins: np.ndarray  # of each id: does it spell a space first
    seen = None  # of the last batch: its parts that follow a space, their sizes, where their ids begin, and the ids

    def whole(self, texts: pa.Array) -> np.ndarray:
        return np.zeros(len(texts), bool)

    def encode(self, texts: pa.Array, lead: bool = False) -> Encoded:
        """Ids of each text (null: empty); ``lead``: of a space and the text."""
        texts = pc.fill_null(texts, "")
        whole = self.whole(texts)
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False) & ~whole
        calm = np.nonzero(~odd & ~whole)[0]
        lists = pc.split_pattern(texts.take(pa.array(calm)), " ")
        rough = [self.safe.split(texts[int(k)].as_py()) for k in np.nonzero(odd)[0]]
        alone = texts.take(pa.array(np.nonzero(whole)[0]))
        order = np.concatenate([calm, np.nonzero(odd)[0], np.nonzero(whole)[0]])
        per = np.concatenate([pc.list_value_length(lists).to_numpy(zero_copy_only=False),
                              [len(r) for r in rough], np.ones(len(alone))]).astype(np.int64)
        parts = pa.concat_arrays([lists.flatten(), pa.array([p for r in rough for p in r], texts.type), alone])
        first = np.cumsum(per) - per
        kind = np.zeros(len(parts), np.int32)
        if not lead:
            kind[first] = HEAD
        kind[len(parts) - len(alone):] = WHOLE
        length, ids, at = self._different(parts, kind, lead)
        bounds = np.concatenate([[0], np.cumsum(length)])
        place = np.repeat((at - bounds[:-1]).astype(np.int32), length)  # a slice has far fewer than 2 ** 31 ids
        place += np.arange(len(place), dtype=np.int32)
        flat = ids[place]
        start, stop = np.empty(len(texts), np.int64), np.empty(len(texts), np.int64)
        start[order], stop[order] = bounds[first], bounds[first + per]
        return Encoded(start, stop, flat)

    def _different(self, parts: pa.Array, kind: np.ndarray, lead: bool):
        """(number of ids of each part, ids of the different parts, where those of each part begin)."""
        coded = parts.dictionary_encode()
        n = len(coded.dictionary)
        kind *= n
        kind += coded.indices.to_numpy()
        code = kind
        used = np.zeros(3 * n, bool)
        used[code] = True
        which = np.nonzero(used)[0]
        words = coded.dictionary.take(pa.array(which % max(1, n)))
        plain = (which < n) | (lead & (which < 2 * n))  # follows a space
        plain &= pc.match_substring_regex(words, self.one).to_numpy(zero_copy_only=False)
        size, begin = np.zeros(len(which), np.int64), np.zeros(len(which), np.int64)
        old = np.zeros(len(which), bool)
        found, held = [np.zeros(0, np.int32)], 0
        if self.seen is not None and self.seen[0].type == words.type:
            parts_seen, sizes, begins, ids = self.seen
            known = pc.fill_null(pc.index_in(words, value_set=parts_seen), -1).to_numpy(zero_copy_only=False)
            old = plain & (known >= 0)
            size[old], begin[old] = sizes[known[old]], begins[known[old]]
            found, held = [ids], len(ids)
        for mask, of in ((plain & ~old, self.joined), (~plain, self.alone)):
            at = np.nonzero(mask)[0]
            after = (which[at] < n) | (lead & (which[at] < 2 * n))
            for k in range(0, len(at), 4096):
                some = at[k:k + 4096]
                size[some], ids = of(words.take(pa.array(some)).to_pylist(), after[k:k + 4096])
                begin[some] = held + np.cumsum(size[some]) - size[some]
                found.append(ids)
                held += len(ids)
        ids = np.concatenate(found)
        self._keep(words, np.nonzero(plain)[0], size, begin, ids)
        place = (np.cumsum(used, dtype=np.int32) - 1)[code]
        return size.astype(np.int32)[place], ids, begin.astype(np.int32)[place]

    def _keep(self, words: pa.Array, at: np.ndarray, size: np.ndarray, begin: np.ndarray, ids: np.ndarray) -> None:
        self.seen = None
        size, begin = size[at], begin[at]
        if 0 < len(at) <= MOST_SEEN and (total := int(size.sum())) <= 8 * MOST_SEEN:
            first = np.cumsum(size) - size
            self.seen = words.take(pa.array(at)), size, first, ids[np.repeat(begin - first, size) + np.arange(total)]

    def joined(self, words: list[str], after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sizes, ids) of parts that follow a space and hold none: as one text, in
        which exactly the first id of each part spells a space."""
        ids = np.array(self.library(" ".join(words)), np.int32)
        first = np.nonzero(self.begins[ids])[0]
        return np.diff(np.append(first, len(ids))), ids

    def alone(self, words: list[str], after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = [self.library(w, a) for w, a in zip(words, after.tolist())]
        return (np.fromiter(map(len, found), np.int64, len(found)),
                np.fromiter((i for f in found for i in f), np.int32))


class ByteLevelBatch(_Encoder):
    """A byte-level ``tokenizers`` file; ``plain``: strings of special tokens are ordinary text."""

    odd = f"^ | $| {WHITE}|{WHITE} "
    safe = re.compile(r"(?<=\S) (?=\S)")
    one = WHITE.replace("[", "^[^") + "[^ ]*$"

    def __init__(self, path: str, plain: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.special = [] if plain else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.begins = np.array([b[:1] == b" " for b in self.spellings()])

    def whole(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts), bool)
        for s in self.special:
            out |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        return out

    def library(self, text: str, after: bool = True) -> list[int]:
        return self.tokenizer.encode_batch_fast([" " + text if after else text], add_special_tokens=False)[0].ids

    def spellings(self) -> list[bytes]:
        """The bytes of every id."""
        rest = iter(range(0x100, 0x200))
        code = {chr(b): b for b in PRINTABLE}
        code |= {chr(next(rest)): b for b in range(256) if b not in PRINTABLE}
        names = [self.tokenizer.id_to_token(i) for i in range(self.tokenizer.get_vocab_size())]
        return [bytes(map(code.__getitem__, n)) if set(n) <= code.keys() else n.encode() for n in names]


class PiecesBatch(_Encoder):
    """A ``sentencepiece`` model, which puts a space before each text by itself."""

    odd = "^ | $|  |▁"
    safe = re.compile("(?<=[^ ▁]) (?=[^ ▁])")
    one = "^[^ ▁]+$"

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        inside = re.compile("[^▁]▁")
        probe = " a   　bﬁ\t"
        #: cuts are safe if no piece spans a space and texts are taken as they are
        self.cuts = (not any(inside.search(self.model.id_to_piece(i)) for i in range(self.model.get_piece_size()))
                     and self.model.decode(self.model.encode(probe)) == probe)
        self.begins = np.array([b[:1] == b" " for b in self.spellings()])

    def whole(self, texts: pa.Array) -> np.ndarray:
        return np.full(len(texts), not self.cuts)

    def library(self, text: str, after: bool = True) -> list[int]:
        return self.model.encode(text)

    def spellings(self) -> list[bytes]:
        """The bytes of every id; <0xHH> is one byte."""
        m = self.model
        return [bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode()
                for i in range(m.get_piece_size())]


_loaded: dict[tuple[str, bool], _Encoder] = {}


def encoder(path: str, plain: bool = False) -> _Encoder:
    """The tokenizer of a file (``.json``: tokenizers, ``.model``: sentencepiece), loaded once a worker."""
    if (path, plain) not in _loaded:
        _loaded[path, plain] = PiecesBatch(path) if path.endswith(".model") else ByteLevelBatch(path, plain)
    return _loaded[path, plain]
