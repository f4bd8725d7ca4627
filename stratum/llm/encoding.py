"""Whole-text encoding by library tokenizers with a memory of the pieces between single spaces.

For the tokenizers used here no token spans the start of a space that follows a
non-space, so the ids of a text are the ids of its pieces one after another. Equal pieces of a batch
are found by dictionary encoding and encoded once, by the library itself; texts with
other spacing (two white-space characters beside each other, a space at an end) are
encoded whole, as are texts with a piece of over LONG bytes (no spaces, encoded data, minified code), in calls of
about WHOLE_BYTES. Either way the ids equal the library's for the whole text.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = r"[\s\p{Z}\x{b}\x{1c}-\x{1f}\x{85}]"
#: Texts whose spaces do not all stand alone between non-spaces.
UNEVEN = f" {SPACES}|{SPACES} |^ | $"
REMEMBERED = 1_000_000  # pieces, about 230 MB a worker; then the memory starts anew
#: Letters before a mark, a digit or a line end: there the pattern of a byte-level BPE ends a run.
CUT = r"(?s)^(?P<head>[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+)(?P<tail>[!-@\[-`{-~\n].*)$"
JOINED = 2_000  # new pieces encoded by one call
LONG = 64  # bytes of a piece; texts with longer ones are encoded whole, and such pieces are not remembered
WHOLE_BYTES = 1 << 20  # text bytes of one library call, which makes objects for every token; one text at least


class PieceEncoder:
    """``whole(texts)`` encodes texts; ``opens[id]`` tells whether a token begins with a space.

    ``first_alike``: the first piece of a text is encoded as if a space preceded it.
    ``also_uneven``: a regex of further texts to encode whole; "" for all texts.
    ``cut``: a regex that divides pieces into a head and a tail, where no token spans the cut and the tail is encoded as at a text's start.
    """

    def __init__(self, whole: Callable[[list[str]], list[list[int]]], opens: np.ndarray, first_alike: bool, also_uneven: str | None = None,
                 cut: str | None = None, remembered: int = REMEMBERED):
        self.whole, self.opens, self.first_alike, self.also_uneven = whole, opens, first_alike, also_uneven
        self.cut, self.remembered = cut, remembered
        self.forget()

    def forget(self) -> None:
        """Start the memory of pieces anew."""
        self.rows: dict[str, int] = {}
        self.tails: dict[str, int] = {}
        self.start, self.length = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0

    def _store(self, keys: list[str], lengths: np.ndarray, ids: np.ndarray, names: dict[str, int] | None = None) -> None:
        n, m = len(self.rows) + len(self.tails), len(keys)
        while n + m > len(self.start):
            self.start, self.length = np.concatenate([self.start, self.start]), np.concatenate([self.length, self.length])
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, self.flat])
        self.start[n:n + m] = self.used + np.cumsum(lengths) - lengths
        self.length[n:n + m] = lengths
        self.flat[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        (self.rows if names is None else names).update(zip(keys, range(n, n + m)))

    def _learn(self, new: pa.Array, names: list[str]) -> None:
        """Encode pieces as they stand after a space, many in one call; a piece that ``cut`` divides is its head
        after a space and its tail alone, which are each encoded once."""
        if self.cut is None:
            return self._ask(names)
        split = pc.extract_regex(new, self.cut)
        heads, tails = (pc.struct_field(split, name).drop_null().dictionary_encode() for name in ("head", "tail"))
        head_names, tail_names = _names(heads.dictionary), _names(tails.dictionary)
        divided = split.is_valid().to_numpy(zero_copy_only=False)
        whole = {names[i] for i in np.flatnonzero(~divided).tolist()}
        whole.update(p for p in head_names if p not in self.rows)
        self._ask(list(whole))
        unseen = [p for p in tail_names if p not in self.tails]
        for at in range(0, len(unseen), JOINED):
            ids = self.whole(unseen[at:at + JOINED])
            self._store(unseen[at:at + JOINED], np.array([len(x) for x in ids], np.int64), np.array([i for x in ids for i in x], np.int32), self.tails)
        if len(heads):
            of = np.stack([_looked_up(self.rows, head_names)[heads.indices.to_numpy()], _looked_up(self.tails, tail_names)[tails.indices.to_numpy()]], 1)
            self._store([names[i] for i in np.flatnonzero(divided).tolist()], self.length[of].sum(1), self._gather(of.ravel()))

    def _gather(self, rows: np.ndarray) -> np.ndarray:
        """The ids of the entries, one after another."""
        length = self.length[rows]
        ends = np.cumsum(length)
        return self.flat[np.repeat(self.start[rows] - (ends - length), length) + np.arange(ends[-1])]

    def _ask(self, new: list[str]) -> None:
        for at in range(0, len(new), JOINED):
            part = new[at:at + JOINED]
            ids = np.array(self.whole([("" if self.first_alike else " ") + " ".join(part)])[0], np.int32)
            opens = np.flatnonzero(self.opens[ids])
            if len(opens) != len(part) or opens[0] != 0:  # not one opening token a piece: one by one
                for p in part:
                    own = np.array(self.whole([p if self.first_alike else f" {p}"])[0], np.int32)
                    self._store([p], np.array([len(own)]), own)
                continue
            self._store(part, np.diff(np.append(opens, len(ids))), ids)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text (no nulls), in order."""
        n = len(texts)
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * n
        if not n:
            return out
        uneven = pc.match_substring_regex(texts, UNEVEN)
        if self.also_uneven is not None:
            uneven = pc.or_(uneven, pc.match_substring_regex(texts, self.also_uneven))
        uneven = uneven.to_numpy(zero_copy_only=False)
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        even = np.flatnonzero(~uneven & (sizes > 0))
        if len(even):
            split = pc.split_pattern(texts.take(pa.array(even)), " ")
            bounds = split.offsets.to_numpy().astype(np.int64)
            long = np.maximum.reduceat(pc.binary_length(split.values).to_numpy(zero_copy_only=False), bounds[:-1]) > LONG
            if long.any():
                uneven[even[long]] = True
                even = even[~long]
                split = pc.split_pattern(texts.take(pa.array(even)), " ")
                bounds = split.offsets.to_numpy().astype(np.int64)
        for part in _parts(np.flatnonzero(uneven), sizes):
            for i, ids in zip(part, self.whole(texts.take(pa.array(part)).to_pylist()), strict=True):
                out[i] = np.array(ids, np.int32)
        if not len(even):
            return out
        coded = split.values.dictionary_encode()
        pieces, codes = _names(coded.dictionary), coded.indices.to_numpy()
        codes = codes[bounds[0]:bounds[-1]]
        bounds = bounds - bounds[0]
        if len(self.rows) + len(self.tails) + len(pieces) > self.remembered and self.rows:
            self.forget()
        known = self.rows
        at = _looked_up(known, pieces)
        unknown = np.flatnonzero(at < 0)
        if len(unknown):
            new = [pieces[i] for i in unknown.tolist()]
            self._learn(coded.dictionary.take(pa.array(unknown)), new)
            at[unknown] = _looked_up(known, new)
        rows = at[codes]
        start, length = self.start[rows], self.length[rows]
        heads = None
        if not self.first_alike:
            length[bounds[:-1]] = 0  # the first pieces have no space before them
            heads = self.whole([pieces[c] for c in codes[bounds[:-1]].tolist()])
        ends = np.cumsum(length)
        source = np.repeat(start - (ends - length), length) + np.arange(ends[-1])
        ids = self.flat[source]
        cuts = np.concatenate([[0], ends])[bounds]
        for j, i in enumerate(even.tolist()):
            body = ids[cuts[j]:cuts[j + 1]]
            out[i] = np.concatenate([np.array(heads[j], np.int32), body]) if heads else body
        return out


def _names(strings: pa.Array) -> list[str]:
    return strings.to_numpy(zero_copy_only=False).tolist()  # faster than to_pylist


def _looked_up(rows: dict[str, int], names: list[str]) -> np.ndarray:
    """The rows of the names, -1 for those without one."""
    return np.fromiter(map(rows.get, names, repeat(-1)), np.int64, len(names))


def _parts(at: np.ndarray, sizes: np.ndarray) -> Iterator[list[int]]:
    """``at`` cut into runs of about WHOLE_BYTES, one at least."""
    part, held = [], 0
    for i in at.tolist():
        if part and held + sizes[i] > WHOLE_BYTES:
            yield part
            part, held = [], 0
        part.append(i)
        held += sizes[i]
    if part:
        yield part


_ENCODERS: dict[tuple[str, bool], PieceEncoder] = {}


def byte_bpe(path: str, specials: bool = False) -> PieceEncoder:
    """An encoder for a byte-level BPE file of the tokenizers library, one per Python worker.

    Strings of special tokens in a text count as ordinary text, or with ``specials`` as these
    tokens, as by the library's default; texts that hold one are then encoded whole.
    """
    if (path, specials) not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = not specials
        added = sorted(t.content for t in tokenizer.get_added_tokens_decoder().values())
        literals = "|".join(re.escape(t) for t in added) if specials and added else None
        opens = np.array([(tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(tokenizer.get_vocab_size())])
        whole = lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        encoder = PieceEncoder(whole, opens, first_alike=False, also_uneven=literals, cut=CUT)
        encoder.tokenizer = tokenizer
        _ENCODERS[path, specials] = encoder
    return _ENCODERS[path, specials]


def byte_lengths(encoder: PieceEncoder) -> np.ndarray:
    """UTF-8 bytes of each id of a byte-level BPE: one printable character stands for a byte."""
    if not hasattr(encoder, "lengths"):
        t = encoder.tokenizer
        encoder.lengths = np.array([len(t.id_to_token(i) or "") for i in range(t.get_vocab_size())], np.int64)
    return encoder.lengths
