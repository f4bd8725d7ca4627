"""Offset-preserving SentencePiece encoding and decoding (operator 8).

The text is normalised here, by the longest prefix in the model's compiled character
map (a double-array trie over UTF-8 bytes), and every normalised byte records the
source byte it came from. Ids are the library's own, for the whole text; the pieces'
lengths give their spans in the normalised text, and the alignment carries each span
back to original bytes. Decoding is the library's ``decode(ids)``.

Defined cases: a null text is an empty one: no ids, decoded to the empty text; an
empty table gives an empty result; repeated rows give repeated rows. Only the id and
text columns are read, so other columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import released, slices, table, text_or_empty
from stratum.llm.encoding import PieceEncoder

MARK = "▁"  # stands for a space in pieces
MARK_BYTES = MARK.encode()
#: Pieces remembered and text bytes encoded at once by a worker, which shares its executor with other stages.
REMEMBERED, SLICE = 250_000, 4 << 20


class CharacterMap:
    """The compiled map of a model: longest matching prefix -> replacement bytes.

    Layout (fixed by the format): four bytes with the size of the trie, the trie's
    32-bit units, then zero-terminated replacements at the offsets the trie holds. A
    unit has its label in bits 0-7, a leaf flag in bit 8, and an offset in bits 10-30
    that bit 9 scales by 256.
    """

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], "<u4").tolist()
        self.strings = blob[4 + size:]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """(replacement, source bytes) of the longest key that ``data`` has at ``at``."""
        units = self.units
        if not units:
            return None
        node, best = self._offset(units[0]), None
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units) or units[node] & 0x800000FF != data[i]:
                break
            leaf = units[node] & 0x100
            node ^= self._offset(units[node])
            if leaf:
                best = (units[node] & 0x7FFFFFFF, i + 1 - at)
        if best is None:
            return None
        start = best[0]
        return self.strings[start:self.strings.index(b"\0", start)], best[1]


class Normaliser:
    """Normalised bytes of a text and, for each of them and the end, the source byte offset."""

    def __init__(self, charsmap: bytes, dummy_prefix: bool, squeeze: bool, escape: bool):
        self.map = CharacterMap(charsmap)
        self.dummy_prefix, self.squeeze = dummy_prefix, squeeze
        self.space = MARK_BYTES if escape else b" "

    def _prefix(self, data: bytes, at: int) -> tuple[bytes, int]:
        found = self.map.longest(data, at)
        if found:
            return found
        lead = data[at]
        width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return data[at:at + width], width

    def _identity(self, data: bytes) -> tuple[bytes, np.ndarray]:
        raw = np.frombuffer(data, np.uint8)
        width = np.where(raw == 32, len(self.space), 1)
        origin = np.repeat(np.arange(len(raw)), width)
        head = len(self.space) if self.dummy_prefix else 0
        return (self.space if head else b"") + data.replace(b" ", self.space), np.concatenate([np.zeros(head, np.int64), origin, [len(raw)]])

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        if not data:
            return b"", np.zeros(1, np.int64)
        if not self.map.units and not self.squeeze:
            return self._identity(data)
        at, out, origin = 0, bytearray(), []
        if self.squeeze:
            while at < len(data):
                new, used = self._prefix(data, at)
                if new != b" ":
                    break
                at += used
            if at == len(data):
                return b"", np.array([at])
        after_space = self.squeeze

        def put(piece: bytes) -> None:
            out.extend(piece)
            origin.extend([at] * len(piece))

        if self.dummy_prefix:
            put(self.space)
        while at < len(data):
            new, used = self._prefix(data, at)
            if after_space:
                new = new.lstrip(b" ")
            if new:
                put(new.replace(b" ", self.space))
                after_space = self.squeeze and new.endswith(b" ")
            at += used
        if self.squeeze:
            while out.endswith(self.space):
                at = origin[-1]
                del out[-len(self.space):], origin[-len(self.space):]
        return bytes(out), np.array([*origin, at], np.int64)


class Pieces:
    """A SentencePiece model: ids, original byte spans and decoded texts."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = proto.ModelProto()
        model.ParseFromString(self.library.serialized_model_proto())
        rules = model.normalizer_spec
        self.normalise = Normaliser(rules.precompiled_charsmap, rules.add_dummy_prefix, rules.remove_extra_whitespaces, rules.escape_whitespaces)
        names = [p.piece for p in model.pieces]
        byte_type, unknown = proto.ModelProto.SentencePiece.BYTE, proto.ModelProto.SentencePiece.UNKNOWN
        self.lengths = np.array([1 if p.type == byte_type else -1 if p.type == unknown else len(p.piece.encode()) for p in model.pieces], np.int64)
        self.names = [str(i) for i in range(len(names))]
        opens = np.array([n.startswith(MARK) for n in names])
        # pieces between spaces are independent if the text is taken as it is and no piece goes on over a space
        apart = (not rules.precompiled_charsmap and rules.add_dummy_prefix and not rules.remove_extra_whitespaces
                 and rules.escape_whitespaces and not any(MARK in n.lstrip(MARK) for n in names))
        whole = lambda texts: self.library.encode(texts, num_threads=1)
        self.encoder = PieceEncoder(whole, opens, first_alike=True, also_uneven=MARK if apart else "", remembered=REMEMBERED)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        return self.encoder.encode(texts)

    def spans(self, data: bytes, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Original byte spans (starts, ends) of the pieces."""
        normal, origin = self.normalise(data)
        lengths = self.lengths[ids]
        unknown = np.flatnonzero(lengths < 0)
        if len(unknown):  # unknown pieces keep their surface
            surfaces = self.library.encode(data.decode(), return_type="proto").pieces
            lengths = lengths.copy()
            for i in unknown.tolist():
                lengths[i] = len(surfaces[i].piece.encode())
        ends = np.cumsum(lengths)
        if (ends[-1] if len(ends) else 0) != len(normal):
            raise ValueError("the pieces do not tile the normalised text")
        return origin[ends - lengths], origin[ends]


_MODELS: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    """The model of ``path``, loaded once in a Python worker."""
    if path not in _MODELS:
        _MODELS[path] = Pieces(path)
    return _MODELS[path]


def encode_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ids (array<int>), span_starts and span_ends (bytes of the original text), decoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces_of(model)
        for batch in slices(batches, "text", SLICE):
            ids = p.encode(batch.column("text"))
            spans = [p.spans(raw, x) for raw, x in zip(batch.column("text").cast(pa.binary()).to_pylist(), ids, strict=True)]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(offsets, np.concatenate(x).astype(np.int32)) for x in (ids, [s for s, _ in spans], [e for _, e in spans])]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *lists, pa.array(p.library.decode([x.tolist() for x in ids]), pa.string())],
                                             names=["id", "ids", "span_starts", "span_ends", "decoded"])

    src = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    return src.mapInArrow(released(run), "id long, ids array<int>, span_starts array<int>, span_ends array<int>, decoded string").withColumnRenamed("id", id_col)


def digest_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same encoding, digested in its tasks: id, n_tokens, ids_sha256, decoded_sha256, spans_sha256
    (of the starts, then the ends, as little-endian 64-bit integers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces_of(model)
        for batch in slices(batches, "text", SLICE):
            ids = p.encode(batch.column("text"))
            lists = [x.tolist() for x in ids]
            decoded = p.library.decode(lists)
            spans = [p.spans(raw, x) for raw, x in zip(batch.column("text").cast(pa.binary()).to_pylist(), ids, strict=True)]
            sha = lambda data: hashlib.sha256(data).hexdigest()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([sha(",".join([p.names[i] for i in x]).encode()) for x in lists]), pa.array([sha(t.encode()) for t in decoded]),
                 pa.array([sha(s.astype("<i8").tobytes() + e.astype("<i8").tobytes()) for s, e in spans])],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"])
        p.encoder.forget()  # a worker that waits, or serves another stage, holds the model alone

    src = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    return src.mapInArrow(released(run), "id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string").withColumnRenamed("id", id_col)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
