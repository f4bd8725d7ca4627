"""Token counts by offset-mapped attribution (operator 6).

A document is encoded once, whole. Byte-level tokens tile the text, so their byte spans
are running sums of token lengths; the spans are joined, as sorted intervals, with the
spans of the document's sections: its lines, each with its line end, or its sentences,
each with the space after its stop. Tokens that begin with that space cross a boundary. A token that crosses a boundary goes to one section by the
rule asked for: ``start`` (the section of its first byte), ``end`` (of its last byte) or
``majority`` (of most of its bytes; the earlier one on a tie). So the counts of the
sections always add up to the document's.

Defined cases: null or empty texts have no sections and no tokens; repeated rows give
repeated rows; an empty table an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import released, slices, table, text_or_empty
from stratum.llm.encoding import byte_bpe, byte_lengths

RULES = ("start", "end", "majority")


SECTIONS = ("lines", "sentences")


def section_starts(data: np.ndarray, kind: str) -> np.ndarray:
    """Byte offsets at which the sections of a non-empty text begin."""
    cut = data == 10
    if kind == "sentences":
        stop = (data == ord(".")) | (data == ord("!")) | (data == ord("?"))
        cut[1:] |= stop[:-1] & (data[1:] == 32)
    starts = np.concatenate([[0], np.flatnonzero(cut) + 1])
    return starts[starts < len(data)]


def attribute(token_ends: np.ndarray, starts: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(section of each token, whether it crosses a boundary) for tokens that tile the text."""
    token_starts = np.concatenate([[0], token_ends[:-1]])
    first = np.searchsorted(starts, token_starts, "right") - 1
    last = np.searchsorted(starts, token_ends - 1, "right") - 1
    crossing = first != last
    if rule == "start":
        return first, crossing
    if rule == "end":
        return last, crossing
    chosen = first.copy()
    for i in np.flatnonzero(crossing).tolist():
        inside = starts[first[i] + 1:last[i] + 1]
        widths = np.diff(np.concatenate([[token_starts[i]], inside, [token_ends[i]]]))
        chosen[i] = first[i] + int(np.argmax(widths))  # argmax takes the earliest
    return chosen, crossing


def _count(path: str, rule: str, kind: str):
    if rule not in RULES or kind not in SECTIONS:
        raise ValueError(f"rule must be one of {RULES}, sections one of {SECTIONS}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(path)
        lengths = byte_lengths(encoder)
        for batch in slices(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            n_tokens, n_crossing, counts, places, sizes = [], [], [], [], []
            for ids, raw in zip(encoder.encode(batch.column("text")), texts, strict=True):
                data = np.frombuffer(raw, np.uint8)
                ends = np.cumsum(lengths[ids])
                n_tokens.append(len(ids))
                if not len(data):
                    n_crossing.append(0), sizes.append(0)
                    continue
                if ends[-1] != len(data):
                    raise ValueError("the tokens do not tile the text")
                starts = section_starts(data, kind)
                section, crossing = attribute(ends, starts, rule)
                n_crossing.append(int(crossing.sum()))
                counts.append(np.bincount(section, minlength=len(starts)))
                code_points = np.cumsum((data & 0xC0) != 0x80)
                places.append(code_points[starts] - 1)
                sizes.append(len(starts))
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            flat = lambda parts: np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n_tokens, pa.int64()), pa.array(sizes, pa.int64()), pa.array(n_crossing, pa.int64()),
                 pa.ListArray.from_arrays(offsets, flat(places)), pa.ListArray.from_arrays(offsets, flat(counts))],
                names=["id", "n_tokens", "n_sections", "n_crossing", "section_starts", "section_tokens"])
    return run


def section_tokens(docs: DataFrame, tokenizer: str, rule: str = "majority", sections: str = "sentences", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, n_sections, n_crossing (tokens over a boundary), section_starts (code
    points) and section_tokens, one entry a section."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    return src.mapInArrow(released(_count(tokenizer, rule, sections)), "id long, n_tokens long, n_sections long, n_crossing long, "
                          "section_starts array<long>, section_tokens array<long>").withColumnRenamed("id", id_col)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return section_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
