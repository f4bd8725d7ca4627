"""Fingerprints, token files, attribution, SentencePiece: against the plain definition on odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import types as T
from tokenizers import Tokenizer

from stratum.llm import attribution, fingerprints, pieces, tokenfile
from stratum.llm.encoding import byte_bpe, byte_lengths

BPE, PIECE = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, n_chars long, fingerprint string, id string, k int, part int"
WORDS = ["the", "Café", "über", "日本", "x", "42", "a.b", "'s", "😀"]


def odd_rows(n=40, seed=3):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 60)))) for i in range(n)]
    rows += [(100, None), (101, ""), (102, "one"), (103, rows[3][1]), (104, "long " * 30_000), (105, " lead  and\ttail "), (5, rows[5][1]), (None, "no id")]
    return [(i, t, 7, "f", "i", 1, 2) for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_chunks_tile_the_text_and_keep_their_bounds():
    rng = np.random.default_rng(1)
    for n in (0, 1, 7, 8, 9, 40, 5000):
        data = rng.integers(97, 123, n, dtype=np.uint8).tobytes()
        ends = fingerprints.chunk_ends(data)
        sizes = np.diff([0, *ends])
        assert (ends[-1] if ends else 0) == n
        assert all(fingerprints.MIN_CHUNK <= s <= fingerprints.MAX_CHUNK for s in sizes[:-1])
    table = [int(g) for g in fingerprints.GEAR]
    data = rng.integers(0, 256, 300, dtype=np.uint8)
    plain = [sum(table[data[i - j]] << j for j in range(32) if i >= j) % (1 << 32) for i in range(300)]
    assert fingerprints.gear_hash(data).tolist() == plain


def test_fingerprint_resists_shifts():
    rng = random.Random(5)
    text = " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(800)).encode()
    own = fingerprints.chunk_set(text)
    assert fingerprints.containment(own, fingerprints.chunk_set(b"a few words in front, " + text)) > 0.95
    assert fingerprints.containment(own, fingerprints.chunk_set(text[::-1])) < 0.05
    assert (fingerprints.decode_set(fingerprints.encode_set(own)) == own).all()


def brute_edits(rows):
    key = lambda r: -(1 << 63) if r[0] is None else r[0]
    order = sorted(rows, key=lambda r: -key(r))
    out = []
    for (i, t, *_), (_, nxt, *_) in zip(order, [*order[1:], *order[:1]]):
        t, nxt = t or "", nxt or ""
        cut = len(t) // 3
        edited = t[:len(t) - cut] + nxt[:cut]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), fingerprints.encode_set(fingerprints.chunk_set(edited.encode()))))
    return out


def test_edits_against_brute_force(docs, empty):
    got = fingerprints.fingerprint_edits(docs).collect()
    expect = brute_edits(odd_rows())
    mine = [(r.doc_id, r.n_chars, r.edited_sha256, r.edited_fingerprint) for r in got]
    order = lambda x: sorted(x, key=str)
    assert order(mine) == order(expect)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert all(r.near_edited == 1 for r in got if r.n_chars == 0)
    assert fingerprints.fingerprint_edits(empty).count() == 0
    plain = fingerprints.fingerprint_documents(docs).collect()
    by_id = {r.doc_id: r.fingerprint for r in plain}
    assert len(plain) == docs.count() and by_id[3] == by_id[103] and by_id[100] == by_id[101] == ""


def test_one_document_is_its_own_next(spark):
    r = fingerprints.fingerprint_edits(spark.createDataFrame([(1, "abcdef" * 40)], "doc_id long, text string")).first()
    assert r.near_next == 1.0


@pytest.fixture(scope="module")
def bpe():
    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = True
    return t


ATOMS = [" ", "  ", "\n", "a", "the", "'s", "é", "1", "!", "\t", "▁", " x.", "\r\n", "日本", "😀", "<|endoftext|>", "<s>", "\x85", "\x1c", "́", "end,", "<0x0A>"]


def fuzz(n=6000, seed=9):
    rng = random.Random(seed)
    return ["".join(rng.choice(ATOMS) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_byte_bpe_equals_the_library(bpe):
    texts = fuzz()
    encoder = byte_bpe(BPE)
    for _ in range(2):  # the second time from memory
        got = encoder.encode(pa.array(texts))
        assert [x.tolist() for x in got] == [bpe.encode(t, add_special_tokens=False).ids for t in texts]
    lengths = byte_lengths(encoder)
    assert all(lengths[x].sum() == len(t.encode()) for t, x in zip(texts, got))


def test_token_files_round_trip(spark, docs, empty, bpe, tmp):
    tokenfile.write_tokens(docs, BPE, f"{tmp}/t")
    rows = tokenfile.read_tokens(spark, f"{tmp}/t").orderBy("start").collect()
    expect = sorted(((r[0], r[1] or "") for r in odd_rows()), key=lambda r: (r[0] is None, r[0] or 0))
    assert [r.doc_id for r in rows] == [i for i, _ in expect]
    at = 0
    for r, (_, text) in zip(rows, expect):
        ids = bpe.encode(text, add_special_tokens=False).ids + [tokenfile.END_ID]
        assert (r.start, r.n_tokens, r.token_ids) == (at, len(ids), ids)
        at += len(ids)
    meta = tokenfile.read_tokens(spark, f"{tmp}/t", tokens=False)
    assert "token_ids" not in meta._jdf.queryExecution().executedPlan().toString()
    tokenfile.write_tokens(empty, BPE, f"{tmp}/none")
    assert tokenfile.read_tokens(spark, f"{tmp}/none").count() == 0


def test_token_files_have_delta_pages_and_indexes(docs, tmp):
    import glob

    import pyarrow.parquet as pq

    tokenfile.write_tokens(docs, BPE, f"{tmp}/t")
    seen = []
    for f in glob.glob(f"{tmp}/t/data/*.parquet"):
        group = pq.ParquetFile(f).metadata
        for g in range(group.num_row_groups):
            column = next(group.row_group(g).column(c) for c in range(group.num_columns) if group.row_group(g).column(c).path_in_schema.startswith("token_ids"))
            seen.append((column.encodings, column.has_offset_index))
    assert seen and all("DELTA_BINARY_PACKED" in e and index for e, index in seen)


def test_crc_is_of_little_endian_ids(spark, docs, bpe, tmp):
    tokenfile.write_tokens(docs, BPE, f"{tmp}/t")
    out = tokenfile.read_tokens(spark, f"{tmp}/t").mapInArrow(tokenfile._crc, "doc_id long, start long, n_tokens long, ids_crc32 long").where("doc_id = 102").first()
    ids = np.array([*bpe.encode("one", add_special_tokens=False).ids, 0], "<u4")
    assert out.ids_crc32 == zlib.crc32(ids.tobytes())


@pytest.mark.parametrize("rule", attribution.RULES)
def test_attribution_against_offsets(spark, docs, bpe, rule):
    got = {(r.doc_id, r.n_tokens): r for r in attribution.section_tokens(docs, BPE, rule).collect()}
    for i, text, *_ in odd_rows():
        text = text or ""
        data = text.encode()
        parts = [p for p in re.split(rb"(?<=\n)|(?<=[.!?] )", data) if p]
        starts = np.cumsum([0, *map(len, parts)])
        counts, crossing, at = [0] * len(parts), 0, 0
        for token in bpe.encode(text, add_special_tokens=False).ids:
            n = len(bpe.id_to_token(token))
            inside = [min(at + n, starts[j + 1]) - max(at, starts[j]) for j in range(len(parts))]
            held = [j for j, x in enumerate(inside) if x > 0]
            crossing += len(held) > 1
            counts[held[0] if rule == "start" else held[-1] if rule == "end" else max(held, key=lambda j: (inside[j], -j))] += 1
            at += n
        r = got[(i, sum(counts))]
        assert (r.section_tokens, r.n_sections, r.n_crossing) == (counts, len(parts), crossing)
        assert r.section_starts == [len(data[:s].decode()) for s in starts[:-1]] or not parts


def test_attribution_empty_and_bad_rule(empty):
    assert attribution.section_tokens(empty, BPE).count() == 0
    with pytest.raises(ValueError):
        attribution.section_tokens(empty, BPE, "middle")


def test_pieces_ids_and_spans_equal_the_library():
    p = pieces.pieces_of(PIECE)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    texts = fuzz()
    for _ in range(2):
        got = p.encode(pa.array(texts))
        assert [x.tolist() for x in got] == library.encode(texts)
    for t, ids in zip(texts[:1500], got):
        starts, ends = p.spans(t.encode(), ids)
        assert list(zip(starts.tolist(), ends.tolist())) == [(q.begin, q.end) for q in library.encode(t, return_type="proto").pieces]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
def test_normaliser_equals_the_library(rule):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    model.ParseFromString(library.serialized_model_proto())
    s = model.normalizer_spec
    mine = pieces.Normaliser(s.precompiled_charsmap, s.add_dummy_prefix, s.remove_extra_whitespaces, s.escape_whitespaces)
    rng = random.Random(2)
    atoms = [*ATOMS, "ﬁ", "①", "Ａ", "ｶﾞ", "　", "½", "㍿", "ẞ"]
    for _ in range(1500):
        t = "".join(rng.choice(atoms) for _ in range(rng.randint(0, 10)))
        expect, offsets = library.normalize(t, with_offsets=True)
        normal, origin = mine(t.encode())
        assert normal.decode() == expect
        firsts = np.cumsum([0, *[len(c.encode()) for c in expect]])[:-1]
        as_chars = [len(t.encode()[:b].decode(errors="ignore")) for b in origin[firsts].tolist()]
        assert as_chars == list(offsets)[:len(as_chars)]


def test_pieces_operator(docs, empty):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    got = pieces.digest_documents(docs, PIECE).collect()
    assert len(got) == docs.count()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expect = sorted((str(i), len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))) for i, ids in ((r[0], library.encode(r[1] or "")) for r in odd_rows()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == expect
    full = {r.doc_id: r for r in pieces.encode_documents(docs, PIECE).collect()}
    assert full[102].ids == library.encode("one") and full[102].decoded == "one" and full[102].span_ends[-1] == 3
    assert pieces.digest_documents(empty, PIECE).count() == 0


def test_schema_names_may_clash(spark):
    t = T.StructType([T.StructField(c, T.StringType()) for c in ("text", "ids", "grp", "u")] + [T.StructField("doc_id", T.LongType())])
    df = spark.createDataFrame([("a b", "x", "y", "z", 1)], t)
    assert pieces.digest_documents(df, PIECE).count() == attribution.section_tokens(df, BPE).count() == fingerprints.fingerprint_documents(df).count() == 1


def test_token_files_equal_the_unmodified_library(spark, tmp):
    library = Tokenizer.from_file(BPE)
    texts = ["a<|endoftext|>b", "plain words", "x <|endoftext|> y z", "<|endoftext|>", *fuzz(300)]
    tokenfile.write_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), BPE, f"{tmp}/t")
    rows = tokenfile.read_tokens(spark, f"{tmp}/t").orderBy("start").collect()
    assert [r.token_ids for r in rows] == [[*library.encode(t, add_special_tokens=False).ids, tokenfile.END_ID] for t in texts]
    assert rows[0].token_ids[:-1] == [64, 50256, 65]


def test_a_word_with_several_marks_is_asked_once():
    """Pieces are divided where a run of letters ends; the ids are the library's all the same."""
    import public_tokenizers
    import pyarrow as pa

    from stratum.llm.encoding import byte_bpe

    encoder, asked = byte_bpe(public_tokenizers.path("byte_bpe_50k.json"), specials=True), []
    encoder.forget()
    whole = encoder.whole
    texts = ["x " + " ".join(f"unquestionably{m}" for m in ("", ".", ",", "$$$", "!!", "7", "\nAnd", "'s", "'tis", ".,", "...\n\nÜber")),
             "a don't we'll it'S x1y2 é́b. naïve; Straße- ñandú́! łódź. wordя. я.b ×. a×b _a a_b {a}b <a|b> a b. ́a. á. ½a a½ a²b. 東京. a東京! x\t.y e‍.",
             "a .b a. .a 'a a' \n.a a.\n a", "", "a", "a.", "$a b$"]
    want = whole(texts)
    encoder.whole = lambda t: asked.extend(t) or whole(t)
    try:
        for _ in range(2):
            got = [x.tolist() for x in encoder.encode(pa.array(texts))]
            assert got == [list(x) for x in want]
        encoder.forget()
        asked.clear()
        encoder.encode(pa.array(texts[:1]))
        assert sum(t.count("unquestionably") for t in asked) == 1
    finally:
        encoder.whole = whole
        encoder.forget()
