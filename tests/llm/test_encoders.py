"""Encoders against the libraries they must equal: ids, counts, files and sequences."""

import hashlib
import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward_texts, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardlake.llm import bit_packing, packing, pair_merges, transducer
from wardlake.llm.queries import BYTE_VOCABULARY, PIECE_MODEL
from wardlake.llm.words import letter_words_encoder, library_encoder, parts_of, split_rows
from wardlake.session import fresh_path

os.environ["TOKENIZERS_PARALLELISM"] = "false"
ODD = st.text(st.sampled_from("aab etinghrs  \n\t'lé漢▁<s>|endotx0!\u00a0\x1c\x85\U0001f600"), max_size=60)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTE_VOCABULARY)


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


def library_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(ODD)
def test_speculation_equals_the_library(library, text):
    own = pair_merges.codec(BYTE_VOCABULARY)
    ids = own.encode([text])[0]
    assert ids.tolist() == library_ids(library, text)
    assert own.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(ODD)
def test_words_equal_whole_texts(library, text):
    assert library_encoder(BYTE_VOCABULARY).encode(pa.array([text]))[0].tolist() == library_ids(library, text)


@settings(max_examples=300, deadline=None)
@given(ODD)
def test_transducer_equals_the_library(pieces, text):
    assert transducer.transducer(PIECE_MODEL).count(pa.array([text])).tolist() == [len(pieces.encode(text))]


def test_every_pair_check_agrees_with_merging():
    own = pair_merges.codec(BYTE_VOCABULARY)
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 3000, 4000), rng.integers(0, 3000, 4000)
    usable = [i for i in range(4000) if own.entries[a[i]] and own.entries[b[i]]]
    a, b = a[usable], b[usable]
    crossed = own.crossed(a, b)
    for x, y, bad in zip(a.tolist(), b.tolist(), crossed.tolist(), strict=True):
        assert (own.merged(own.entries[x] + own.entries[y]) != [x, y]) == bad


def test_encoding_query_columns(spark, library):
    rows = pair_merges.round_trip_digests(documents(spark), BYTE_VOCABULARY).collect()
    assert len(rows) == len(awkward_texts())
    for row in rows:
        text = awkward_texts()[row.doc_id] or ""
        ids = library_ids(library, text)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_encoding_with_null_and_repeated_ids(spark):
    docs = documents(spark, ["a b", "a b", None], [None, 4, 4])
    got = pair_merges.encode_and_decode(docs, BYTE_VOCABULARY).collect()
    assert sorted((r.doc_id or -1, r.decoded) for r in got) == [(-1, "a b"), (4, ""), (4, "a b")]
    assert pair_merges.encode_and_decode(docs.where("false"), BYTE_VOCABULARY).count() == 0


def test_counts(spark, pieces):
    for row in transducer.token_counts(documents(spark), PIECE_MODEL, 10).collect():
        text = awkward_texts()[row.doc_id] or ""
        assert (row.n_bytes, row.n_tokens) == (len(text.encode()), len(pieces.encode(text)))
        assert row.over_limit == (row.n_tokens > 10)


@pytest.mark.parametrize("bits", [1, 7, 16, 17, 31])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000)
    packed = bit_packing.pack(ids, bits)
    assert len(packed) == 16 * bits * 8
    for start, stop in ((0, 1000), (63, 64), (64, 64), (100, 777), (999, 1000)):
        assert bit_packing.unpack(packed, bits, start, stop).tolist() == ids[start:stop].tolist()
    assert bit_packing.bits_for(1 << bits) == bits


def test_packed_file(spark, library):
    path = fresh_path(spark, "packed")
    docs = documents(spark).unionByName(documents(spark, ["twice", None], [5, None]))
    bit_packing.write_packed(docs, BYTE_VOCABULARY, path, block_ids=500)
    blocks = bit_packing.open_packed(spark, path)
    got = sorted(bit_packing.read_documents(blocks).collect(), key=lambda r: r.start)
    expected = sorted([*enumerate(awkward_texts()), (5, "twice"), (None, None)], key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    whole, at = [], 0
    for row, (name, text) in zip(got, expected, strict=True):
        ids = [*library_ids(library, text), 0]
        assert (row.doc_id, row.start, row.n_tokens) == (name, at, len(ids))
        assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        whole += ids
        at += len(ids)
    assert blocks.count() > 3
    assert bit_packing.read_tokens(blocks, 90, 20_345).tolist() == whole[90:20_345]
    assert bit_packing.read_tokens(blocks, at, at + 5).tolist() == []


def test_packed_file_of_no_documents(spark):
    path = fresh_path(spark, "packed")
    bit_packing.write_packed(documents(spark, []), BYTE_VOCABULARY, path)
    assert bit_packing.read_documents(bit_packing.open_packed(spark, path)).count() == 0


def test_sequences_hold_each_id_once(spark, library):
    docs = documents(spark).unionByName(documents(spark, ["no id", None], [None, None]))
    pieces = packing.packed_pieces(docs, BYTE_VOCABULARY, window=64).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u2")
        assert len(ids) == p.length and p.ids_crc32 == zlib.crc32(ids.astype("<u4").tobytes())
        by_doc.setdefault(p.doc_id, []).append((p.start, p.length, ids.tolist(), p.doc_tokens))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for name, text in enumerate(awkward_texts()):
        expected, got = [*library_ids(library, text), 0], []
        for start, length, ids, total in sorted(by_doc[name]):
            assert start == len(got) and total == len(expected)
            got += ids
        assert got == expected
    assert sum(p[1] for p in by_doc[None]) == 1 + len(library_ids(library, "no id")) + 1
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 64 or (at < 64 and at & (at - 1) == 0)
    assert packing.packed_pieces(docs.where("false"), BYTE_VOCABULARY).count() == 0


def test_a_seed_is_followed_by_its_neighbours(library):
    texts = ["red apples grow on trees", "the stock market fell", "apples and trees are red", "market prices of stock fell"]
    ids = [np.array([*library_ids(library, " " + t), 0], "<u2") for t in texts]
    counts = np.bincount(np.concatenate([np.unique(i[:-1]) for i in ids]), minlength=50_257)
    idf = np.log1p((4 - counts + 0.5) / (counts + 0.5)).astype(np.float32)
    index = packing.ShardIndex(ids, idf, 6.0)
    index.unused[0] = False
    assert next(index.neighbours(0)) == 2
    index.unused[1] = False
    assert next(index.neighbours(1)) == 3
    assert sorted(index.neighbours(0)) == [2, 3]


def test_terms_are_counted_over_all_documents(spark, library):
    rows, terms = packing.tokenized(documents(spark), BYTE_VOCABULARY)
    expected = {}
    for text in awkward_texts():
        for i in set(library_ids(library, text)):
            expected[i] = expected.get(i, 0) + 1
    assert {r.term: r.docs for r in terms.where(F.col("docs") > 0).collect()} == expected
    assert rows.count() == len(awkward_texts())


def test_the_best_neighbour_is_found_in_a_table_of_many_documents(spark, library):
    """Every document of a table beyond 1024 is searched, by all terms of the seed."""
    rng = np.random.default_rng(8)
    word = lambda: "".join(rng.choice(list("bcdfgklmnprstvz"), 7))
    filler = [word() for _ in range(30)]
    texts = [" ".join([*(word() for _ in range(12)), *rng.choice(filler, 20)]) for _ in range(1500)]
    twins = [" ".join(rng.permutation(t.split())) for t in texts]
    docs = documents(spark, texts + twins).repartition(7)
    longest = max(len(library_ids(library, t)) for t in texts + twins)
    pieces = packing.packed_pieces(docs, BYTE_VOCABULARY, window=4 * longest).collect()
    sequences: dict[int, list] = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        sequences.setdefault(p.sequence_id, []).append(p.doc_id)
    used, right, wrong = set(), 0, 0
    for held in sequences.values():
        twin = (held[0] + 1500) % 3000
        if twin not in used and len(held) > 1:
            right, wrong = right + (held[1] == twin), wrong + (held[1] != twin)
        used |= set(held)
    assert right > 300 and wrong == 0
    # A seed of many terms finds the one document that shares its weakest.
    ids = [np.array([*range(100, 140), 0], "<u2"), np.array([*range(200, 240), 0], "<u2"), np.array([139, *range(300, 339), 0], "<u2")]
    idf = np.ones(50_257, np.float32)
    idf[139] = 0.01
    index = packing.ShardIndex(ids, idf, 41.0)
    index.unused[0] = False
    assert list(index.neighbours(0)) == [2, 1]


def test_words_encoded_together_equal_words_alone(library):
    """Words with white space of their own, empty ones and special strings among plain ones, each led by a space."""
    ends = ("", "'ll", "é\u00a0x", "<|endoftext|>", "\n", "Ġ", " ", "\u200b", "1234")
    words = [f" w{k}{end}" for k in range(400) for end in ends] + [" ", "head", " \t"]
    flat, counts = library_encoder(BYTE_VOCABULARY).encode_new(words)
    alone = [library_ids(library, w) for w in words]
    assert counts.tolist() == [len(ids) for ids in alone] and flat.tolist() == [i for ids in alone for i in ids]


def test_neighbours_equal_scores_of_all_documents():
    """Bounds and the removal of used documents change nothing: the same scores as all terms of all unused documents."""
    rng = np.random.default_rng(5)
    draw = lambda: np.minimum(rng.zipf(1.3, rng.integers(20, 200)), 3000)
    ids = [np.append(draw(), 0).astype("<u2") for _ in range(1200)]
    held = np.bincount(np.concatenate([np.unique(i[:-1]) for i in ids]), minlength=3001)
    idf = np.log1p((1200 - held + 0.5) / (held + 0.5)).astype(np.float32)
    mean = float(np.mean([len(i) for i in ids]))
    own = [dict(zip(*(x.tolist() for x in packing.bm25(i, idf, mean)), strict=True)) for i in ids]
    index = packing.ShardIndex(ids, idf, mean)
    assert len(index.row) > 20 and len(index.place) > 200
    for seed in range(0, 1200, 40):
        index.unused[seed] = False
        score = {d: sum(own[d].get(t, 0) for t in own[seed]) for d in np.flatnonzero(index.unused).tolist()}
        best = sorted(score.values(), reverse=True)
        got = list(index.neighbours(seed))
        assert sorted(got) == sorted(score)
        assert np.allclose([score[d] for d in got], best, rtol=1e-4, atol=1e-4)
        index.unused[rng.integers(0, 1200, 45)] = False
    assert len(index.inside) < 600


def test_texts_cut_at_line_feeds_and_marks_equal_whole_texts(library):
    texts = ["a\nb\nc\n\nd", "One. Two,three!\nFour", "x.\n y", "it's\u00e9?\u00a0\nz", "\n", "e:\x01f g.\x01", "über; <|endoftext|>\nab.c"]
    flat, counts = library_encoder(BYTE_VOCABULARY).encode(pa.array(texts))
    assert [r.tolist() for r in split_rows(flat, counts)] == [library_ids(library, t) for t in texts]


@pytest.mark.parametrize("kind", ["<u2", "<u4"])
def test_terms_of_many_documents_equal_those_of_each(kind, monkeypatch):
    monkeypatch.setattr(packing, "RUN_IDS", 60)
    rng = np.random.default_rng(3)
    ids = [np.append(rng.integers(0, 60_000, n) // 7, 0).astype(kind) for n in (0, 5, 300, 0, 40, 40, 1, 0)]
    runs = list(packing.runs_of(ids))
    assert [len(row) for run in runs for row in run] == [len(row) for row in ids] and len(runs) == 4
    expected = [np.unique(row[:-1], return_counts=True) for row in ids]
    term, repeats, held = (np.concatenate(x) for x in zip(*map(packing.terms_of, runs), strict=True))
    assert term.tolist() == np.concatenate([t for t, _ in expected]).tolist()
    assert repeats.tolist() == np.concatenate([n for _, n in expected]).tolist()
    assert held.tolist() == [len(t) for t, _ in expected]


def test_a_seed_like_the_last_reads_only_the_rows_that_differ():
    """Rows of common terms that both seeds hold are not added again, and the order stays that of exact scores."""
    rng = np.random.default_rng(11)
    ids = [np.append(rng.choice(400, 120, replace=False), 0).astype("<u2") for _ in range(1500)]
    ids[1] = ids[0].copy()
    ids[1][:6] = np.setdiff1d(np.arange(400), ids[0][:-1])[:6]
    idf = rng.uniform(0.5, 2, 400).astype(np.float32)
    own = [dict(zip(*(x.tolist() for x in packing.bm25(i, idf, 121.0)), strict=True)) for i in ids]
    index = packing.ShardIndex(ids, idf, 121.0)
    assert len(index.row) == 400
    index.unused[0] = False
    assert next(index.neighbours(0)) == 1
    index.unused[1] = False
    index.dense[[t for t in own[1] if t in own[0]]] = 0
    score = {d: sum(own[d].get(t, 0) for t in own[1]) for d in range(2, 1500)}
    found = index.neighbours(1)
    got = [next(found) for _ in range(8)]
    assert np.allclose([score[d] for d in got], sorted(score.values(), reverse=True)[:8], rtol=1e-9)


def test_words_of_letters_equal_the_library(library):
    words = ["the", " the", " Über", "ÿ", " q" + "x" * 300, " naïve", "a", " Éenmentelle", "straße"]
    words += [f" {a}{b}onthe" for a in "abcdefgh" for b in "éñxyz"]
    flat, counts = letter_words_encoder(library)(words)
    assert [r.tolist() for r in split_rows(flat, counts)] == [library_ids(library, w) for w in words]
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    other = Tokenizer(library.model)
    other.pre_tokenizer = pre_tokenizers.Whitespace()
    assert letter_words_encoder(other) is None
    other.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    assert letter_words_encoder(other) is not None
    other.add_tokens(["letters"])
    assert letter_words_encoder(other) is None
    other = Tokenizer(library.model)
    other.pre_tokenizer, other.normalizer = pre_tokenizers.ByteLevel(add_prefix_space=False), normalizers.Lowercase()
    assert letter_words_encoder(other) is None


def test_texts_cut_between_letters_and_symbols_equal_whole_texts(library):
    texts = ["trash### it%%%, a$b&&c", "é*** #x #", "a|b <|endoftext|># x&'s", "R&D's 5%%%\nq$\n$"]
    assert parts_of(pa.array(texts[:1])).to_pylist() == [["trash", "###", " it", "%%%,", " a", "$b", "&&c"]]
    for encoder in (library_encoder(BYTE_VOCABULARY), pair_merges.codec(BYTE_VOCABULARY).memory):
        flat, counts = encoder.encode(pa.array(texts))
        assert [r.tolist() for r in split_rows(flat, counts)] == [library_ids(library, t) for t in texts]
