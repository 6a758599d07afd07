"""Token files, packing and byte pairs against the plain libraries."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from featureframe.llm import byte_pairs, packing, token_files
from featureframe.llm.encoding import TextEncoder
from tests.llm.conftest import TEXTS

BYTES, WORDS = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "word_bpe_49k.json"))
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def plain_ids(path: str, names_are_text: bool = False):
    tokenizer = Tokenizer.from_file(path)
    if names_are_text:
        tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [BYTES, WORDS])
@pytest.mark.parametrize("names_are_text", [False, True])
def test_encoder_gives_the_librarys_ids(path, names_are_text):
    plain, encoder = plain_ids(path, names_are_text), TextEncoder(open(path, "rb").read(), 50, names_are_text)
    letters = [" ", "\n", "  ", "\t", "a", "b", " the", "'s", "'LL", "9", "12", "!", "é", "É", "ſ", "İ", "Σ", "ŉ", "×", "中"]
    letters += ["😀", "²", "́", "\xa0", " ", "\x1c", "\x85", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "Å", "re"]
    chance = random.Random(11)
    for few in (letters, letters[:13], ["<|endoftext|>", "<|startoftext|>", "a", " ", "\n", "  ", "<|"]):
        for _ in range(1500):
            text = "".join(chance.choice(few) for _ in range(chance.randint(0, 25)))
            assert np.frombuffer(encoder(text), encoder.dtype).tolist() == plain(text), text
    for _, text in TEXTS[:15]:
        assert np.frombuffer(encoder(text or ""), encoder.dtype).tolist() == plain(text)


def test_token_files_hold_all_ids_in_order(docs):
    plain = plain_ids(BYTES)
    manifest = token_files.write_token_files(docs, BYTES, end_id=2, length=64)
    rows = token_files.read_documents(manifest).orderBy("start").collect()
    order = sorted(TEXTS, key=lambda row: (row[0] is not None, row[0] or 0))
    assert [row.doc_id for row in rows] == [doc_id for doc_id, _ in order]
    assert Counter((row.doc_id, bytes(row.ids)) for row in rows) == Counter(
        (doc_id, np.array([*plain(text), 2], "<u4").tobytes()) for doc_id, text in TEXTS
    )
    start = 0
    for row in rows:
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(row.ids) // 4, zlib.crc32(row.ids))
        start += row.n_tokens


def test_sequences_have_equal_length_and_masks(docs):
    manifest = token_files.write_token_files(docs, BYTES, end_id=2, length=64)
    total = sum(len(plain_ids(BYTES)(text)) + 1 for _, text in TEXTS)
    rows = token_files.read_sequences(manifest).collect()
    assert all(len(row.ids) == len(row.mask) == 64 for row in rows)
    assert sum(sum(row.mask) for row in rows) == total
    assert all(id == 2 for row in rows for id, kept in zip(row.ids, row.mask, strict=True) if not kept)
    found = manifest.orderBy("shard").first()
    shard = token_files.TokenShard(found.ids_path)
    assert shard.sequence(1).base is not None  # a view, not a copy
    assert shard.sequence(1).tolist() == shard.span(64, 64).tolist()


def test_many_batches_in_a_shard(tmp_path):
    chance = np.random.default_rng(1)
    docs = [chance.integers(0, 50_000, size).astype("<u2") for size in chance.integers(1, 3000, 300)]
    with open(tmp_path / "x.arrow", "wb") as file:
        writer = token_files._SequenceWriter(file, np.dtype("<u2"), 7, 2)
        for one in docs:
            writer.add(one.tobytes())
        writer.close()
    shard, start = token_files.TokenShard(str(tmp_path / "x.arrow")), 0
    assert shard.batches > 3
    for one in docs:
        assert (shard.span(start, len(one)) == one).all()
        start += len(one)


def test_no_documents_no_shards(no_docs):
    manifest = token_files.write_token_files(no_docs, BYTES, end_id=2)
    assert manifest.count() == 0 and token_files.read_documents(manifest).count() == 0


def check_packed(rows, capacity):
    by_sequence = {}
    for row in rows:
        by_sequence.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for pieces in by_sequence.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= capacity
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return len(by_sequence)


def test_packing_places_every_id_once(docs):
    plain = plain_ids(WORDS)
    pieces, placed = packing.pack_documents(docs, WORDS, end_id=2, capacity=128)
    rows = placed.collect()
    check_packed(rows, 128)
    expected = Counter()
    for doc_id, text in TEXTS:
        ids = [*plain(text), 2]
        for start in range(0, len(ids), 128):
            part = ids[start : start + 128]
            expected[doc_id, start, len(part), len(ids), crc(part)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.doc_tokens, r.ids_crc32) for r in rows) == expected
    sequences = packing.packed_sequences(pieces, placed).collect()
    assert sum(row.length for row in sequences) == sum(row.length for row in rows)
    assert all(len(row.ids) == 2 * row.length for row in sequences)


def test_packing_ranks_equal_lengths(make_docs):
    """Copies, a third of all rows and more, share their lengths."""
    texts = [(n, "alpha beta gamma" if n % 2 else "word " * (n % 40)) for n in range(600)]
    _, placed = packing.pack_documents(make_docs(texts), WORDS, end_id=2, capacity=64)
    rows = placed.collect()
    assert len(rows) == 600
    used = check_packed(rows, 64)
    assert sum(row.length for row in rows) / (64 * used) > 0.97


def test_packing_nothing(no_docs):
    assert packing.pack_documents(no_docs, WORDS, end_id=2)[1].count() == 0


def test_histogram_patterns_use_every_piece():
    chance = random.Random(3)
    histogram = {length: chance.randint(1, 50) for length in chance.sample(range(1, 101), 60)}
    patterns = packing.pack_histogram(dict(histogram), 100)
    used = Counter()
    for pattern in patterns:
        assert sum(length * times for length, times in pattern.lengths) <= 100
        for length, times in pattern.lengths:
            used[length] += times * pattern.count
    assert used == Counter(histogram)
    assert len(patterns) <= 300


@pytest.fixture(scope="module")
def library():
    lines = open(RANKS, "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_pairs_and_back(docs, library):
    encoded = byte_pairs.encode(docs, RANKS, public_tokenizers.PATTERN)
    rows = byte_pairs.decode(encoded, RANKS, public_tokenizers.PATTERN).collect()
    expected = Counter(
        (doc_id, np.array(library.encode_ordinary(text or ""), "<u4").tobytes(), (text or "").encode()) for doc_id, text in TEXTS
    )
    assert Counter((row.doc_id, bytes(row.ids), bytes(row.decoded)) for row in rows) == expected


def test_long_runs_of_white_space(library, monkeypatch):
    monkeypatch.setattr(byte_pairs, "SECTION", 40)
    encoder = byte_pairs.RankEncoder(open(RANKS, "rb").read(), public_tokenizers.PATTERN)
    for text in ("x" + " " * 20_000 + "y z", "a " * 100 + "\n" * 15_000, "b" * 200 + " c\n\n d" * 50, " " * 12_000):
        assert encoder.encode(text) == library.encode_ordinary(text)
        assert hashlib.sha256(encoder.decode(encoder.encode(text))).digest() == hashlib.sha256(text.encode()).digest()


def test_no_byte_pairs(no_docs):
    assert byte_pairs.encode(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0
