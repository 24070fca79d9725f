"""Codecs, packing, wavelet files and counts against the libraries and plain loops."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tickloom.llm import bpe, packing, token_counts, tokens, wavelet
from tickloom.llm.queries import registry
from tickloom.session import scratch_path

ODD = [
    "", " ", "  ", "a  b", " a", "a ", "\na\n b\t c \n\n d", "x\x1cy z", "É́ İstanbul ΣΑΣ", "<|endoftext|>a <|startoftext|> b",
    "don't 'll 're '' 'x we'll 'l 'lx 'v 're's '''s", "tab\t\tq w e", "日本語 テキスト 😀😀", "123 4567 12a",
    "a, b. c.\nD", "a), b", "a,, b", "a_, b", "a.\n\nb", "a. \n b", "\tfoo bar", "foo\t bar", "\n", "a\n", "\na", "a. ",
    "DENİZLİ, Türkiye", "İ, ", "İ.\n", "\u0958, a", "\u0958. b", "e\u0301, f", "ﬁ, ﬂ. ", ", ", ". a", "x\xa0 y", "a.\r\nb", "  'll x", "a'", "'rex", "a" * 900, "=" * 300 + "'s", " " * 200 + "x",
]


def noise(count):
    generator = random.Random(7)
    letters = list("aab st'relvdm  \n\t.-!,1290éñ=日\xa0")
    return ["".join(generator.choices(letters, k=generator.randint(0, 60))) for _ in range(count)]


@pytest.fixture(scope="module")
def texts(given):
    return [text for _, text in given[:60]] + ODD + noise(1500)


def library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


@pytest.mark.parametrize("name", [tokens.BYTE_BPE, tokens.WORD_BPE])
def test_pieces_give_the_ids_of_whole_texts(texts, name):
    encode, plain = tokens.encoder(name).encode, library(name)
    found = [ids for i in range(0, len(texts), 100) for ids in encode(texts[i : i + 100])]
    for text, ids in zip(texts, found, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text[:80]


@pytest.mark.parametrize("name", [tokens.BYTE_BPE, tokens.WORD_BPE])
def test_pieces_of_all_letters_marks_and_controls(name):
    generator = random.Random(3)
    low, high = [chr(c) for c in range(0x600)], [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    marks = [", ", ". ", ".\n", " ", "a", "B", "1"]
    texts = []
    for _ in range(20_000):
        letters = generator.choices(low, k=3) + generator.choices(high, k=3) + generator.choices(marks, k=6)
        texts.append("".join(generator.sample(letters, generator.randint(2, 12))))
    for char in ("İ", "\u0958", "\u0345", "\u0e33", "ß", "\x1f", "\x85", "\u2028"):
        texts += [f"{char}{mark}x" for mark in marks]
    found = tokens.encoder(name).encode(texts)
    plain = library(name).encode_batch(texts, add_special_tokens=False)
    wrong = [t for t, ids, e in zip(texts, found, plain) if np.frombuffer(ids, "<u4").tolist() != e.ids]
    assert not wrong


def test_memory_of_pieces_is_bounded(monkeypatch):
    encoder = tokens.LibraryEncoder(public_tokenizers.path(tokens.BYTE_BPE), by_words=False)
    monkeypatch.setattr(encoder, "PIECES", 50, raising=False)
    for i in range(20):
        text = " ".join(f"piece{i}number{j}" for j in range(30))
        assert encoder.encode([text]) == [encoder.whole(text)]
    assert len(encoder._known) < 200


def test_bpe_equals_tiktoken_and_decodes(texts):
    path = public_tokenizers.path(bpe.RANKS)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = bpe.byte_pair_encoder(path, public_tokenizers.PATTERN)
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode_ordinary(text), text[:80]
        assert codec.decode(ids) == text.encode()


def test_rank_queue_gives_lowest_rank_and_leftmost_position():
    queue, generator = bpe.RankQueue(5000), random.Random(3)
    entries = [(generator.randrange(5000), generator.randrange(100)) for _ in range(3000)]
    for entry in entries:
        queue.push(*entry)
    assert [queue.pop() for _ in entries] == sorted(entries)
    assert not queue


def test_rank_queue_started_at_once_equals_pushes():
    generator = random.Random(4)
    for size in (0, 1, 7, 400):
        pair = [generator.choice([None, generator.randrange(5000), 17, 255, 256]) for _ in range(size)]
        started, pushed = bpe.RankQueue(5000), bpe.RankQueue(5000)
        started.start(pair)
        for position, rank in enumerate(pair):
            if rank is not None:
                pushed.push(rank, position)
        count = sum(rank is not None for rank in pair)
        assert [started.pop() for _ in range(count)] == [pushed.pop() for _ in range(count)]
        assert not started and not pushed


def test_merges_of_random_vocabularies_equal_plain_merging(tmp_path):
    generator = random.Random(5)
    for trial in range(30):
        tokens_of = [bytes([c]) for c in b"abc"]
        while len(tokens_of) < 300:
            token = generator.choice(tokens_of) + generator.choice(tokens_of)
            if token not in tokens_of:
                tokens_of.append(token)
        later = tokens_of[3:]
        generator.shuffle(later)
        ranks = {token: rank for rank, token in enumerate(tokens_of[:3] + later)}
        path = tmp_path / f"{trial}.ranks"
        path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items()))
        codec = bpe.BytePairEncoder(str(path), r"\S+")
        for size in (1, 2, 5, 60, 300):
            data = bytes(generator.choices(b"abc", k=size))
            parts = [data] if data in ranks else [data[i : i + 1] for i in range(size)]
            while True:
                found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
                if not found:
                    break
                _, i = min(found)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            assert codec.merge(data) == [ranks[part] for part in parts]


def test_very_long_piece():
    codec = bpe.byte_pair_encoder(public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN)
    text = "abcdefghij" * 20_000
    assert codec.decode(codec.encode([text])[0]) == text.encode()


def test_counts_equal_the_library(texts):
    machine, plain = token_counts.transducer(public_tokenizers.path(tokens.BYTE_BPE)), library(tokens.BYTE_BPE)
    for text in texts:
        assert machine.count(text) == len(plain.encode(text, add_special_tokens=False).ids), text[:80]


def test_maps_of_chunks_compose_by_scan():
    machine = token_counts.transducer(public_tokenizers.path(tokens.BYTE_BPE))
    text = "it's   a'lx \n\n foo'll bar  "
    for size in (1, 2, 3, 7):
        maps = [lambda at, c=text[i : i + size]: machine.run(at, c) for i in range(0, len(text), size)]
        at, found = token_counts.scan(maps, token_counts.compose)[-1](machine.START)
        assert found + machine._end(at) == machine.count(text)
    assert token_counts.scan([1, 2, 3, 4, 5], lambda a, b: a + b) == [1, 3, 6, 10, 15]


def test_op1_packs_every_token_once(spark, sf_dir, given):
    rows = registry()["op1_packing"](spark, sf_dir).collect()
    plain = library(tokens.WORD_BPE)
    pieces = {}
    for row in rows:
        pieces.setdefault(row.doc_id, []).append(row)
        assert row.offset == 0 and row.length == 1 << row.bucket <= packing.MAX_LENGTH
    assert sorted(row.sequence_id for row in rows) == list(range(len(rows)))
    by_sequence = sorted(rows, key=lambda r: r.sequence_id)
    assert all(a.length >= b.length for a, b in zip(by_sequence, by_sequence[1:]))
    for doc_id, text in given:
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for row in sorted(pieces[doc_id], key=lambda r: r.start):
            assert (row.start, row.doc_tokens) == (at, len(ids))
            assert row.ids_crc32 == zlib.crc32(ids[at : at + row.length].tobytes())
            at += row.length
        assert at == len(ids)


def test_piece_lengths():
    assert packing.piece_lengths(0, 8) == []
    assert packing.piece_lengths(21, 8) == [8, 8, 4, 1]
    with pytest.raises(ValueError):
        packing.decompose(None, max_length=1000)


def test_pieces_with_ids(docs_of):
    rows = packing.pack(docs_of([(1, words_text())]), max_length=4, with_ids=True).orderBy("start").collect()
    ids = [i for row in rows for i in row.ids]
    assert ids == [*library(tokens.WORD_BPE).encode(words_text(), add_special_tokens=False).ids, 1]


def words_text():
    return "seven words make more than seven tokens"


def test_op5_and_op10_rows(spark, sf_dir, given):
    encoded = {row.doc_id: row for row in registry()["op5_byte_bpe"](spark, sf_dir).collect()}
    counted = {row.doc_id: row for row in registry()["op10_token_counts"](spark, sf_dir).collect()}
    path = public_tokenizers.path(bpe.RANKS)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    counter = library(tokens.BYTE_BPE)
    assert len(encoded) == len(counted) == len(given)
    for doc_id, text in given:
        ids = np.array(plain.encode_ordinary(text), "<u4")
        row = encoded[doc_id]
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        n = len(counter.encode(text, add_special_tokens=False).ids)
        assert tuple(counted[doc_id]) == (doc_id, len(text.encode()), n, n > 1024)


def test_op9_reads_back_what_it_wrote(spark, sf_dir, given):
    rows = sorted(registry()["op9_wavelet_tokens"](spark, sf_dir).collect(), key=lambda r: r.doc_id)
    plain, at = library(tokens.BYTE_BPE), 0
    assert [row.doc_id for row in rows] == [doc_id for doc_id, _ in given]
    for row, (_, text) in zip(rows, given):
        ids = np.array([*plain.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert (row.start, row.n_tokens, row.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_wavelet_queries():
    generator = np.random.default_rng(5)
    ids = generator.zipf(1.3, 5000).clip(0, 50_256).astype(np.uint32)
    matrix = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(ids, [(1, 5000)]).to_bytes())
    assert (matrix.tokens() == ids).all() and len(matrix) == 5000 and matrix.docs == [(1, 5000)]
    assert [matrix.access(i) for i in range(0, 5000, 97)] == ids[::97].tolist()
    for value in (1, 2, 77, 50_256, 60_000, 1 << 20):
        places = np.flatnonzero(ids == value).tolist()
        assert matrix.count(value) == len(places)
        assert matrix.rank(value, 1234) == sum(p < 1234 for p in places)
        assert matrix.occurrences(value)[:50] == places[:50]
    with pytest.raises(IndexError):
        matrix.access(5000)
    with pytest.raises(IndexError):
        matrix.select(1, 5000)
    empty = wavelet.WaveletMatrix.build(np.empty(0, np.uint32), [])
    assert len(empty) == 0 and empty.count(3) == 0 and len(empty.tokens()) == 0


def test_small_blocks_continue_the_count(spark, docs_of):
    path = scratch_path(spark, "blocks")
    wavelet.write_tokens(docs_of([(i, f"text number {i} " * i) for i in range(30)]), path, block_tokens=50)
    rows = wavelet.read_tokens(spark, path).orderBy("doc_id").collect()
    sizes = [row.n_tokens for row in rows]
    assert [row.start for row in rows] == [sum(sizes[:i]) for i in range(30)]
    assert wavelet.read_matrices(spark, path).count() > 5


def test_odd_rows(spark, odd, odd_rows, no_rows):
    n = len(odd_rows)
    assert bpe.encode(odd).count() == n and bpe.encode(no_rows).count() == 0
    assert token_counts.count_tokens(odd).where("doc_id = 9").first().n_tokens == 1
    assert token_counts.count_tokens(odd).count() == n and token_counts.count_tokens(no_rows).count() == 0
    packed = packing.pack(odd)
    assert packed.where("doc_id = 2").count() == 1
    assert packed.agg({"sequence_id": "max"}).first()[0] == packed.count() - 1
    assert packing.pack(no_rows).count() == 0
    for frame, rows in ((odd, n), (no_rows, 0)):
        path = scratch_path(spark, "odd")
        wavelet.write_tokens(frame, path)
        found = wavelet.read_tokens(spark, path).collect()
        assert len(found) == rows
        at = 0
        for row in sorted(found, key=lambda r: r.start):
            assert row.start == at
            at += row.n_tokens
