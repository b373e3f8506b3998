"""Byte BPE, packing and id files against the libraries and exact round trips."""

import base64
import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from audix.llm import byte_bpe, id_files, mixing_coder, packing

vocabularies = pytest.importorskip("public_tokenizers")
WORDS = vocabularies.path("word_bpe_49k.json")
BYTES = vocabularies.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def word_ids():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(WORDS)
    return lambda text: np.array(t.encode(text or "", add_special_tokens=False).ids + [2], np.uint32)


@pytest.fixture(scope="module")
def library():
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTES, "rb"))}
    return tiktoken.Encoding("own", pat_str=vocabularies.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(3)
    space = ["\x1c", "\x1f", "\x85", "\xa0", " ", " ", "  ", " ", "　", "​", "\t", "\n", "\r", "\x0b", "᠎"]
    alphabet = space + list("aaabtheTHE's're'll0123½²٣!?-_=é ñßÉ×÷…‼中文字🙂ａİK")
    alphabet += ["a\u0301", "\u0338", "\u0301", "<|endoftext|>", "\x01"]
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    out += ["a" * n for n in range(0, 300, 7)] + ["ab" * n for n in range(0, 90, 5)]
    out += ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(50, 1500))) for _ in range(60)]
    return out + ["the" * 5000, "x" * 30000, "中文" * 2000, " " * 3000 + "a", "\n" * 2000]


def flat(texts):
    b = [t.encode() for t in texts]
    return np.frombuffer(b"".join(b), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in b]))).astype(np.int64)


def test_byte_ids_equal_the_library(library):
    texts = odd_texts()
    encoder = byte_bpe.text_encoder(BYTES, vocabularies.PATTERN)
    ids, sizes = encoder.encode(*flat(texts))
    for t, part in zip(texts, np.split(ids, np.cumsum(sizes)[:-1])):
        assert part.tolist() == library.encode_ordinary(t)
        assert encoder.bpe.decode(part).tobytes() == t.encode()


def test_halves_join_to_the_plain_encoding():
    bpe = byte_bpe.text_encoder(BYTES, vocabularies.PATTERN).bpe
    rng = random.Random(4)
    for _ in range(300):
        piece = bytes(rng.choice(b"abther n") for _ in range(rng.randint(1, 200)))
        cut = rng.randint(0, len(piece))
        assert bpe.join(bpe.merge(piece[:cut]), bpe.merge(piece[cut:])) == bpe.merge(piece) == bpe._merge_long(piece)
        assert bpe.leaf(piece[:40]) == bpe.merge(piece[:40]) or piece[:40] in bpe.ranks


def test_encode_texts(docs, library):
    got = byte_bpe.encode_texts(docs, BYTES, vocabularies.PATTERN, keep_ids=True).collect()
    expected = collections.Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = np.array(library.encode_ordinary(r.text or ""), "<u4")
        expected[r.doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                 hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == expected
    assert all(hashlib.sha256(r.decoded).hexdigest() == r.decoded_sha256 for r in got)


@pytest.mark.parametrize("special", [False, True])
def test_word_ids_equal_the_library(word_ids, special):
    from audix.llm.token_ids import with_end, word_encoder
    texts = [t for t in odd_texts() if ("<|" in t) == special]
    assert len(texts) > 100
    ids, sizes = with_end(*word_encoder(WORDS).encode(*flat(texts)), 2)
    for t, part in zip(texts, np.split(ids, np.cumsum(sizes)[:-1])):
        assert part.tolist() == word_ids(t).tolist(), t


def test_packing(docs, word_ids):
    rows = packing.pack(docs, WORDS, keep_ids=True, fan_in=2).collect()
    texts = collections.defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        texts[r.doc_id].append(word_ids(r.text))
    pieces = collections.Counter()
    for r in rows:
        ids = np.array(r.ids, np.uint32)
        assert len(ids) == r.length and zlib.crc32(ids.tobytes()) == r.ids_crc32
        assert any(len(t) == r.doc_tokens and (t[r.start:r.start + r.length] == ids).all() for t in texts[r.doc_id])
        pieces[r.doc_id] += r.length
    assert pieces == {d: sum(map(len, t)) for d, t in texts.items()}
    padding = 0
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    assert padding < 0.01 * sum(pieces.values())


@pytest.mark.parametrize("length", [0, 1, 255, 256, 257, 4095, 4096, 4097, 50000])
def test_cut_classes(length):
    pieces = packing.cut(length)
    assert sum(size for _, size in pieces) == length
    assert all(size == 4096 // j for j, size in pieces if j) and all(size < 256 for j, size in pieces if not j)


def test_id_files(docs, word_ids, monkeypatch):
    monkeypatch.setattr(id_files, "FILE_BYTES", 20_000)
    monkeypatch.setattr(id_files, "GROUP_IDS", 3000)
    got = id_files.read_ids(id_files.write_ids(docs, WORDS), keep_ids=True).collect()
    texts = docs.select("doc_id", "text").collect()
    assert len(got) == len(texts)
    at, before = 0, None
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and len(r.ids) == r.n_tokens
        assert before is None or r.doc_id >= before
        at, before = at + r.n_tokens, r.doc_id
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in got) == \
        collections.Counter((r.doc_id, tuple(word_ids(r.text).tolist())) for r in texts)


def test_blocks_round_trip_alone():
    rng = np.random.default_rng(0)
    blocks = [rng.integers(0, 65536, n).astype(np.uint32) for n in (0, 1, 5, 700, 1024)]
    blocks += [np.repeat(np.uint32(7), 1024), (rng.zipf(1.3, 1024) % 49408).astype(np.uint32)]
    header = mixing_coder.scaled_counts(np.concatenate(blocks))
    assert header[1].sum() == 1 << 20 and (header[1] > 0).all()
    coded = mixing_coder.encode_blocks(blocks, header)
    for part in mixing_coder.decode_blocks(coded, [len(b) for b in blocks], header), \
            [mixing_coder.decode_blocks([c], [len(b)], header)[0] for c, b in zip(coded, blocks)]:
        assert all((a == b).all() and len(a) == len(b) for a, b in zip(part, blocks))
    assert len(coded[5]) < 200          # one repeated id costs next to nothing


def test_damaged_block_fails():
    ids = np.arange(500, dtype=np.uint32) % 90
    header = mixing_coder.scaled_counts(ids)
    payload = bytearray(mixing_coder.encode_blocks([ids], header)[0])
    payload[len(payload) // 2] ^= 0x55
    row = {"file": 0, "part": 0, "sizes": [500], "ids": header[0].tolist(), "counts": header[1].tolist(),
           "blocks": [{"n": 500, "crc": mixing_coder.checksum(ids), "payload": bytes(payload)}]}
    with pytest.raises(ValueError, match="damaged"):
        id_files.decode_group(row)


def test_empty_tables(nothing):
    assert byte_bpe.encode_texts(nothing, BYTES, vocabularies.PATTERN).collect() == []
    assert packing.pack(nothing, WORDS).collect() == []
    assert id_files.read_ids(id_files.write_ids(nothing, WORDS)).collect() == []


def test_blocks_round_trip_many():
    rng = np.random.default_rng(7)
    for n_ids in (1, 2, 50, 40000):
        blocks = [rng.integers(0, n_ids, rng.integers(0, 1025)).astype(np.uint32) * 3 for _ in range(60)]
        blocks += [np.tile(rng.integers(0, n_ids, 5), 200).astype(np.uint32) * 3 for _ in range(5)]
        header = mixing_coder.scaled_counts(np.concatenate(blocks))
        coded = mixing_coder.encode_blocks(blocks, header)
        back = mixing_coder.decode_blocks(coded, [len(b) for b in blocks], header)
        assert all(len(a) == len(b) and (a == b).all() for a, b in zip(back, blocks))


def test_rare_ids_after_repeated_lines():
    """Ids of count 1 in the header keep a range when all orders are confident."""
    rng = np.random.default_rng(3)
    blocks = []
    for k in range(300):
        line = rng.integers(0, 40, rng.integers(1, 12))
        block = np.tile(line, 1024 // len(line) + 1)[:1024].astype(np.uint32)
        block[rng.integers(100, 1024, 6)] = 1000 + 6 * k + np.arange(6)
        blocks.append(block)
    common = np.repeat(np.arange(40, dtype=np.uint32), 100_000)
    header = mixing_coder.scaled_counts(np.concatenate([common, *blocks]))
    assert (header[1][header[0] >= 1000] == 1).all()
    coded = mixing_coder.encode_blocks(blocks, header)
    back = mixing_coder.decode_blocks(coded, [len(b) for b in blocks], header)
    assert all((a == b).all() for a, b in zip(back, blocks))


def test_pieces_beyond_the_vocabulary_are_joined(library, monkeypatch):
    """Every piece that is no token is halved and joined, whatever its length, and the
    windows at the borders grow where they must."""
    joins, windows = [], []
    join, merge = byte_bpe.MonoidBpe.join, byte_bpe.MonoidBpe.merge

    def counted(self, left, right):
        joins.append(len(left) + len(right))
        before = len(windows)
        out = join(self, left, right)
        joins[-1] = (joins[-1], len(windows) - before)
        return out
    monkeypatch.setattr(byte_bpe.MonoidBpe, "join", counted)
    monkeypatch.setattr(byte_bpe.MonoidBpe, "merge", lambda self, piece: windows.append(piece) or merge(self, piece))
    encoder = byte_bpe.TextEncoder(BYTES, vocabularies.PATTERN)
    rng = random.Random(12)
    words = {"".join(rng.choice(["the", "on", "er", "zq", "x", "tion", "é", "ing"]) for _ in range(rng.randint(2, 40))) for _ in range(400)}
    beyond = 0
    for word in words:
        got, before = [], len(joins)
        for piece in encoder.split(word):
            held = len(joins)
            got += encoder.bpe.tokens(piece.encode())
            assert (len(joins) > held) == (piece.encode() not in encoder.bpe.ranks)
        beyond += len(joins) > before
        assert [encoder.bpe.ranks[t] for t in got] == library.encode_ordinary(word)
    assert beyond > 300 and any(n > 2 for _, n in joins)


def test_words_of_letters_need_the_model_alone(word_ids, monkeypatch):
    """Only cuts with other signs than ASCII and Latin-1 letters go through the whole tokenizer."""
    from audix.llm.token_ids import WordEncoder
    whole = []

    class Tokenizer:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def encode_batch_fast(self, words, **options):
            whole.extend(words)
            return self.tokenizer.encode_batch_fast(words, **options)

    rng = random.Random(8)
    plain = [" ".join("".join(rng.choice("etaoinshrdluéèßÿÀþ") for _ in range(rng.randint(1, 20)))
                      for _ in range(50)) for _ in range(40)]
    plain.append(" ".join(chr(c) + "nt" + chr(c) for c in range(0xC0, 0x100)))
    texts = plain + ["It's THE 3rd café, don't!", "s t re", "ā a×b", "áb ab"]
    encoder = WordEncoder(WORDS)
    monkeypatch.setattr(encoder, "tokenizer", Tokenizer(encoder.tokenizer))
    for some in (texts, ["<| ABC É", "", "Éa <|endoftext|>b"]):
        ids, sizes = encoder.encode(*flat(some))
        for t, part in zip(some, np.split(ids, np.cumsum(sizes)[:-1])):
            assert part.tolist() == word_ids(t)[:-1].tolist()
    assert "'s" in whole and "ā" in whole and not [w for w in whole if w.isalpha() and max(w) <= "ÿ"]


def test_damage_anywhere_is_found():
    """A damaged word may lead a lane out of its ranges and its payload; it ends and its checksum tells."""
    rng = np.random.default_rng(5)
    blocks = [(rng.zipf(1.4, 300) % 900).astype(np.uint32) for _ in range(8)]
    header = mixing_coder.scaled_counts(np.concatenate(blocks))
    coded = mixing_coder.encode_blocks(blocks, header)
    for at in range(0, 300, 7):
        bad = []
        for p in coded[:4]:
            k = at % (len(p) - 8)       # not in the last words, of which a part may be unused
            bad.append(p[:k] + bytes([p[k] ^ 0xFF]) + p[k + 1:])
        cut = coded[4][:at % (len(coded[4]) - 8)]
        found = mixing_coder.decode_blocks([*bad, cut, b"", *coded[6:]], [300] * 8, header)
        assert [bool((a == b).all()) for a, b in zip(found, blocks)] == [False] * 6 + [True] * 2
