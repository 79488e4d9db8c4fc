import hashlib
import random
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from msgflow.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as f:
        return bpe.PrefixEncoder(f.read())


def ids(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def expected(library, text):
    own = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(own, skip_special_tokens=False)
    packed = struct.pack(f"<{len(own)}I", *own)
    return len(own), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def found(df):
    return sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_report(df, PATH).collect())


def test_documents_of_the_tables(small, small_rows, library):
    assert found(small) == sorted((i, *expected(library, t)) for i, t in small_rows)


KINDS = [
    ["a", "b", "aa", "ab", " "],
    [" ", "\n", "\t", "  ", "a", "'s", "'", "1", "　", "\x85", "é"],
    ["<|endoftext|>", "<|end", "x ", " y", "<|endoftext|><|endoftext|>"],
    ["th", "er", "tion", "ß", "中文", "\U0001f600", "՘", "\U00016ea0", "꟝"],
]


@pytest.mark.parametrize("kind", range(len(KINDS) + 1))
def test_random_texts(encoder, library, kind):
    r = random.Random(kind)
    for _ in range(400):
        n = r.randrange(1, 60)
        if kind < len(KINDS):
            text = "".join(r.choice(KINDS[kind]) for _ in range(n))
        else:
            text = "".join(chr(c) for c in (r.randrange(0x110000) for _ in range(n)) if not 0xD800 <= c <= 0xDFFF)
        own = ids(encoder.encode(text))
        assert own == library.encode(text, add_special_tokens=False).ids
        assert encoder.decode(own) == library.decode(own, skip_special_tokens=False) == text


def test_one_last_token_per_prefix(encoder, library):
    pieces = ["internationalisation", "a", " of", "aabaabbabaaaabab", "ß"]
    last, starts = encoder.last_tokens([p.encode() for p in pieces])
    for piece, start in zip(pieces, starts.tolist()):
        for end in range(len(piece)):
            if piece.isascii():
                assert last[start + end] == library.encode(piece[: end + 1]).ids[-1]


def test_only_one_token_fits_each_prefix(encoder):
    piece = b"aabaabbabaaaabab"
    last, _ = encoder.last_tokens([piece])
    for end in range(len(piece)):
        suffixes = [encoder.bytes.index(piece[k : end + 1]) for k in range(end + 1) if piece[k : end + 1] in encoder.bytes]
        fit = [t for t in suffixes if len(encoder.bytes[t]) > end or encoder.apart(last[end - len(encoder.bytes[t])], t)]
        assert fit == [last[end]]


def test_remembered_pieces_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    monkeypatch.setattr(bpe, "TOGETHER", 40)
    monkeypatch.setattr(bpe, "PAIR_BITS", 3)
    with open(PATH, encoding="utf-8") as f:
        small = bpe.PrefixEncoder(f.read())
    r = random.Random(7)
    texts = ["".join(r.choice(["inter", "nation", "al ", "ly", " ", "<|endoftext|>", "ß"]) for _ in range(9)) for _ in range(200)]
    for text, own in zip(texts, small.encode_all(texts)):
        assert ids(own) == library.encode(text, add_special_tokens=False).ids
    assert len(small.pieces) < 60 and small.older


def test_every_token_is_the_encoding_of_its_text(encoder, library):
    for token in range(0, 50256, 37):
        text = encoder.bytes[token].decode("utf-8", "replace")
        if text.encode() == encoder.bytes[token] and len(library.pre_tokenizer.pre_tokenize_str(text)) == 1:
            assert ids(encoder.encode(text)) == [token]


def test_nulls_repeats_and_long_texts(make, library):
    long = "ab" * 300_000 + " words" * 50_000
    rows = [(1, None), (2, ""), (3, "  "), (3, "  "), (None, "no id"), (5, long)]
    got = bpe.encode_report(make(rows, ids="a", decoded="b", n_tokens="c"), PATH).collect()
    key = lambda x: (x[0] is None, x[0], x[1:])
    assert sorted(map(tuple, got), key=key) == sorted(((i, *expected(library, t)) for i, t in rows), key=key)


def test_ids_and_decoded_texts(make, library):
    rows = [(1, "Some words <|endoftext|> and more"), (2, None)]
    both = {r.doc_id: r for r in bpe.decode(bpe.encode(make(rows), PATH), PATH).collect()}
    assert both[1].ids == library.encode(rows[0][1], add_special_tokens=False).ids
    assert both[1].decoded == rows[0][1] and (both[2].ids, both[2].decoded) == ([], "")


def test_no_rows(make):
    assert bpe.encode_report(make([]), PATH).collect() == []


def test_other_kinds_of_vocabulary_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        bpe.PrefixEncoder(f.read())
