"""BPE by tree reduction and token counts by heap merging, against the public libraries."""

import os
import random
import sys

import public_tokenizers
import sentencepiece
import tiktoken

sys.path.insert(0, os.path.dirname(__file__))

from llm_frames import DOCS, empty, frame  # noqa: E402

from fabflow.llm import bpe_tree, piece_counts  # noqa: E402

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = [*"abcdefgh   etaoin'sTRE012 \n\t.,!é ß漢字🎉​\xa0\x1c\x85　▁", "the", "ing", "</s>", "<s>", "<|endoftext|>", "\x00", "<0x41>", "\r\n"]


def random_texts(n, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 80))) for _ in range(n)]


def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_tree.load_ranks(RANKS), special_tokens={})


def test_bpe_equals_library_on_random_texts():
    codec, enc = bpe_tree.ByteBpe(bpe_tree.load_ranks(RANKS), public_tokenizers.PATTERN, cache=500), library()
    for text in random_texts(3000):
        packed = codec.encode_text(text)
        assert memoryview(packed).cast("I").tolist() == enc.encode_ordinary(text), text
        assert codec.decode(packed) == text.encode()


def test_bpe_long_pieces():
    codec, enc = bpe_tree.ByteBpe(bpe_tree.load_ranks(RANKS), public_tokenizers.PATTERN), library()
    rng = random.Random(3)
    for text in ("a" * 3001, "ab" * 1777, "=-" * 900 + "=" * 501, " " * 2003, "漢" * 700, "".join(rng.choice("abcde") for _ in range(4000))):
        packed = codec.encode_text(text)
        assert memoryview(packed).cast("I").tolist() == enc.encode_ordinary(text)
        assert codec.decode(packed) == text.encode()


def test_bpe_any_split_joins_to_the_whole():
    codec = bpe_tree.ByteBpe(bpe_tree.load_ranks(RANKS), public_tokenizers.PATTERN)
    rng = random.Random(5)
    for _ in range(400):
        word = "".join(rng.choice("thesingtionrab") for _ in range(rng.randint(2, 40))).encode()
        at = rng.randint(1, len(word) - 1)
        assert codec.join(codec.merge(word[:at]), codec.merge(word[at:])) == codec.merge(word)


def test_bpe_rows(spark):
    import hashlib
    enc = library()
    rows = bpe_tree.digests(bpe_tree.encode_decode(frame(spark), RANKS, public_tokenizers.PATTERN)).collect()
    want = []
    for i, t in DOCS:
        ids = enc.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert bpe_tree.encode_decode(empty(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def test_piece_counts_equal_library_on_random_texts():
    counter = piece_counts.PieceCounter(piece_counts.load_pieces(MODEL), cache=500)
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in random_texts(3000, 11) + ["a" * 3000 + " " * 500, " lead", "trail ", "  "]:
        assert counter.count_text(text) == len(model.encode(text)), text


def test_piece_count_rows(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = piece_counts.count_tokens(frame(spark), MODEL, 4096).collect()
    want = [(i, len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 4096) for i, t in DOCS]
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert piece_counts.count_tokens(empty(spark), MODEL, 4096).count() == 0
