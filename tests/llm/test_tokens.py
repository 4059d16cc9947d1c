"""BPE codec and token counts against the public libraries."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sluice.llm.bpe_codec import WordBpe, _pair, cut_text, digest, encode_texts
from sluice.llm.token_counts import PieceVocabulary, token_counts

from llm_helpers import make_docs  # noqa: F401

WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a", "th", " ", "  ", "\n", "\t", "'s", "'ll", "é", "é", "́", "İ", "Σ", "ß", "ﬁ", "　", "\xa0",
       "\x85", "\x1c", " ", "▁", "<s>", "</s>", "<|endoftext|>", "<|", "1", "½", "中文", "하", "🙂",
       "​", "\x00", "!!", "$$$", "...", "<0x0A>", "a" * 45, "=" * 40, "qwertyuiop" * 7, "中" * 40]


def odd_texts(n=400):
    rng = random.Random(3)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    texts += ["".join(rng.choice("abcdehilnorstu") for _ in range(k)) for k in (100, 3000, 20000)]
    return texts + ["a" * 9000, "ab" * 9000, " " * 500, "=" * 9000, "word " * 9000, "", None]


@pytest.fixture(scope="module")
def lib():
    return Tokenizer.from_file(WORD)


def expected(lib, text):
    ids = lib.encode(text or "", add_special_tokens=False).ids
    decoded = lib.decode(ids, skip_special_tokens=False)
    return (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest())


@pytest.mark.parametrize("piece_chars", [64, 1 << 15])
def test_codec_equals_library(spark, make_docs, lib, piece_chars):
    texts = odd_texts()
    docs = make_docs(list(enumerate(texts)) + [(5, texts[5]), (None, "null id")])
    got = digest(encode_texts(docs, WORD, piece_chars=piece_chars)).collect()
    want = [(i, *expected(lib, t)) for i, t in enumerate(texts)] + [(5, *expected(lib, texts[5])), (None, *expected(lib, "null id"))]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_codec_of_no_rows(make_docs):
    assert encode_texts(make_docs([]), WORD).collect() == []


def test_pieces_rejoin_to_the_whole():
    bpe = WordBpe(WORD)
    for text in odd_texts(150)[:-1]:
        for size in (50, 997):
            parts = cut_text(text, size)
            assert "".join(p for p, _, _ in parts) == text
            assert bpe.join_pieces([bpe.encode_piece(*p) for p in parts]) == bpe.encode(text)


def test_long_runs_of_any_script_are_cut():
    bpe, rng = WordBpe(WORD), random.Random(5)
    runs = ["абвгдежзиклмнопрст", "αβγδεζηθικλμνξοπ", "あいうえおかきくけこさしすせそたち", "가나다라마바사아자차카타파하", "éèêëàâîïôûüçñãõåø",
            "กขคงจฉชซญฎฏฐฑฒณด", "ابتثجحخدذرزسشصضط", "אבגדהוזחטיכלמנסעפצ", "0123456789", "aB3dE5fG7h1J9kL2mN4"]
    for letters in runs:
        text = "".join(rng.choice(letters) for _ in range(3000)) + "! x" + "".join(rng.choice(letters) for _ in range(700))
        parts = cut_text(text, 100)
        assert len(parts) > 20 and max(len(p) for p, _, _ in parts) < 400, letters
        assert "".join(p for p, _, _ in parts) == text
        assert bpe.join_pieces([bpe.encode_piece(*p) for p in parts]) == bpe.encode(text)


def test_cut_runs_equal_the_library(spark, make_docs, lib):
    rng = random.Random(6)
    texts = ["".join(rng.choice("абвг가나다あいéèİı0123456789") for _ in range(k)) for k in (50, 300, 2000)]
    texts += ["가" * 40 + "\u11a8" + "が" * 30 + "\u3099", "İ" * 60, "1" * 90 + "a" * 90 + "1"]
    got = digest(encode_texts(make_docs(list(enumerate(texts))), WORD, piece_chars=64)).collect()
    assert sorted(map(tuple, got)) == [(i, *expected(lib, t)) for i, t in enumerate(texts)]


def test_tree_equals_direct_merging():
    bpe, rng = WordBpe(WORD), random.Random(4)
    for n in (30, 200, 1500):
        word = "".join(rng.choice("aehinorst") for _ in range(n))
        symbols = bpe._symbols(word)
        from sluice.llm.token_counts import heap_merge

        assert bpe.tree(list(symbols)) == heap_merge(symbols, bpe.joins, _pair)[0]


def test_counts_equal_library(spark, make_docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    texts = odd_texts()
    got = token_counts(make_docs(list(enumerate(texts)) + [(None, "null id"), (1, texts[1])]), PIECE).collect()
    want = [(i, len((t or "").encode()), len(sp.encode(t or ""))) for i, t in enumerate(texts)]
    want += [(None, 7, len(sp.encode("null id"))), (1, *want[1][1:])]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert token_counts(make_docs([]), PIECE).collect() == []


def test_counts_survive_forgetting():
    vocab = PieceVocabulary(PIECE)
    vocab.seen.most = 3
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    text = "one two three four five one two six seven eight nine one"
    assert vocab.count(text) == len(sp.encode(text))
