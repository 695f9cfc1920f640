"""The encoder's ids are the library's, whatever the characters and the tokenizer."""

import random
import sys
import unicodedata

import numpy as np
import pyarrow as pa
import pytest

from tripflow.llm import tokens


@pytest.fixture(scope="module", params=["word_bpe_49k.json", "byte_bpe_50k.json"])
def both(request):
    from tokenizers import Tokenizer
    path = tokens.tokenizer_path(request.param)
    return tokens.Encoder(path), Tokenizer.from_file(path)


def same(both, texts):
    ours, library = both
    want = [e.ids + [tokens.END_ID] for e in library.encode_batch(texts, add_special_tokens=False)]
    got = [np.frombuffer(b, ours.dtype).tolist() for b in ours.encode(texts)]
    bad = [(t, g, w) for t, g, w in zip(texts, got, want) if g != w]
    assert not bad, bad[:3]


def test_every_case_and_mark_character_beside_stops(both):
    """Characters whose case or normal form is another, marks, and all of Latin."""
    odd = [c for c in map(chr, range(sys.maxunicode + 1)) if not 0xD800 <= ord(c) < 0xE000 and (
        ord(c) < 0x250 or len(c.lower()) > 1 or unicodedata.normalize("NFC", c) != c or unicodedata.category(c) in ("Mn", "Lt", "Lm"))]
    same(both, [f"{c}! a{c}. {c}b, x{c}y; {c}{c}: {c}" for c in odd])


def test_random_mixtures(both):
    r = random.Random(5)
    alphabet = "aZé İıſßÀÉñ'.,!?;:-_09\t\n\r\x0b\x85\xa0😀中अ̈̇क़ǅ" + "ABCxyz" * 3 + "   "
    same(both, ["".join(r.choices(alphabet, k=r.randint(0, 60))) for _ in range(4000)])
    same(both, ["İ!", "it's I'LL don'T.", "<|endoftext|>. a", "", " ", "word " * 500])


def test_only_the_word_tokenizer_goes_by_chunks():
    assert [tokens._by_chunk(tokens.tokenizer_path(n)) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")] == [True, False]


def test_memo_that_is_emptied(both):
    path = tokens.tokenizer_path()
    from tokenizers import Tokenizer
    small = (tokens.Encoder(path, memo_chars=50), Tokenizer.from_file(path))
    for i in range(20):
        same(small, [f"some words{i} again, and Again {i}", "again word" + "s" * i])


def test_a_word_is_learnt_once_whatever_its_case_and_marks():
    ours = tokens.Encoder(tokens.tokenizer_path())
    ours.encode(["Häuser häuser, HÄUSER!! (häuser\nhäuser###", "häuser. häuser%%% İ!"])
    assert set(ours._memo) == {"häuser", "", ",", "!!", "(häuser", "###", ".", "%%%", "İ!"}


def test_memo_stays_within_its_bound():
    ours = tokens.Encoder(tokens.tokenizer_path(), memo_chars=20_000)
    held = []
    for i in range(40):
        ours.encode([" ".join(f"{a}{b}{c}{'xyzw'[i % 4]}{'k' * (i // 4)}" for a in "abcdefgh" for b in "abcdefgh" for c in "abcd")])
        held.append(sum(map(len, ours._memo)) + sum(map(len, ours._older)))
    assert max(held) <= 20_000 + 2 * 256 * 14


def test_gathered_batches_have_the_same_rows(monkeypatch):
    monkeypatch.setattr(tokens, "_BYTES", 1000)
    rows = [None if i % 7 == 0 else "x" * (i % 50) for i in range(500)]
    batches = [pa.RecordBatch.from_pydict({"n": range(i, i + 10), "text": pa.array(rows[i:i + 10], pa.string())}) for i in range(0, 500, 10)]
    found = list(tokens.gathered(iter(batches)))
    assert len(found) < 20
    assert [x for b in found for x in b.column(1).to_pylist()] == rows and [x for b in found for x in b.column(0).to_pylist()] == list(range(500))
    ours = tokens.Encoder(tokens.tokenizer_path())
    assert [x for b in found for x in ours.encode(b.column(1))] == ours.encode(rows)  # slices, too: texts beyond _BYTES at once
