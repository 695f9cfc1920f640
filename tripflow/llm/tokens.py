"""Token ids of whole texts, by the ``tokenizers`` library.

Where a tokenizer's file says that it lower-cases, drops white space and marks the
ends of words (``_by_chunk``), a text's ids are the ids of its space-separated chunks, one
after the other. Chunks repeat far more often than texts: some megabytes of text are cut and
their different chunks found by Arrow at once. Each worker keeps the ids of the chunks it has
met, in a memo of two halves (when one is full, the older one goes), and learns new words many at
a time. Of any other tokenizer whole texts are encoded, one by one.
"""

from __future__ import annotations

import json
import os
import string
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Letters of Latin whose lower case is one letter too (not of a capital I with a dot, which
#: becomes a letter and a mark, and that would join the marks behind).
_LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and len(c.lower()) == 1)
_WORD = f"^[{_LETTERS}]+$"
_JOINED = 64
_BYTES = 1 << 22  # of text that are encoded at once


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _by_chunk(path: str) -> bool:
    """Whether nothing is joined across a space, case is dropped, a run of letters is one
    word, a stop after it none of its letters, and ids tell where words end."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    splits = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    first = splits[0] if splits else {}
    pattern = (first.get("pattern") or {}).get("Regex", "")
    by_words = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and \
        r"|[\p{L}]+|" in pattern and pattern.endswith(r"[^\s\p{L}\p{N}]+") and \
        [(x.get("type"), x.get("add_prefix_space"), x.get("use_regex")) for x in splits[1:]] == [("ByteLevel", False, False)]
    return bool(steps == ["NFC", "Replace", "Lowercase"] and by_words and spec["model"].get("end_of_word_suffix") == "</w>")


class Encoder:
    """Texts to arrays of ids, the end id last. Null is the empty text."""

    def __init__(self, path: str, end_id: int = END_ID, memo_chars: int = 4_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        size = self._tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")  # the narrowest that holds every id
        self._end = np.array([end_id], self.dtype).tobytes()
        self._chunks = _by_chunk(path)
        if self._chunks:
            self._ends = np.zeros(size, bool)
            self._ends[[i for token, i in self._tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
            # The same model for lower-case letters and spaces alone, which the other steps leave as they are.
            self._letters = Tokenizer(self._tokenizer.model)
            self._letters.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self._memo: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._chars, self._most = 0, memo_chars // 2

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Each text's ids as little-endian unsigned integers of ``dtype``."""
        if not self._chunks:
            texts = texts if isinstance(texts, list) else texts.to_pylist()
            return [np.array(e.ids, self.dtype).tobytes() + self._end
                    for e in self._tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
        texts = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts, "")
        before = np.concatenate(([0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)))
        out, at = [], 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(before, before[at] + _BYTES, "right")) - 1)
            out += self._encode(texts.slice(at, end - at))
            at = end
        return out

    def _encode(self, texts: pa.Array) -> list[bytes]:
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        chunks = split.flatten().dictionary_encode()
        stems, tails = (x.dictionary_encode() for x in _parts(chunks.dictionary))
        known = [self._ids(x.dictionary).take(x.indices) for x in (stems, tails)]
        ids = pc.binary_join_element_wise(*known, pa.scalar(b"", pa.large_binary())).take(chunks.indices)
        _, offsets, raw = ids.buffers()  # one after the other
        number = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        cuts = np.frombuffer(offsets, np.int64)[np.concatenate(([0], np.cumsum(number, dtype=np.int64)))].tolist()
        raw = memoryview(raw or b"")
        if self._chars > self._most:
            self._memo, self._older, self._chars = {}, self._memo, 0
        return [b"".join((raw[a:b], self._end)) for a, b in zip(cuts[:-1], cuts[1:])]

    def _ids(self, parts: pa.Array) -> pa.Array:
        """Each part's ids, by the memo; what it lacks is put into it."""
        memo, names = self._memo, parts.to_pylist()
        found = list(map(memo.get, names))
        lacking = [i for i, ids in enumerate(found) if ids is None]
        if lacking:
            older, words, others = self._older, [], []
            plain = pc.match_substring_regex(parts.take(pa.array(lacking)), _WORD).to_pylist()
            for i, is_word in zip(lacking, plain):
                name = names[i]
                ids = older.get(name)
                if ids is not None:
                    memo[name] = ids
                elif is_word:
                    words.append(name)
                else:
                    others.append(name)
            for at in range(0, len(words), 64 * _JOINED):
                self._learn_words(words[at:at + 64 * _JOINED])
            self._learn_each(others)
            for i in lacking:
                name = names[i]
                found[i] = memo[name]
                self._chars += len(name)
        return pa.array(found, pa.large_binary())

    def _learn_words(self, words: list[str]) -> None:
        """Words of lower-case letters, joined by spaces: each ends with the one id that ends a word."""
        joined = [" ".join(words[i:i + _JOINED]) for i in range(0, len(words), _JOINED)]
        found = self._letters.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable([e.ids for e in found]), self.dtype)
        ends = (np.flatnonzero(self._ends[ids]) + 1) * self.dtype.itemsize
        if len(ends) != len(words):
            self._learn_each(words)
            return
        raw, start = ids.tobytes(), 0
        for word, end in zip(words, ends.tolist()):
            self._memo[word] = raw[start:end]
            start = end

    def _learn_each(self, parts: list[str]) -> None:
        for at in range(0, len(parts), 4096):
            some = parts[at:at + 4096]
            for part, e in zip(some, self._tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                self._memo[part] = np.array(e.ids, self.dtype).tobytes()


def _parts(chunks: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Each chunk as two with the same ids: ASCII marks after a word are tokens of their own, and
    the vocabulary is lower case. Of other chunks the second is empty."""
    stems = pc.utf8_rtrim(chunks, characters=string.punctuation)
    words = pc.match_substring_regex(stems, _WORD)
    tails = pc.utf8_ltrim(chunks, characters=_LETTERS)
    return pc.if_else(words, pc.utf8_lower(stems), chunks), pc.if_else(words, tails, "")


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of some megabytes, in which a chunk is looked up once."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= _BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


@lru_cache(maxsize=1)
def encoder(path: str, end_id: int = END_ID) -> Encoder:
    """This process's encoder; a worker keeps it from task to task."""
    return Encoder(path, end_id)
