"""Token ids of many texts with a public tokenizer.

Built for a word-based vocabulary: no token reaches over ASCII white space, so a
text's ids are the ids of its words in order. Each Python worker keeps the ids of
the words it has met and asks the tokenizer for new ones only.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A word of plain letters (each lower-cases to one letter and composes with nothing), then marks that are
# tokens of their own.
SPLIT = r"^(?P<core>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[.,!?%$&*#|;:]*)$"
CACHE_WORDS = 200_000
END_OF_WORD = "</w>"


def spread(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces ``flat[start:start + size]`` one after the other, and where each ends."""
    ends = np.cumsum(size, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(start - (ends - size), size) + np.arange(total)], ends


class WordTokenizer:
    """Ids of words, remembered for up to ``CACHE_WORDS`` words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # Plain lower-case words need no normalising and part at blanks only.
        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for w, i in vocabulary.items() if w.endswith(END_OF_WORD)]] = True
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.start = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int32)
        self.flat = np.zeros(1 << 18, np.int32)
        self.used = 0

    def remember(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, k = len(self.index), len(words)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + k > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.start[n : n + k] = self.used + np.cumsum(sizes) - sizes
        self.size[n : n + k] = sizes
        self.index.update(zip(words, range(n, n + k)))
        self.used += len(ids)

    def learn_plain(self, words: list[str], per_line: int = 256) -> None:
        """Many words at a time; the ends of words show where each one's ids stop."""
        for k in range(0, len(words), per_line * 64):
            chunk = words[k : k + per_line * 64]
            lines = [" ".join(chunk[j : j + per_line]) for j in range(0, len(chunk), per_line)]
            encoded = self.plain.encode_batch_fast(lines, add_special_tokens=False)
            ids = np.array([i for line in encoded for i in line.ids], np.int32)
            stops = np.flatnonzero(self.ends_word[ids]) + 1
            if len(stops) == len(chunk):
                self.remember(chunk, ids, np.diff(stops, prepend=0).astype(np.int32))
            else:
                self.learn_each(chunk)

    def learn_each(self, words: list[str]) -> None:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        self.remember(
            words, np.array([i for w in ids for i in w], np.int32), np.array([len(w) for w in ids], np.int32)
        )

    def places(self, words: pa.Array, plain: np.ndarray | None = None) -> np.ndarray:
        """Place in the memory of each word, learning the new ones."""
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        found = np.fromiter((self.index.get(w, -1) for w in distinct), np.int64, len(distinct))
        new = np.flatnonzero(found < 0)
        if len(new):
            codes = coded.indices.to_numpy(zero_copy_only=False)
            easy = np.zeros(len(distinct), bool)
            if plain is not None:
                easy[codes] = plain
            self.learn_plain([distinct[i] for i in new if easy[i]])
            self.learn_each([distinct[i] for i in new if not easy[i]])
            found[new] = [self.index[distinct[i]] for i in new]
        return found[coded.indices.to_numpy(zero_copy_only=False)]

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct words: all in a row, where each begins and how many it has."""
        if len(self.index) > CACHE_WORDS:
            self.clear()
        parts = pc.extract_regex(words, SPLIT)
        core, marks = pc.utf8_lower(parts.field(0)), parts.field(1)
        plain = parts.is_valid().to_numpy(zero_copy_only=False)
        valid = parts.is_valid()
        first = self.places(pc.if_else(valid, core, words), plain)
        second = self.places(pc.if_else(valid, marks, ""))
        both = np.stack([first, second], 1).ravel()
        ids, ends = spread(self.flat, self.start[both], self.size[both])
        size = self.size[both].reshape(-1, 2).sum(1)
        return ids, ends[1::2] - size, size

    def encode_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text begins (one more at the end). Null is empty."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        at = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        known, start, size = self.encode_words(coded.dictionary)
        word = coded.indices.to_numpy(zero_copy_only=False)
        ids, ends = spread(known, start[word], size[word])
        return ids, np.concatenate([[0], ends])[at - at[0]]


def lowered_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of all texts as codes, where each text begins (one more at the end), and the distinct words.

    Words are runs of anything but ASCII white space, A-Z lower-cased; null has
    none. Case is changed in the word list only: the kernel misreads sliced texts.
    """
    split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat = split.flatten()
    filled = pc.greater(pc.binary_length(flat), 0)
    at = split.offsets.to_numpy().astype(np.int64)
    at = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])[at - at[0]].astype(np.int64)
    coded = flat.filter(filled).dictionary_encode()
    lowered = pc.ascii_lower(pa.concat_arrays([coded.dictionary])).dictionary_encode()
    code = lowered.indices.to_numpy(zero_copy_only=False)[coded.indices.to_numpy(zero_copy_only=False)]
    return code.astype(np.int64), at, lowered.dictionary


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and where each begins (one more at the end). Null is empty."""
    filled = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(filled) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = filled.buffers()
    at = np.frombuffer(offsets, np.int64)[filled.offset : filled.offset + len(filled) + 1]
    whole = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One per worker process and vocabulary file."""
    return WordTokenizer(path)


def text_batches(batch: pa.RecordBatch, column: int, most: int = 12_000_000):
    """Slices of a batch of about ``most`` bytes of text; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total, start = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += int(size)
    if batch.num_rows > start:
        yield batch.slice(start)
