"""N-grams of word arrays as numbers: a word is its place in a dictionary, an n-gram a pair of (its first
n - 1 words, its last word). Whole Arrow batches at a time; no n-gram occurrence becomes a string.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of a slice of a batch: what a task holds at once follows it, not the texts.
SLICE_BYTES = 1 << 23


def joined(words: Column) -> Column:
    """Words as one string for Arrow, which copies it whole; they hold no blank."""
    return F.array_join(words, " ")


def slices(batches: Iterable[pa.RecordBatch], column: str = "words") -> Iterator[tuple[pa.RecordBatch, pa.ListArray]]:
    """Slices of about ``SLICE_BYTES`` of ``joined`` words, one row at least, with their words."""
    for b in batches:
        text = b.column(b.schema.get_field_index(column))
        size = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        start = np.concatenate([[0], np.cumsum(size)])
        at = 0
        while at < b.num_rows:
            upto = max(at + 1, int(np.searchsorted(start, start[at] + SLICE_BYTES, "right")) - 1)
            yield b.slice(at, upto - at), _split(text.slice(at, upto - at))
            at = upto


def _split(text: pa.Array) -> pa.ListArray:
    """The words of each text; an empty one, which a plain split makes one empty word, and NULL have none."""
    words = pc.split_pattern(text, " ")
    flat, offsets = words.flatten(), words.offsets.to_numpy()
    some = pc.greater(pc.binary_length(flat), 0)
    start = np.concatenate([[0], np.cumsum(some.to_numpy(zero_copy_only=False))])[offsets - offsets[0]]
    return pa.ListArray.from_arrays(pa.array(start.astype(np.int32)), flat.filter(some))


def _positions(words: pa.ListArray):
    """(row of each word, words from there to the row's end, dictionary, place of each word in it)."""
    start = words.offsets.to_numpy().astype(np.int64)
    enc = words.values.slice(start[0], start[-1] - start[0]).dictionary_encode()
    row = np.repeat(np.arange(len(words)), np.diff(start))
    left = (start[1:] - start[0])[row] - np.arange(len(row))
    return row, left, enc.dictionary, enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def count_grams(words: pa.ListArray, n_min: int, n_max: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(terms, rows holding each, occurrences of each) of the rows' n-grams, for each n that has some."""
    row, left, dictionary, word = _positions(words)
    n_words, n_rows = max(1, len(dictionary)), max(1, len(words))
    at, gram, terms = np.arange(len(word)), word, dictionary
    for n in range(1, n_max + 1):
        if n > 1:
            longer = left[at] >= n
            at = at[longer]
            gram, pair = pd.factorize(gram[longer] * n_words + word[at + (n - 1)])
            terms = pc.binary_join_element_wise(terms.take(pa.array(pair // n_words)), dictionary.take(pa.array(pair % n_words)), " ")
        if not len(at):
            return
        if n >= n_min:
            held = np.sort(gram * n_rows + row[at])
            held = held[np.concatenate([[True], held[1:] != held[:-1]])] // n_rows
            yield terms, np.bincount(held, minlength=len(terms)), np.bincount(gram, minlength=len(terms))


class GramIndex:
    """Place of every vocabulary term, found word by word: level n maps (place of the first n - 1 words, last word)."""

    def __init__(self, terms: Sequence[str]):
        parts = [t.split(" ") for t in terms]
        self.words = pa.array(sorted({w for p in parts for w in p}), pa.string())
        self.n_terms, place = len(parts), {w: i for i, w in enumerate(self.words.to_pylist())}
        self.term_of = [np.full(len(self.words), -1, np.int64)]  # level 1: every word, a term or not
        self.keys: list[np.ndarray] = []
        node = np.full(len(parts), -1, np.int64)
        for n in range(1, max(map(len, parts), default=1) + 1):
            reach = np.array([i for i, p in enumerate(parts) if len(p) >= n], np.int64)
            last = np.array([place[parts[i][n - 1]] for i in reach], np.int64)
            if n == 1:
                node[reach] = last
            else:
                keys, node[reach] = np.unique(node[reach] * len(self.words) + last, return_inverse=True)
                self.keys.append(keys)
                self.term_of.append(np.full(len(keys), -1, np.int64))
            ends = np.array([i for i in reach if len(parts[i]) == n], np.int64)
            self.term_of[-1][node[ends]] = ends

    def counts(self, words: pa.ListArray, n_min: int, n_max: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, term, occurrences) of the vocabulary's n-grams, by row and term."""
        row, left, dictionary, word = _positions(words)
        known = pc.fill_null(pc.index_in(dictionary, self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        word = known[word]
        at = np.nonzero(word >= 0)[0]
        node, found = word[at], []
        for n in range(1, min(n_max, len(self.term_of)) + 1):
            if n > 1:
                longer = left[at] >= n
                at, node = at[longer], node[longer]
                last = word[at + (n - 1)]
                at, key = at[last >= 0], (node * len(self.words) + last)[last >= 0]
                keys = self.keys[n - 2]
                node = np.searchsorted(keys, key)
                met = keys[np.minimum(node, len(keys) - 1)] == key
                at, node = at[met], node[met]
            if n >= n_min:
                term = self.term_of[n - 1][node]
                found.append((row[at] * self.n_terms + term)[term >= 0])
        pairs = np.sort(np.concatenate([np.empty(0, np.int64), *found]))
        first = np.nonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))[0] if len(pairs) else np.empty(0, np.int64)
        pair = pairs[first]
        return pair // self.n_terms, pair % self.n_terms, np.diff(np.append(first, len(pairs)))
