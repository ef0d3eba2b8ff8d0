"""Counting inside tasks, in numpy over Arrow batches: rows become counts before any shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words or characters counted at once.
PART = 1 << 20


def parts(sizes: np.ndarray, limit: int = PART) -> Iterator[slice]:
    """Slices of rows of at most ``limit`` together, or of one row that has more."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield slice(start, stop)
        start = stop


def count_tokens(batches: Iterator[pa.RecordBatch], least: int, most: int) -> Iterator[pa.RecordBatch]:
    """``(token, count, n_docs)`` of the n-grams of ``least`` to ``most`` words of the lists in the
    first column; a token may come several times. Lists hold no NULLs."""
    for batch in batches:
        lists = batch.column(0)
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        for part in parts(sizes):
            some, size = lists.slice(part.start, part.stop - part.start), sizes[part]
            encoded = some.flatten().dictionary_encode()
            words, codes = encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            doc = np.repeat(np.arange(len(size)), size)
            key, token = codes, words
            for n in range(1, most + 1):
                if n > 1:
                    # Places whose n words are of one list; an n-gram is one of n - 1 words and the word after it.
                    whole = doc[n - 1:] == doc[:len(doc) - n + 1] if len(doc) >= n else np.zeros(0, dtype=bool)
                    pairs = key[:len(whole)] * len(words) + codes[n - 1:n - 1 + len(whole)]
                    found, inverse = np.unique(pairs[whole], return_inverse=True)
                    token = pc.binary_join_element_wise(token.take(pa.array(found // max(1, len(words)))), words.take(pa.array(found % max(1, len(words)))), " ")
                    key = np.zeros(len(whole), dtype=np.int64)
                    key[whole] = inverse
                    ids, rows = inverse, doc[:len(whole)][whole]
                else:
                    ids, rows = codes, doc
                if n >= least and len(token):
                    in_docs = np.unique(ids * len(size) + rows) // len(size)
                    yield pa.RecordBatch.from_arrays(
                        [token, pa.array(np.bincount(ids, minlength=len(token))), pa.array(np.bincount(in_docs, minlength=len(token)))],
                        ["token", "count", "n_docs"])


def count_char_ngrams(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """``(group, gram, count)`` of the n characters from every place of the texts in the second column, for
    each group in the first; a gram may come several times."""
    for batch in batches:
        texts = batch.column(1).fill_null("")
        sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        for part in parts(sizes):
            size = sizes[part]
            groups = batch.column(0).slice(part.start, part.stop - part.start).dictionary_encode(null_encoding="encode")
            joined = "".join(texts.slice(part.start, part.stop - part.start).to_pylist())
            points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
            if len(points) < n:
                continue
            letters = np.flatnonzero(np.bincount(points)).astype(np.uint32)
            places = np.zeros(int(letters[-1]) + 1, dtype=np.int64)
            places[letters] = np.arange(len(letters))
            codes = places[points]
            doc = np.repeat(np.arange(len(size)), size)
            starts = np.flatnonzero(doc[n - 1:] == doc[:len(doc) - n + 1])
            columns = [groups.indices.to_numpy(zero_copy_only=False).astype(np.int64)[doc[starts]], *[codes[starts + k] for k in range(n)]]
            if len(groups.dictionary) * len(letters) ** n < 1 << 62:
                key = columns[0]
                for c in columns[1:]:
                    key = key * len(letters) + c
                found, count = np.unique(key, return_counts=True)
                grams = np.empty((len(found), n), dtype=np.uint32)
                for k in reversed(range(n)):
                    found, digit = np.divmod(found, len(letters))
                    grams[:, k] = letters[digit]
            else:
                rows, count = np.unique(np.column_stack(columns), axis=0, return_counts=True)
                found, grams = rows[:, 0], letters[rows[:, 1:]]
            named = np.ascontiguousarray(grams).tobytes().decode("utf-32-le")
            yield pa.RecordBatch.from_arrays(
                [groups.dictionary.take(pa.array(found)), pa.array([named[i:i + n] for i in range(0, len(named), n)], pa.string()), pa.array(count)],
                ["group", "gram", "count"])
