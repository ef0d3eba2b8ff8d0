"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The pieces come from a vocabulary file that the driver reads; nothing is trained.
A file of merges holds ranks, not probabilities: then a piece's log score follows
Zipf's law over its rank. The whitespace marker is kept as a space inside: a
marker character in a text is no space and goes through byte fallback, so
decoding gives back every text exactly.

No piece has a marker behind another character or crosses a line break (checked
on loading), so the best segmentation of a text is made of the best ones of its
chunks (spaces and the word after them), and each distinct chunk is solved once.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .rows import whole

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
UNKNOWN_PENALTY = 10.0
#: Chunks whose pieces a task remembers before it starts anew.
MEMO = 100_000
#: Bytes of a chunk that is solved together with others of its length.
SHORT = 40
#: Characters or ids worked on at once.
PART = 1 << 19
CHUNK = re.compile(r" +[^ \n]*|\n|[^ \n]+")
#: Where no piece has an ASCII sign behind a Latin letter, a word also ends there.
LETTER, SIGN = r"[A-Za-zÀ-ÖØ-öø-ÿ]", r"[!-/:-@\[-`{-~]"
WORD_CHUNK = re.compile(r" *" + LETTER + r"++(?=[ \n!-/:-@\[-`{-~]|\Z)|" + CHUNK.pattern)


class Vocabulary:
    """``pieces``: bytes of every id, the marker as a space; ``scores``: of the ids in the trie."""

    def __init__(self, pieces: list[bytes], scores: dict[int, float], byte_ids: list[int]):
        self.pieces, self.scores, self.byte_ids = pieces, scores, byte_ids
        self.base, self.check = double_array(sorted((pieces[i], i) for i in scores))
        crossing = re.compile(LETTER + SIGN)
        self.chunks = CHUNK if any(crossing.search(pieces[i].decode()) for i in scores) else WORD_CHUNK
        self.unknown = min(scores.values()) - UNKNOWN_PENALTY


def load(path: str = MODEL) -> Vocabulary:
    """Pieces of a SentencePiece file with byte fallback."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces, scores, byte_ids = [b""] * n, {}, [-1] * 256
    for i in range(n):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(piece[3:5], 16)
            pieces[i], byte_ids[value] = bytes([value]), i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            if "\n" in piece or MARKER in piece.lstrip(MARKER):
                raise ValueError(f"piece {i} crosses a chunk: {piece!r}")
            pieces[i], scores[i] = piece.replace(MARKER, " ").encode(), model.get_score(i)
    if -1 in byte_ids or max(byte_ids) - min(byte_ids) != 255:
        raise ValueError(f"{path} has no byte fallback")
    if all(s == round(s) for s in scores.values()):
        scores = zipf(scores)
    return Vocabulary(pieces, scores, byte_ids)


def zipf(scores: dict[int, float]) -> dict[int, float]:
    """Log of ``1 / (rank * H)``, best first."""
    total = math.log(sum(1 / r for r in range(1, len(scores) + 1)))
    order = sorted(scores, key=lambda i: (-scores[i], i))
    return {i: -math.log(rank) - total for rank, i in enumerate(order, 1)}


def double_array(keys: list[tuple[bytes, int]]) -> tuple[list[int], list[int]]:
    """``base, check`` of sorted keys. The child of s by byte c is ``base[s] + c + 1``,
    taken if ``check`` there is s; ``base[s]`` itself holds ``-1 - id`` of a key ending at s."""
    size = 1 << 12
    base, check = np.zeros(size, dtype=np.int64), np.full(size, -1, dtype=np.int64)
    check[0] = 0
    lowest = 1
    todo = [(0, 0, len(keys), 0)]
    while todo:
        state, lo, hi, depth = todo.pop()
        ends = len(keys[lo][0]) == depth
        groups, i = [], lo + ends
        while i < hi:
            c, j = keys[i][0][depth], i
            while j < hi and keys[j][0][depth] == c:
                j += 1
            groups.append((c + 1, i, j))
            i = j
        codes = np.array(([0] if ends else []) + [g[0] for g in groups])
        while lowest < len(check) and check[lowest] >= 0:
            lowest += 1
        start = max(lowest - int(codes[0]), 1)
        while True:
            if start + 4096 + 257 >= len(check):
                base = np.concatenate([base, np.zeros(len(base), dtype=np.int64)])
                check = np.concatenate([check, np.full(len(check), -1, dtype=np.int64)])
            tries = start + np.arange(256)
            free = (check[tries[:, None] + codes] < 0).all(axis=1)
            if free.any():
                start = int(tries[free.argmax()])
                break
            start += 256
        base[state] = start
        check[start + codes] = state
        if ends:
            base[start] = -1 - keys[lo][1]
        todo += [(start + code, i, j, depth + 1) for code, i, j in groups]
    return base.tolist(), check.tolist()


class Encoder:
    """Encodes and decodes with one vocabulary; remembers the chunks it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.memo: dict[str, tuple[int, ...]] = {}
        self.base, self.check = np.array(vocabulary.base), np.array(vocabulary.check)
        self.scores = np.full(len(vocabulary.pieces), -np.inf)
        self.scores[list(vocabulary.scores)] = list(vocabulary.scores.values())

    def best(self, data: bytes) -> tuple[int, ...]:
        """Ids of the segmentation with the highest sum of scores; of equal ones the longer last piece."""
        base, check, scores, unknown = self.v.base, self.v.check, self.v.scores, self.v.unknown
        n = len(data)
        best = [-math.inf] * (n + 1)
        best[0] = 0.0
        came: list[tuple[int, int]] = [(0, 0)] * (n + 1)
        start = 0
        while start < n:
            lead = data[start]
            width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            here, state, at, single = best[start], 0, start, False
            while at < n:
                to = base[state] + data[at] + 1
                if check[to] != state:
                    break
                state = to
                at += 1
                end = base[state]
                if check[end] == state and base[end] < 0:
                    piece = -1 - base[end]
                    single = single or at == start + width
                    score = here + scores[piece]
                    if score > best[at]:
                        best[at] = score
                        came[at] = (start, piece)
            if not single:
                score = here + unknown
                if score > best[start + width]:
                    best[start + width] = score
                    came[start + width] = (start, -1)
            start += width
        out: list[int] = []
        at = n
        while at > 0:
            start, piece = came[at]
            out += [piece] if piece >= 0 else [self.v.byte_ids[b] for b in reversed(data[start:at])]
            at = start
        return tuple(reversed(out))

    def solve(self, chunks: list[str]) -> None:
        """Remember the ids of new chunks. Short ones of one length are solved side by side."""
        lengths: dict[int, list[tuple[str, bytes]]] = {}
        for c in chunks:
            data = c.encode()
            if len(data) <= SHORT:
                lengths.setdefault(len(data), []).append((c, data))
            else:
                self.memo[c] = self.best(data)
        for n, group in lengths.items():
            for c, ids in zip([c for c, _ in group], self._side_by_side([d for _, d in group], n)):
                self.memo[c] = ids

    def _side_by_side(self, data: list[bytes], n: int) -> list[tuple[int, ...]]:
        """``best`` for many chunks of n bytes; those with an unknown character go one by one."""
        base, check, scores = self.base, self.check, self.scores
        text = np.frombuffer(b"".join(data), dtype=np.uint8).reshape(-1, n).astype(np.int64)
        m = len(text)
        best = np.full((m, n + 1), -np.inf)
        best[:, 0] = 0
        came = np.zeros((m, n + 1), dtype=np.int64)
        piece = np.full((m, n + 1), -1, dtype=np.int64)
        for start in range(n):
            rows = np.flatnonzero(best[:, start] > -np.inf)
            state = np.zeros(len(rows), dtype=np.int64)
            here = best[rows, start]
            for at in range(start, n):
                to = base[state] + text[rows, at] + 1
                alive = check[to] == state
                rows, state, here = rows[alive], to[alive], here[alive]
                if not len(rows):
                    break
                end = base[state]
                ends = np.flatnonzero((check[end] == state) & (base[end] < 0))
                ids = -1 - base[end[ends]]
                score = here[ends] + scores[ids]
                r = rows[ends]
                better = score > best[r, at + 1]
                r = r[better]
                best[r, at + 1] = score[better]
                came[r, at + 1] = start
                piece[r, at + 1] = ids[better]
        # A character without a piece of its own may need bytes: those chunks are solved alone.
        alone = np.zeros(m, dtype=bool)
        for at in range(n):
            lead = text[:, at]
            width = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
            whole = np.flatnonzero(((lead < 0x80) | (lead >= 0xC0)))
            state = np.zeros(len(whole), dtype=np.int64)
            for k in range(4):
                more = width[whole] > k
                to = np.where(more, base[state] + text[whole, np.minimum(at + k, n - 1)] + 1, state)
                alone[whole[more & (check[to] != state)]] = True
                state = np.where(more & (check[to] == state), to, state)
            end = base[state]
            alone[whole[~((check[end] == state) & (base[end] < 0))]] = True
        steps, at, each = [], np.full(m, n), np.arange(m)
        at[alone] = 0
        while at.any():
            steps.append(np.where(at > 0, piece[each, at], -1))
            at = np.where(at > 0, came[each, at], 0)
        table = np.stack(steps[::-1], axis=1).tolist() if steps else [[]] * m
        return [self.best(d) if x else tuple(i for i in row if i >= 0) for d, x, row in zip(data, alone.tolist(), table)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts, each behind the marker that stands for its start."""
        chunks = [self.v.chunks.findall(" " + t) if t else [] for t in texts]
        new = set().union(*chunks)
        if len(self.memo) + len(new) > MEMO:
            self.memo.clear()
        self.solve([c for c in new if c not in self.memo])
        get = self.memo.__getitem__
        return [np.array(list(chain.from_iterable(map(get, c))), dtype=np.int32) for c in chunks]

    def decode(self, ids) -> str:
        data = b"".join(map(self.v.pieces.__getitem__, ids))
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


def _parts(values: pd.Series, size) -> Iterator[slice]:
    """Slices of rows of about ``PART`` characters or ids, or of one row that has more."""
    start = total = 0
    for i, v in enumerate(values):
        n = 0 if v is None else size(v)
        if i > start and total + n > PART:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(values):
        yield slice(start, len(values))


def share(spark: SparkSession, path: str = MODEL) -> Broadcast:
    """The vocabulary for all tasks: its size is the file's, whatever the corpus."""
    return spark.sparkContext.broadcast(load(path))


def encode(text: Column, vocabulary: Broadcast) -> Column:
    """Piece ids of a text. NULL stays NULL, an empty text has none."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(vocabulary.value)
        for batch in batches:
            out = []
            for part in _parts(batch, len):
                texts = batch.iloc[part].tolist()
                out += [None if t is None else x for t, x in zip(texts, encoder.encode(texts))]
            yield pd.Series(out, dtype=object)

    return run(text)


def decode(ids: Column, vocabulary: Broadcast) -> Column:
    """The text of an array of piece ids. NULL stays NULL, an empty array is the empty text."""

    @F.pandas_udf(T.StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(vocabulary.value)
        for batch in batches:
            yield pd.Series([None if x is None else encoder.decode(x.tolist()) for x in batch], dtype=object)

    return run(ids)


def tokenize(docs: DataFrame, text: str = "text", path: str = MODEL) -> DataFrame:
    """All columns and ``piece_ids``, ``n_pieces`` (0 for a NULL text).

    Existing columns of these names are replaced. Rows pass as Arrow batches and leave
    in small ones, so no task holds the ids of many texts.
    """
    shared = share(docs.sparkSession, path)
    rows = docs.select(whole(docs, "piece_ids", "n_pieces"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for part in _parts(batch.column("text"), lambda t: len(t.as_py() or "")):
                some = batch.slice(part.start, part.stop - part.start)
                texts = some.column("text").to_pylist()
                ids = encoder.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [some.column("row"), pa.array([None if t is None else x for t, x in zip(texts, ids)], pa.list_(pa.int32())),
                     pa.array([len(x) for x in ids], pa.int64())], ["row", "piece_ids", "n_pieces"])

    added = [T.StructField("piece_ids", T.ArrayType(T.IntegerType())), T.StructField("n_pieces", T.LongType())]
    return rows.mapInArrow(run, T.StructType([rows.schema["row"], *added])).select("row.*", "piece_ids", "n_pieces")


def round_trip(docs: DataFrame, id_column: str = "doc_id", text: str = "text", path: str = MODEL) -> DataFrame:
    """``doc_id, n_pieces, n_byte_pieces, piece_ids, exact``: whole texts encoded, then decoded and compared.

    A NULL text has NULL ids, no pieces and is exact. Repeated rows give repeated
    results; other columns are not read.
    """
    shared = share(docs.sparkSession, path)
    # As text an id survives pandas even where others are NULL.
    rows = docs.select(F.col(id_column).cast("string").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(shared.value)
        least, most = min(encoder.v.byte_ids), max(encoder.v.byte_ids)
        for pdf in batches:
            for part in _parts(pdf["text"], len):
                texts = pdf["text"].iloc[part].tolist()
                ids = encoder.encode(texts)
                yield pd.DataFrame({
                    "doc_id": pdf["doc_id"].iloc[part].to_numpy(), "n_pieces": [len(x) for x in ids],
                    "n_byte_pieces": [int(((x >= least) & (x <= most)).sum()) for x in ids],
                    "piece_ids": [None if t is None else x for t, x in zip(texts, ids)],
                    "exact": [t is None or encoder.decode(x.tolist()) == t for t, x in zip(texts, ids)]})

    found = rows.mapInPandas(run, "doc_id string, n_pieces long, n_byte_pieces long, piece_ids array<int>, exact boolean")
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_column].dataType))
