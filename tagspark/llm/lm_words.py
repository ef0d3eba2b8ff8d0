"""Cross-entropy difference of two matched word models whose counts grow with the corpus.

A document is its words between two marks of its bounds: runs of letters and digits in
lower case, every other mark by itself, and every character by itself in scripts
without spaces. The target model counts the words and pairs of words of the documents
marked as target, the background model those of all others; both share one vocabulary,
all words of the corpus. Nothing is dropped: no list of words, no least count.

Counts never come to one place. Documents are dealt to batches by their hash. A batch
sums its words and pairs and sends every part of the hash range its share, in hash
order; a part adds up what all batches sent and answers each in the same order, so
an answer needs no keys. With the answers of all parts a batch scores its documents.
Words and pairs are known by 64-bit hashes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: Weight of the single word in a pair, and what every word of the vocabulary counts more than it was seen.
PRIOR, EXTRA = 4.0, 0.5
#: Bytes of text in a batch, at least and at most; between them batches are MANY.
LEAST, MOST, MANY = 1 << 20, 13 << 20, 64
#: Bytes hashed at once; longer texts go in pieces cut at a space.
PIECE = 1 << 20

_rng = np.random.default_rng(9)
_OF_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
#: Stands for the begin and the end of a document.
BOUND = np.uint64(0x2545F4914F6CDD1D)


def _powers(base: int) -> np.ndarray:
    steps = np.full(PIECE + 4, base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))
#: 0 white space and controls, 1 letters, digits and bytes of other characters, 2 marks.
_KIND = np.array([0 if b < 33 or b == 127 else 1 if b > 127 or chr(b).isalnum() else 2 for b in range(256)], dtype=np.uint8)


def _mix(h: np.ndarray) -> np.ndarray:
    for m in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(m)
    return h ^ (h >> np.uint64(33))


def _hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of at most ``PIECE`` bytes that end in white space."""
    b = np.frombuffer(data, dtype=np.uint8)
    after = np.append(b[1:], 32)
    lead = (b & 0xC0) != 0x80
    # General marks, CJK, kana, Hangul and all beyond the first plane; Thai, Lao and Tibetan; Burmese and Khmer.
    single = (b >= 0xE2) | ((b == 0xE0) & (after >= 0xB8)) | (
        (b == 0xE1) & ((after <= 0x82) | ((after >= 0x9E) & (after <= 0x9F))))
    kind = _KIND[b]
    if single.any():
        first = np.maximum.accumulate(np.where(lead, np.arange(len(b)), 0))
        kind = np.where(single[first], 2, kind)
    before = np.append(np.uint8(0), kind[:-1])
    start = ((kind == 2) & lead) | ((kind == 1) & (before != 1))
    at = np.flatnonzero(start | (kind == 0))
    begins = start[at]
    ends = np.append(at[1:], len(b))[begins]
    begins = at[begins]
    sums = np.append(np.uint64(0), np.cumsum(_OF_BYTE[b] * _UP[:len(b)], dtype=np.uint64))
    return begins, _mix((sums[ends] - sums[begins]) * _DOWN[begins])


def _pieces(text: str | None) -> Iterator[bytes]:
    data = (text or "").lower().encode("utf-8", "replace")
    at = 0
    while at < len(data):
        to = at + PIECE - 1
        if to < len(data):
            cut = max(data.rfind(c, at, to) for c in (b" ", b"\n", b"\t"))
            if cut > at:
                to = cut
            else:
                while to > at + 1 and data[to] & 0xC0 == 0x80:
                    to -= 1
        yield data[at:to] + b"\n"
        at = to


def words(texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, each with words closed by ``BOUND``, and their number per text."""
    found: list[np.ndarray] = []
    n = np.zeros(len(texts), dtype=np.int64)
    held: list[bytes] = []
    owners: list[int] = []

    def work() -> None:
        starts = np.cumsum([0, *map(len, held)])[:-1]
        begins, h = _hash_words(b"".join(held))
        found.append(h)
        np.add.at(n, np.asarray(owners)[np.searchsorted(starts, begins, side="right") - 1], 1)

    size = 0
    for i, text in enumerate(texts):
        for piece in _pieces(text):
            if held and size + len(piece) > PIECE:
                work()
                held.clear()
                owners.clear()
                size = 0
            held.append(piece)
            owners.append(i)
            size += len(piece)
    if held:
        work()
    h = np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)
    ends = np.cumsum(n)[n > 0]
    return np.insert(h, ends, BOUND), n + (n > 0)


def pairs(h: np.ndarray) -> np.ndarray:
    """Hashes of each word and the one before it; ``BOUND`` comes before the first."""
    before = np.append(BOUND, h[:-1]) if len(h) else h
    return _mix(before * np.uint64(0x9FB21C651E98DF25) + (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1))


def _planes(values: np.ndarray) -> bytes:
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _read(data: bytes, kind: type, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8, count=n * size).reshape(size, n).T).view(kind).reshape(-1)


def pack(background: np.ndarray, target: np.ndarray, keys: np.ndarray | None = None) -> bytes:
    """Counts, and before them sorted keys as their differences; both by byte planes."""
    data = _planes(background.astype(np.int64)) + _planes(target.astype(np.int64))
    if keys is not None:
        data += _planes(np.diff(keys, prepend=np.uint64(0)))
    return zlib.compress(data, 1)


def unpack(data: bytes, with_keys: bool = False) -> tuple[np.ndarray, ...]:
    data = zlib.decompress(data)
    n = len(data) // (24 if with_keys else 16)
    counts = _read(data, np.int64, n), _read(data[8 * n:], np.int64, n)
    return (*counts, np.cumsum(_read(data[16 * n:], np.uint64, n), dtype=np.uint64)) if with_keys else counts


def _send(parts: int):
    """Documents of a batch and its targets' ids to one row per part."""
    edges = np.array([(i << 64) // parts for i in range(1, parts)], dtype=np.uint64)

    def run(docs: pd.DataFrame, hits: pd.DataFrame) -> pd.DataFrame:
        ids = set(hits["hit"])
        h, n = words(docs["text"].tolist())
        target = np.repeat(np.array([i is not None and i in ids for i in docs["doc_id"]], dtype=bool), n)
        sent = {"part": np.arange(parts), "batch": int(docs["batch"].iloc[0]) if len(docs) else 0,
                "n_background": int((~target).sum()), "n_target": int(target.sum())}
        for name, all_keys in (("one", h), ("two", pairs(h))):
            keys, at = np.unique(all_keys, return_inverse=True)
            t = np.bincount(at[target], minlength=len(keys))
            b = np.bincount(at, minlength=len(keys)) - t
            cuts = [0, *np.searchsorted(keys, edges), len(keys)]
            sent[name] = [pack(b[i:j], t[i:j], keys[i:j]) for i, j in zip(cuts, cuts[1:])]
        return pd.DataFrame(sent) if len(docs) else pd.DataFrame(sent).iloc[:0]

    return run


def _answer(rows: pd.DataFrame) -> pd.DataFrame:
    """What all batches sent to a part to the sums each of them asked for."""
    out = rows[["batch", "part"]].copy()
    out["n_background"], out["n_target"] = int(rows["n_background"].sum()), int(rows["n_target"].sum())
    for name in ("one", "two"):
        got = [unpack(x, True) for x in rows[name]]
        keys, at = np.unique(np.concatenate([k for *_, k in got]), return_inverse=True)
        # Sums of whole numbers: exact in any order below 2**53.
        b = np.bincount(at, np.concatenate([x for x, *_ in got]), len(keys)).astype(np.int64)
        t = np.bincount(at, np.concatenate([x for _, x, _ in got]), len(keys)).astype(np.int64)
        if name == "one":
            out["vocabulary"] = len(keys)
        ends = np.cumsum([len(k) for *_, k in got])
        out[name] = [pack(b[at[e - len(k):e]], t[at[e - len(k):e]]) for e, (*_, k) in zip(ends, got)]
    return out


def _score(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    answers = answers.sort_values("part")
    h, n = words(docs["text"].tolist())
    counts = {}
    for name, all_keys in (("one", h), ("two", pairs(h))):
        keys, at = np.unique(all_keys, return_inverse=True)
        got = [np.concatenate(x) for x in zip(*map(unpack, answers[name]))] or [np.zeros(0, np.int64)] * 2
        if len(got[0]) != len(keys):
            raise RuntimeError("a batch was dealt differently when it was read again")
        counts[name] = [x[at].astype(np.float64) for x in got]
    # The count of the word before; BOUND is before the first word of every text.
    bound = [x[h == BOUND][:1] for x in counts["one"]]
    totals = answers[["n_background", "n_target"]].max().to_numpy(dtype=np.float64) if len(answers) else np.zeros(2)
    vocabulary = max(int(answers["vocabulary"].sum()), 1)
    owner, loss = np.repeat(np.arange(len(docs)), n), []
    for k in (0, 1):
        scale = totals[1] / totals[0] if k == 0 and totals.all() else 1.0
        one, two = counts["one"][k] * scale, counts["two"][k] * scale
        before = np.concatenate([bound[k] * scale, one[:-1]])
        p = (one + EXTRA) / (totals[k] * scale + EXTRA * vocabulary)
        p = (two + PRIOR * p) / (before + PRIOR)
        loss.append(np.bincount(owner, -np.log(p), len(docs)) / np.maximum(n, 1))
    return pd.DataFrame({"doc_id": docs["doc_id"], "n_symbols": n, "h_target": loss[1], "h_background": loss[0], "score": loss[0] - loss[1]})


def score_against(docs: DataFrame, targets: DataFrame, id_column: str = "doc_id", text: str = "text", batch_bytes: int | None = None) -> DataFrame:
    """``doc_id, n_symbols, h_target, h_background, score``: nats per word, the difference last.

    The target model learns from the documents whose id is in ``targets``, the background model
    from the others, whose counts are scaled to as many words. Higher scores are more like the
    target. ``n_symbols`` counts words, marks and the text's end; texts without a word have 0
    everywhere. Ids may repeat in ``targets``; documents with a NULL id belong to the
    background; repeated rows give repeated results.
    """
    kind = docs.schema[id_column].dataType
    rows = docs.select(F.col(id_column).cast("string").alias("doc_id"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = max(1, -(-size // (batch_bytes or min(MOST, max(LEAST, size // MANY)))))
    dealt = rows.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)))
    marks = targets.select(F.col(id_column).cast(kind).cast("string").alias("doc_id")).where("doc_id IS NOT NULL").distinct().hint("merge")
    hits = dealt.select("batch", "doc_id").join(marks, "doc_id", "left_semi").select(
        F.col("batch").alias("to"), F.col("doc_id").alias("hit")).distinct()
    sent = dealt.groupBy("batch").cogroup(hits.groupBy("to")).applyInPandas(
        _send(batches), "part long, batch long, n_background long, n_target long, one binary, two binary")
    answers = sent.groupBy("part").applyInPandas(
        _answer, "batch long, part long, n_background long, n_target long, vocabulary long, one binary, two binary")
    found = dealt.groupBy("batch").cogroup(answers.groupBy("batch")).applyInPandas(
        _score, "doc_id string, n_symbols long, h_target double, h_background double, score double")
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))
