"""Personal data: exact patterns, and a linear-chain CRF for the forms they miss.

The patterns give the base spans. The CRF labels white-space words as part of an
e-mail address, IP address, card or phone number, or of nothing, from features of
the word's shape and of its neighbours. It is trained in numpy on the sentences
of ``pii_table`` and decoded by Viterbi over batches of whole texts of like
length. Its spans are added where they meet no base span.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .pii_table import SENTENCES

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)
K = len(LABELS)

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: Words in each round of Viterbi, padding included.
CELLS = 1 << 18
#: Distinct words remembered by a task at most; then it starts anew.
MEMO = 200_000
#: Characters worked on at once (one longer text alone): their words are all in memory.
PART = 1 << 20


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches. Each holds one ``@``, so the address is read outwards from it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_CHARS:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``start, kind number, end`` of the pattern matches, sorted."""
    spans = [(s, 0, e) for s, e in _emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        # Without leading zeros first: a number of thousands of digits is no int in Python.
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (q.lstrip("0") for q in m[0].split("."))):
            spans.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                spans.append((m.start(), 3, m.end()))
    spans.sort()
    return spans


# Features -------------------------------------------------------------------------

KEYWORDS = frozenset(
    "at dot tel phone call fax mobile ring text email e-mail mail write card visa mastercard account ip host address server".split())
PLAIN = ("plain",)
OPEN, CLOSE = "([{<\"'«", ".,;:!?)]}>\"'»"


def shape(word: str) -> str:
    """Runs of capitals, small letters and digits as one sign each; other signs stay."""
    out = []
    for c in word[:64]:
        s = "9" if "0" <= c <= "9" else ("A" if c.isupper() else "a") if c.isalpha() else c
        if not out or out[-1] != s or s not in "Aa9":
            out.append(s)
    return "".join(out)


def features(word: str) -> list[str]:
    core = word.lstrip(OPEN).rstrip(CLOSE)
    lower = core.lower()
    if core.isalpha():
        if lower in KEYWORDS:
            return ["keyword", "word=" + lower]
        return ["plain"]
    digits = [c for c in word if "0" <= c <= "9"]
    out = ["shape=" + shape(core), "digits=" + str(min(len(digits), 20))]
    if "@" in word:
        out.append("has@")
    if "." in core:
        out.append("dots=" + str(min(core.count("."), 4)))
    if word[:1] == "+":
        out.append("plus")
    if any(x in lower for x in ("(at)", "[at]", "{at}", "(dot)", "[dot]", "{dot}")):
        out.append("spelled")
    if len(digits) == len(core.replace("-", "")) and 12 <= len(digits) <= 19:
        out.append("luhn" if luhn("".join(digits)) else "long number")
    parts = core.replace("[.]", ".").split(".")
    if len(parts) == 4 and all(p.isdecimal() and p.isascii() and len(p) < 4 and int(p) < 256 for p in parts):
        out.append("octets")
    if not digits and "@" not in word:
        out.append("no digit")
    return out


# Training -------------------------------------------------------------------------

MARK = re.compile(r"\{(\w+)\|([^{}]*)\}")


def labelled(sentence: str) -> tuple[list[str], list[int]]:
    """``call {phone|555 0101} now`` to words and label numbers."""
    words: list[str] = []
    labels: list[int] = []
    plain, last = [], 0
    for m in MARK.finditer(sentence):
        plain += [(sentence[last:m.start()], 0), (m[2], LABELS.index(m[1]))]
        last = m.end()
    plain.append((sentence[last:], 0))
    for part, label in plain:
        found = part.split()
        words += found
        labels += [label] * len(found)
    return words, labels


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Crf:
    """Feature names and weights: own word, word before, word after, transitions."""

    def __init__(self, names: dict[str, int], own: np.ndarray, before: np.ndarray, after: np.ndarray, moves: np.ndarray):
        self.names, self.own, self.before, self.after, self.moves = names, own, before, after, moves

    def scores(self, word: str) -> np.ndarray:
        """What a word adds to its own labels, to the next word's and to the last one's."""
        ids = [i for f in features(word) if (i := self.names.get(f)) is not None]
        return np.stack([self.own[ids].sum(0), self.before[ids].sum(0), self.after[ids].sum(0)]).astype(np.float32)


def train(sentences: list[str] | None = None, epochs: int = 250, rate: float = 0.1, l2: float = 0.02) -> Crf:
    """Maximum likelihood by Adam over the padded table; the same weights on every run."""
    rows = [labelled(s) for s in (sentences or SENTENCES)]
    names: dict[str, int] = {}
    for words, _ in rows:
        for w in words:
            for f in features(w):
                names.setdefault(f, len(names))
    n, longest, nf = len(rows), max(len(w) for w, _ in rows), len(names)
    x = np.zeros((n, longest, nf))
    y = np.zeros((n, longest), dtype=np.int64)
    mask = np.zeros((n, longest))
    for i, (words, labels) in enumerate(rows):
        for t, w in enumerate(words):
            for f in features(w):
                x[i, t, names[f]] = 1
        y[i, :len(labels)] = labels
        mask[i, :len(labels)] = 1
    zero = np.zeros((n, 1, nf))
    full = np.concatenate([x, np.concatenate([zero, x[:, :-1]], 1), np.concatenate([x[:, 1:], zero], 1)], axis=2)
    gold = np.eye(K)[y] * mask[..., None]
    gold_moves = np.einsum("nti,ntj->ij", gold[:, :-1], gold[:, 1:])
    w, moves = np.zeros((3 * nf, K)), np.zeros((K, K))
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(moves), np.zeros_like(moves)]
    for step in range(1, epochs + 1):
        e = full @ w
        alpha, beta = np.zeros((n, longest, K)), np.zeros((n, longest, K))
        alpha[:, 0] = e[:, 0]
        for t in range(1, longest):
            new = _logsumexp(alpha[:, t - 1, :, None] + moves, 1) + e[:, t]
            alpha[:, t] = np.where(mask[:, t, None] > 0, new, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = _logsumexp(moves + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(mask[:, t + 1, None] > 0, new, 0)
        z = _logsumexp(alpha[:, -1], 1)
        p = np.exp(alpha + beta - z[:, None, None]) * mask[..., None]
        pair = np.exp(alpha[:, :-1, :, None] + moves + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None])
        pair = (pair * mask[:, 1:, None, None]).sum((0, 1))
        grads = [np.einsum("ntf,ntk->fk", full, p - gold) + l2 * w, pair - gold_moves + l2 * moves]
        for k, (value, g) in enumerate(zip((w, moves), grads)):
            m, v = state[2 * k], state[2 * k + 1]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            value -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Crf(names, w[:nf], w[nf:2 * nf], w[2 * nf:], moves)


# Decoding -------------------------------------------------------------------------


class _Memo(dict):
    """Word to the row of its scores in ``table``, worked out on first sight."""

    def __init__(self, model: Crf):
        super().__init__()
        self.model = model
        self.clear()

    def clear(self) -> None:
        """Forget words, features and scores."""
        super().clear()
        self.known: dict[tuple[str, ...], int] = {}
        self.room = np.zeros((256, 3, K), dtype=np.float32)

    @property
    def table(self) -> np.ndarray:
        return self.room[:len(self.known)]

    def __missing__(self, word: str) -> int:
        core = word if word.isalpha() else word.lstrip(OPEN).rstrip(CLOSE)
        plain = core.isalpha() and core.lower() not in KEYWORDS
        key = PLAIN if plain else tuple(features(word))
        row = self.known.get(key)
        if row is None:
            row = self.known[key] = len(self.known)
            if row == len(self.room):
                self.room = np.concatenate((self.room, np.zeros_like(self.room)))
            self.room[row] = self.model.scores(word)
        self[word] = row
        return row


def viterbi(own: np.ndarray, moves: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Best labels of padded sequences: ``own`` is (steps, sequences, labels)."""
    steps, n, k = own.shape
    back = np.zeros((steps, n, k), dtype=np.uint8)
    best = own[0].copy()
    ends = np.zeros((n, k), dtype=np.float32)
    ends[lengths == 1] = best[lengths == 1]
    for t in range(1, steps):
        total = best[:, :, None] + moves
        back[t] = total.argmax(1)
        best = total.max(1) + own[t]
        if (over := lengths == t + 1).any():
            ends[over] = best[over]
    labels = np.zeros((steps, n), dtype=np.uint8)
    now = ends.argmax(1).astype(np.uint8)
    each = np.arange(n)
    for t in range(steps - 1, -1, -1):
        inside = lengths > t
        labels[t] = np.where(inside, now, 0)
        now = np.where(inside, back[t, each, now], now)
    return labels


def decode(texts: list[list[str]], model: Crf, memo: _Memo | None = None) -> list[np.ndarray]:
    """Label numbers of the words of every text."""
    memo = memo if memo is not None else _Memo(model)
    get = memo.__getitem__
    ids = [np.fromiter(map(get, words), dtype=np.int32, count=len(words)) for words in texts]
    table = memo.table
    moves = model.moves.astype(np.float32)
    out: list[np.ndarray] = [np.zeros(0, dtype=np.uint8)] * len(texts)
    order = sorted((i for i in range(len(texts)) if len(ids[i])), key=lambda i: -len(ids[i]))
    at = 0
    while at < len(order):
        steps = len(ids[order[at]])
        group = order[at:at + max(1, CELLS // steps)]
        at += len(group)
        lengths = np.array([len(ids[i]) for i in group])
        own = np.zeros((steps, len(group), K), dtype=np.float32)
        for j, i in enumerate(group):
            x = ids[i]
            own[:len(x), j] = table[x, 0]
            own[1:len(x), j] += table[x[:-1], 1]
            own[:len(x) - 1, j] += table[x[1:], 2]
        labels = viterbi(own, moves, lengths)
        for j, i in enumerate(group):
            out[i] = labels[:lengths[j], j].copy()
    return out


WORD = re.compile(r"\S+")


def added_spans(text: str, labels: np.ndarray, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Runs of one label as spans without outer punctuation, where no base span lies."""
    if not labels.any():
        return []
    spans: list[tuple[int, int, int]] = []
    last = 0
    for m, label in zip(WORD.finditer(text), labels.tolist()):
        if label and label == last:
            spans[-1] = (spans[-1][0], label - 1, m.end())
        elif label:
            spans.append((m.start(), label - 1, m.end()))
        last = label
    out = []
    for start, kind, end in spans:
        while start < end and text[start] in OPEN:
            start += 1
        while start < end and text[end - 1] in CLOSE:
            end -= 1
        if start < end and not any(s < end and start < e for s, _, e in base):
            out.append((start, kind, end))
    return out


def find(texts: list[str | None], model: Crf, memo: _Memo | None = None) -> list[tuple[list, list]]:
    """Base spans and all spans of every text."""
    texts = [t or "" for t in texts]
    labels = decode([t.split() for t in texts], model, memo)
    out = []
    for text, found in zip(texts, labels):
        base = base_spans(text)
        out.append((base, sorted(base + added_spans(text, found, base))))
    return out


def find_in_parts(batch: pd.Series, memo: _Memo) -> Iterator[tuple[list[str | None], list[tuple[list, list]]]]:
    """Texts and what ``find`` gives for them, some at a time."""
    texts: list[str | None] = []
    size = 0
    for text in batch:
        if texts and size + len(text or "") > PART:
            yield texts, find(texts, memo.model, memo)
            texts, size = [], 0
            if len(memo) > MEMO:
                memo.clear()
        texts.append(text)
        size += len(text or "")
    if texts:
        yield texts, find(texts, memo.model, memo)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each span as ``[KIND]``; of overlapping spans the first kind covers all."""
    out, last = [], 0
    for start, kind, end in spans:
        if start >= last:
            out += [text[last:start], f"[{KINDS[kind].upper()}]"]
        last = max(last, end)
    return "".join(out) + text[last:]


RESULT = T.StructType([
    *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS], T.StructField("base_sha256", T.StringType()),
    T.StructField("spans", T.StringType())])


def scan(text: Column, model: Crf) -> Column:
    """Struct of the base counts, the digest of the base spans and all spans. NULL is the empty text."""

    @F.pandas_udf(RESULT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memo = _Memo(model)
        for batch in batches:
            rows = []
            for _, found in find_in_parts(batch, memo):
                for base, spans in found:
                    counts = [0] * len(KINDS)
                    for _, kind, _ in base:
                        counts[kind] += 1
                    rows.append((*counts, hashlib.sha256(written(base).encode()).hexdigest(), written(spans)))
            yield pd.DataFrame(rows, columns=RESULT.names)

    return run(text)


def redact(text: Column, model: Crf) -> Column:
    """The text with every span replaced by its kind; NULL stays NULL."""

    @F.pandas_udf(T.StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo = _Memo(model)
        for batch in batches:
            out = []
            for texts, found in find_in_parts(batch, memo):
                out += [t if t is None else redacted(t, spans) for t, (_, spans) in zip(texts, found)]
            yield pd.Series(out, dtype=object)

    return run(text)


def find_personal_data(docs: DataFrame, id_column: str = "doc_id", text: str = "text", model: Crf | None = None) -> DataFrame:
    """One row per document: ``doc_id``, base counts, ``base_sha256`` and ``spans``.

    Offsets are code points, the end exclusive. NULL and empty texts have no
    spans; repeated rows give repeated results; other columns are not read.
    """
    found = docs.select(F.col(id_column).alias("doc_id"), scan(F.col(text), model or train()).alias("r"))
    return found.select("doc_id", "r.*")
