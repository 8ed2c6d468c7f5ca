"""Toxic spans by a linear-chain conditional random field.

Tokens are words (A-Z lower-cased); labels are O and T (toxic). The chain has emission weights for
*marks*, which are words or word beginnings (3 to 8 bytes, so that inflected and compound forms share
one), for the marks of the words before and after a token, and transition weights. Candidates for marks
are found in a bounded sample of labelled documents: their documents are toxic far more often than not
(a lower bound on the ratio of rates), and together they explain the toxic ones.

Training has two steps, both by gradient ascent with forward-backward expectations. The first, on labelled
tokens: those of a toxic document that have a mark are T, all others O (where the caller has token labels,
``fit`` takes those). The second lets the tags of toxic documents be unknown, under their label: a toxic
document has at least one T, a clean one has none, and the likelihood of just that is raised. So a mark
that clean documents hold too, or that others explain, loses its weight, and neighbours count.

Scoring computes forward-backward marginals of every token of a whole text. Words without a mark or a marked
neighbour share one emission, so a run of k of them is one step with the k-th power of their transition
matrix; only the other tokens are visited. The result is that of visiting every token.

The document's score is a noisy-or of its tokens' marginals, each less the marginal that a word
without weight has on its own, and offending offsets are the runs of tokens with a marginal of at
least ``SPAN``.

Defined cases: null and empty texts score 0 and have no spans; labels of equal id count once, toxic if
any is; a table without labels of both kinds gives scores of 0. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SAMPLE_BYTES, sampled, texts

#: Labelled documents of each kind that training reads at most, by a hash of the id.
SAMPLE = 1500
THRESHOLD, SPAN = 0.3, 0.5
HELD_OUT = (4, 2)  # crc32(doc_id as text) mod 4 == 2
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def tokens(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


_STEM = range(8, 2, -1)


class _MarkOf(dict):
    """The mark of a word: itself, or its longest beginning that is one (with a * at the end), or None."""

    def __init__(self, marks: set[bytes]):
        super().__init__()
        self.marks = marks

    def __missing__(self, word: bytes):
        if len(self) > 1 << 20:
            self.clear()
        got = word if word in self.marks else None
        if got is None:
            got = next((s for n in _STEM if len(word) > n and (s := word[:n] + b"*") in self.marks), None)
        self[word] = got
        return got

    def __reduce__(self):
        return _MarkOf, (self.marks,)


class Chain:
    """Two labels; ``emission[mark]`` is the weight of T against O, ``other`` that of all other words; ``before``
    and ``after`` are added for the marks of the words there; ``step``: 2 x 2 transition weights, ``start``: two
    weights."""

    def __init__(self, emission: dict[bytes, float], other: float, step: np.ndarray, start: np.ndarray, before=None, after=None):
        self.emission, self.other, self.step, self.start = emission, other, step, start
        self.before, self.after = before or {}, after or {}
        self.mark_of = _MarkOf(set(emission))
        plain = np.exp(np.array([0.0, other]))
        # the matrix of a step onto a word without weight, in its eigenbasis: powers in closed form
        self._plain = np.exp(step) * plain[None, :]
        values, vectors = np.linalg.eig(self._plain)
        self._values, self._vectors, self._inverse = values.real, vectors.real, np.linalg.inv(vectors.real)
        self._norm = float(np.max(np.abs(self._values)))
        self._powers: dict[int, tuple] = {}
        # a word without weight far from any other
        left = np.abs(self._inverse_left())
        self.background = float(left[1] / left.sum())

    def _inverse_left(self) -> np.ndarray:
        k = int(np.argmax(np.abs(self._values)))
        return self._vectors[:, k] * self._inverse[k]

    def power(self, k: int) -> tuple:
        """The k-th power of the plain step, scaled to have a largest eigenvalue of 1."""
        got = self._powers.get(k)
        if got is None:
            m = (self._vectors * (self._values / self._norm) ** k) @ self._inverse
            got = tuple(float(x) for x in m.ravel())
            if len(self._powers) < 200_000:
                self._powers[k] = got
        return got

    def weights(self, words: list[bytes]) -> list[tuple[int, float]]:
        """(index, weight of T) of the tokens that are not like any plain word, in order."""
        marked = [(i, m) for i, m in enumerate(map(self.mark_of.__getitem__, words)) if m is not None]
        out = {i: self.emission[m] for i, m in marked}
        last = len(words) - 1
        for i, m in marked:
            for at, more in ((i - 1, self.after.get(m, 0.0)), (i + 1, self.before.get(m, 0.0))):
                if more and 0 <= at <= last:
                    out[at] = out.get(at, self.other) + more
        return sorted(out.items())

    def marginals(self, words: list[bytes]) -> list[tuple[int, float]]:
        """(index, P(T)) of the tokens that have a weight."""
        active = self.weights(words)
        if not active:
            return []
        t = np.exp(self.step)
        t00, t01, t10, t11 = (float(x) for x in t.ravel())
        plain1 = math.exp(self.other)
        s0, s1 = (float(x) for x in np.exp(self.start))
        # forward, to each active token
        out, f0, f1, at = [], 0.0, 0.0, -1
        for i, w in active:
            gap = i - at - 1
            if at < 0:
                a0, a1 = s0, s1
                if gap:
                    a0, a1 = s0, s1 * plain1
                    p = self.power(gap - 1)
                    a0, a1 = a0 * p[0] + a1 * p[2], a0 * p[1] + a1 * p[3]
                    a0, a1 = a0 * t00 + a1 * t10, a0 * t01 + a1 * t11
            else:
                p = self.power(gap)
                a0, a1 = f0 * p[0] + f1 * p[2], f0 * p[1] + f1 * p[3]
                a0, a1 = a0 * t00 + a1 * t10, a0 * t01 + a1 * t11
            a1 *= math.exp(w)
            z = a0 + a1
            f0, f1, at = a0 / z, a1 / z, i
            out.append((f0, f1))
        # backward
        p = self.power(len(words) - 1 - active[-1][0])
        b0, b1 = p[0] + p[1], p[2] + p[3]
        result = []
        for k in range(len(active) - 1, -1, -1):
            g0, g1 = out[k][0] * b0, out[k][1] * b1
            result.append((active[k][0], g1 / (g0 + g1)))
            if k:
                e1 = math.exp(active[k][1])
                c0, c1 = t00 * b0 + t01 * e1 * b1, t10 * b0 + t11 * e1 * b1
                p = self.power(active[k][0] - active[k - 1][0] - 1)
                b0, b1 = p[0] * c0 + p[1] * c1, p[2] * c0 + p[3] * c1
                z = b0 + b1
                b0, b1 = b0 / z, b1 / z
        return result[::-1]

    def score(self, words: list[bytes]) -> tuple[float, list[tuple[int, float]]]:
        found = self.marginals(words)
        clean = 0.0
        for _, p in found:
            clean += math.log1p(-min(max(p - self.background, 0.0), 1 - 1e-9))
        return 1.0 - math.exp(clean), found


def plain_marginals(chain: Chain, words: list[bytes]) -> list[float]:
    """Forward-backward over every token, for tests and training."""
    m = [chain.mark_of[w] for w in words]
    near = lambda table, k: table.get(m[k], 0.0) if 0 <= k < len(m) and m[k] is not None else 0.0
    total = [chain.emission.get(x, chain.other) + near(chain.before, i - 1) + near(chain.after, i + 1) for i, x in enumerate(m)]
    e = np.array([[1.0, math.exp(w)] for w in total])
    t = np.exp(chain.step)
    f = np.empty_like(e)
    f[0] = np.exp(chain.start) * e[0]
    f[0] /= f[0].sum()
    for i in range(1, len(words)):
        f[i] = (f[i - 1] @ t) * e[i]
        f[i] /= f[i].sum()
    b = np.ones_like(e)
    for i in range(len(words) - 2, -1, -1):
        b[i] = t @ (e[i + 1] * b[i + 1])
        b[i] /= b[i].sum()
    g = f * b
    return (g[:, 1] / g.sum(axis=1)).tolist()


def find_marks(docs: list[tuple[list[bytes], int]], z: float = 2.6) -> set[bytes]:
    """Words and beginnings that mark toxic documents. Candidates: the lower bound (z standard errors)
    of the ratio of their rates in toxic and clean documents is above 3. Of these, a greedy cover takes
    the one that explains most toxic documents that are not explained yet, less its rate in clean
    ones, down to one document in fifty; frequent candidates that no clean document holds follow."""
    bad, good = Counter(), Counter()
    sets = []
    for words, y in docs:
        kinds = set(words)
        kinds |= {w[:n] + b"*" for w in kinds for n in _STEM if len(w) > n}
        (bad if y else good).update(kinds)
        if y:
            sets.append(kinds)
    n1, n0 = len(sets), len(docs) - len(sets)

    def above(w: bytes, k: int) -> bool:
        ratio = math.log((k + 0.5) / (n1 + 1)) - math.log((good[w] + 0.5) / (n0 + 1))
        return ratio - z * math.sqrt(1 / (k + 0.5) + 1 / (good[w] + 0.5)) > math.log(3)

    fewest = max(3, n1 // 50)
    able = {w for w, k in bad.items() if k >= fewest and above(w, k)}
    left, chosen = [x & able for x in sets], set()
    while left := [x for x in left if x and not x & chosen]:
        cover = Counter(w for x in left for w in x)
        # of equally good ones the longer, which is the more particular
        best = max(cover, key=lambda w: (cover[w] / n1 - good[w] / n0, len(w), w))
        if cover[best] < fewest:
            break
        chosen.add(best)
    return chosen | {w for w in able if not good[w] and bad[w] >= max(8, n1 // 25)}


def _passes(emission: np.ndarray, step: np.ndarray, start: np.ndarray, real: np.ndarray):
    """Forward-backward over padded sequences: (token marginals, pair marginals, log partition function)."""
    e = np.stack([np.ones(emission.shape), np.exp(emission)], axis=2)
    t, longest = np.exp(step), emission.shape[1]
    f, logs = np.empty_like(e), np.zeros(len(e))
    for i in range(longest):
        f[:, i] = (np.exp(start) if i == 0 else f[:, i - 1] @ t) * e[:, i]
        norm = f[:, i].sum(axis=1)
        f[:, i] /= norm[:, None]
        logs += np.where(real[:, i], np.log(norm), 0.0)
    b = np.ones_like(e)
    for i in range(longest - 2, -1, -1):
        nxt = (e[:, i + 1] * b[:, i + 1]) @ t.T
        nxt /= nxt.sum(axis=1, keepdims=True)
        b[:, i] = np.where(real[:, i + 1][:, None], nxt, 1.0)
    g = f * b
    g /= g.sum(axis=2, keepdims=True)
    pair = f[:, :-1, :, None] * t[None, None] * (e[:, 1:] * b[:, 1:])[:, :, None, :]
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    return g[:, :, 1], pair, logs


def fit(
    sequences: list[tuple[list[bytes], list[int]]],
    marks: set[bytes],
    rounds: int = 100,
    l2: float = 0.0002,
    toxic: list[int] | None = None,
    latent_rounds: int = 60,
) -> Chain:
    """Weights from labelled tokens, by adaptive gradient ascent on batches of forward-backward passes. With
    ``toxic`` (the labels of the sequences' documents), followed by rounds in which the tags are latent."""
    marked = sorted(marks)
    number, mark_of = {w: k for k, w in enumerate(marked)}, _MarkOf(marks)
    plain = len(marked)
    longest = max(len(words) for words, _ in sequences)
    ids = np.full((len(sequences), longest + 2), plain)  # with a place before and after
    ys, real = np.zeros((len(sequences), longest), np.int64), np.zeros((len(sequences), longest), bool)
    for k, (words, y) in enumerate(sequences):
        ids[k, 1 : len(words) + 1] = [number.get(mark_of[w], plain) for w in words]
        ys[k, : len(words)], real[k, : len(words)] = y, True
    own, left, right = ids[:, 1:-1], ids[:, :-2], ids[:, 2:]
    value = {
        "emission": np.zeros(plain + 1), "before": np.zeros(plain + 1), "after": np.zeros(plain + 1),
        "step": np.zeros((2, 2)), "start": np.zeros(2),
    }
    both, total = real[:, 1:] & real[:, :-1], real.sum()

    def sums(tags: np.ndarray, pairs: np.ndarray, weight: np.ndarray) -> dict:
        """Expected features of tags (P(T) of each token) and pairs, of sequences with weights."""
        tags = np.where(real, tags, 0.0) * weight[:, None]
        out = {n: np.bincount(at.ravel(), weights=tags.ravel(), minlength=plain + 1) for n, at in (("emission", own), ("before", left), ("after", right))}
        out["step"] = (np.where(both[:, :, None, None], pairs, 0.0) * weight[:, None, None, None]).sum(axis=(0, 1))
        out["start"] = np.array([weight.sum() - tags[:, 0].sum(), tags[:, 0].sum()])
        return out

    one = np.ones(len(sequences))
    seen_pairs = np.zeros((len(sequences), longest - 1, 2, 2))
    rows, cols = np.nonzero(both)
    seen_pairs[rows, cols, ys[rows, cols], ys[rows, cols + 1]] = 1
    seen = sums(ys.astype(float), seen_pairs, one)

    def ascend(times: int, gradient) -> None:
        speed = {n: np.full_like(v, 1e-8) for n, v in value.items()}
        for _ in range(times):
            energy = value["emission"][own] + value["before"][left] + value["after"][right]
            for n, grad in gradient(energy).items():
                grad = grad / total - l2 * value[n] / value[n].size
                if n in ("before", "after"):
                    grad[plain] = 0.0  # a plain neighbour says nothing
                speed[n] += grad * grad
                value[n] += grad / np.sqrt(speed[n])

    def labelled(energy):
        tags, pairs, _ = _passes(energy, value["step"], value["start"], real)
        want = sums(tags, pairs, one)
        return {n: seen[n] - want[n] for n in want}

    ascend(rounds, labelled)
    if toxic is not None:
        y = np.array(toxic, bool)
        clean_pairs = np.zeros((2, 2))
        clean_pairs[0, 0] = 1.0

        def latent(energy):
            tags, pairs, logs = _passes(energy, value["step"], value["start"], real)
            # log P(all O) of each sequence; of toxic ones, the gradient of log(1 - P) is that of log P times -P / (1 - P)
            none = value["start"][0] + value["step"][0, 0] * both.sum(axis=1) - logs
            p = np.exp(np.minimum(none, -1e-9))
            weight = np.where(y, -np.minimum(p / (1 - p), 1e3), 1.0)
            want = sums(tags, pairs, weight)
            has = sums(np.zeros(tags.shape), np.broadcast_to(clean_pairs, pairs.shape), weight)
            return {n: has[n] - want[n] for n in want}

        ascend(latent_rounds, latent)
    weights = {n: {w: float(value[n][k]) for w, k in number.items()} for n in ("emission", "before", "after")}
    return Chain(weights["emission"], float(value["emission"][plain]), value["step"], value["start"], weights["before"], weights["after"])


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT[0] == HELD_OUT[1], F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[tuple[bytes, int]]:
    """(text, toxic) of at most about ``sample`` labelled documents of each kind that are not held out."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("label"))
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    picked = picked.where(F.octet_length("text") > 0)
    found = [(r[0].encode(), r[1]) for r in sampled(picked, "text", sample, SAMPLE_BYTES // 2, known, "doc_id")]
    return found if {y for _, y in found} == {0, 1} else []


#: Training sees so many tokens around each of at most so many places of a document, drawn by a hash of the place.
_AROUND, _PLACES = 4, 5


def _drawn(words: list[bytes], places: list[int]) -> list[int]:
    """Tokens in the windows around the drawn places (any place, where there are none), in order."""
    mix = lambda i: (i * 0x9E3779B97F4A7C15 + len(words) * 0xD6E8FEB86659FD93 & (1 << 64) - 1) >> 20
    chosen = sorted(places, key=mix)[:_PLACES] if places else [mix(0) % len(words)]
    return sorted({k for i in chosen for k in range(max(0, i - _AROUND), min(len(words), i + _AROUND + 1))})


def train(sample: list[tuple[bytes, int]]) -> Chain | None:
    docs = [(tokens(t), y) for t, y in sample]
    if len({y for _, y in docs}) < 2:
        return None
    marks = find_marks(docs)
    if not marks:
        return None
    mark_of = _MarkOf(marks)
    sequences, toxic = [], []
    for words, y in docs:
        at = [i for i, w in enumerate(words) if mark_of[w] is not None]
        if words and (at or not y):  # a toxic document without any mark tells nothing of the words
            piece = [words[k] for k in _drawn(words, at)]
            sequences.append((piece, [int(y and mark_of[w] is not None) for w in piece]))
            toxic.append(y)
    return fit(sequences, marks, toxic=toxic)


def tag(
    docs: DataFrame, chain: Chain | None, doc_id: str = "doc_id", text_col: str = "text", span: float = SPAN
) -> DataFrame:
    """One row per document: doc_id, score, spans (array of start, end, p; code points, end exclusive)."""
    shape = "doc_id long, score double, spans array<struct<start:long,end:long,p:double>>"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))
    shipped = docs.sparkSession.sparkContext.broadcast(chain)

    def spans_of(text: bytes, found: list) -> list[dict]:
        hot = {i: p for i, p in found if p >= span}
        if not hot:
            return []
        out, last = [], None
        places = [(m.start(), m.end()) for m in _WORD.finditer(text)]
        for i in sorted(hot):
            s, e = places[i]
            if last == i - 1:
                out[-1][1], out[-1][2] = e, max(out[-1][2], hot[i])
            else:
                out.append([s, e, hot[i]])
            last = i
        return [
            {"start": len(text[:s].decode()), "end": len(text[:e].decode()), "p": p} for s, e, p in out
        ]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        for batch in batches:
            scores, spans = [], []
            for text in texts(batch.column(1)):
                if model is None or not text:
                    scores.append(0.0)
                    spans.append([])
                    continue
                s, found = model.score(tokens(text))
                scores.append(s)
                spans.append(spans_of(text, found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, kind)], ["doc_id", "score", "spans"]
            )

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(score, shape)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, spans of every document, learnt from the labels not held out."""
    scored = tag(docs, train(training_texts(docs, labels)))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "spans",
    )
