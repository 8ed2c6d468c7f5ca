"""Personal data: exact patterns, extended by a skip-chain conditional random field.

Base spans are those of four patterns (email, ip, card, phone; leftmost, not overlapping within a
kind; a match that fails its check is dropped without another try). The field then labels the other
tokens that hold a digit or an '@':

* nodes: those tokens; labels: O and the four kinds. Node features: the token's shape, its number of
  digits, its marks of punctuation, and the words before and after it;
* chain edges between tokens that follow each other, so that a number written in pieces is one span;
* skip edges between distant tokens of one document with equal or similar text (the same letters and
  digits, or the same last seven digits, also of a number written in pieces): they share a potential that favours equal labels, so that an
  entity which is plain in one place is found where it is written otherwise;
* loopy belief propagation with a bounded number of sweeps gives marginals; a token joins a kind at
  a marginal of at least ``SURE``, adjoining tokens of a kind are one span. Spans that touch a base
  span, or lack what their kind cannot be without (``plausible``), are not added. Tokens that a base span covers are observed: their label is given.

Training is piecewise: node weights by multinomial logistic regression, chain and skip potentials from
smoothed counts of label pairs, on a bounded sample of documents labelled by the base patterns, and by
the skip edges: what is like a found entity is labelled as that entity written otherwise. Shape
features of a training token are left out at random, so that context counts as well.

Offsets are code points, end exclusive. Defined cases: null and empty texts have no spans; repeated rows
get equal results; extra columns are ignored; without any base span in the sample nothing is added.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, bisect_right
from collections import Counter, deque
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sampled, texts

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)
#: Documents that training reads at most; sweeps of belief propagation; marginal that adds a span.
SAMPLE, SWEEPS, SURE = 1500, 12, 0.9
#: Skip edges join a token with at most so many earlier like tokens (a chain of them joins all).
SKIPS = 2

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_CUE = re.compile(r"[0-9@]")
_PIECE = re.compile(r"[0-9@]\S*")
_NUMBER = re.compile(r"[0-9]+")
_TRIM = "\"'`.,;:!?()[]{}<>|*"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        first = at
        while first > done and text[first - 1] in _LOCAL:
            first -= 1
        m = _DOMAIN.match(text, at + 1) if first < at else None
        if m:
            yield first, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, number of the kind), sorted by start, then kind."""
    if not _CUE.search(text):
        return []
    out = [(s, e, 0) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.groups()):
            out.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


def cue_tokens(text: str) -> list[tuple[int, int]]:
    """Blank-separated tokens with a digit or '@', without punctuation at their ends."""
    out, done = [], 0
    for m in _PIECE.finditer(text):
        first, end = m.start(), m.end()
        while first > done and not text[first - 1].isspace():
            first -= 1
        done = end
        while first < end and text[first] in _TRIM and text[first] not in "(":
            first += 1
        while end > first and text[end - 1] in _TRIM and text[end - 1] not in ")":
            end -= 1
        if first < end:
            out.append((first, end))
    return out


def shape(token: str) -> str:
    """Runs of letters as a, digits as 9 (up to four, then +), all else as it is; at most 24 characters."""
    out = re.sub(r"[^\W\d_]+", "a", token)
    return re.sub(r"[0-9]+", lambda m: "9" * len(m[0]) if len(m[0]) <= 4 else "9999+", out)[:24]


def features(text: str, first: int, end: int) -> tuple[list[str], list[str]]:
    """(of the token's own form, of its context)."""
    token = text[first:end]
    digits = sum(c.isdigit() for c in token)
    marks = "".join(sorted({c for c in token if not c.isalnum()}))[:6]
    own = ["s=" + shape(token), f"d={min(digits, 20)}", "m=" + marks, "@" if "@" in token else "-"]
    before = text[max(0, first - 40) : first].split()
    after = text[end : end + 40].split()
    context = [
        "p=" + (before[-1].strip(_TRIM).lower() if before else ""),
        "q=" + (before[-2].strip(_TRIM).lower() if len(before) > 1 else ""),
        "n=" + (shape(after[0]) if after else ""),
        "ps=" + (shape(before[-1]) if before else ""),
    ]
    return own, context


def _digits(text: str) -> str:
    return "".join(_NUMBER.findall(text))


def _alike(token: str, run: str) -> list[str]:
    """Keys under which like tokens meet; ``run``: the digits of the token and of those that it continues."""
    plain = "".join(c for c in token.lower() if c.isalnum() or c == "@")
    keys = ["t" + plain] if len(plain) >= 5 else []
    if len(run) >= 7:
        keys.append("d" + run[-7:])
    return keys


class Field:
    """Node weights (feature -> weights of the labels), chain and skip potentials (5 x 5, logs)."""

    def __init__(self, weights: dict[str, np.ndarray], bias: np.ndarray, chain: np.ndarray, skip: np.ndarray):
        self.weights, self.bias, self.chain, self.skip = weights, bias, chain, skip

    def node(self, text: str, first: int, end: int) -> np.ndarray:
        own, context = features(text, first, end)
        return self.bias + sum((self.weights[f] for f in own + context if f in self.weights), np.zeros(len(LABELS)))


def graph(text: str, tokens: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(chain edges, skip edges) of the tokens."""
    chain = [
        (i, i + 1)
        for i in range(len(tokens) - 1)
        if tokens[i + 1][0] - tokens[i][1] <= 3 and not text[tokens[i][1] : tokens[i + 1][0]].strip(_TRIM + " \t")
    ]
    seen: dict[str, deque] = {}
    skip, chained, run = set(), {j for _, j in chain}, ""
    for i, (s, e) in enumerate(tokens):
        # a number written in pieces is like the same one in other pieces where its last piece ends
        run = (run[-6:] if i in chained else "") + _digits(text[s:e])
        for key in _alike(text[s:e], run):
            last = seen.setdefault(key, deque(maxlen=SKIPS))
            skip.update((j, i) for j in last if j < i - 1 or i not in chained)
            last.append(i)
    return chain, sorted(skip)


def marginals(field: Field, node: np.ndarray, chain, skip, given: dict[int, int], sweeps: int = SWEEPS) -> np.ndarray:
    """Loopy sum-product over the graph: label probabilities of each node. ``given``: observed labels."""
    psi = np.exp(node - node.max(axis=1, keepdims=True))
    for i, label in given.items():
        psi[i] = 1e-12
        psi[i, label] = 1.0
    edges = [(i, j, field.chain) for i, j in chain] + [(i, j, field.skip) for i, j in skip]
    if not edges:
        return psi / psi.sum(axis=1, keepdims=True)
    src = np.array([e[0] for e in edges] + [e[1] for e in edges])
    dst = np.array([e[1] for e in edges] + [e[0] for e in edges])
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    pot = np.exp(np.stack([e[2] for e in edges] + [e[2].T for e in edges]))
    message = np.full((len(src), len(LABELS)), 1.0 / len(LABELS))
    for _ in range(sweeps):
        logs = np.log(psi)
        np.add.at(logs, dst, np.log(message))
        out = logs[src] - np.log(message[back])  # all that comes to the source, but from the destination
        out = np.exp(out - out.max(axis=1, keepdims=True))
        new = np.einsum("ea,eab->eb", out, pot)
        new /= new.sum(axis=1, keepdims=True)
        moved = np.abs(new - message).max()
        message = 0.3 * message + 0.7 * new
        if moved < 1e-4:
            break
    logs = np.log(psi)
    np.add.at(logs, dst, np.log(message))
    out = np.exp(logs - logs.max(axis=1, keepdims=True))
    return out / out.sum(axis=1, keepdims=True)


def _observed(tokens: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> dict[int, int]:
    """Labels of the tokens that base spans cover or touch; the first of several spans counts."""
    out, ends = {}, [e for _, e in tokens]
    for s, e, kind in base:
        i = bisect_right(ends, s)  # the first token that ends behind the span's start
        while i < len(tokens) and tokens[i][0] < e:
            out.setdefault(i, kind + 1)
            i += 1
    return out


def plausible(span: str, kind: int) -> bool:
    """Whether a span has what its kind cannot be without, however it is written: '@' within an email, four
    numbers up to 255 in an ip, 12 to 19 digits in a card, 9 to 15 in a phone."""
    if kind == 0:
        return "@" in span[1:-1]
    numbers = _NUMBER.findall(span)
    if kind == 1:
        return len(numbers) == 4 and all(len(n.lstrip("0")) <= 3 and int(n) <= 255 for n in numbers)
    digits = sum(map(len, numbers))
    return 12 <= digits <= 19 if kind == 2 else 9 <= digits <= 15


def _carried(text: str, tokens, given: dict[int, int], chain, skip, base) -> dict[int, int]:
    """``given`` carried along the skip edges: a token like one of an entity is taken for the same entity written
    otherwise, with the pieces before it that the entity's digits end with."""
    out, ends = dict(given), [e for _, e, _ in base]
    whole = {}
    for i in given:
        k = bisect_right(ends, tokens[i][0])
        whole[i] = _digits(text[base[k][0] : base[k][1]]) if k < len(base) else ""
    chained = {j for _, j in chain}
    for edges in (skip, skip[::-1]):
        for pair in edges:
            for j, i in (pair, pair[::-1]):
                if j not in out or i in out:
                    continue
                out[i], whole[i] = out[j], whole[j]
                at, run = i, _digits(text[slice(*tokens[i])])
                while at in chained and at - 1 not in out and (piece := _digits(text[slice(*tokens[at - 1])])) and whole[i].endswith(piece + run):
                    at, run = at - 1, piece + run
                    out[at], whole[at] = out[i], whole[i]
    return out


def train(sample: list[str], seed: int = 5, rounds: int = 120) -> Field | None:
    """Piecewise training on texts that the base patterns label."""
    rnd = random.Random(seed)
    rows, labels, chains, skips = [], [], Counter(), Counter()
    for text in sample:
        tokens = cue_tokens(text)
        base = base_spans(text)
        chain, skip = graph(text, tokens)
        given = _carried(text, tokens, _observed(tokens, base), chain, skip, base)
        for i, (s, e) in enumerate(tokens):
            own, context = features(text, s, e)
            rows.append([f for f in own if rnd.random() > 0.2] + context)
            labels.append(given.get(i, 0))
        for edges, count in ((chain, chains), (skip, skips)):
            count.update((given.get(i, 0), given.get(j, 0)) for i, j in edges)
    if not any(labels):
        return None
    seen = Counter(f for r in rows for f in r)
    number = {f: k for k, f in enumerate(sorted(f for f, n in seen.items() if n >= 3))}
    y = np.array(labels)
    width = max(len(r) for r in rows)
    at = np.full((len(rows), width), len(number))
    for i, r in enumerate(rows):
        known = [number[f] for f in r if f in number]
        at[i, : len(known)] = known
    w, bias = np.zeros((len(number) + 1, len(LABELS))), np.zeros(len(LABELS))
    speed = np.full_like(w, 1e-6), np.full_like(bias, 1e-6)
    hot = np.eye(len(LABELS))[y]
    for _ in range(rounds):
        z = w[at].sum(axis=1) + bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        gap = (hot - p) / len(y)
        grad = np.zeros_like(w)
        np.add.at(grad, at, gap[:, None, :].repeat(width, axis=1))
        grad[-1] = 0
        for value, g, s in ((w, grad - 1e-5 * w, speed[0]), (bias, gap.sum(axis=0), speed[1])):
            s += g * g
            value += 0.5 * g / np.sqrt(s)

    def potential(count: Counter, same: float) -> np.ndarray:
        """log of how often labels meet, against independence; smoothed, with a prior for equal ones."""
        n = len(LABELS)
        met = np.array([[count[(a, b)] + count[(b, a)] for b in range(n)] for a in range(n)], float)
        met += 1.0 + same * np.eye(n)
        return np.log(met / met.sum()) - np.log(np.outer(met.sum(axis=1), met.sum(axis=0)) / met.sum() ** 2)

    return Field({f: w[k] for f, k in number.items()}, bias, potential(chains, 1.0), potential(skips, 5.0))


def added_spans(text: str, field: Field | None, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that the field adds to the base spans."""
    if field is None:
        return []
    tokens = cue_tokens(text)
    given = _observed(tokens, base)
    if len(given) == len(tokens):
        return []
    chain, skip = graph(text, tokens)
    # only what is tied to a plausible token needs messages; the rest is decided by its own features
    node = np.stack([field.node(text, s, e) for s, e in tokens])
    p = marginals(field, node, chain, skip, given)
    best, linked, out, last = p.argmax(axis=1), set(chain), [], None
    for i, (s, e) in enumerate(tokens):
        kind = int(best[i])
        if i in given or not kind or p[i, kind] < SURE:
            continue
        if last is not None and last[0] == i - 1 and (i - 1, i) in linked and last[1] == kind:
            out[-1] = (out[-1][0], e, kind - 1)
        else:
            out.append((s, e, kind - 1))
        last = (i, kind)
    starts, reach = [b[0] for b in base], list(accumulate((b[1] for b in base), max))
    touches = lambda s, e: (k := bisect_left(starts, e)) and reach[k - 1] > s
    return [x for x in out if plausible(text[x[0] : x[1]], x[2]) and not touches(x[0], x[1])]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], x[2], x[1])))


def sample_texts(docs: DataFrame, text_col: str, sample: int = SAMPLE) -> list[str]:
    """At most ``sample`` distinct texts that have a base-like cue, by a hash of the text."""
    rows = docs.select(F.col(text_col).cast("string").alias("text")).where(F.col("text").rlike(r"@|\+[0-9]|[0-9]{4}"))
    return [r[0] for r in sampled(rows, "text", sample)]


_SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"


def find(
    docs: DataFrame, doc_id: str = "doc_id", text_col: str = "text", field: Field | None = None, sample: int = SAMPLE
) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all,
    as text), found (all, as an array)."""
    if field is None:
        field = train(sample_texts(docs, text_col, sample))
    shipped = docs.sparkSession.sparkContext.broadcast(field)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
    empty = hashlib.sha256(b"").hexdigest()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        for batch in batches:
            counts, hashes, every, found = [[] for _ in KINDS], [], [], []
            for raw in texts(batch.column(1)):
                text = raw.decode() if raw else ""
                base = base_spans(text)
                more = added_spans(text, model, base) if text and _CUE.search(text) else []
                for k in range(len(KINDS)):
                    counts[k].append(sum(s[2] == k for s in base))
                hashes.append(hashlib.sha256(joined(base).encode()).hexdigest() if base else empty)
                every.append(joined(base + more))
                found.append(
                    [{"kind": KINDS[k], "start": s, "end": e, "base": True} for s, e, k in base]
                    + [{"kind": KINDS[k], "start": s, "end": e, "base": False} for s, e, k in more]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(c, pa.int64()) for c in counts),
                    pa.array(hashes, pa.string()),
                    pa.array(every, pa.string()),
                    pa.array(found, kind),
                ],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "found"],
            )

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counted = ", ".join(f"n_{k} long" for k in KINDS)
    return narrow.mapInArrow(search, f"doc_id long, {counted}, base_sha256 string, spans string, found {_SPANS}")
