"""Personal data: proposed spans, boosted trees over format and context, calibrated selection.

Strict patterns give the base spans, which always stay. Generators with high
recall propose further, overlapping spans (keys, passwords, local numbers,
identifiers). Gradient-boosted trees score each proposal by its format and the
text around it; they learn from the base spans, from values that stand behind
a keyword (numbers: a keyword of their kind), and from the matches that fail
all checks and touch no proposed number. Scores are calibrated
on documents that the trees didn't see, and the smallest threshold that keeps
the wanted precision there selects what is added.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

KINDS = ("email", "ip", "card", "phone")
#: Kinds of added spans, in their order after the base ones.
ADDED = ("local_phone", "id_number", "secret")
#: Expected bound on the documents that the trees are trained on.
SAMPLE_ROWS = 20_000
PRECISION = 0.98

_AT = re.compile("@")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TEL = re.compile(r"\(?(?<![0-9+])[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}(?![0-9])")
_ID = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])|\b[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}\b")
_LONG = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_ASSIGNED = re.compile(r"""(?i)(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)["']?\s{0,3}[:=]\s{0,3}["']?([^\s"']{6,})""")
_KEY = re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}$")
_KEYWORDS = (
    re.compile(r"(?i)passw|pwd|secret|token|key|login|auth"),
    re.compile(r"(?i)tel|phone|call|fax|mobile"),
    re.compile(r"(?i)card|visa|iban|account|ssn|passport"),
)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the address pattern, each found from its at sign in linear time."""
    end = 0
    for m in _AT.finditer(text):
        at = start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """The spans of the strict patterns by kind and start, and matches that surely hold none."""
    kept, failed = [], []
    if "@" in text:
        kept += [("email", a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            good = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))
            (kept if good else failed).append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            d = _digits(m[0]) if m.end() - m.start() < 64 else ""
            good = 13 <= len(d) <= 19 and luhn(d)
            if good or 6 < len(d) <= 19:  # a longer match may hold a number and more
                (kept if good else failed).append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                d = _digits(m[0])
                if len(d) <= 15:
                    (kept if len(d) >= 9 else failed).append(("phone", *m.span()))
    return kept, failed


def proposals(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, weak label) of added candidates that touch no base span; they may overlap one another."""
    out: list[tuple[str, int, int, int]] = []
    # A number behind a keyword of its kind is a positive; without one it is neither, like a long word behind a keyword of secrets.
    named = lambda m, k: 1 if _KEYWORDS[k].search(text[max(0, m.start() - 24) : m.start()]) else -1
    assigned = {m.span(1) for m in _ASSIGNED.finditer(text)} if "=" in text or ":" in text else set()
    out += [("secret", a, b, 1) for a, b in assigned]
    inside = lambda a, b: any(x < b and a < y for x, y in assigned)
    for m in _LONG.finditer(text):
        # A run of digits alone is proposed only if it could be a card number.
        if m.span() not in assigned and not (m[0].isdigit() and not (len(m[0]) <= 19 and luhn(m[0]))):
            out.append(("secret", *m.span(), 1 if _KEY.match(m[0]) or inside(*m.span()) else min(0, -named(m, 0))))
    if _DIGIT.search(text):
        out += [("local_phone", *m.span(), named(m, 1)) for m in _TEL.finditer(text)]
        out += [("id_number", *m.span(), named(m, 2)) for m in _ID.finditer(text)]
    if not base:
        return out
    return [c for c in out if not any(x < c[2] and c[1] < y for _, x, y in base)]


def features(text: str, start: int, end: int) -> list[float]:
    """Format of the span, and what stands around it."""
    s = text[start : min(end, start + 256)]
    n = max(1, len(s))
    digits = sum("0" <= c <= "9" for c in s)
    upper, lower = sum(c.isupper() for c in s), sum(c.islower() for c in s)
    hexes = sum(c in "0123456789abcdefABCDEF" for c in s)
    counts = [s.count(c) for c in set(s)]
    entropy = -sum(c / n * math.log2(c / n) for c in counts)
    switches = sum(("0" <= a <= "9") != ("0" <= b <= "9") for a, b in zip(s, s[1:]))
    before, after = text[max(0, start - 24) : start], text[end : end + 8]
    return [
        end - start, digits / n, upper / n, lower / n, hexes / n, entropy, switches / n, len(counts) / n,
        sum(c in " -.()" for c in s) / n, float("@" in s), float(s[:1] == "+"), float(digits >= 13 and luhn(_digits(s))),
        float(before[-1:] in "=\"':"  and before != ""), float(before[-1:].isspace() or before == ""),
        float(after[:1].isspace() or after == ""), *[float(bool(k.search(before))) for k in _KEYWORDS],
    ]


class Boosted:
    """Gradient-boosted trees of fixed depth on binned features, with a calibrated logistic output."""

    def __init__(self, trees: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32) -> None:
        self.trees, self.depth, self.rate, self.bins = trees, depth, rate, bins
        self.made: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.edges: list[np.ndarray] = []
        self.start, self.slope, self.shift, self.threshold = 0.0, 1.0, 0.0, 1.1

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(self.edges)], 1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        self.edges = [np.unique(np.quantile(c, np.arange(1, self.bins) / self.bins)) for c in x.T]
        b = self._binned(x)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        f = np.full(len(y), self.start)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-f))
            g, h = p - y, p * (1 - p)
            node = np.zeros(len(y), np.int64)
            feature, cut = np.full(2**self.depth - 1, -1), np.zeros(2**self.depth - 1, np.int64)
            for level in range(self.depth):
                base, width = 2**level - 1, 2**level
                best = np.full(width, 1e-6)
                for k in range(b.shape[1]):
                    cell = node * self.bins + b[:, k]
                    sums = [np.bincount(cell, v, width * self.bins).reshape(width, self.bins).cumsum(1) for v in (g, h)]
                    gl, hl = sums
                    gt, ht = gl[:, -1:], hl[:, -1:]
                    gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                    at = gain.argmax(1)
                    won = gain[np.arange(width), at] > best
                    best[won] = gain[np.arange(width), at][won]
                    feature[base : base + width][won], cut[base : base + width][won] = k, at[won]
                node = self._step(b, node, feature, cut, base)
            leaf = -self.rate * np.bincount(node, g, 2**self.depth) / (np.bincount(node, h, 2**self.depth) + 1)
            self.made.append((feature, cut, leaf))
            f += leaf[node]

    @staticmethod
    def _step(b: np.ndarray, node: np.ndarray, feature: np.ndarray, cut: np.ndarray, base: int) -> np.ndarray:
        k = feature[base + node]
        right = (k >= 0) & (b[np.arange(len(b)), np.maximum(k, 0)] > cut[base + node])
        return node * 2 + right

    def raw(self, x: np.ndarray) -> np.ndarray:
        b, out = self._binned(x), np.full(len(x), self.start)
        for feature, cut, leaf in self.made:
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                node = self._step(b, node, feature, cut, 2**level - 1)
            out += leaf[node]
        return out

    def calibrate(self, x: np.ndarray, y: np.ndarray, precision: float) -> None:
        """A logistic curve over the raw scores, and the least threshold that keeps the precision on these rows."""
        f = self.raw(x)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(self.slope * f + self.shift, -35, 35)))
            h = p * (1 - p) + 1e-6
            grad = np.array([((p - y) * f).sum() + (self.slope - 1), (p - y).sum()])
            hess = np.array([[(h * f * f).sum() + 1, (h * f).sum()], [(h * f).sum(), h.sum()]])
            self.slope, self.shift = np.array([self.slope, self.shift]) - 0.5 * np.linalg.solve(hess + 1e-6 * np.eye(2), grad)
        p = self.probability(x)
        order = np.argsort(-p, kind="stable")
        good = np.cumsum(y[order]) / np.arange(1, len(y) + 1) >= precision
        good[:-1] &= p[order][1:] < p[order][:-1]  # equal scores are kept or left together
        last = np.flatnonzero(good)
        self.threshold = max(0.5, float(p[order][last[-1]])) if len(last) and y.sum() else 1.1

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(x) + self.shift, -35, 35)))


def _examples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for fold, text in zip(b["fold"], b["text"]):
            base, failed = base_spans(text)
            proposed = proposals(text, base)
            numbers = [(a, z) for kind, a, z, _ in proposed if kind != "secret"]
            clear = lambda x, y: not any(a < y and x < z for a, z in numbers)
            failed = [s for s in failed if clear(*s[1:])]
            for label, spans in ((1, base), (0, failed)):
                out += [(fold, label, features(text, a, z)) for _, a, z in spans]
            out += [(fold, y, features(text, a, z)) for _, a, z, y in proposed if y == 1 or y == 0 and clear(a, z)]
        yield pd.DataFrame(out, columns=["fold", "label", "x"])


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, precision: float = PRECISION) -> Boosted:
    """Trees from about ``sample_rows`` documents, those with the smallest hashes of their text.

    Every other one (by hash) is held out for the calibration. Without both
    labels in both halves nothing is added to the base spans.
    """
    texts = docs.select("text").where("text is not null")
    n = texts.count()
    cut = min(int(-(2**63) + min(1.0, sample_rows / max(1, n)) * (2**64 - 1)), 2**63 - 1)
    h = F.xxhash64("text")
    chosen = texts.where(h <= F.lit(cut)).select("text", F.pmod(h, F.lit(2)).cast("int").alias("fold"))
    rows = chosen.mapInPandas(_examples, "fold int, label int, x array<double>")

    def learn(made: pd.DataFrame) -> pd.DataFrame:
        import pickle

        x, y, fold = np.stack(made["x"]), made["label"].to_numpy(np.float64), made["fold"].to_numpy()
        order = np.lexsort((*x.T, y, fold))  # the same trees whatever order the rows come in
        x, y, fold = x[order], y[order], fold[order]
        model = Boosted()
        if all(len(set(y[fold == k])) == 2 for k in (0, 1)):
            model.fit(x[fold == 0], y[fold == 0])
            model.calibrate(x[fold == 1], y[fold == 1], precision)
        return pd.DataFrame({"model": [pickle.dumps(vars(model))]})

    got = rows.withColumn("all", F.lit(1)).groupBy("all").applyInPandas(learn, "model binary").collect()
    model = Boosted()
    if got:
        import pickle

        vars(model).update(pickle.loads(bytes(got[0]["model"])))
    return model


def select(candidates: list[tuple[str, int, int]], p: np.ndarray, threshold: float) -> list[tuple[str, int, int]]:
    """The likeliest of overlapping candidates that reach the threshold."""
    taken: list[tuple[str, int, int]] = []
    for k in sorted(range(len(candidates)), key=lambda k: (-p[k], candidates[k][1], -candidates[k][2], candidates[k][0])):
        kind, a, b = candidates[k]
        if p[k] >= threshold and not any(x < b and a < y for _, x, y in taken):
            taken.append((kind, a, b))
    return sorted(taken, key=lambda s: (ADDED.index(s[0]), s[1]))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each run of covered characters replaced by the kind of its first span."""
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"[{kind}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def find(docs: DataFrame, model: Boosted | None = None) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: counts, ``base_sha256``, ``spans`` and ``redacted``.

    Null texts are empty ones: no span, and the checksum of an empty list.
    Positions are code points, ends exclusive. Equal texts have equal spans.
    An empty table gives no row.
    """
    model = model or train(docs)
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Boosted()
        vars(model).update(sent.value)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            bases, asked, xs = [], [], []
            for t in texts:
                base, _ = base_spans(t)
                bases.append(base)
                own = [c[:3] for c in proposals(t, base)] if model.made else []
                asked.append(own)
                xs += [features(t, a, z) for _, a, z in own]
            p = model.probability(np.array(xs)) if xs else np.zeros(0)
            rows, at = [], 0
            for t, base, own in zip(texts, bases, asked):
                added = select(own, p[at : at + len(own)], model.threshold)
                at += len(own)
                written = [f"{k}:{a}:{z}" for k, a, z in base]
                rows.append(
                    (
                        *[sum(k == kind for k, _, _ in base) for kind in KINDS],
                        hashlib.sha256(",".join(written).encode()).hexdigest(),
                        ",".join(written + [f"{k}:{a}:{z}" for k, a, z in added]),
                        redact(t, base + added),
                    )
                )
            made = list(zip(*rows)) or [()] * 7
            columns = [pa.array(x, pa.int64()) for x in made[:4]] + [pa.array(x, pa.string()) for x in made[4:]]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *columns], ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "redacted"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, {counts}, base_sha256 string, spans string, redacted string")
