"""Personal data by a semi-Markov conditional random field over candidate segments.

Candidates are whole spans: base matches, e-mail addresses written out, and
runs of up to ``MAX_GROUPS`` neighbouring digit groups, each with the types
it may have. A segment's score is the product of its features (digit count,
check digit, parts, separators, group shape, the words before it) and the
weights of its type; text outside segments scores 0. The entity length is
bounded, so the dynamic programs over the candidates of a text are linear in
them: log-sum for training, maximum for the joint choice of boundaries and
types.

Training is on a bounded sample of texts with partial labels: base spans are
certain, candidates that fail a base check (a part over 255, a wrong check
digit) are certainly none, all others are open. The gradient is the
difference of the segments' marginals with and without these constraints;
weights are drawn to ``PRIOR``, which also holds where nothing is learned.

The base kinds are found by linear scans, exactly as leftmost non-overlapping
matches of their patterns with failing matches dropped. They always stay; the
field adds spans that overlap none of them.

Defined results: null text as empty; repeated rows each get their row; an
empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import map_blocks, texts

KINDS = ("email", "ip", "card", "phone")
#: Texts the weights are fitted on, chosen by a hash of doc_id.
SAMPLE_TEXTS = 1500
#: Digit groups of one segment at most.
MAX_GROUPS = 8
PASSES, RATE, PULL = 25, 0.3, 0.05

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_RUN = re.compile(r"[+(]?[0-9](?:[\x20().-]{0,2}[0-9])+")
_GROUP = re.compile(r"[0-9]+")
_SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{1,63}){1,4}", re.IGNORECASE | re.ASCII)
_AT = re.compile(r"at[)\]]", re.IGNORECASE | re.ASCII)

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_GROUP.findall(text))


def _count_digits(text: str, a: int, b: int, stop: int) -> int:
    """The digits of a span, or ``stop`` or more once there are so many."""
    n = 0
    for m in _GROUP.finditer(text, a, b):
        n += m.end() - m.start()
        if n >= stop:
            break
    return n


def base_matches(text: str) -> list[tuple[str, int, int, bool]]:
    """All matches of the base patterns with whether they pass their check."""
    out = []
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append(("email", start, m.end(), True))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in _DOTTED.finditer(text):
        groups = list(_GROUP.finditer(text, *m.span())) if text.find(".", *m.span()) >= 0 else []
        for k in range(0, len(groups) - 3, 4):
            four = groups[k : k + 4]
            out.append(("ip", four[0].start(), four[3].end(), all(len(g[0].lstrip("0")) <= 3 and int(g[0].lstrip("0") or 0) <= 255 for g in four)))
    for m in _CARD.finditer(text):
        d = _digits(m[0]) if m.end() - m.start() <= 64 else ""
        out.append(("card", *m.span(), 16 <= len(d) <= 19 and luhn(d)))
    for m in _PHONE.finditer(text):
        out.append(("phone", *m.span(), 8 <= _count_digits(text, *m.span(), 16) <= 15))
    return out


def base_spans(text: str) -> list[Span]:
    """Base spans by kind as listed, then start."""
    return sorted(((k, a, b) for k, a, b, ok in base_matches(text) if ok), key=lambda s: (KINDS.index(s[0]), s[1]))


#: The features of a segment; each type has a weight for each.
FEATURES = ("bias", "base", "fails", "spelled", "plus", "bracket", "luhn", "parts", "few", "d7_11", "d12_15", "d16_19", "many", "g334", "g4444", "mixed", "free", "said_phone", "said_card", "said_ip", "said_mail")
#: Starting weights by type; all others are 0.
PRIOR = {
    "email": {"bias": -4.0, "base": 9.0, "spelled": 6.0, "said_mail": 2.0},
    "ip": {"bias": -6.0, "base": 9.0, "fails": -8.0, "parts": 2.0, "free": 0.5, "said_ip": 3.0},
    "card": {"bias": -6.0, "base": 9.0, "fails": -8.0, "luhn": 1.5, "d16_19": 2.0, "g4444": 1.0, "free": 0.5, "said_card": 3.0},
    "phone": {"bias": -6.0, "base": 9.0, "fails": -6.0, "plus": 1.0, "bracket": 1.0, "d7_11": 1.5, "g334": 2.0, "mixed": 0.5, "free": 0.5, "few": -4.0, "many": -4.0, "said_phone": 3.0},
}
_SAID = {
    "said_phone": re.compile(r"(?:phone|tel|call|mobile|fax|cell)[^A-Za-z0-9]{0,4}$", re.IGNORECASE | re.ASCII),
    "said_card": re.compile(r"(?:card|visa|mastercard|amex)[^A-Za-z0-9]{0,4}$", re.IGNORECASE | re.ASCII),
    "said_ip": re.compile(r"(?:ip|host|address|server)[^A-Za-z0-9]{0,4}$", re.IGNORECASE | re.ASCII),
    "said_mail": re.compile(r"(?:mail|contact|write to)[^A-Za-z0-9]{0,4}$", re.IGNORECASE | re.ASCII),
}


def prior() -> np.ndarray:
    return np.array([[PRIOR[k].get(f, 0.0) for f in FEATURES] for k in KINDS])


def _describe(text: str, a: int, b: int, kind: str, flags: dict[str, bool]) -> np.ndarray:
    span = text[a:b]
    groups = [len(g) for g in _GROUP.findall(span)]
    d = _digits(span)
    n = len(d) if kind != "email" else 0
    before = text[max(0, a - 16) : a]
    has = flags | {
        "bias": True,
        "plus": span[:1] == "+",
        "bracket": "(" in span and kind != "email",
        "luhn": 12 <= n <= 19 and luhn(d),
        "parts": span.count(".") == 3 and len(groups) == 4,
        "few": 0 < n < 7,
        "d7_11": 7 <= n <= 11,
        "d12_15": 12 <= n <= 15,
        "d16_19": 16 <= n <= 19,
        "many": n > 19,
        "g334": groups[-3:] == [3, 3, 4],
        "g4444": groups == [4, 4, 4, 4],
        "mixed": len(set(span) & set(" ().-")) > 1,
        "free": not text[a - 1 : a].isalnum() and not text[b : b + 1].isalnum(),
    } | {k: bool(r.search(before)) for k, r in _SAID.items()}
    return np.array([float(has.get(f, False)) for f in FEATURES])


class Lattice:
    """The candidate segments of a text, by end; ``label`` is 1 (certain), 0 (none) or -1 (open)."""

    def __init__(self, text: str, matches: list[tuple[str, int, int, bool]]) -> None:
        found: dict[Span, dict[str, bool]] = {}
        label: dict[Span, int] = {}
        for kind, a, b, ok in matches:
            if b - a <= 256:
                found[kind, a, b] = {"base": ok, "fails": not ok}
                label[kind, a, b] = int(ok)
        for m in _SPELLED.finditer(text):
            found.setdefault(("email", *m.span()), {"spelled": True})
        for m in _RUN.finditer(text):
            if m.end() - m.start() < 7:
                continue
            groups = list(_GROUP.finditer(text, *m.span()))
            for i in range(len(groups)):
                a = groups[i].start()
                if i == 0:
                    a = m.start()
                elif text[a - 1] == "(":
                    a -= 1
                for j in range(i, min(len(groups), i + MAX_GROUPS)):
                    b = groups[j].end()
                    if 7 <= b - a <= 48:
                        for kind in ("phone", "card") if j - i != 3 or text.count(".", a, b) != 3 else ("ip",):
                            found.setdefault((kind, a, b), {})
        self.spans = sorted(found, key=lambda s: (s[2], s[1], KINDS.index(s[0])))
        self.kinds = np.array([KINDS.index(s[0]) for s in self.spans], np.int64)
        self.x = np.array([_describe(text, a, b, k, found[k, a, b]) for k, a, b in self.spans]).reshape(len(self.spans), len(FEATURES))
        self.label = np.array([label.get(s, -1) for s in self.spans], np.int64)
        ends = np.array([s[2] for s in self.spans], np.int64)
        starts = np.array([s[1] for s in self.spans], np.int64)
        #: How many segments end before each one starts: the state it continues.
        self.before = np.searchsorted(ends, starts, "right").tolist()
        self.starts = starts

    def scores(self, w: np.ndarray) -> np.ndarray:
        return np.einsum("nf,nf->n", self.x, w[self.kinds])

    def marginals(self, s: np.ndarray) -> np.ndarray:
        """The probability of each segment by the forward and the backward log-sum."""
        n = len(s)
        fwd = [0.0] * (n + 1)
        for i in range(n):
            fwd[i + 1] = _logadd(fwd[i], fwd[self.before[i]] + s[i])
        bwd = [-math.inf] * (n + 1)
        bwd[n] = 0.0
        for i in range(n - 1, -1, -1):
            bwd[i] = _logadd(bwd[i], bwd[i + 1])
            bwd[self.before[i]] = _logadd(bwd[self.before[i]], s[i] + bwd[i + 1])
        return np.exp([fwd[self.before[i]] + s[i] + bwd[i + 1] - fwd[n] for i in range(n)])

    def best(self, s: np.ndarray) -> list[Span]:
        """The set of non-overlapping segments of highest score."""
        n = len(s)
        top = [0.0] * (n + 1)
        took = [False] * n
        for i in range(n):
            with_ = top[self.before[i]] + s[i]
            took[i] = with_ > top[i]
            top[i + 1] = max(top[i], with_)
        out, i = [], n
        while i:
            if took[i - 1]:
                out.append(self.spans[i - 1])
                i = self.before[i - 1]
            else:
                i -= 1
        return out[::-1]

    def gradient(self, w: np.ndarray) -> np.ndarray:
        s = self.scores(w)
        # Constraints: certain segments get a bonus none can beat, refuted ones can't be chosen.
        held = np.where(self.label == 1, s + 50.0, np.where(self.label == 0, -1e9, s))
        difference = self.marginals(held) - self.marginals(s)
        out = np.zeros_like(w)
        np.add.at(out, self.kinds, difference[:, None] * self.x)
        return out


def _logadd(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def fit(sample: list[str]) -> np.ndarray:
    """Weights (types, features) by AdaGrad on the partial-label likelihood."""
    start = prior()
    lattices = [x for x in (Lattice(t, base_matches(t)) for t in sorted(sample)) if len(x.spans)]
    w, seen = start.copy(), np.full_like(start, 1e-2)
    for _ in range(PASSES if lattices else 0):
        g = sum((x.gradient(w) for x in lattices), np.zeros_like(w)) / len(lattices) - PULL * (w - start)
        seen += g * g
        w += RATE * g / np.sqrt(seen)
    return w


def all_spans(text: str, w: np.ndarray) -> list[Span]:
    """Base spans and those that the field adds, by kind as listed, then start."""
    matches = base_matches(text)
    base = [(k, a, b) for k, a, b, ok in matches if ok]
    if not matches and not ((")" in text or "]" in text) and _AT.search(text)) and not _RUN.search(text):
        return []
    lattice = Lattice(text, matches)
    if not len(lattice.spans):
        return sorted(base, key=lambda s: (KINDS.index(s[0]), s[1]))
    busy = sorted((a, b) for _, a, b in base)
    starts = np.array([a for a, _ in busy], np.int64)
    reach = np.maximum.accumulate([b for _, b in busy]) if busy else np.zeros(0, np.int64)
    added = []
    for k, a, b in lattice.best(lattice.scores(w)):
        i = int(np.searchsorted(starts, b)) - 1
        if i < 0 or reach[i] <= a:
            added.append((k, a, b))
    return sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def sample_texts(docs: DataFrame, limit: int = SAMPLE_TEXTS) -> list[str]:
    """At most ``limit`` whole texts, by a hash of doc_id and text length (a bounded sort: top rows of each task)."""
    ids = docs.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    found = texts(docs.where(F.col("text").isNotNull())).join(F.broadcast(chosen), "doc_id", "left_semi").collect()
    return [t for _, t in sorted({r["doc_id"]: r["text"] for r in sorted(found, key=lambda r: r["text"])}.items())]


def find_personal_data(docs: DataFrame, w: np.ndarray | None = None) -> DataFrame:
    """``doc_id, spans array<struct<kind,start,stop>>, n_base`` of every row; weights are fitted unless given."""
    if w is None:
        w = fit(sample_texts(docs))

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans, base = [], []
        for t in batch.column("text").to_pylist():
            spans.append([{"kind": k, "start": a, "stop": b} for k, a, b in all_spans(t, w)])
            base.append([{"kind": k, "start": a, "stop": b} for k, a, b in base_spans(t)] if spans[-1] else [])
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind), pa.array(base, kind)], ["doc_id", "spans", "base"])

    span = "array<struct<kind:string,start:int,stop:int>>"
    return map_blocks(texts(docs), block, f"doc_id bigint, spans {span}, base {span}")


def span_digests(found: DataFrame) -> DataFrame:
    joined = lambda c: F.concat_ws(",", F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def base_digest(text: str) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(text)).encode()).hexdigest()
