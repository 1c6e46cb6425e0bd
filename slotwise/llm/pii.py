"""Personal data (op 4): candidate generation, boosted trees over format and context, calibrated thresholds.

Generators with high recall propose overlapping spans: anything around an at sign or its spelled-out forms, dotted
numbers and IPv6 groups, and runs of digits with the separators of phone and card numbers, each as every kind it could
be. Base patterns (below) always stay; a selected span may cover some, as a mail address whose first letters are not ASCII
does. Of the other candidates, boosted trees decide from the form of the span
and the words before it; the threshold of each kind is the lowest at which the examples of held-out texts reach PRECISION.

The trees and thresholds come from all documents. The trees see of a number only between which of the BINS quantiles of
all training examples it lies; Spark finds these quantiles, exactly, puts the numbers into their bins and counts equal examples,
which loses nothing that the trees would use. The different ones are few and go to the driver with the number of their copies.
Should more than MAX_ROWS remain, every other quantile is taken, so that no example is left out. Examples
come from base spans in their own surroundings, as they are, in other spellings and as IPv6 addresses, cards of 13 to 15
digits or addresses with letters outside ASCII (positive), and from candidates that fail the checks of the base rules, or
numbers of other meaning put in their place (negative). A valid candidate of a form that no base pattern has is neither.

Defined results: a null text is empty and has no spans; repeated rows and rows without an id each keep their row; without
base spans nothing is added, nor is anything of a kind that occurs in a single text; extra columns are dropped; an empty table gives no rows. All patterns scan in
time linear in the text.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from ipaddress import IPv6Address

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.boosting import Trees, fit, precise_threshold
from slotwise.llm.common import pick, pieces, prepare, texts
from slotwise.llm.spans import Span, apart, digest, joined, masked
from slotwise.session import stored

# Kinds and base patterns. Look-behinds and possessive runs keep the scan linear and change no match.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

_AT = re.compile(r"@|\x20?[(\[]at[)\]]\x20?", re.I | re.A)
_HOST = re.compile(r"[^\W_][\w-]*+(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[\w-]++)*", re.I)
_DOTTED = re.compile(r"(?<![0-9.])[0-9]++(?:\.[0-9]++){2,5}")
_SIX = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_NUMBER = re.compile(r"[+(]?[0-9](?:[\x20().-]{0,2}[0-9])+")
_PART = re.compile(r"[^\x20]+")
_SIGN = re.compile(r"[0-9@:]")

KIND_WEIGHT = 5000  # a kind with more examples weighs no more than so many, so that a rare kind is not drowned
BINS = 64  # a power of two; what the trees are fitted over
MAX_ROWS = 200_000  # different examples that the driver fits on
PRECISION = 0.98
CONTEXT = 40
FOLDS = 4  # one text in so many is held out for the thresholds
CELL_BITS = 20  # texts are held out by the upper 12 bits of their crc32
# Words that speak for a kind when they stand before a span.
CLUES = {
    "email": ("mail", "contact", "write", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "ping"),
    "card": ("card", "visa", "credit", "tarjeta", "karte", "carte"),
    "phone": ("phone", "tel", "call", "fax", "mobil", "cell"),
}


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[::-2])
    return (total + sum((2 * int(d)) % 9 if d != "9" else 9 for d in digits[-2::-2])) % 10 == 0


def _octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def _six(body: str) -> bool:
    """A valid IPv6 address."""
    try:
        return body.count(":") > 1 and bool(IPv6Address(body))
    except ValueError:
        return False


def unruled(span: Span, body: str) -> bool:
    """Valid personal data of a form that no base pattern has: its absence from the base spans says nothing."""
    digits = _NOT_DIGIT.sub("", body)
    if span[0] == "email":
        return not body.isascii() and "." in body.rpartition("@")[2]
    return _six(body) if span[0] == "ip" else span[0] == "card" and 13 <= len(digits) <= 19 and luhn(digits)


def base_spans(text: str) -> list[Span]:
    """Base spans by kind and start."""
    out: list[Span] = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        host = _DOMAIN.match(text, at + 1) if start < at else None
        if host:
            out.append(("email", start, host.end()))
        # The next local part may begin inside this host only if the pattern did not take it.
        free = host.end() if host else at + 1
        at = text.find("@", free)
    out += [("ip", *m.span()) for m in _IP.finditer(text) if _octets(m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def candidates(text: str) -> list[Span]:
    """Overlapping proposals of the generators."""
    out: set[Span] = set()
    for m in _AT.finditer(text):
        start = m.start()
        while start > 0 and (text[start - 1] in _LOCAL or text[start - 1].isalnum()):
            start -= 1
        host = _HOST.match(text, m.end())
        if start < m.start() and host:
            out.add(("email", start, host.end()))
    out |= {("ip", *m.span()) for pattern in (_DOTTED, _SIX) for m in pattern.finditer(text)}
    for m in _NUMBER.finditer(text):
        parts = [(m.start() + p.start(), m.start() + p.end()) for p in _PART.finditer(m[0])]
        for start, end in {m.span(), *parts}:
            n = len(_NOT_DIGIT.sub("", text[start:end]))
            out |= {("card", start, end)} if 13 <= n <= 19 else set()
            out |= {("phone", start, end)} if 7 <= n <= 15 else set()
    return sorted(out, key=lambda s: (s[1], s[2], s[0]))


def features(text: str, span: Span) -> list[float]:
    """Form of a span and what stands around it."""
    kind, start, end = span
    body, before = text[start:end], text[max(0, start - CONTEXT) : start].lower()
    digits = _NOT_DIGIT.sub("", body)
    groups = [len(g) for g in re.findall(r"[0-9]+", body)] or [0]
    dotted = body.split(".")
    return [
        *[float(kind == k) for k in KINDS],
        len(body),
        len(digits),
        sum(c.isalpha() for c in body),
        len(groups),
        max(groups),
        min(groups),
        float(body[0] == "+"),
        float("(" in body),
        float(luhn(digits)) if digits else 0.0,
        body.count("."),
        body.count("-"),
        body.count(" "),
        body.count(":"),
        float(len(dotted) == 4 and all(p.isdecimal() and p.isascii() and _octets([p]) for p in dotted)),
        float("@" in body),
        len(dotted[-1]) if dotted[-1].isalpha() else 0.0,
        *[float(any(c in before for c in CLUES[k])) for k in KINDS],
        float(text[start - 1].isalnum()) if start else 0.0,
        float(text[end].isalnum()) if end < len(text) else 0.0,
        sum(c.isdigit() for c in before),
        float(_six(body)),
        float(digits[0]) if digits else -1.0,
        float(body.isascii()),
    ]


N_FEATURES = len(features("1.2.3.4", ("ip", 0, 7)))


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Features rounded up to the next of the sorted `cuts`, beyond the last one to one more than it; the kind always stays.

    A row lies on the same side of every cut as before.
    """
    x = np.array(x, float).reshape(-1, N_FEATURES)
    for f in range(len(KINDS), N_FEATURES):
        x[:, f] = np.append(cuts[f], cuts[f][-1] + 1 if len(cuts[f]) else 0.0)[np.searchsorted(cuts[f], x[:, f])]
    return x


def _checked(digits: str) -> str:
    """The digits and the one that makes them pass the Luhn test."""
    return next(digits + d for d in "0123456789" if luhn(digits + d))


def _short_cards(digits: str) -> list[str]:
    """Card numbers of 13 to 15 digits out of a longer one."""
    amex, diners, old = (_checked(f"{head}{digits[2:]}"[: n - 1]) for head, n in ((("34", "37")[int(digits[-1]) % 2], 15), (("30", "36", "38")[int(digits[-1]) % 3], 14), (digits[:2], 13)))
    fifteen, fourteen = _checked(digits[:14]), _checked(digits[:13])
    spaced = [" ".join((d[:4], d[4:10], d[10:])) for d in (amex, diners, fifteen)]
    return [amex, diners, old, fifteen, fourteen, *spaced, *[x.replace(" ", "-") for x in spaced]]


def _spellings(kind: str, body: str) -> list[str]:
    """Other ways to write what a base span says, and data of the same kind in forms that no base pattern has."""
    salt = zlib.crc32(body.encode())
    if kind == "email":
        name, _, host = body.partition("@")
        accent = "éñüçøßяõ"[salt % 8]
        return [
            f"{name} (at) {host}",
            f"{name}[at]{host.replace('.', '[dot]')}",
            f"{name} (at) {host.replace('.', ' (dot) ')}",
            f"{name[:-1]}{accent}@{host}",
            f"{name}{accent}@{host}",
            f"{name}@{host[0]}{accent}{host[1:]}",
            f"{name[:2]}{accent}@{host.partition('.')[2] if host.count('.') > 1 else host}",
            f"{name[:2]}{accent}@{host[0]}.{host.rpartition('.')[2]}",
            f"{name[:1]}.{name}{accent}@{host[:2]}.{host}",
            f"{name[:3]}{accent}.{name}@{host}",
            f"{accent}{name}@{host}",
        ]
    digits = _NOT_DIGIT.sub("", body)
    if kind == "ip":
        groups = [f"{(salt * p + int(digits[:9])) % 65536:x}" for p in (3, 7919, 104729, 1299709, 15485863, 179424673)]
        full = ":".join(["2001", "db8", *groups])
        return [full, full.upper(), ":".join(g.zfill(4) for g in full.split(":")), "2001:db8::" + groups[0], "fe80::" + ":".join(groups[:4]), "2001:db8:" + ":".join(groups[:2]) + "::" + groups[2], "::" + ":".join(groups[:2])]
    if kind == "card":
        fours = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return [".".join(fours), "-".join(fours), *_short_cards(digits)]
    tail = digits[-10:]
    return [f"({tail[:3]}) {tail[3:6]}-{tail[6:]}", f"{tail[:3]}-{tail[3:6]}-{tail[6:]}", f"{tail[:3]}.{tail[3:6]}.{tail[6:]}"]


def _decoys(kind: str, body: str, salt: int) -> list[str]:
    """Numbers and words of another meaning, in the same place."""
    digits = (_NOT_DIGIT.sub("", body) + str(salt) * 3 + "7305512946")[:16]
    wrong = digits[:-1] + str((int(digits[-1]) + 1 + salt % 8) % 10)
    if luhn(wrong):
        wrong = wrong[:-1] + str((int(wrong[-1]) + 1) % 10)
    # Numbers of 13 to 15 digits that fail the check, milliseconds of a clock, network card addresses.
    short = [d[:-1] + str((int(d[-1]) + 1 + salt % 8) % 10) for d in _short_cards(digits)[:3]]
    clock = f"1{5 + salt % 5}{digits[:11]}"
    mac = ":".join(f"{(salt * p) % 256:02x}" for p in (3, 5, 7, 11, 13, 17))
    day = f"{1990 + salt % 40}-{1 + salt % 12:02d}-{1 + salt % 28:02d}"
    return [wrong, f"{wrong[:4]}.{wrong[4:7]}.{wrong[7:9]}", f"{day} 12:{salt % 60:02d}:05", f"{wrong[:8]}", f"{day} {wrong[:4]}", f"v{salt % 9}.{salt % 7}.{salt % 13}.{300 + salt % 99}", f"look @ {wrong[:3]}", f"{wrong[:2]}@{wrong[2:5]}", f"look[at]{wrong[:4]}", f"são@{wrong[:1]}", *short, clock, mac]


def examples(text: str) -> list[tuple[list[float], bool]]:
    """Labelled candidates of one document."""
    if not _SIGN.search(text):
        return []  # no base span, and of the candidates only spelled-out at signs, which bear no label
    base = base_spans(text)
    known = set(base)
    out = []
    for span in candidates(text):
        inside = any(s != span and s[1] < span[2] and span[1] < s[2] for s in base)
        if span in known or not inside:
            # Not a base span: of a spelling the rules know (a plain at sign, four numbers, 16 digits) but failing them.
            body = text[span[1] : span[2]]
            if span in known or ("@" in body or span[0] in ("ip", "card")) and not unruled(span, body):
                out.append((features(text, span), span in known))
    for kind, start, end in base:
        left, right, body = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT], text[start:end]
        for good, forms in ((True, _spellings(kind, body)), (False, _decoys(kind, body, zlib.crc32(body.encode()) % 9973))):
            for form in forms:
                put = left + form + right
                decoy = () if good else {(k, len(left), len(left) + len(form)) for k in KINDS}
                for span in candidates(put):
                    if span[1] < len(left) + len(form) and span[2] > len(left):
                        exact = span == (kind, len(left), len(left) + len(form))
                        # A neighbour in the text, or part of a form, may be valid by itself.
                        if good and exact or span in decoy or not unruled(span, put[span[1] : span[2]]):
                            out.append((features(put, span), good and exact))
    return out


@dataclass
class PiiModel:
    trees: Trees
    thresholds: dict[str, float]


def _threshold(probability: np.ndarray, truth: np.ndarray, precision: float, copies: np.ndarray) -> float:
    """Lowest probability that reaches the precision, half way down to the next held-out example, which would not."""
    least = precise_threshold(probability, truth, precision, copies=copies)
    below = probability[probability < least]
    return max(0.5, (least + float(below.max())) / 2) if least < 1.0 and len(below) else least


def _held_below(found: DataFrame) -> dict[tuple[int, bool], int]:
    """Of each kind, and of its texts with and without a positive example, the cell of the last held-out text.

    Texts are in order of their crc32, so that equal ones stay together; the first of every FOLDS are held out, but never all.
    """
    cell = F.expr(f"text_crc div {1 << CELL_BITS}").alias("cell")
    counts = found.select("kind", "good", "text_crc").distinct().groupBy("kind", "good", cell).agg(F.count("*").alias("n"))
    per: dict[tuple[int, bool], list[tuple[int, int]]] = {}
    for r in counts.collect():  # at most 4,096 cells of each kind, with and without
        per.setdefault((r.kind, r.good), []).append((r.cell, r.n))
    below = {}
    for group, cells in per.items():
        cells.sort()
        total, seen = sum(n for _, n in cells), 0
        for at, n in cells:
            seen += n
            if seen * FOLDS >= total:
                break
        below[group] = at if seen < total else cells[-1][0] - 1
    return below


def _held(batch: pa.RecordBatch, below: dict[tuple[int, bool], int]) -> np.ndarray:
    """Which examples are of held-out texts."""
    last = np.array([below[g] for g in zip(batch.column("kind").to_pylist(), batch.column("good").to_pylist())], np.int64)
    return (batch.column("text_crc").to_numpy() >> CELL_BITS) <= last


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)


def _quantiles(found: DataFrame, below: dict[tuple[int, bool], int]) -> np.ndarray:
    """(features, BINS - 1): the exact quantiles of each feature over all training examples; no columns without any."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch)[~_held(batch, below)]
            each = [np.unique(x[:, f], return_counts=True) for f in range(N_FEATURES)]
            names = np.repeat(np.arange(N_FEATURES, dtype=np.int32), [len(v) for v, _ in each])
            values, n = (np.concatenate(part) for part in zip(*each))
            yield pa.RecordBatch.from_pydict({"feature": pa.array(names), "value": pa.array(values), "n": pa.array(n.astype(np.int64))})

    values = found.mapInArrow(counted, "feature int, value double, n bigint").groupBy("feature", "value").agg(F.sum("n").alias("n"))
    values = stored(values, "pii-values")
    total = values.where("feature = 0").agg(F.sum("n")).first()[0] or 0
    out = np.zeros((N_FEATURES, BINS - 1 if total else 0))
    if not total:
        return out
    places = np.floor(np.linspace(0, 1, BINS + 1)[1:-1] * (total - 1))
    of, seen, at = -1, 0, 0
    for r in values.orderBy("feature", "value").toLocalIterator():  # one partition at a time on the driver
        if r.feature != of:
            of, seen, at = r.feature, 0, 0
        seen += r.n
        upto = int(np.searchsorted(places, seen))
        out[of, at:upto], at = r.value, upto
    return out


def train(docs: DataFrame, sample_rows: int | None = None, precision: float = PRECISION) -> PiiModel:
    """Trees and thresholds from all documents. `sample_rows` is taken from older callers and leaves nothing out."""
    prepare(docs.sparkSession)

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            x, y, kinds, good, crc = [], [], [], [], []
            for text in texts(batch.column("text")):
                mine = examples(text)
                kind = [int(np.argmax(e[0][: len(KINDS)])) for e in mine]
                having = {k for k, (_, true) in zip(kind, mine) if true}
                x += [e[0] for e in mine]
                y += [e[1] for e in mine]
                kinds += kind
                good += [k in having for k in kind]
                crc += [zlib.crc32(text.encode())] * len(mine)
            columns = {"x": pa.array(x, pa.list_(pa.float64())), "y": pa.array(y, pa.bool_()), "kind": pa.array(kinds, pa.int32())}
            yield pa.RecordBatch.from_pydict(columns | {"good": pa.array(good, pa.bool_()), "text_crc": pa.array(crc, pa.int64())})

    found = stored(pick(docs, "text").mapInArrow(labelled, "x array<double>, y boolean, kind int, good boolean, text_crc bigint"), "pii-examples")
    below = _held_below(found)
    quantiles = _quantiles(found, below)

    def counted(bins: int) -> DataFrame:
        """Different examples in so many bins, and which of them are held out, with the number of their copies."""
        cuts = [np.unique(q) for q in quantiles[:, BINS // bins - 1 :: BINS // bins]]

        def rounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = binned(_matrix(batch), cuts)
                ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * N_FEATURES)
                yield pa.RecordBatch.from_pydict({"x": pa.ListArray.from_arrays(ends, x.ravel()), "y": batch.column("y"), "held": pa.array(_held(batch, below))})

        each = found.mapInArrow(rounded, "x array<double>, y boolean, held boolean")
        return stored(each.groupBy("x", "y", "held").agg(F.count("*").alias("n")), "pii-counts")

    bins = BINS
    while (counts := counted(bins)).count() > MAX_ROWS and bins > 1:
        bins //= 2
    got = counts.collect()  # at most MAX_ROWS rows, or the kinds alone
    got.sort(key=lambda r: (r.x, r.y, r.held))
    x = np.array([r.x for r in got], float).reshape(-1, N_FEATURES)
    y, held = np.array([r.y for r in got], bool), np.array([r.held for r in got], bool)
    n = np.array([r.n for r in got], np.int64)
    kind = x[:, : len(KINDS)].argmax(axis=1)
    many = np.bincount(kind[~held], n[~held], len(KINDS))
    weight = np.minimum(1.0, KIND_WEIGHT / np.maximum(many, 1))[kind]
    trees = fit(x[~held], y[~held], trees=80, depth=4, bins=BINS, copies=n[~held], weight=weight[~held])
    p = trees.probability(x[held])
    of = lambda i: kind[held] == i
    return PiiModel(trees, {k: _threshold(p[of(i)], y[held][of(i)], precision, n[held][of(i)]) for i, k in enumerate(KINDS)})


def added(good: list[tuple[float, Span]], base: list[Span]) -> list[Span]:
    """Selected spans that overlap no base span or no better one, or that wholly cover base spans of their kind."""
    starts = {k: [s[1] for s in base if s[0] == k] for k in KINDS}
    ends = {k: [s[2] for s in base if s[0] == k] for k in KINDS}

    def covered(span: Span) -> range:
        """Which base spans of its kind it covers, by their place among these; they are in order and apart."""
        first = bisect_left(starts[span[0]], span[1])
        return range(first, max(first, bisect_right(ends[span[0]], span[2])))

    wide = [(q, s) for q, s in good if covered(s)]
    inside = {(s[0], i) for _, s in wide for i in covered(s)}
    left = [(k, a, b) for k in KINDS for i, (a, b) in enumerate(zip(starts[k], ends[k])) if (k, i) not in inside]
    over = apart(wide, left)
    return over + apart([g for g in good if not covered(g[1])], base + over)


def all_spans(text: str, model: PiiModel) -> tuple[list[Span], list[Span]]:
    """Base spans, and base and selected spans by kind and start."""
    base = base_spans(text)
    known = set(base)
    proposed = [s for s in candidates(text) if s not in known]
    if not proposed:
        return base, base
    p = model.trees.probability(np.array([features(text, s) for s in proposed]))
    good = [(float(q), s) for q, s in zip(p, proposed) if q >= model.thresholds[s[0]]]
    every = base + added(good, base)
    return base, sorted(every, key=lambda s: (KINDS.index(s[0]), s[1]))


def find(docs: DataFrame, model: PiiModel) -> DataFrame:
    """doc_id, counts of base spans by kind, base_sha256, all spans and the redacted text."""
    prepare(docs.sparkSession)
    rows = pick(docs, "doc_id", "text")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            out = []
            for text in texts(batch.column("text")):
                base, every = all_spans(text, model)
                out.append((*[sum(s[0] == k for s in base) for k in KINDS], digest(base), joined(every), masked(text, every)))
            names = (*[f"n_{k}" for k in KINDS], "base_sha256", "spans", "redacted")
            columns = {n: pa.array([o[i] for o in out], pa.int64() if i < 4 else pa.string()) for i, n in enumerate(names)}
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id")} | columns)

    kind = dict(rows.dtypes)["doc_id"]
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return rows.mapInArrow(found, f"doc_id {kind}, {counts}, base_sha256 string, spans string, redacted string")
