"""Secret scans (op 10): named patterns, and a token-efficiency test for random strings.

The base patterns mark assignments, access keys and hexadecimal runs. The test then looks at every other run of at least
MIN_LENGTH characters of a key alphabet: prose and identifiers are cheap under a tiktoken vocabulary, random strings are
not, so a run with few characters per token is marked `random`. Known digests (hexadecimal of 32, 40, 56, 64, 96 or 128
characters in either case), UUIDs, plain numbers, times and identifiers made of words are excluded from the test, not
from the base patterns; a word is what the vocabulary too has in few tokens, so a random string of one letter case is
none. How few is enough depends on alphabet and length: up to the length of long words, letters of one case must be
dearer than mixed strings, or unknown words would be marked. Of a run that is cheap as a whole, the values between equal signs and the stretches of dear parts are tested. The vocabulary is a parameter: its file is read on the driver and travels as a broadcast (bounded by
MAX_VOCABULARY bytes, checked).

Defined results: a null text is empty and has no spans; repeated rows and rows without an id each keep their row; extra
columns are dropped; an empty table gives no rows. All patterns scan in time linear in the text.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from slotwise.llm.common import pick, pieces, prepare, texts
from slotwise.llm.spans import Span, apart, digest, joined, masked

# The base patterns and their least lengths. Look-behinds only keep a scan from starting inside a run.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_VALUE, LEAST_ACCESS = 12, 18

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MAX_VOCABULARY = 64 << 20
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
MIN_LENGTH = 12
LEAST_GROUPED = 20  # shorter digits with separators are telephone, book and other numbers
MAX_RATIO = 2.2  # characters per token at most
# Letters of one case have a lower limit as long as they are no longer than words are: unknown words of 12 to 18 letters
# lie at 1.6 to 2.2, random strings of 12 lower-case letters at 1.7 on average, of 12 capitals at 1.5.
ONE_CASE, ONE_CASE_RATIO, LONGEST_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+"), 1.6, 19
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_LENGTH)
DIGEST = re.compile(r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})")
UUID = re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}")
WORDS = re.compile(r"[_/=+-]*(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4})(?:[_/=+-]+(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4}))*[_/=+-]*")
TIME = re.compile(r"[0-9]{4}-?[0-9]{2}-?[0-9]{2}[T_-][0-9]{2}(?:[0-9]{2}){0,2}Z?")
PART = re.compile(r"[A-Za-z0-9]+")
VALUE = re.compile(r"[^=]+")
LETTER = re.compile(r"[A-Za-z]")
_ENCODINGS: dict[int, tiktoken.Encoding] = {}


def encoding(vocabulary: bytes) -> tiktoken.Encoding:
    """The encoding of a vocabulary file, built once per worker."""
    key = hash(vocabulary)
    if key not in _ENCODINGS:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines()) if a}
        _ENCODINGS[key] = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[key]


def base_spans(text: str) -> list[Span]:
    """Base spans, by start and then in the order of the kinds."""
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def measured(run: str, tokens: tiktoken.Encoding) -> float:
    """Characters per token."""
    return len(run) / len(tokens.encode_ordinary(run))


def limit(run: str, ratio: float) -> float:
    """The ratio up to which a run is taken for random: it depends on its alphabet and length."""
    return min(ratio, ONE_CASE_RATIO) if MIN_LENGTH <= len(run) <= LONGEST_WORD and ONE_CASE.fullmatch(run) else ratio


def known(run: str) -> bool:
    """Known digests, UUIDs, numbers and times."""
    number = run.isdigit() or len(run) < LEAST_GROUPED and not LETTER.search(run)
    return bool(DIGEST.fullmatch(run) or UUID.fullmatch(run) or number or TIME.fullmatch(run))


def cheap(part: str, tokens: tiktoken.Encoding, ratio: float) -> bool:
    """A short number, or letters that the vocabulary knows as one word or as few pieces."""
    return (part.isdigit() and len(part) <= 4) or measured(part, tokens) > limit(part, ratio) or len(tokens.encode_ordinary(part)) == 1


def excluded(run: str, tokens: tiktoken.Encoding, ratio: float) -> bool:
    """Known forms, and identifiers made of words that are words to the vocabulary too."""
    return known(run) or bool(WORDS.fullmatch(run)) and all(cheap(p, tokens, ratio) for p in PART.findall(run))


def dear_stretches(run: str, tokens: tiktoken.Encoding, ratio: float) -> list[tuple[int, int]]:
    """Stretches of neighbouring parts that are not cheap; parts of up to three characters do not end one."""
    out: list[tuple[int, int]] = []
    going = False
    for m in PART.finditer(run):
        dear = not cheap(m[0], tokens, ratio) and not known(m[0])
        if dear:
            out.append((out.pop()[0], m.end()) if going else m.span())
        going = dear or going and len(m[0]) <= 3
    return out


def random_spans(text: str, tokens: tiktoken.Encoding, base: list[Span], ratio: float) -> list[Span]:
    found = []
    for m in RUN.finditer(text):
        # The whole run, or else what stands between equal signs, or else the parts that are not words.
        some = [m.span()]
        for pattern in (None, VALUE, PART):
            if pattern is VALUE:
                some = [(m.start() + v.start(), m.start() + v.end()) for v in VALUE.finditer(m[0])]
            elif pattern is PART:
                some = [(a + x, a + y) for a, b in some for x, y in dear_stretches(text[a:b], tokens, ratio)]
            good = [(a, b) for a, b in some if b - a >= MIN_LENGTH and not excluded(text[a:b], tokens, ratio)]
            rates = [(measured(text[a:b], tokens), a, b) for a, b in good]
            found += [(-rate, ("random", a, b)) for rate, a, b in rates if rate <= limit(text[a:b], ratio)]
            if pattern is None and (found and found[-1][1][1:] == m.span() or excluded(m[0], tokens, ratio)):
                break
    return apart(found, base)


def scan(docs: DataFrame, vocabulary: str = VOCABULARY, ratio: float = MAX_RATIO) -> DataFrame:
    """doc_id, text, counts of the base kinds and of `random`, base_sha256, spans and the masked text."""
    spark = docs.sparkSession
    prepare(spark)
    with open(vocabulary, "rb") as file:
        content = file.read(MAX_VOCABULARY + 1)
    if len(content) > MAX_VOCABULARY:
        raise ValueError(f"{vocabulary} is larger than {MAX_VOCABULARY} bytes")
    shipped = spark.sparkContext.broadcast(content)
    rows = pick(docs, "doc_id", "text")

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoding(shipped.value)
        for batch in pieces(batches):
            out = []
            for text in texts(batch.column("text")):
                base = base_spans(text)
                more = random_spans(text, tokens, base, ratio)
                every = sorted(base + more, key=lambda s: (s[1], (*KINDS, "random").index(s[0])))
                count = {k: sum(s[0] == k for s in every) for k in (*KINDS, "random")}
                out.append((*count.values(), digest(base), joined(every), masked(text, every)))
            names = (*[f"n_{k}" for k in (*KINDS, "random")], "base_sha256", "spans", "redacted")
            columns = {n: pa.array([o[i] for o in out], pa.int64() if i < 4 else pa.string()) for i, n in enumerate(names)}
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id")} | columns)

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(scanned, f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, n_random bigint, base_sha256 string, spans string, redacted string")
