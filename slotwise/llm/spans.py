"""Helpers for operators that mark spans of text (code points, end exclusive)."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable

Span = tuple[str, int, int]  # kind, start, end


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def digest(spans: Iterable[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()


def apart(found: list[tuple[float, Span]], fixed: list[Span]) -> list[Span]:
    """Of scored spans, those that overlap neither a fixed span nor a better one."""
    # Taken stretches, disjoint and in order.
    starts: list[int] = []
    ends: list[int] = []
    for start, end in sorted((start, end) for _, start, end in fixed):
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start), ends.append(end)
    out = []
    for _, span in sorted(found, key=lambda f: (-f[0], f[1][1], f[1][2], f[1][0])):
        at = bisect_right(ends, span[1])  # the first stretch that ends behind the span's start
        if at == len(starts) or span[2] <= starts[at]:
            out.append(span)
            starts.insert(at, span[1]), ends.insert(at, span[2])
    return out


def masked(text: str, spans: Iterable[Span]) -> str:
    """The text with every marked stretch replaced by its kind in brackets; overlapping spans are one stretch."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])
