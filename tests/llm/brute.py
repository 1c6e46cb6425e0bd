"""Plain versions of the numbered operators, for comparison on small tables."""

import hashlib
import re
from fractions import Fraction

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def targets(sizes):
    """Weights 5, 2, 1; at most three times the size; one source at a time is capped."""
    weight = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    capped: dict[int, Fraction] = {}
    while True:
        free = [i for i in range(len(sizes)) if i not in capped]
        rest = Fraction(sum(sizes)) - sum(capped.values())
        share = {i: rest * weight[i] / sum(weight[j] for j in free) for i in free}
        over = [i for i in free if share[i] > 3 * sizes[i]]
        if not over:
            return [capped.get(i, share.get(i)) for i in range(len(sizes))]
        capped[over[0]] = Fraction(3 * sizes[over[0]])


def shingles(text, k):
    w = words((text or "").translate(lower))
    return [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []


def fingerprint(text):
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(text, 4)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, prints, radius):
    """Smallest id reachable over links, for each row."""
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, p in enumerate(prints):
            for j, q in enumerate(prints):
                if label[j] < label[i] and (p ^ q).bit_count() <= radius:
                    label[i], changed = label[j], True
    out = []
    for i in range(len(prints)):
        group = [ids[j] for j in range(len(prints)) if label[j] == label[i] and ids[j] is not None]
        out.append(min(group, default=None))
    return out


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    w, places = words(text), {}
    for i in range(len(w) - 7):
        places.setdefault(tuple(w[i : i + 8]), []).append(i)
    covered = {j for some in places.values() if len(some) > 1 for i in some for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def personal(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m[0])) <= 15]


def secret(text):
    text, kinds = text or "", ["assign", "access", "hex"]
    names = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name) for name in ("password", "passwd", "secret", "token", "api_?key"))
    assign = re.compile(rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 12]
    out += [("access", *m.span()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [("hex", *m.span()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out, key=lambda s: (s[1], kinds.index(s[0])))


def sha(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def leaks(docs, items, threshold=0.8):
    """(doc_id, item_id, n_shingles, n_shared) of every document row."""
    out = []
    for doc, text in docs:
        own = {k: set(shingles(text, k)) if len(words(text)) >= k else set() for k in range(1, 6)}
        for item, said in items:
            want = set(shingles(said, 5))
            own_runs = own[min(len(words(said)), 5)] if want else set()
            if want and len(want & own_runs) >= threshold * len(want) - 1e-9:
                out.append((doc, item, len(want), len(want & own_runs)))
    return out


def jaccard_components(rows, percent):
    """(doc_id, set size, smallest id reachable over links) of every row."""
    sets = [frozenset(shingles(text, 4)) for _, text in rows]
    distinct = list(dict.fromkeys(s for s in sets if s))
    label = {s: i for i, s in enumerate(distinct)}
    changed = True
    pairs = [(x, y) for i, x in enumerate(distinct) for y in distinct[:i] if 100 * len(x & y) >= percent * len(x | y)]
    while changed:
        changed = False
        for x, y in pairs:
            least = min(label[x], label[y])
            changed |= (label[x], label[y]) != (least, least)
            label[x] = label[y] = least
    first = {}
    for (doc, _), s in zip(rows, sets):
        if s and doc is not None:
            first[label[s]] = min(doc, first.get(label[s], doc))
    return [(doc, len(s), first.get(label[s]) if s else doc) for (doc, _), s in zip(rows, sets)]


def infill(doc, text):
    """n, form, prefix, middle, suffix and example of one document."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    u = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    prefix, middle, suffix = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(u), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(u), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(u), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def hard_negatives(rows, is_anchor, positives=5, negatives=10):
    """Rows are distinct (id, label, integers); ties of one id come in the order given."""
    out = []
    score = lambda x, y: sum(p * q for p, q in zip(x[2], y[2]))
    for i, a in enumerate(rows):
        if not is_anchor(a):
            continue
        ranked = sorted(((-score(a, r), r[0], j, r[1]) for j, r in enumerate(rows) if j != i))
        for s, positive, _, label in [r for r in ranked if r[3] == a[1]][:positives]:
            fit = [r for r in ranked if r[3] != a[1] and 30 * -s <= 100 * -r[0] <= 90 * -s][:negatives]
            out += [(a[0], positive, k + 1, r[1], -s, -r[0]) for k, r in enumerate(fit)]
    return out
