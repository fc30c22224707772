"""Small inputs with every awkward row, and plain re-statements of the contracts."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, Toxicity string, _text_hash int"

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
BASE = " ".join(f"alpha{i}" for i in range(120))


def edge_rows():
    """Nulls everywhere, empty, blank and very long texts, ties, repeated rows, clashing columns."""
    texts = [
        (1, "the same text"), (2, "the  same\ttext"), (3, "thesametext"), (4, None), (5, ""), (6, " \n\t "), (7, LONG), (8, LONG + " end"),
        (9, BASE), (10, BASE.replace("alpha7 ", "beta ")), (11, BASE.upper()), (None, "the same text"), (None, None), (12, "é ü 日本 😀"),
        (13, "one"), (14, "one two"), (14, "one two"), (14, "another text of this id"), (15, "a\nb\na\n\nb\na"), (16, "spam ham eggs " * 30),
    ]
    rows = [(i, t, "en", f"src{(i or 0) % 4}" if i != 12 else None, len(t or ""), "x", "y", 7) for i, t in texts]
    return rows + [(i, t, None, None, None, None, None, None) for i, t in texts[:2]]


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def components(rows, n, percent):
    """doc index -> set of linked indexes, by comparing all sets."""
    lower = {i: i + 32 for i in range(65, 91)}
    sets = []
    for _, t, *_ in rows:
        w = WORD.findall((t or "").translate(lower))
        sets.append(frozenset(zip(*[w[j:] for j in range(n)])) if len(w) >= n else frozenset([tuple(w)]) if w else frozenset())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    return {i: g for g in groups.values() for i in g}, sets


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans)).encode()).hexdigest()


def pii_base(t):
    digits = lambda m: re.sub("[^0-9]", "", m.group())

    def luhn(x):
        return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(map(int, reversed(x)))) % 10 == 0

    out = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(m.start(), 2, m.end(), "card") for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [(m.start(), 3, m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m)) <= 15]


def secret_base(t):
    pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, m.end(), "assign") for m in re.finditer(pattern, t, re.I | re.A) if len(m.group(2)) >= 12]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 18]
    return out + [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 16]
