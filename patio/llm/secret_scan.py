"""Secret scans with a guess-cost dynamic program.

Base spans of three kinds come from fixed rules (see base_spans). The method looks at values in
a credential context, meaning a credential word followed by a separator and a value, in more
spellings than the base rule takes, and asks how many guesses an attacker would need. The value
is cut into words of a list, dates, repeats, keyboard walks, sequences and brute-force spans so
that the product of their guesses (the sum of logarithms) is smallest; each further segment
costs the factorial of the number of segments. Values that need at least MIN_GUESSES (log10)
are added as spans of kind `guess`, unless a base span covers them.

Defined cases: null and empty texts have no spans. Repeated rows get a row each. Texts are read
whole; a value is what stands up to the next white space or quote. Values of all lengths go
through the same program in linear time: what alone takes MIN_GUESSES is left out, be it a walk or
a number of segments, as are stretches inside a long sequence that end away from its ends.
Positions count code points. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame

from patio.llm.common import id_text

MIN_GUESSES = 10.0
#: Most segments: the factorial of one more takes MIN_GUESSES by itself.
MOST = next(k for k in range(1, 99) if math.log10(math.factorial(k + 1)) >= MIN_GUESSES)
#: No word, date or walk that counts reaches further into a sequence than this.
EDGE = 16
KINDS = ("assign", "access", "hex", "guess")

# A credential stands before a separator, so the search goes from separator to separator: no word
# of the list is the end of another, and so a separator has at most one match of the fixed rule.
_SEPARATOR = re.compile(r"[:=]")
_BEFORE = re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\Z", re.IGNORECASE | re.ASCII)
_AFTER = re.compile(r"\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}+")
_CONTEXT = re.compile(
    r"(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_\x20-]?key|credentials?|auth)(?:\x20is)?[\"']?\Z", re.IGNORECASE | re.ASCII
)
_VALUE = re.compile(r"[=>]?[\x20\t]*[\"']?([^\s\"'<>]+)")
#: Longer than any credential word with what may stand behind it.
_REACH = 24

# Words that lists of common passwords begin with, most common first.
WORDS = (
    "password", "qwerty", "admin", "welcome", "monkey", "dragon", "letmein", "login", "princess", "football", "shadow", "master", "sunshine",
    "iloveyou", "trustno", "baseball", "superman", "batman", "hello", "freedom", "whatever", "starwars", "secret", "summer", "winter", "spring",
    "autumn", "flower", "michael", "jordan", "hunter", "pass", "love", "root", "user", "guest", "test", "default", "changeme", "example",
    "token", "service", "server", "system", "database", "company", "access", "computer", "internet", "orange", "banana", "cookie", "soccer",
    "hockey", "ginger", "pepper", "cheese", "coffee", "purple", "silver", "golden", "diamond", "thunder", "killer", "january", "february",
    "march", "april", "june", "july", "august", "september", "october", "november", "december", "monday", "friday", "sunday",
    "the", "and", "you", "for", "this", "that", "with", "have", "from", "your", "here", "none", "null", "true", "false", "value",
)
RANK = {word: rank + 1 for rank, word in enumerate(WORDS)}
LONGEST_WORD = max(map(len, WORDS))
# The rows of the keyboard.
ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
# Letters that other signs stand for.
LEET = str.maketrans("@4031!$57", "aaoeiisst")
_PLACE = {c: (x + y * 0.5, y) for y, row in enumerate(ROWS) for x, c in enumerate(row)}
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d")


def _near(a: str, b: str) -> bool:
    p, q = _PLACE.get(a), _PLACE.get(b)
    return bool(p and q and a != b and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1)


def _runs(text: str, follows) -> list[tuple[int, int]]:
    """Maximal stretches in which every neighbour pair follows."""
    out, start = [], 0
    for i, (a, b) in enumerate(pairwise(text), 1):
        if not follows(a, b):
            if i - start >= 3:
                out.append((start, i))
            start = i
    if len(text) - start >= 3:
        out.append((start, len(text)))
    return out


def _stretches(a: int, b: int) -> list[tuple[int, int]]:
    """Stretches of a sequence from a to b that a cheapest segmentation may use."""
    short = [(s, e) for s in range(a, b - 2) for e in range(s + 3, min(s + 2 * EDGE, b) + 1)]
    left = [(s, e) for s in range(a, min(a + EDGE, b)) for e in range(s + 2 * EDGE + 1, b + 1)]
    right = [(s, e) for s in range(a + EDGE, b) for e in range(max(s + 2 * EDGE + 1, b - EDGE), b + 1)]
    return short + left + right


def _alphabet(span: str) -> int:
    size = 10 * any(c.isdigit() for c in span) + 26 * any(c.islower() for c in span)
    size += 26 * any(c.isupper() for c in span) + 33 * any(not c.isalnum() for c in span)
    return max(size, 10)


def segments(value: str) -> list[tuple[int, int, float]]:
    """(start, end, log10 of the guesses) of all words, dates, repeats, walks and sequences."""
    low = value.lower()
    plain = low.translate(LEET)
    found = []
    for a in range(len(value)):
        for b in range(a + 3, min(a + LONGEST_WORD, len(value)) + 1):
            for spelling, extra in ((low[a:b], 0.0), (plain[a:b], 0.6)):
                if spelling in RANK:
                    capital = 0.0 if value[a:b].islower() else 0.3 if value[a : a + 1].isupper() else 0.9
                    found.append((a, b, math.log10(RANK[spelling]) + extra + capital))
                    break
        m = _DATE.match(value, a)
        if m and m.end() - a >= 4:
            found.append((a, m.end(), 2.1 if m.end() - a == 4 else math.log10(365 * 120)))
    for a, b in _runs(low, lambda x, y: x == y):
        found += [(a, e, math.log10(40 * (e - a))) for e in range(a + 3, b + 1)]
    for a, b in _runs(low, _near):
        for s in range(a, b - 2):
            for e in range(s + 3, b + 1):
                if (cost := math.log10(94) + 0.6 * (e - s - 1)) >= MIN_GUESSES:
                    break
                found.append((s, e, cost))
    for step in (1, -1):
        for a, b in _runs(low, lambda x, y, step=step: ord(y) - ord(x) == step):
            found += [(s, e, math.log10(26 * (e - s))) for s, e in _stretches(a, b)]
    for size in (2, 3, 4):  # a short block again and again
        for a in range(len(low) - 2 * size + 1):
            block, e = low[a : a + size], a + size
            if a >= size and low.startswith(block, a - size):
                continue
            while low.startswith(block, e):
                e += size
            if e - a >= 2 * size:
                found.append((a, e, size * math.log10(_alphabet(block)) + math.log10((e - a) / size)))
    return found


def guess_cost(value: str) -> float:
    """log10 of the guesses that the cheapest segmentation takes, exact below MIN_GUESSES."""
    n = len(value)
    sign = math.log10(_alphabet(value))
    into: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    for a, b, cost in segments(value):
        into[b].append((a, max(cost, 0.0)))
    # best[k][i]: cheapest way to i in k segments; brute force may take any stretch as one segment.
    most = min(n, MOST)
    best = [[0.0] + [math.inf] * n]
    for _ in range(most):
        last, now, brute = best[-1], [math.inf] * (n + 1), math.inf
        for i in range(1, n + 1):
            brute = min(brute, last[i - 1]) + sign
            now[i] = min([brute, *(last[a] + cost for a, cost in into[i])])
        best.append(now)
    return min(row[n] + math.log10(math.factorial(k)) for k, row in enumerate(best) if k or not n)


def _separators(text: str):
    """Each separator with where the blanks before it begin."""
    for m in _SEPARATOR.finditer(text):
        at = m.start()
        while at and text[at - 1] in "\x20\t":
            at -= 1
        yield m.start(), at


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, order of kind, end) of the fixed rules, by start, then kind."""
    found, done = [], 0
    if "=" in text or ":" in text:
        for at, end in _separators(text):
            word = _BEFORE.search(text, max(0, end - _REACH), end) if at >= done else None
            if word and "\t" not in text[end:at] and word.start() >= done and (m := _AFTER.match(text, at + 1)):
                done = m.end()
                if len(m[1]) >= 8:
                    found.append((word.start(), 0, done))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def added_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Values in a credential context that take many guesses and that no base span covers."""
    found, reach, k, done = [], 0, 0, 0
    for at, end in _separators(text):
        if at < done or not _CONTEXT.search(text, max(0, end - _REACH), end) or not (m := _VALUE.match(text, at + 1)):
            continue
        done = m.end()
        value = m[1].rstrip(".,;:)]}")
        a, b = m.start(1), m.start(1) + len(value)
        while k < len(base) and base[k][0] <= a:
            reach, k = max(reach, base[k][2]), k + 1
        if len(value) >= 6 and b > reach and guess_cost(value) >= MIN_GUESSES:
            found.append((a, 3, b))
    return found


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def scan(text: str) -> tuple[list, list]:
    base = base_spans(text)
    return base, added_spans(text, base)


FOUND = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_added"]
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_added long"


def secret_spans(docs: DataFrame) -> DataFrame:
    """Spans of every row: counts and digest of the base ones, all as `spans`."""

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                base, added = scan(text)
                counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                out.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + added), len(added)))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            arrays = [pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=FOUND)

    return id_text(docs).mapInArrow(run, SCHEMA)
