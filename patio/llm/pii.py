"""Personal data with a semi-Markov conditional random field.

Base spans of four kinds come from fixed rules (see BASE). The field adds spans that the rules
do not reach, such as phone numbers without country code or cards written with dots. It works
on stretches of text around digits and at-signs. A candidate segment is a run of up to
MAX_TOKENS tokens; its features describe the whole span (digits, groups, separators, checksum,
octets, edges). A dynamic program over the stretch chooses the best set of segments, boundaries
and types together; everything else is outside at score zero. Weights are fitted in numpy by
maximum likelihood (forward and backward sums over segmentations) on EXAMPLES sentences that a
seeded generator makes: spans of each kind in several spellings, among numbers that are not
personal data. An added span is dropped where it touches a base span.

Defined cases: null and empty texts have no spans. Repeated rows get a row each. Text is read
whole; stretches are independent, so memory is bounded by the stretch and a stretch of more than
STRETCH_TOKENS tokens is decided by the same program over the whole stretch in linear time.
Positions count code points. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patio.llm.common import id_text

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 12
EXAMPLES = 300
ROUNDS = 60
#: A segment is reported when it scores this much above being outside.
MARGIN = 2.0

# The rules start at an at-sign or at the first digit of a run, where a leftmost match has to
# start, so that no text costs more than linear time.
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", re.ASCII)
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+", re.ASCII)
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and (not part or int(part) <= 255)


def base_spans(text: str) -> list[tuple[int, str, int, int]]:
    """(order of kind, kind, start, end) of the fixed rules, by kind and start."""
    found = []
    if "@" in text:
        end = 0
        for m in _AT.finditer(text):
            if m.start() < end:
                continue
            start = m.start()
            while start > end and text[start - 1] in _LOCAL_SET:
                start -= 1
            if start < m.start():
                end = m.end()
                found.append((0, "email", start, end))
    for m in _IP.finditer(text):
        if all(_octet(x) for x in m.groups()):
            found.append((1, "ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _DIGITS.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, "card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGITS.sub("", m[0])) <= 15:
                found.append((3, "phone", m.start(), m.end()))
    return found


# Stretches: words that hold a digit or an at-sign, with up to two such words' gaps of one word.
_WORD = r"[^\s0-9@]*[0-9@]\S*"
_STRETCH = re.compile(rf"(?<!\S){_WORD}(?:\x20{_WORD})*")
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s|[\W_]|\d")

#: Names of the whole-span features, in the order of features().
FEATURES = (
    "bias", "digits 16-19", "luhn", "digits 16-19 and luhn", "digits 10", "digits 7", "digits 8-15",
    "plus first", "bracket first", "bracket inside", "groups 3-3-4", "groups 1-3-3-4", "four groups of four",
    "four groups", "octets", "dots only", "no letters", "one at-sign", "dot after at-sign", "letters around at-sign",
    "starts and ends in word character", "space inside", "two separators together", "joined to a word on the left",
    "joined to a word on the right", "one group", "date groups", "short", "slash or colon",
)


def features(text: str, start: int, end: int) -> list[float]:
    s = text[start:end]
    groups = re.findall(r"[0-9]+", s)
    sizes = [len(g) for g in groups]
    n = sum(sizes)
    letters = any(c.isalpha() for c in s)
    outside = re.sub(r"[0-9]+", "", s)
    at = s.find("@")
    left = text[start - 1] if start else " "
    right = text[end] if end < len(text) else " "
    after = text[end + 1] if end + 1 < len(text) else " "
    long = 16 <= n <= 19 and not letters
    passes = n >= 8 and luhn("".join(groups))
    octets = sizes and len(sizes) == 4 and all(_octet(g) for g in groups) and outside == "..."
    return [
        1.0, long, passes and not letters, long and passes, n == 10, n == 7, 8 <= n <= 15,
        s[0] == "+", s[0] == "(", "(" in s[1:], sizes == [3, 3, 4], sizes == [1, 3, 3, 4] or sizes == [2, 3, 3, 4],
        sizes == [4, 4, 4, 4], len(sizes) == 4, bool(octets), bool(outside) and set(outside) == {"."}, not letters,
        s.count("@") == 1, at > 0 and "." in s[at + 2 : -1], at > 0 and at + 1 < len(s) and s[at - 1].isalnum() and s[at + 1].isalnum(),
        s[0].isalnum() and s[-1].isalnum(), " " in s, bool(re.search(r"[^0-9A-Za-z\s(+][^0-9A-Za-z\s(+]|\s\s", s)), left.isalnum() or left in "+@_%-" or left == "." and start > 1,
        right.isalnum() or right in "@_-" or right in ".,:/" and after.isalnum(), len(sizes) == 1, sizes in ([4, 2, 2], [2, 2, 4], [1, 2, 4], [2, 1, 4]), n < 7, "/" in s or ":" in s,
    ]


def candidates(text: str) -> tuple[list[int], list[tuple[int, int]], np.ndarray]:
    """Token edges of a stretch, segments as token ranges, and their features."""
    edges = [0, *(m.end() for m in _TOKEN.finditer(text))]
    if edges[-1] != len(text):
        edges.append(len(text))
    kinds = [text[a] for a in edges[:-1]]
    segments, rows = [], []
    for a in range(len(edges) - 1):
        first = kinds[a]
        if not (first.isalnum() or first in "+("):
            continue
        for b in range(a + 1, min(a + MAX_TOKENS, len(edges) - 1) + 1):
            if not kinds[b - 1].isalnum():
                continue
            span = text[edges[a] : edges[b]]
            if "@" in span or sum(c.isdigit() for c in span) >= 4:
                segments.append((a, b))
                rows.append(features(text, edges[a], edges[b]))
    return edges, segments, np.array(rows, float).reshape(len(rows), len(FEATURES))


# --- training ---------------------------------------------------------------------------------


def _examples(random: np.random.Generator, count: int):
    """Sentences with their true spans; seeded, so every fit is the same."""

    def digits(n, low=0):
        return "".join(str(x) for x in random.integers(low, 10, n))

    def word():
        return "".join(random.choice(list("abcdefghijklmnopqrstuvwxyz"), random.integers(2, 9)))

    def card():
        head = str(random.integers(3, 7)) + digits(14)
        number = next(head + str(d) for d in range(10) if luhn(head + str(d)))
        mark = str(random.choice(["", "", " ", "-", "."]))
        return mark.join(number[i : i + 4] for i in range(0, 16, 4))

    def phone():
        a, b, c = digits(3, 2), digits(3, 2), digits(4)
        form = random.integers(0, 6)
        return [f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{digits(2, 1)} {a} {b} {c}", f"{a}.{b}.{c}", f"{a} {b} {c}"][form]

    def ip():
        return ".".join(str(x) for x in random.integers(0, 256, 4))

    def email():
        return f"{word()}{random.choice(['.', '_', ''])}{digits(random.integers(1, 3))}@{word()}{random.choice(['', '2', '.example'])}.{random.choice(['com', 'org', 'net'])}"

    def other():
        n = int(random.integers(1, 7))
        form = random.integers(0, 12)
        return [
            digits(n), f"{digits(4, 1)}-0{digits(1, 1)}-{digits(2)}", f"{digits(1, 1)}{digits(1)}:{digits(2)}", f"{digits(2, 1)},{digits(3)},{digits(3)}",
            f"{digits(1)}.{digits(3)}", f"{digits(16)}", f"{digits(2, 1)}/{digits(2)}/{digits(4, 1)}", f"v{digits(1)}.{digits(1)}.{digits(2)}", f"@{word()}",
            f"{digits(3, 3)}.{digits(3, 3)}.{digits(3, 3)}.{digits(3, 3)}", f"{word()}{digits(2)}", f"{digits(12)}",
        ][form]

    makers = (email, ip, card, phone)
    for _ in range(count):
        text, spans = "", []
        for _ in range(int(random.integers(1, 4))):
            kind = int(random.integers(0, 7))
            piece = makers[kind]() if kind < 4 else other()
            if kind >= 4 and piece.isdigit() and len(piece) >= 16 and luhn(piece):
                kind = 2
            if kind < 4:
                spans.append((kind, len(text), len(text) + len(piece)))
            text += piece + str(random.choice([" ", ", ", ". "]))
        yield text.rstrip(), spans


def _lattice(edges, segments):
    """Segments by their last edge, for the sums."""
    ends: list[list[int]] = [[] for _ in edges]
    for k, (_, b) in enumerate(segments):
        ends[b].append(k)
    return ends


def _expected(scores: np.ndarray, edges, segments, ends) -> np.ndarray:
    """Probability of each (segment, kind) under the field."""
    n = len(edges) - 1
    total = np.logaddexp.reduce(scores, axis=1) if len(segments) else np.zeros(0)
    alpha, beta = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    alpha[0] = beta[n] = 0.0
    for b in range(1, n + 1):
        alpha[b] = np.logaddexp.reduce([alpha[b - 1], *(alpha[segments[k][0]] + total[k] for k in ends[b])])
    for b in range(n, 0, -1):
        beta[b - 1] = np.logaddexp(beta[b - 1], beta[b])
        for k in ends[b]:
            a = segments[k][0]
            beta[a] = np.logaddexp(beta[a], beta[b] + total[k])
    a, b = np.array(segments).T
    return np.exp(alpha[a][:, None] + scores + beta[b][:, None] - alpha[n])


@lru_cache(maxsize=1)
def fit() -> np.ndarray:
    """Weights (feature, kind)."""
    data = []
    for text, spans in _examples(np.random.default_rng(5), EXAMPLES):
        edges, segments, rows = candidates(text)
        if not segments:
            continue
        truth = np.zeros((len(segments), len(KINDS)))
        at = {(edges[a], edges[b]): k for k, (a, b) in enumerate(segments)}
        for kind, start, end in spans:
            if (start, end) in at:
                truth[at[start, end], kind] = 1
        data.append((edges, segments, _lattice(edges, segments), rows, truth))
    rows, truth = np.concatenate([d[3] for d in data]), np.concatenate([d[4] for d in data])
    weights = np.zeros((len(FEATURES), len(KINDS)))
    weights[0] = -2.0
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, ROUNDS + 1):
        scores = rows @ weights
        made, at = [], 0
        for edges, segments, ends, own, _ in data:
            made.append(_expected(scores[at : at + len(own)], edges, segments, ends))
            at += len(own)
        grad = rows.T @ (truth - np.concatenate(made)) / len(data) - 1e-4 * weights
        mean += 0.1 * (grad - mean)
        square += 0.01 * (grad * grad - square)
        weights += 0.15 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return weights


# --- decoding ---------------------------------------------------------------------------------


def decode(text: str, weights: np.ndarray) -> list[tuple[int, str, int, int]]:
    """Best non-overlapping segments of a stretch, as (order of kind, kind, start, end)."""
    edges, segments, rows = candidates(text)
    if not segments:
        return []
    scores = rows @ weights
    kind = scores.argmax(axis=1)
    value = scores[np.arange(len(kind)), kind] - MARGIN
    ends = _lattice(edges, segments)
    best, back = [0.0], [-1]
    for b in range(1, len(edges)):
        top, by = best[b - 1], -1
        for k in ends[b]:
            if best[segments[k][0]] + value[k] > top:
                top, by = best[segments[k][0]] + value[k], k
        best.append(top)
        back.append(by)
    spans, b = [], len(edges) - 1
    while b > 0:
        if back[b] < 0:
            b -= 1
        else:
            a, e = segments[back[b]]
            k = int(kind[back[b]])
            spans.append((k, KINDS[k], edges[a], edges[e]))
            b = a
    return spans[::-1]


def find(text: str, weights: np.ndarray) -> tuple[list, list]:
    """Base spans and added spans of a text."""
    base = base_spans(text)
    added = []
    taken = sorted((s, e) for _, _, s, e in base)
    starts = [s for s, _ in taken]
    reach = list(np.maximum.accumulate([e for _, e in taken])) if taken else []
    for m in _STRETCH.finditer(text):
        stretch = m[0]
        for order, kind, a, b in decode(stretch, weights):
            a, b = a + m.start(), b + m.start()
            k = int(np.searchsorted(starts, b))
            if k == 0 or reach[k - 1] <= a:
                added.append((order, kind, a, b))
    return base, added


def joined(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for _, kind, a, b in sorted(spans, key=lambda s: (s[0], s[2])))


COUNTS = ["n_email", "n_ip", "n_card", "n_phone"]
FOUND = ["doc_id", *COUNTS, "base_sha256", "spans", "n_added"]
SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def pii_spans(docs: DataFrame) -> DataFrame:
    """Spans of every row: counts and digest of the base ones, all as `spans`."""
    weights = fit()

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                base, added = find(text, weights)
                counts = [sum(k == kind for k, *_ in base) for kind in range(len(KINDS))]
                out.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + added), len(added)))
            columns = list(zip(*out, strict=True)) if out else [[]] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            arrays = [pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=FOUND)

    return id_text(docs).mapInArrow(run, SCHEMA)


def masked(text: str, spans) -> str:
    """The text with each span replaced by its kind; overlapping spans are one, the first one's kind."""
    out, at = [], 0
    for _, kind, a, b in sorted(spans, key=lambda s: (s[2], s[0])):
        if a >= at:
            out += (text[at:a], f"[{kind}]")
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame) -> DataFrame:
    """docs with personal data in `text` replaced by its kind in brackets; n_chars follows."""
    weights = fit()
    names = docs.columns

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = [t if t is None else masked(t, sum(find(t, weights), [])) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in names:
        size = F.when(F.col("n_chars").isNotNull() & F.col("text").isNotNull(), F.char_length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return out.select(*names)
