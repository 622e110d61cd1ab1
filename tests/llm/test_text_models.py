"""Language ID, PII, tokens, packing, fingerprints, secrets and the pipeline."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from patio.llm import edit_fingerprints, lang_id, packing, pii, piece_viterbi, secret_scan
from patio.llm.bpe import Encoder
from patio.llm.common import documents, utf8

SF = "/root/testdata/sf0.001"
SIGNS = ["the", "Erheha", "don't", "'S", "Ñandú", "ß", "×", "²", " ", "é", "İ", "ΑΣ", "日本", "😀", "<s>", ".", ",,", "123", "\x00", "\x1c", "\n", "\t", "a" * 70, "-", "▁", "  "]


def noise(n, seed):
    pick = random.Random(seed)
    return ["", " "] + ["".join(pick.choice(SIGNS) for _ in range(pick.randint(0, 14))) for _ in range(n)]


def test_language_held_out(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    rows = driver.queries()["op4_language_id"](spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held) and all(0 <= r.score <= 1 for r in rows)


def test_language_odd(odd_docs, no_docs, docs):
    rows = {r.doc_id: r for r in lang_id.language_id(odd_docs).collect()}
    assert rows[1].lang_pred == "und" and rows[1].score == 0 and rows[7].lang_pred == "en" and rows[None].held_out
    assert lang_id.language_id(no_docs).count() == 0
    assert {r.lang_pred for r in lang_id.language_id(docs("words", "123 ...", lang=None)).collect()} == {"und"}
    kept = lang_id.keep_known(odd_docs)
    assert kept.columns == odd_docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 4, 4, 5, 6, 7]


def test_network_gradients():
    rng = np.random.default_rng(1)
    windows, target = rng.integers(0, 256, (5, 32)).astype(np.uint8), np.array([0, 1, 0, 1, 1])
    net = lang_id.Network(["a", "b"])
    for weight, grad in zip(net.weights(), net.gradients(windows, target), strict=True):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        losses = []
        for move in (2e-3, -2e-3):
            weight[at] += move
            p = net.probabilities(windows)
            losses.append(-np.log(p[np.arange(5), target]).mean())
            weight[at] -= move
        assert abs((losses[0] - losses[1]) / 4e-3 - grad[at]) < 5e-3


def brute_pii(text):
    out = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", m))
    out += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [(k, m.start(), m.end()) for k, m in out]


def test_pii_base_brute():
    pick = random.Random(5)
    parts = ["a.b", "@", "x-y", ".", "com", "1", "23", "255", "4539578763621486", "+", "(", ")", " ", "-", "é", "+1 (555) 123-4567", "1.2.3.4", "300", "4539 5787 6362 1486"]
    for _ in range(4000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 12)))
        assert [(k, a, b) for _, k, a, b in pii.base_spans(text)] == brute_pii(text), text


def test_pii_field():
    weights = pii.fit()
    assert [s[1:] for s in pii.find("call (517) 555-0724 now", weights)[1]] == [("phone", 5, 19)]
    assert pii.find("on 2024-05-12 at 10:30 paid 12,345,678 for v1.2.3", weights)[1] == []
    wrong = total = 0
    for text, spans in pii._examples(np.random.default_rng(99), 200):
        got = {(k, a, b) for k, _, a, b in sum(pii.find(text, weights), [])}
        wrong, total = wrong + len(got ^ set(spans)), total + len(spans)
    assert wrong <= 0.06 * total


def test_pii_decode_brute():
    """The dynamic program against all sets of segments of a short stretch."""
    weights = pii.fit()
    for text in ("(517) 555-0724 1.2.3.4", "4539 5787 6362 1486", "555-0724 12"):
        edges, segments, rows = pii.candidates(text)
        value = (rows @ weights).max(axis=1) - pii.MARGIN
        best = {0: 0.0}
        for b in range(1, len(edges)):
            best[b] = max([best[b - 1], *(best[a] + value[k] for k, (a, e) in enumerate(segments) if e == b)])
        at = {(edges[a], edges[b]): k for k, (a, b) in enumerate(segments)}
        assert sum(value[at[a, b]] for _, _, a, b in pii.decode(text, weights)) == pytest.approx(best[len(edges) - 1])


def test_pii_query(spark, odd_docs, no_docs):
    texts = {r.doc_id: r.text for r in documents(spark, SF).collect()}
    for r in driver.queries()["op5_pii"](spark, SF).collect():
        base = brute_pii(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and set(joined.split(",")) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, *_ in base) for kind in pii.KINDS]
    assert pii.pii_spans(odd_docs).count() == odd_docs.count() and pii.pii_spans(no_docs).count() == 0
    assert pii.mask(odd_docs).columns == odd_docs.columns and pii.mask(no_docs).count() == 0


def test_pii_mask(docs):
    rows = pii.mask(docs("mail bob@x.com or 1.2.3.4", None, "plain")).collect()
    assert [r.text for r in rows] == ["mail [email] or [ip]", None, "plain"] and rows[0].n_chars == len(rows[0].text)


def test_merging_equals_library():
    from tokenizers import Tokenizer

    path = packing.default_tokenizer()
    library, own = Tokenizer.from_file(path), Encoder(path)
    library.encode_special_tokens = True
    texts = noise(3000, 2)
    ids, at = own.ids(*utf8(pa.array(texts)), 0)
    for k, e in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert e.ids + [0] == ids[at[k] : at[k + 1]].tolist(), texts[k]


def test_packing_query(spark, odd_docs, no_docs):
    rows = driver.queries()["op7_packing"](spark, SF).collect()
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:k]) for k in range(len(held))] and sum(n for _, n in held) <= packing.CAPACITY
    assert len(bins) <= 1.03 * sum(r.length for r in rows) / packing.CAPACITY + 2
    odd = packing.pack(odd_docs).collect()
    assert sum(r.piece == 0 for r in odd) == odd_docs.count() and {r.length for r in odd if r.doc_id in (1, 2)} == {1}
    assert packing.pack(no_docs).count() == 0


def test_packing_rounds(docs, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 7)
    texts = [" ".join(["word"] * (37 * k % 900 + 1)) for k in range(60)]
    rows = packing.pack(docs(*texts)).collect()
    assert sorted((r.doc_id, r.piece) for r in rows) == [(k, 0) for k in range(60)]
    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= packing.CAPACITY and len(filled) <= 1.2 * sum(filled.values()) / packing.CAPACITY + 1


def test_place_brute():
    """Each step leaves the smallest sum of squares."""
    lengths, capacity = np.random.default_rng(2).integers(1, 21, 150), 20
    own, gap = packing.place(lengths, capacity), {}
    for size, bin_ in zip(lengths.tolist(), own.tolist(), strict=True):

        def total(at, left, gap=gap):
            gaps = [g for b, g in gap.items() if b != at and g] + [left] * bool(left)
            return sum(gaps.count(g) ** 2 for g in set(gaps))

        made = total(bin_, gap.get(bin_, capacity) - size)
        others = [total(b, g - size) for b, g in gap.items() if g >= size] + [total(-1, capacity - size)]
        assert made == min(others)
        gap[bin_] = gap.get(bin_, capacity) - size
    assert min(gap.values()) >= 0


def test_viterbi_equals_library():
    """Without characters that need bytes or runs of blanks, whose scores swallow all others."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    path = piece_viterbi.default_model()
    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    pick = random.Random(8)
    words = ["Hello", "world", "thanheh", "Ñandú", "ß", "don't", "123", ".", "aaaa", "été", "xyzzy"]
    texts = [" ".join(pick.choice(words) for _ in range(pick.randint(1, 9))) for _ in range(1500)]
    ids, at = piece_viterbi.Model(path).encode(*utf8(pa.array(texts)))
    assert all(library.encode(t) == ids[at[k] : at[k + 1]].tolist() for k, t in enumerate(texts))


def test_viterbi_round_trip(spark, odd_docs, no_docs):
    model = piece_viterbi.Model(piece_viterbi.default_model())
    texts = [t.replace("▁", " ") for t in noise(1500, 4)] + ["long" * 9000 + "é" * 3000]
    ids, at = model.encode(*utf8(pa.array(texts)))
    data, edge = model.decode(ids, at)
    raw = data.tobytes()
    assert [raw[a:b].decode() for a, b in zip(edge[:-1], edge[1:], strict=True)] == texts
    rows = driver.queries()["op6_piece_viterbi"](spark, SF).collect()
    assert rows and all(r.round_trip for r in rows)
    assert {r.doc_id: len(r.ids) for r in piece_viterbi.encode(odd_docs).collect()}[2] == 0
    assert piece_viterbi.decode(piece_viterbi.encode(no_docs)).count() == 0


def test_fingerprint_query(spark, odd_docs, no_docs):
    texts = {r.doc_id: r.text for r in documents(spark, SF).collect()}
    order = sorted(texts, reverse=True)
    rows = {r.doc_id: r for r in driver.queries()["op8_edit_fingerprints"](spark, SF).collect()}
    for k, d in enumerate(order):
        text, after = texts[d], texts[order[(k + 1) % len(order)]]
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        assert rows[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and rows[d].n_chars == len(text)
    near, apart = (np.mean([getattr(r, n) for r in rows.values()]) for n in ("near_edited", "near_next"))
    assert 0.4 < near < 0.6 and apart < 0.2
    assert edit_fingerprints.edit_fingerprints(odd_docs).count() == odd_docs.count()
    assert edit_fingerprints.edit_fingerprints(no_docs).count() == 0


def test_fingerprint_ranges(docs, monkeypatch):
    monkeypatch.setattr(edit_fingerprints, "RANGE_ROWS", 3)
    texts = [f"text number {k} " * 5 for k in range(40)]
    rows = {r.doc_id: r for r in edit_fingerprints.edit_fingerprints(docs(*texts, (None, "no id"))).collect()}
    order = [*range(39, -1, -1), None]
    by_id = dict(enumerate(texts)) | {None: "no id"}
    for k, d in enumerate(order):
        n, after = len(by_id[d]), by_id[order[(k + 1) % len(order)]]
        assert rows[d].edited_sha256 == hashlib.sha256((by_id[d][: n - n // 2] + after[: n // 2]).encode()).hexdigest(), d


def test_walk_brute_and_likeness():
    """Texts walked together give what each gives by itself, step by step."""
    texts = noise(60, 6) + ["abcdefgh " * 200]
    made = edit_fingerprints.walk(texts)
    places = edit_fingerprints._places.at
    for text, samples in zip(texts, made.tolist(), strict=True):
        want, at, step = [edit_fingerprints.ABSENT] * edit_fingerprints.SAMPLES, 0, 0
        while at < len(text):
            code = (ord(text[at]) * 2654435761 % (1 << 32) >> 13) % edit_fingerprints.END
            if step in places:
                want[places[step]] = int(edit_fingerprints._NIBBLE[code])
            at += int(edit_fingerprints._BITS[step % edit_fingerprints.PERIOD, code])
            step += 1
        assert samples == want
    base = "".join(random.Random(3).choices("abcdefghijklmnop ", k=4000))
    edited = base[:1000] + "X" + base[1001:2500] + "Y" + base[2500:]
    a, b, c = (edit_fingerprints.walk([t]) for t in (base, edited, base[::-1]))
    assert edit_fingerprints.likeness(a, b)[0] > 0.7 > 0.3 > edit_fingerprints.likeness(a, c)[0]
    assert edit_fingerprints.likeness(a, a)[0] == 1


def test_similar_search(spark, docs):
    base = "".join(random.Random(4).choices("abcdefghijklmnop ", k=3000))
    rows = edit_fingerprints.edit_fingerprints(docs(base, base + "!", base[:2950], base[::-1], base))
    found = edit_fingerprints.similar(rows.where("doc_id = 0"), rows).collect()
    assert {r.doc_id for r in found} >= {0, 1, 4} and 3 not in {r.doc_id for r in found}


def brute_secrets(text):
    rule = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    out = [(m.start(), 0, m.end()) for m in rule.finditer(text) if len(m[1]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32])


def test_secrets_brute(spark, odd_docs, no_docs):
    pick = random.Random(7)
    parts = ["password", "PassWD", "secret", "token", "api_key", "=", ":", " ", '"', "'", "abcdefgh", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef" * 2, "\t", "ſecret", "é", "abc="]
    for _ in range(4000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 12)))
        assert secret_scan.base_spans(text) == brute_secrets(text), text
    texts = {r.doc_id: r.text for r in documents(spark, SF).collect()}
    for r in driver.queries()["op9_secret_scan"](spark, SF).collect():
        assert r.base_sha256 == hashlib.sha256(secret_scan.joined(brute_secrets(texts[r.doc_id])).encode()).hexdigest()
    assert secret_scan.secret_spans(odd_docs).count() == odd_docs.count() and secret_scan.secret_spans(no_docs).count() == 0


def test_guess_cost():
    cost = secret_scan.guess_cost
    assert max(map(cost, ("password123", "qwertyuiop", "aaaaaaaa", "changeme", "2019-05-12", "abcabcabc"))) < 6
    assert min(map(cost, ("x9$Kq!27zP", "f8cb0ab732d29a210e"))) > 15
    text = 'pwd: "x9$Kq!27zP" and passphrase=hunter2'
    assert secret_scan.scan(text)[1] == [(6, 3, 16)]


def test_guess_cost_brute():
    """The program against all segmentations of short values."""
    from functools import lru_cache
    from math import factorial, log10

    for value in ("pass12", "aaab", "x1x1", "qwe9"):
        found = {}
        for a, b, cost in secret_scan.segments(value):
            found[a, b] = min(found.get((a, b), 99), max(cost, 0.0))
        sign = log10(secret_scan._alphabet(value))

        @lru_cache(None)
        def best(at, k, value=value, found=found, sign=sign):
            if at == len(value):
                return log10(factorial(k))
            return min(min(found.get((at, b), 99), sign * (b - at)) + best(b, k + 1) for b in range(at + 1, len(value) + 1))

        assert secret_scan.guess_cost(value) == pytest.approx(best(0, 0))


def test_guess_cost_long():
    """Length and number of segments change no rule, and long values take linear time."""
    scan = secret_scan.scan
    for text in ("passphrase=" + "z" * 200, "passphrase=" + "z" * 300, "passphrase=" + "ab" * 20000, "passphrase=" + "".join(map(chr, range(0x4E00, 0x5600)))):
        assert scan(text)[1] == [], text[:20]
    assert scan("passphrase=" + "password" * 13)[1] == [] and len(scan("passphrase=" + "password" * 14)[1]) == 1
    assert len(scan("passphrase=" + "x9$Kq!27zP" * 3 + "q" * 400)[1]) == 1
    assert len(scan("passphrase=" + "qw" * 20 + "er" * 2000 + "x9$Kq!27zP")[1]) == 1


def test_pipeline_stages(spark, odd_docs, no_docs):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "simhash_near_dedup", "pii", "packing"]
    rows = driver.queries()["pipeline"](spark, SF).collect()
    kept = {r.doc_id for r in rows}
    docs = documents(spark, SF)
    exact = {r.doc_id for r in driver.queries()["op3_exact_dedup"](spark, SF).collect() if r.kept}
    assert kept <= exact and len(kept) > 0.8 * docs.select("text").distinct().count()
    for start in (odd_docs, no_docs):
        frame = start
        for name, stage in corpus_pipeline.STAGES:
            before = frame.columns
            frame = stage(spark, frame, SF)
            assert name == "packing" or frame.columns == before
        assert frame.count() >= 0
    assert {r.doc_id for r in frame.collect()} == set()


def test_pipeline_brute(spark, docs):
    """On few texts the whole pipeline by plain code."""
    base = " ".join(f"word{k}" for k in range(400))
    texts = ["12345", base, base.replace(" ", "  "), base + " more", "mail bob@x.com please", None, "other text stands here"]
    frame = docs(*texts)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, SF)
    got = {r.doc_id: r.text for r in frame.collect()}
    assert got[1] == base and got[4] == "mail [email] please" and not {0, 2, 5} & set(got)
    pieces = corpus_pipeline.STAGES[-1][1](spark, frame, SF).collect()
    assert {r.doc_id for r in pieces} == set(got)
