"""Exact dedup, SimHash, licences and repeated passages against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as driver
from patio.llm import exact_dedup, licence_texts, licenses, simhash, suffix_array, suffix_dedup
from patio.llm.common import documents
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"
random.seed(3)
WORDS = ["lorem", "ipsum", "dolor", "sit", "amet", "magna", "aliqua", "enim", "minim", "veniam", "quis", "nostrud"]


def prose(n, seed):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randint(0, 99)) for _ in range(n))


def test_sql_answers(spark):
    con = connect(SF)
    for key in ("op1_license_scan", "op3_exact_dedup"):
        assert difference(driver.queries()[key](spark, SF), con, driver.oracle_sql()[key]) is None, key


def test_minimal_perfect_hash():
    for n in (1, 2, 7, 500):
        keys = np.random.default_rng(n).integers(0, 256, (n, 32), dtype=np.uint8)
        moves, slots = exact_dedup.build_bucket(keys)
        assert sorted(slots) == list(range(n))
        assert (exact_dedup._slot(keys, moves[exact_dedup._group(keys, len(moves))], n) == slots).all()


def test_exact_odd(odd_docs, no_docs):
    rows = {(r.doc_id, r.text_sha256, r.copy): r for r in exact_dedup.exact_dedup(odd_docs).collect()}
    assert len(rows) >= 9 and exact_dedup.exact_dedup(no_docs).count() == 0
    empty = hashlib.sha256(b"").hexdigest()
    assert rows[2, empty, 1].keep_id == 1 and rows[1, empty, 1].kept and rows[1, empty, 1].group_size == 4
    kept = exact_dedup.keep_first(odd_docs)
    assert sorted((r.doc_id or 0, r.text) for r in kept.select("doc_id", "text").collect() if r.text and len(r.text) < 99) == [
        (0, "lost words here"), (4, "same row"), (7, "one\ntwo")]
    assert kept.columns == odd_docs.columns


def brute_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash_brute(spark):
    docs = documents(spark, SF)
    got = {r.doc_id: r for r in driver.queries()["op10_simhash"](spark, SF).collect()}
    want = {r.doc_id: brute_fingerprint(r.text) for r in docs.collect()}
    assert all(got[d].fingerprint == f"{f:016x}" for d, f in want.items())
    root = {d: d for d in want}
    changed = True
    while changed:
        changed = False
        for a in want:
            for b in want:
                if root[b] < root[a] and (want[a] ^ want[b]).bit_count() <= 3:
                    root[a], changed = root[b], True
    assert {d: r.component_id for d, r in got.items()} == root


def test_linked_rows_brute(monkeypatch):
    rng = np.random.default_rng(4)
    centre = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    code = np.repeat(centre, 30)
    for _ in range(3):
        code ^= np.uint64(1) << rng.integers(0, 24, len(code)).astype(np.uint64)
    code = np.unique(code)
    for frontier in (1 << 18, 50):
        monkeypatch.setattr(simhash, "FRONTIER", frontier)
        key = np.zeros(len(code), np.int64)
        order = np.argsort(simhash.gray_rank(code))
        head = simhash.linked_rows(key, code[order])
        near = np.bitwise_count(code[order][:, None] ^ code[order][None, :]) <= 3
        reach = np.eye(len(code), dtype=bool) | near
        while ((reach @ reach) != reach).any():
            reach = reach @ reach
        assert (head == reach.argmax(axis=1)).all()


def test_simhash_hot_keys(docs, monkeypatch, spark):
    monkeypatch.setattr(simhash, "HOT_ROWS", 5)
    points = [(int(x), k) for k, x in enumerate([0, 1, 3, 7, 1 << 20, (1 << 20) | 6, 1 << 40, 5 << 50, 255, 256])]
    frame = spark.createDataFrame(points, "fp long, node long")
    links = simhash.components(simhash.edges(frame)).collect()
    got = {r.node: r.root for r in links}
    root = {n: n for _, n in points}
    for _ in points:
        for a, m in points:
            for b, n in points:
                if (a ^ b).bit_count() <= 3:
                    root[m] = root[n] = min(root[m], root[n])
    assert {n: got.get(n, n) for _, n in points} == root


def test_simhash_odd(odd_docs, no_docs):
    rows = simhash.near_groups(odd_docs).collect()
    assert len(rows) == odd_docs.count() and simhash.near_groups(no_docs).count() == 0
    by_id = {r.doc_id: r for r in rows}
    assert by_id[1].fp == by_id[2].fp == 0 and by_id[2].component_id == 1
    assert by_id[5].component_id == 4 and by_id[None].component_id is None
    kept = simhash.keep_one(odd_docs)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 4, 6, 7] and kept.columns == odd_docs.columns


def test_licences(docs, odd_docs, no_docs):
    mit = "Copyright (c) 2024 Someone\n\n" + licence_texts.MIT.replace("copyright holders", "Copyright Holders").upper() + "\n"
    zlib = licence_texts.ZLIB.replace("acknowledgment", "acknowledgement").replace("\n", "  \n ")
    got = {r.doc_id: r for r in licenses.license_scan(docs(mit, zlib, "words\nReleased under the  MIT LICENCE\n" * 2, licence_texts.MIT + " and more")).collect()}
    assert [got[k].licence for k in range(4)] == ["MIT", "Zlib", None, None]
    assert (got[2].notices, got[2].n_notices) == ("MIT", 2)
    assert licenses.license_scan(odd_docs).count() == odd_docs.count() and licenses.license_scan(no_docs).count() == 0
    plan = licenses.license_scan(docs("x"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


@pytest.mark.parametrize("most", [0, 100])
def test_licences_of_the_caller(spark, docs, odd_docs, monkeypatch, most):
    """A list of the caller's, broadcast or hash-joined: long texts, equal texts, null and empty ones."""
    monkeypatch.setattr(licenses, "BROADCAST_TEXTS", most)
    long = "You may share this licence.\n" + "Clause by clause it grants little. " * 20_000
    rows = [("Own-2", long), ("Own-1", long.replace("licence", "license")), ("Nil", None), ("Nil", " .. "), ("Own-3", "Do as you like")]
    listed = spark.createDataFrame(rows, "licence string, text string")
    found = licenses.license_scan(docs(long.upper(), "do AS you like!", licence_texts.MIT, None, "", long + "more"), listed)
    assert [r.licence for r in found.orderBy("doc_id").collect()] == ["Own-1", "Own-3", None, None, None, None]
    assert ("strategy=broadcast" in found._jdf.queryExecution().analyzed().toString()) == (most > 0)
    assert licenses.license_scan(odd_docs, listed.limit(0)).where("licence is null").count() == odd_docs.count()


def brute_removed(texts):
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + 400] for b in raw for i in range(len(b) - 399))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, np.int64)
        for i in range(len(b) - 399):
            if count[b[i : i + 400]] > 1:
                gone[i] += 1
                gone[i + 400 if i + 400 < len(b) else -1] -= 1
        cover = np.cumsum(gone)[: len(b)] > 0
        kept = np.frombuffer(b, np.uint8)[~cover].tobytes()
        spans = int(cover[:1].sum() + (cover[1:] & ~cover[:-1]).sum())
        out.append((len(b), int(cover.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("case", ["as shipped", "crowded keys", "clashing numbers"])
def test_repeats_brute(docs, monkeypatch, case):
    if case == "crowded keys":
        monkeypatch.setattr(suffix_dedup, "CROWDED", 1)
    if case == "clashing numbers":
        name = suffix_dedup._name
        monkeypatch.setattr(suffix_dedup, "_name", lambda text, turn: name(text, turn) if turn else F.length(text) % 2)
    a, b, c = prose(120, 1), prose(400, 2), prose(90, 3)
    texts = [
        a, a[:399], a[:400], a[5:300] + b, b[40:900] + c, prose(200, 9) + a[100:520] + "é" * 300, c + "é" * 500, "xy" * 450,
        "na na na batman " * 60, b[500:1100] + b[500:1100], a[:350] + c[:350], None, "", "short", b, b, "q" + c[1:], prose(300, 5),
    ]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(docs(*texts)).collect()}
    assert [got[k] for k in range(len(texts))] == brute_removed(texts)


@pytest.mark.parametrize(("rows", "top"), [(60_000, 4096), (96, 4096), (96, 3)])
def test_suffixes_sorted_brute(spark, monkeypatch, rows, top):
    """One part, parts cut on the driver, and parts cut once more: the same order."""
    monkeypatch.setattr(suffix_array, "PART_ROWS", rows)
    monkeypatch.setattr(suffix_array, "TOP_PARTS", top)
    pick = random.Random(8)
    strings = [[pick.randint(1, 3) for _ in range(pick.randint(1, 90))] for _ in range(40)]
    strings += [[3]] * 900 + [strings[0]] * 8 + [[2] * 120, [1, 2] * 50] + [[pick.randint(1, 2), *strings[1]] for _ in range(6)]
    letters = [(s, i, x) for s, string in enumerate(strings) for i, x in enumerate(string) if (s + i) % 41 != 40]
    frame = spark.createDataFrame(letters, "s long, i int, a long")
    zero, one = F.lit(0), F.lit(1)
    frame = frame.select(
        "s", zero.alias("r"), "i", "a", F.col("i").alias("p"), one.alias("cover"), zero.alias("lo"), zero.alias("hi"),
        zero.cast("long").alias("kr"), zero.cast("long").alias("f"),
    )
    got = suffix_array.sort_suffixes(frame).select("s", "i", "rank").collect()
    at = {(s, i): x for s, i, x in letters}

    def suffix(s, i):
        out = []
        while (s, i) in at:
            out.append(at[s, i])
            i += 1
        return out

    assert len(got) == len({r.rank for r in got}) == len(letters)
    order = [suffix(r.s, r.i) for r in sorted(got, key=lambda r: r.rank)]
    assert order == sorted(order)
    parts = Counter(r.rank >> 32 for r in got)
    assert len(parts) > 10 if rows == 96 else len(parts) == 1
    assert max(parts.values()) <= 3 * rows  # 900 equal suffixes, all at places 0, are spread


def test_repeats_deep_recursion(docs):
    """Many near copies with edits and short periods: names repeat over several rounds."""
    base = prose(250, 11)
    texts = [base[: 100 * k] + f"[{k}]" + base[100 * k :] for k in range(12)] + ["ab " * 300, "abc ab " * 200, "ab " * 300 + base[300:900]]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(docs(*texts)).collect()}
    assert [got[k] for k in range(len(texts))] == brute_removed(texts)


def test_repeats_copies_meet_once(docs, monkeypatch):
    """However many copies a text has, each of its anchors reaches the suffix array once."""
    seen, sort = [], suffix_dedup.sort_suffixes
    monkeypatch.setattr(suffix_dedup, "sort_suffixes", lambda strings: seen.append(strings) or sort(strings))
    a = prose(200, 21)
    texts = [a] * 30 + [a[:700] + prose(100, 22)]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(docs(*texts)).collect()}
    assert [got[k] for k in range(len(texts))] == brute_removed(texts)
    [strings] = seen
    assert strings.count() == strings.select("s", "i").distinct().count() > 0


def brute_shared(texts):
    words = [(t or "").encode().split() for t in texts]
    found = [[b" ".join(w[i : i + 51]) for i in range(len(w) - 50)] for w in words]
    where = Counter(p for each in found for p in set(each))
    return [sum(where[p] > 1 for p in each) for each in found]


def test_shared_words_brute(docs):
    """Passages of over 50 words, shorter than 400 bytes: nothing is removed, but they are counted."""
    a, b, c = (prose(n, seed).split() for n, seed in ((300, 31), (400, 32), (60, 33)))
    small = [f"{x:x}" for x in range(16, 76)]  # 51 words are 152 bytes
    join, near = " ".join, b[:180] + ["other"] + b[181:]
    texts = [
        join(a), join(prose(90, 34).split() + a[100:151]), join(prose(90, 35).split() + a[200:250]), "\n".join(a[20:75]) + "\t \x0bé",
        join(small), join(c + small[3:54] + c), join(small[:50]), join(c[:51]), join(c[:51]), join(c[:50]), join(c[:50]),
        join(b), join(near), join(b[:90] + near[60:]), join(b + b[100:200]), join(prose(70, 36).split() * 3), "na " * 200, "na " * 49 + "no " + "na " * 60,
        None, "", "a " * 51, "a " * 52, "a " * 50,
    ]
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs(*texts)).collect()}
    assert [got[k].n_shared for k in range(len(texts))] == brute_shared(texts)
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in map(got.get, range(len(texts)))] == brute_removed(texts)
    assert got[1].n_removed == got[4].n_removed == 0 < got[1].n_shared


def test_shared_words_near_copies(docs):
    """Many copies with edits, exact copies among them, and a passage that all share."""
    base, common = prose(200, 41).split(), prose(51, 42).split()
    texts = [" ".join(base[: 9 * k] + [f"[{k}]"] + base[9 * k :] + common) for k in range(20)] + [" ".join(prose(30 + k, k).split() + common) for k in range(30)]
    texts += [texts[3], texts[3], texts[25], " ".join(common[:50])]
    got = {r.doc_id: r.n_shared for r in suffix_dedup.remove_repeats(docs(*texts)).collect()}
    assert [got[k] for k in range(len(texts))] == brute_shared(texts)


def test_repeats_odd(odd_docs, no_docs):
    rows = suffix_dedup.remove_repeats(odd_docs).collect()
    assert len(rows) == odd_docs.count() and suffix_dedup.remove_repeats(no_docs).count() == 0
    assert {r.doc_id: r.n_removed for r in rows if r.n_removed} == {6: 36 * 8000}
