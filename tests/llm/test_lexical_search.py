"""Search against brute force and its SQL answer."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as driver
from patio.llm import lexical_search
from patio.llm.lexical_search import Corpus, Queries, Scorer, counted

SF = "/root/testdata/sf0.01"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    held = [(i, Counter(words(t))) for i, t in docs]
    total = sum(sum(c.values()) for _, c in held)
    n_docs = sum(1 for _, c in held if c)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            m = 75 + 25 * sum(c.values()) * n_docs // max(total, 1)
            w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in words(text)}
            score = sum(w[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in words(text) if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, n, s[3], -s[0]) for n, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def found(docs, items, **options):
    return sorted(map(tuple, lexical_search.search(docs, items, **options).collect()), key=repr)


@pytest.fixture
def items(spark):
    return lambda *rows: spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "item_id long, text string")


def test_query_equals_sql(spark):
    got = sorted(map(tuple, driver.queries()["op12_lexical_search"](spark, SF).collect()))
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    assert got == sorted(db.execute(driver.oracle_sql()["op12_lexical_search"]).fetchall()) and got


def noise(n, seed):
    pick = random.Random(seed)
    vocabulary = ["Word", "wORD", "ß", "É", "é", "10", "a", "日本", "x-y", "İ", "tail", *[f"w{k}" for k in range(30)]]
    return [" ".join(pick.choice(vocabulary) for _ in range(pick.randint(0, 25))) for _ in range(n)]


def test_noise_in_blocks(docs, items, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 3)
    monkeypatch.setattr(lexical_search, "BATCH_ROWS", 7)
    texts, asked = noise(120, 1), [*noise(6, 2), "", None, "nowhere", "word word word"]
    rows, queries = docs(*texts), items(*asked)
    assert found(rows, queries, k=5) == brute(list(enumerate(texts)), list(enumerate(asked)), 5)


def test_ties_and_odd_rows(odd_docs, no_docs, items):
    queries = items("same row", "TALL words", "lost", None)
    want = brute([(r.doc_id, r.text) for r in odd_docs.collect()], [(r.item_id, r.text) for r in queries.collect()])
    assert found(odd_docs, queries) == want
    assert found(no_docs, queries) == [] and found(odd_docs, items("x").limit(0)) == []


def test_equal_hashes_are_told_apart(monkeypatch):
    texts, asked = noise(60, 3), noise(4, 4)
    plain = lexical_search.terms_of

    def few_hashes(data, at):
        found = plain(data, at)
        return found._replace(code=found.code % np.uint64(5))

    def answers():
        queries = Queries(asked)
        batch = counted(queries, pa.array(texts))
        held = dict(enumerate(np.bincount(batch.number[batch.number >= 0], minlength=len(queries.number)).tolist()))
        names = {v: k.decode() for k, v in queries.number.items()}
        corpus = Corpus(int((batch.n > 0).sum()), int(batch.n.sum()), held)
        scorer = Scorer(queries, corpus, 10)
        scorer.add(list(range(len(texts))), batch)
        return {names[t]: n for t, n in held.items()}, scorer.best

    want = answers()
    monkeypatch.setattr(lexical_search, "terms_of", few_hashes)
    assert answers() == want


def test_few_documents_are_scored(spark):
    """The bound leaves most pairs of a query and a document unscored."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").toPandas()
    table = docs.fillna({"text": ""}).toArrow()
    queries = Queries(items.text.fillna("").tolist())
    corpus = lexical_search.corpus_counts(docs.fillna({"text": ""}), queries)
    scorer = Scorer(queries, corpus, 20)
    for batch in table.to_batches(max_chunksize=100):
        scorer.add(batch.column("doc_id").to_pylist(), counted(queries, batch.column("text")))
    pairs = len(items) * table.num_rows
    assert scorer.scored < 0.3 * pairs
