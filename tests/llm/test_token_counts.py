"""Token counts against the library."""

import random

import pytest
from tokenizers import Tokenizer

import __spark_entry__ as driver
from patio.llm import token_counts
from patio.llm.common import documents

SF = "/root/testdata/sf0.01"
SIGNS = ["the", " ", "  ", "\n", "don't", "'S", "'ll", "é", "ß", "日本", "😀", "<|endoftext|>", "123", "²", "՘", "　", "\x00", "\x85", "a" * 70, "-", "..", "'re", "'", "İ"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(token_counts.VOCABULARY)


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(token_counts.VOCABULARY, token_counts.prove_whole())


def sizes(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_query_equals_the_library(spark, library):
    rows = {r.doc_id: r for r in driver.queries()["op13_token_counts"](spark, SF).collect()}
    texts = {r.doc_id: r.text or "" for r in documents(spark, SF).collect()}
    want = dict(zip(texts, sizes(library, list(texts.values())), strict=True))
    assert {k: r.n_tokens for k, r in rows.items()} == want
    assert all(r.n_bytes == len(texts[k].encode()) and r.over_limit == (r.n_tokens > 1024) for k, r in rows.items())
    assert 0 < sum(r.n_whole for r in rows.values()) < sum(want.values())


def test_noise_equals_the_library(library, counter):
    pick = random.Random(4)
    texts = ["".join(pick.choice(SIGNS) for _ in range(pick.randint(0, 14))) for _ in range(3000)]
    texts += ["a" * 30_000, "x" + " " * 5000, "<|endoftext|>" * 3]
    assert counter.count(texts)[0].tolist() == sizes(library, texts)


def test_proof_against_merging_by_the_library(library):
    whole = token_counts.prove_whole()
    pieces = random.Random(2).sample(sorted(whole), 2000)
    signs = dict(enumerate(token_counts._byte_signs()))
    assert all(len(library.model.tokenize("".join(signs[b] for b in p.encode()))) == 1 for p in pieces)
    rules = token_counts.merger(token_counts.VOCABULARY)
    others = [s for s in rules.strings if rules.count(s) > 1]
    assert all(len(library.model.tokenize("".join(signs[b] for b in s))) > 1 for s in others)


def test_windows_change_nothing(library, counter, monkeypatch):
    text = "It's a 12 word-list,  then\n more 'll words <|endoftext|> and é 日本 go on " * 50
    assert "".join(token_counts.windows(text, 40)) == text and len(list(token_counts.windows(text, 40))) > 20
    whole = counter.count([text])
    monkeypatch.setattr(token_counts, "WINDOW", 64)
    monkeypatch.setattr(token_counts, "REMEMBERED", 5)
    monkeypatch.setattr(token_counts.windows, "__defaults__", (64,))
    small = token_counts.Counter(token_counts.VOCABULARY, counter.whole)
    assert [x.tolist() for x in small.count([text, text])] == [[int(v[0])] * 2 for v in whole]
    assert whole[0].tolist() == sizes(library, [text])


def test_odd_rows(odd_docs, no_docs, library):
    rows = token_counts.token_counts(odd_docs, limit=2).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert (by_id[1].n_bytes, by_id[1].n_tokens, by_id[1].over_limit) == (0, 0, False)
    assert by_id[7].n_tokens == sizes(library, ["one\ntwo"])[0] and by_id[7].over_limit
    assert by_id[6].n_tokens == sizes(library, ["tall words stand in a row and go on " * 8000])[0]
    assert token_counts.token_counts(no_docs).count() == 0


def test_other_vocabularies_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        token_counts.Merger(public_tokenizers.path("word_bpe_49k.json"))
