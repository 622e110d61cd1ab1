"""Near copies that the pipeline drops: fingerprints of 3-word shingles within 3 bits, against all pairs."""

import random

import corpus_pipeline
from patio.llm import simhash
from patio.llm.common import documents

SF = "/root/testdata/sf0.01"


def brute_kept(texts):
    """Ids that are the smallest of what links between fingerprints reach."""
    prints = {k: simhash.fingerprint((t or "").encode()) & (1 << 64) - 1 for k, t in texts.items()}
    root = {}
    for k in sorted(prints):
        if k in root:
            continue
        root[k], open_ids = k, [k]
        while open_ids:
            at = open_ids.pop()
            for other, fp in prints.items():
                if other not in root and (fp ^ prints[at]).bit_count() <= 3:
                    root[other] = k
                    open_ids.append(other)
    return {k for k in root if root[k] == k}


def test_near_copies_brute(spark):
    docs = documents(spark, SF)
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == brute_kept(texts)


def test_pipeline_near_copies(spark, docs):
    """Planted copies within 3 bits go, texts that share half of their words stay."""
    pick = random.Random(5)
    prose = lambda n: [f"word{pick.randint(0, 5000)}" for _ in range(n)]
    rows = []
    for k in range(60):
        text = prose(pick.randint(400, 900))
        rows.append((1000 + k, " ".join(text)))
        rows.append((2000 + k, " ".join([*text, "other"])))
        rows.append((3000 + k, " ".join(text[: len(text) // 2] + prose(len(text) // 2))))
    base = prose(900)
    rows += [(5000 + k, " ".join([*base, f"turn{k}"])) for k in range(150)]
    kept = brute_kept(dict(rows))
    assert {k for k, _ in rows if k < 2000} <= kept and {k for k, _ in rows if 3000 <= k < 4000} <= kept
    assert len([k for k in kept if 2000 <= k < 3000]) < 20 and len([k for k in kept if k >= 5000]) < 20
    frame = docs(*rows)
    for name, stage in corpus_pipeline.STAGES[:3]:
        frame = stage(spark, frame, SF)
    assert name == "simhash_near_dedup"
    assert {r.doc_id for r in frame.collect()} == kept
