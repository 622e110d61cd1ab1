"""The manifest against a tree built in memory, and against its SQL answer."""

import hashlib
import zlib

import duckdb
import pytest

import __spark_entry__ as driver
from patio.llm import merkle
from patio.llm.common import documents

SF = "/root/testdata/sf0.01"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    return digest("".join(map(field, (row.doc_id, row.source, row.lang, row.n_chars, text))))


def tree(leaves):
    """The root, and of each leaf the digests before and after it at every level."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = nodes[i // 3 * 3 : i // 3 * 3 + 3]
            paths[k].append(("".join(run[: i % 3]), "".join(run[i % 3 + 1 :])))
        at = [i // 3 for i in at]
        nodes = [digest("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def brute(rows):
    trees, out = {}, []
    for r in rows:
        trees.setdefault(r.source, []).append(r)
    for members in trees.values():
        members.sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: tree([leaf(r, r.text) for r in trees[s]]) for s in order}
    root, high = tree([own[s][0] for s in order])
    for s, up in zip(order, high, strict=True):
        for r, low in zip(trees[s], own[s][1], strict=True):
            text = r.text
            if None not in (r.doc_id, text) and zlib.crc32(str(r.doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            again = leaf(r, text)
            for before, after in low + up:
                again = digest(before + again + after)
            proof = digest("".join(a + b for a, b in low + up))
            out.append((r.doc_id, leaf(r, r.text), own[s][0], root, proof, again, again == root))
    return sorted(out, key=repr)


def proved(docs):
    rows = merkle.verified(merkle.manifest(docs, tampered=merkle.tampered_digest())).collect()
    return sorted(map(tuple, rows), key=repr)


def test_query_equals_tree_and_sql(spark):
    got = sorted(map(tuple, driver.queries()["op11_merkle"](spark, SF).collect()), key=repr)
    docs = documents(spark, SF).collect()
    assert got == brute(docs) and len(got) == len(docs) and 0 < sum(r[-1] for r in got) < len(got)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert sorted(db.execute(driver.oracle_sql()["op11_merkle"]).fetchall(), key=repr) == got


@pytest.mark.parametrize("depth", [2])
def test_storeys_do_not_show(spark, docs, depth, monkeypatch):
    """Sources of many sizes; small blocks need several storeys, also over the sources."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(merkle, "DEPTH", depth)
    rows = docs(*[(k * 7 % 101, f"text {k}\nline") for k in range(101)])
    hot = F.when(F.col("doc_id") < 40, "big").when(F.col("doc_id") < 43, "trio").otherwise(F.concat(F.lit("é"), (F.col("doc_id") % 13).cast("string")))
    rows = rows.withColumn("source", F.when(F.col("doc_id") != 43, hot))
    assert proved(rows) == brute(rows.collect())


def test_odd_rows(odd_docs, no_docs, docs):
    from pyspark.sql import functions as F

    assert proved(odd_docs) == brute(odd_docs.collect())
    nulls = odd_docs.withColumn("source", F.lit(None).cast("string")).withColumn("lang", F.lit(None)).withColumn("n_chars", F.lit(None))
    assert proved(nulls) == brute(nulls.collect())
    assert proved(no_docs) == []
    alone = docs((5, "one\nrow"))
    (row,) = merkle.manifest(alone).collect()
    assert row.leaf == row.subroot == row.root and row.path == []
    assert proved(alone) == brute(alone.collect())
