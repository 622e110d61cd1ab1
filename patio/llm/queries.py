"""The registered queries of the text operators and their SQL answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patio.llm import edit_fingerprints, exact_dedup, lang_id, lexical_search, licenses, merkle, packing, pii, piece_viterbi, secret_scan, simhash, suffix_dedup, token_counts
from patio.llm.common import documents


def op1_license_scan(spark, sf_dir) -> DataFrame:
    return licenses.license_scan(documents(spark, sf_dir))


def op2_suffix_array(spark, sf_dir) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir))


def op3_exact_dedup(spark, sf_dir) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir)).drop("copy")


OP3_SQL = r"""
WITH hashed AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM hashed
"""


def op4_language_id(spark, sf_dir) -> DataFrame:
    return lang_id.language_id(documents(spark, sf_dir))


def op5_pii(spark, sf_dir) -> DataFrame:
    return pii.pii_spans(documents(spark, sf_dir))


def op6_piece_viterbi(spark, sf_dir) -> DataFrame:
    """Ids of every text, and the text that they give back."""
    back = piece_viterbi.decode(piece_viterbi.encode(documents(spark, sf_dir)))
    decoded = F.sha2(F.encode("text", "UTF-8"), 256)
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        F.xxhash64("ids").alias("ids_hash"),
        decoded.alias("decoded_sha256"),
        (decoded == F.col("text_sha256")).alias("round_trip"),
    )


def op7_packing(spark, sf_dir) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op8_edit_fingerprints(spark, sf_dir) -> DataFrame:
    return edit_fingerprints.edit_fingerprints(documents(spark, sf_dir))


def op9_secret_scan(spark, sf_dir) -> DataFrame:
    return secret_scan.secret_spans(documents(spark, sf_dir))


def op10_simhash(spark, sf_dir) -> DataFrame:
    groups = simhash.near_groups(documents(spark, sf_dir))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_merkle(spark, sf_dir) -> DataFrame:
    proofs = merkle.manifest(documents(spark, sf_dir), tampered=merkle.tampered_digest())
    return merkle.verified(proofs)


# Levels one by one; DuckDB has no crc32, so that it is computed from its definition.
OP11_SQL = r"""
WITH RECURSIVE
crc AS (
    SELECT list(list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8],
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) r(i)
),
base AS (
    SELECT doc_id, source, text,
           coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
           list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
               lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])) AS state
    FROM documents, crc
),
leaves AS (
    SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS h,
           sha256(head || coalesce(strlen(changed) || ':' || changed, '-')) AS tampered,
           row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n
    FROM (SELECT *, CASE WHEN xor(state, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed FROM base)
),
nodes AS (
    SELECT 0 AS level, source, idx, h, n FROM leaves
    UNION ALL
    SELECT level + 1, source, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM nodes WHERE n > 1 GROUP BY level, source, idx // 3, n
),
tops AS (
    SELECT 0 AS level, source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, h, count(*) OVER () AS n
    FROM nodes WHERE n = 1
),
high AS (
    SELECT level, idx, h, n FROM tops
    UNION ALL
    SELECT level + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM high WHERE n > 1 GROUP BY level, idx // 3, n
),
steps AS (
    SELECT level, source, idx,
           coalesce(string_agg(h, '') OVER (PARTITION BY level, source, idx // 3 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
           coalesce(string_agg(h, '') OVER (PARTITION BY level, source, idx // 3 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
    FROM nodes WHERE n > 1
),
high_steps AS (
    SELECT level, idx,
           coalesce(string_agg(h, '') OVER (PARTITION BY level, idx // 3 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
           coalesce(string_agg(h, '') OVER (PARTITION BY level, idx // 3 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
    FROM high WHERE n > 1
),
paths AS (
    SELECT l.source, l.idx, s.level, {'b': s.b, 'a': s.a} AS step
    FROM leaves l JOIN steps s ON s.source IS NOT DISTINCT FROM l.source AND s.idx = l.idx // CAST(pow(3, s.level) AS BIGINT)
    UNION ALL
    SELECT l.source, l.idx, 1000 + s.level, {'b': s.b, 'a': s.a}
    FROM leaves l JOIN tops t ON t.source IS NOT DISTINCT FROM l.source
    JOIN high_steps s ON s.idx = t.idx // CAST(pow(3, s.level) AS BIGINT)
),
listed AS (SELECT source, idx, list(step ORDER BY level) AS path FROM paths GROUP BY source, idx),
proved AS (
    SELECT l.doc_id, l.h AS leaf, t.h AS subroot, (SELECT h FROM high WHERE n = 1) AS root, l.tampered,
           coalesce(p.path, []) AS path
    FROM leaves l JOIN tops t ON t.source IS NOT DISTINCT FROM l.source
    LEFT JOIN listed p ON p.source IS NOT DISTINCT FROM l.source AND p.idx = l.idx
),
refolded AS (
    SELECT doc_id, leaf, subroot, root,
           sha256(array_to_string(list_transform(path, lambda s: s.b || s.a), '')) AS proof_sha256,
           list_reduce(list_prepend({'b': tampered, 'a': ''}, path), lambda x, y: {'b': sha256(y.b || x.b || y.a), 'a': ''}).b AS folded_root
    FROM proved
)
SELECT *, folded_root = root AS verified FROM refolded
"""


def op12_lexical_search(spark, sf_dir) -> DataFrame:
    return lexical_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP12_SQL = r"""
WITH held AS (
    SELECT doc_id, term, count(*) AS tf
    FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents)
    GROUP BY doc_id, term
),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS terms FROM held GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, sum(terms)::BIGINT AS terms FROM lengths),
documents_m AS (SELECT l.doc_id, 100 - 25 + (25 * l.terms * c.docs) // c.terms AS m FROM lengths l, corpus c),
weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM held GROUP BY term), corpus
),
asked AS (
    SELECT item_id, term, count(*) AS times
    FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
    GROUP BY item_id, term
),
scores AS (
    SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN documents_m USING (doc_id)
    GROUP BY item_id, doc_id
),
placed AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
    FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 20
"""


def op13_token_counts(spark, sf_dir) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_suffix_array": op2_suffix_array,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_language_id": op4_language_id,
    "op5_pii": op5_pii,
    "op6_piece_viterbi": op6_piece_viterbi,
    "op7_packing": op7_packing,
    "op8_edit_fingerprints": op8_edit_fingerprints,
    "op9_secret_scan": op9_secret_scan,
    "op10_simhash": op10_simhash,
    "op11_merkle": op11_merkle,
    "op12_lexical_search": op12_lexical_search,
    "op13_token_counts": op13_token_counts,
}
ORACLES = {"op1_license_scan": licenses.answer_sql(), "op3_exact_dedup": OP3_SQL, "op11_merkle": OP11_SQL, "op12_lexical_search": OP12_SQL}
