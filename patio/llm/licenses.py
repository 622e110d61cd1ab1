"""Licence scans by canonical digest.

A text is brought to a canonical form: lower case, copyright lines dropped, everything but
letters and digits one blank, equivalent spellings made equal. The SHA-256 of the whole
canonical text is looked up among the digests of known licence texts with a hash join; each
line that speaks of a licence is looked up whole among the digests of known notices. Only
DataFrame functions are used. The shipped list is fixed, so its digests are broadcast. A caller's
list is broadcast up to BROADCAST_TEXTS digests, which are counted; a longer one is hash-joined.

Defined cases: null text counts as empty. Known texts that are null or empty in canonical form name
nothing; of licences with equal texts the smallest id is given. A text whose canonical form is empty has the digest of
the empty text and no licence. Repeated rows get a row each; ids and texts may be null. Other
columns, whatever their names, are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patio.llm.common import id_text, stored
from patio.llm.licence_texts import NOTICES, SPELLINGS, TEXTS

#: Lines end at a line feed only (d), in the other engine too.
COPYRIGHT_LINE = r"(?imd)^[\x20\x09]*(?:copyright[\x20\x09]|\(c\)|©)[^\n]*$"
NOT_WORD = r"[^\p{L}\p{N}]+"
#: Every known notice holds this after lower case and spelling, so other lines need no digest.
NOTICE_MARK = r"(?i)licen[sc]"
#: A digest and an id take about 100 bytes.
BROADCAST_TEXTS = 100_000


def canonical(text: Column) -> Column:
    text = F.regexp_replace(text, COPYRIGHT_LINE, "")
    text = F.trim(F.regexp_replace(F.lower(text), NOT_WORD, " "))
    for spelling, same in SPELLINGS:
        text = F.replace(text, F.lit(spelling), F.lit(same))
    return text


def digest(text: Column) -> Column:
    return F.sha2(F.encode(canonical(text), "UTF-8"), 256)


def known(texts: DataFrame) -> DataFrame:
    """licence and digest of a table (licence, text); one row a digest."""
    named = texts.select("licence", F.col("text").cast("string").alias("text")).where(canonical(F.col("text")) != "")
    return named.select(digest(F.col("text")).alias("digest"), "licence").groupBy("digest").agg(F.min("licence").alias("licence"))


def license_scan(docs: DataFrame, known_texts: DataFrame | None = None) -> DataFrame:
    """doc_id, text_sha256 (of the canonical text), licence, notices, n_notices of every row.

    `licence` is the licence that the whole text is, or null. `notices` lists the licences named
    by whole lines, each once, in order, joined by commas (empty if none); `n_notices` counts the
    lines. `known_texts` (licence, text) takes the place of the shipped whole texts.
    """
    if known_texts is None:
        texts = F.broadcast(known(docs.sparkSession.createDataFrame(list(TEXTS), "licence string, text string")))
    else:
        texts = stored(known(known_texts))
        if texts.count() <= BROADCAST_TEXTS:
            texts = F.broadcast(texts)
    # The list of known notices folds to one literal map, so lines are looked up in place: no row
    # is exploded, and a document that repeats a notice costs no shuffle.
    notices = F.create_map(*[part for name, text in NOTICES for part in (digest(F.lit(text)), F.lit(name))])
    rows = id_text(docs).select(
        "doc_id",
        digest(F.col("text")).alias("text_sha256"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(NOTICE_MARK)).alias("lines"),
    )
    found = F.transform("lines", lambda line: F.try_element_at(notices, digest(line)))
    return (
        rows.join(texts, F.col("text_sha256") == F.col("digest"), "left")
        .withColumn("named", F.filter(found, lambda x: x.isNotNull()))
        .select(
            "doc_id",
            "text_sha256",
            "licence",
            F.array_join(F.array_sort(F.array_distinct("named")), ",").alias("notices"),
            F.size("named").cast("long").alias("n_notices"),
        )
    )


def answer_sql() -> str:
    """The same scan as DuckDB SQL."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    def plain(expr: str) -> str:
        line = COPYRIGHT_LINE.replace("(?imd)", "(?im)")
        out = f"trim(regexp_replace(lower(regexp_replace({expr}, '{line}', '', 'g')), '{NOT_WORD}', ' ', 'g'))"
        for spelling, same in SPELLINGS:
            out = f"replace({out}, '{spelling}', '{same}')"
        return f"sha256({out})"

    def listed(texts) -> str:
        rows = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in texts)
        return f"SELECT {plain('text')} AS digest, min(licence) AS licence FROM (VALUES {rows}) AS v(licence, text) GROUP BY 1"

    return f"""
WITH texts AS ({listed(TEXTS)}),
notices AS ({listed(NOTICES)}),
lines AS (
    SELECT doc_id, {plain('line')} AS digest
    FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)
    WHERE regexp_matches(line, '{NOTICE_MARK}')
),
named AS (
    SELECT doc_id, string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices, count(*) AS n_notices
    FROM lines JOIN notices USING (digest) GROUP BY doc_id
),
hashed AS (SELECT doc_id, {plain("coalesce(text, '')")} AS text_sha256 FROM documents)
SELECT h.doc_id, h.text_sha256, t.licence, coalesce(n.notices, '') AS notices, coalesce(n.n_notices, 0) AS n_notices
FROM hashed h LEFT JOIN texts t ON t.digest = h.text_sha256 LEFT JOIN named n ON n.doc_id = h.doc_id
"""
