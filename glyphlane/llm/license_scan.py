"""Licence scan by canonical digests, with DataFrame functions only.

A text in canonical form has A-Z in lower case, no copyright lines, every run
of blanks and punctuation as one blank, and one spelling of words that licences
spell in several ways. Its digest is looked up among the digests of known
licences; so is the digest of each of its lines, which finds notices within
other text. The known list is small and bounded, so it is broadcast; only hits
and one row per document leave a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import folded
from .license_texts import known_texts

#: How a copyright line begins, and what separates words.
COPYRIGHT_LINE = r"(^|\n)[^a-z0-9\n©(]*(copyright[ \t:]*(\(c\)|©|[0-9])|\(c\)[ \t]*[0-9]|©)[^\n]*"
BETWEEN_WORDS = "[\\x00-/:-@\\[-`{-\\x7f‘’“”–—•©]+"
BETWEEN_WORDS_OF_A_LINE = BETWEEN_WORDS.replace("\\x00-/", "\\x00-\\x09\\x0b-/")
#: Spellings that licences use for one another.
SPELLINGS = [
    ("licenc", "licens"), ("sub licens", "sublicens"), ("non commercial", "noncommercial"), ("non infring", "noninfring"),
    ("whilst", "while"), ("isation", "ization"), ("favour", "favor"), ("judgement", "judgment"),
    ("acknowledgement", "acknowledgment"), ("per cent", "percent"), ("copyright owner", "copyright holder"), ("https ", "http "),
]


def _plain(text: Column, between: str) -> Column:
    return F.regexp_replace(F.regexp_replace(folded(text), COPYRIGHT_LINE, "\n"), between, " ")


def _spelled(words: Column) -> Column:
    for variant, usual in SPELLINGS:
        words = F.replace(words, F.lit(variant), F.lit(usual))
    return F.trim(words)


def canonical(text: Column) -> Column:
    return _spelled(_plain(text, BETWEEN_WORDS))


def _units(text: Column) -> Column:
    """Canonical whole text, then canonical lines; the slow patterns pass once over the text."""
    lines = F.split(_plain(text, BETWEEN_WORDS_OF_A_LINE), "\n")
    return F.transform(F.array(lines), lambda found: F.concat(
        F.array(_spelled(F.regexp_replace(F.array_join(found, " "), " +", " "))), F.transform(found, _spelled)))[0]


#: Digests of so many known texts, about 100 bytes each, are handed to every executor at most.
BROADCAST_TEXTS = 1 << 17


def known_digests(spark: SparkSession, known: list[tuple[str, str]]) -> DataFrame:
    """digest, known_id of each known text; plans hold these, never the texts."""
    listed = spark.createDataFrame(known, "known_id string, known_text string").select("known_id", canonical(F.col("known_text")).alias("words"))
    found = listed.filter("words <> ''").groupBy(F.sha2("words", 256).alias("digest")).agg(F.min("known_id").alias("known_id")).collect()
    return spark.createDataFrame([tuple(r) for r in found], "digest string, known_id string")


def license_scan(
    docs: DataFrame, known: list[tuple[str, str]] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per id: doc_id, license_id, notice_ids, n_notices, canonical_sha256.

    license_id names the licence that the whole text is (null if none, the
    smallest id if several), notice_ids the licences of its lines, sorted and
    joined by commas (empty if none), n_notices the lines that hit. Null and
    empty texts hit nothing, as does text without words. Rows that repeat an id
    are one document: their hits are joined, the largest digest is shown. Null
    ids form one row. An empty table gives no rows; other columns are not read.
    ``known`` is a list of the driver; a list beyond ``BROADCAST_TEXTS`` is not broadcast.
    """
    known = known_texts() if known is None else known
    digests = known_digests(docs.sparkSession, known)
    if len(known) <= BROADCAST_TEXTS:
        digests = F.broadcast(digests)
    units = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(_units(F.col(text_col))).alias("place", "unit"))
    hits = units.select("doc_id", "place", F.sha2("unit", 256).alias("digest")).join(digests, "digest", "left")
    whole = F.col("place") == 0
    return hits.groupBy("doc_id").agg(
        F.min(F.when(whole, F.col("known_id"))).alias("license_id"),
        F.array_join(F.array_sort(F.collect_set(F.when(~whole, F.col("known_id")))), ",").alias("notice_ids"),
        F.count(F.when(~whole, F.col("known_id"))).alias("n_notices"),
        F.max(F.when(whole, F.col("digest"))).alias("canonical_sha256"),
    )
