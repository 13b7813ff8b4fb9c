"""The registered queries of the operators and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bin_packing import best_fit_packing
from .bpe import bpe_round_trip, with_digests
from .common import table
from .exact_dedup import exact_dedup
from .fill_in_middle import fill_in_middle
from .fill_in_middle import with_digests as middle_digests
from .lexical_search import lexical_search
from .license_scan import license_scan
from .license_texts import known_texts
from .line_dedup import line_dedup
from .near_dedup import minhash_components
from .quality import quality
from .sharding import shard_facts, sharded
from .token_files import read_documents, token_files_folder, write_token_files
from .topk import exact_topk
from .toxicity import toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: A-Z in lower case and nothing else, for the check SQL.
FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return register


@query("op1_exact_dedup", f"""
    WITH n AS (SELECT doc_id, {FOLD} AS t FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
    FROM n WINDOW w AS (PARTITION BY t)""")
def op1(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


@query("op3_exact_topk", """
    WITH v AS (
      SELECT row_number() OVER () AS row, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e
      FROM embeddings
      WHERE embedding IS NOT NULL
        AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
    s AS (
      SELECT q.row, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e::DOUBLE[], c.e::DOUBLE[]) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.row <> c.row),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op3(spark, sf_dir):
    return exact_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op6_line_dedup", r"""
    WITH l AS (
      SELECT doc_id, u.place, u.line,
             translate(regexp_replace(regexp_replace(u.line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents) d,
           LATERAL (SELECT unnest(d.a) AS line, unnest(range(len(d.a))) AS place) u),
    c AS (SELECT key, max(doc_id) AS last_doc FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
    m AS (SELECT l.*, coalesce(l.doc_id <> c.last_doc, false) AS gone FROM l LEFT JOIN c USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
    FROM m GROUP BY doc_id""")
def op6(spark, sf_dir):
    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def tokenizer(name: str) -> str:
    """A public vocabulary file of this machine; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op5_token_files")
def op5(spark, sf_dir):
    manifest = write_token_files(
        table(spark, sf_dir, "documents"), token_files_folder(spark), tokenizer("word_bpe_49k.json"), end_id=2
    )
    return read_documents(manifest)


@query("op8_bpe_automaton")
def op8(spark, sf_dir):
    return with_digests(bpe_round_trip(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json")))


@query("op9_best_fit_packing")
def op9(spark, sf_dir):
    return best_fit_packing(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=1)


@query("op4_toxicity")
def op4(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _canonical_sql(text: str) -> str:
    out = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = rf"regexp_replace({out}, '(^|\n)[^a-z0-9\n©(]*(copyright[ \t:]*(\(c\)|©|[0-9])|\(c\)[ \t]*[0-9]|©)[^\n]*', chr(10), 'g')"
    out = rf"regexp_replace({out}, '[\x00-/:-@\[-`{{-\x7f‘’“”–—•©]+', ' ', 'g')"
    for pair in (
        "'licenc', 'licens'", "'sub licens', 'sublicens'", "'non commercial', 'noncommercial'", "'non infring', 'noninfring'",
        "'whilst', 'while'", "'isation', 'ization'", "'favour', 'favor'", "'judgement', 'judgment'",
        "'acknowledgement', 'acknowledgment'", "'per cent', 'percent'", "'copyright owner', 'copyright holder'", "'https ', 'http '",
    ):
        out = f"replace({out}, {pair})"
    return f"trim({out})"


_KNOWN_ROWS = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in known_texts())


@query("op7_license_scan", f"""
    WITH known(known_id, known_text) AS (VALUES {_KNOWN_ROWS}),
    digests AS (SELECT sha256({_canonical_sql('known_text')}) AS digest, min(known_id) AS known_id FROM known GROUP BY 1),
    units AS (
      SELECT doc_id, 0 AS place, coalesce(text, '') AS unit FROM documents
      UNION ALL SELECT doc_id, 1, unnest(string_split(coalesce(text, ''), chr(10))) FROM documents),
    hits AS (
      SELECT doc_id, place, u.digest, known_id
      FROM (SELECT doc_id, place, sha256({_canonical_sql('unit')}) AS digest FROM units) u LEFT JOIN digests USING (digest))
    SELECT doc_id, min(known_id) FILTER (place = 0) AS license_id,
           coalesce(string_agg(DISTINCT known_id, ',' ORDER BY known_id) FILTER (place = 1), '') AS notice_ids,
           count(known_id) FILTER (place = 1) AS n_notices, max(digest) FILTER (place = 0) AS canonical_sha256
    FROM hits GROUP BY doc_id""")
def op7(spark, sf_dir):
    return license_scan(table(spark, sf_dir, "documents"))


@query("op10_quality")
def op10(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_fill_in_middle", """
    WITH t AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS h FROM documents),
    d AS (
      SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4,
             ('0x' || substr(h, 1, 8))::BIGINT % (length(t) + 1) AS x, ('0x' || substr(h, 9, 8))::BIGINT % (length(t) + 1) AS y FROM t),
    f AS (
      SELECT doc_id, n, t, least(x, y) AS a, greatest(x, y) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
    p AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM f)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                  ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
    FROM p""")
def op11(spark, sf_dir):
    return middle_digests(fill_in_middle(table(spark, sf_dir, "documents")))


@query("op12_sharding")
def op12(spark, sf_dir):
    return shard_facts(sharded(table(spark, sf_dir, "documents").select("doc_id", "text")))


@query("op13_lexical_search", r"""
    WITH w AS (
      SELECT row, doc_id, u.term FROM (
        SELECT row_number() OVER () AS row, doc_id,
               regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS a FROM documents) d,
        LATERAL (SELECT unnest(d.a) AS term) u),
    size AS (SELECT row, any_value(doc_id) AS doc_id, count(*) AS n FROM w GROUP BY row),
    total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM size),
    asked AS (
      SELECT DISTINCT item_id, u.term FROM (
        SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS a FROM benchmark) b,
        LATERAL (SELECT unnest(b.a) AS term) u),
    tf AS (SELECT row, term, count(*) AS tf FROM w WHERE term IN (SELECT term FROM asked) GROUP BY row, term),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    weight AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w FROM df, total),
    part AS (
      SELECT row, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms))) AS part
      FROM tf JOIN weight USING (term) JOIN size USING (row), total),
    score AS (SELECT item_id, row, CAST(sum(part) AS BIGINT) AS score FROM asked JOIN part USING (term) GROUP BY item_id, row HAVING sum(part) > 0),
    best AS (
      SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
      FROM score JOIN size USING (row))
    SELECT item_id, rank, doc_id, score FROM best WHERE rank <= 50""")
def op13(spark, sf_dir):
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_minhash_near_dedup")
def op2(spark, sf_dir):
    return minhash_components(table(spark, sf_dir, "documents"))
