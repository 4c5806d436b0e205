"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.llm import bpe_codec, decontam, exact_dedup, language_id, minhash_dedup, outliers, phrases, quality, ranked_search, suffix_dedup, token_count, url_filter, warc
from sitelens.llm.common import prepare, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run
    return add


# Exact pairs and components over all documents that share a shingle.
OP1_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, md5_number(array_to_string(ws[i:i + 4], ' ')) AS sh
  FROM w, LATERAL (SELECT unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
-- a pair that links shares a shingle among the (n - ceil(0.85 n) + 1) first by hash
p AS (SELECT doc_id, sh, row_number() OVER (PARTITION BY doc_id ORDER BY sh) AS r FROM s),
f AS (SELECT p.doc_id, sh FROM p JOIN n USING (doc_id) WHERE r <= n - (85 * n + 99) // 100 + 1),
c AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM f a JOIN f b ON a.sh = b.sh AND a.doc_id < b.doc_id
      JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id WHERE 100 * least(na.n, nb.n) >= 85 * greatest(na.n, nb.n)),
k AS (SELECT c.a, c.b, count(*) AS hits FROM c JOIN s x ON x.doc_id = c.a JOIN s y ON y.doc_id = c.b AND y.sh = x.sh GROUP BY ALL),
e AS (SELECT a, b FROM k JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * hits >= 85 * (na.n + nb.n - hits)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
t(a, b) AS (SELECT a, b FROM u UNION SELECT t.a, u.b FROM t JOIN u ON t.b = u.a),
m AS (SELECT a AS doc_id, min(b) AS low FROM t GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, m.low) AS component_id,
       d.doc_id = least(d.doc_id, m.low) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id
"""


@_query("op1_minhash_dedup", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components at Jaccard 0.85."""
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@_query("op2_bpe_codec")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    return bpe_codec.encode_documents(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH t AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
w AS (SELECT kind, id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM t),
s AS (SELECT DISTINCT kind, id, ws[i:i + 4] AS sh
  FROM w, LATERAL (SELECT unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i) WHERE len(ws) > 0),
q AS (SELECT id, count(*) AS n FROM s WHERE kind = 'i' GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS shared, any_value(q.n) AS item_shingles, count(*) / any_value(q.n) AS containment
FROM s d JOIN s i ON d.sh = i.sh AND d.kind = 'd' AND i.kind = 'i' JOIN q ON q.id = i.id
GROUP BY d.id, i.id HAVING 100 * count(*) >= 80 * any_value(q.n)
"""


@_query("op3_decontamination", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item, with the items."""
    return decontam.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP4_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@_query("op4_exact_dedup", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the copy that stays, four id ranges through one index."""
    out = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), batches=4)
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@_query("op5_token_count")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of whole texts."""
    return token_count.count_tokens(table(spark, sf_dir, "documents"))


@_query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.train(docs))


OP7_SQL = """
WITH x AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
-- windows as 128-bit digests
w AS MATERIALIZED (SELECT doc_id, unnest([{'i': i, 's': md5_number(substr(h, 2 * i + 1, 100))} FOR i IN range(0, length(h) // 2 - 49)],
  recursive := true) FROM x),
m AS (SELECT s, min(doc_id) AS low FROM w GROUP BY s),
g AS (SELECT doc_id, i FROM w JOIN m USING (s) WHERE low < doc_id),
e AS (SELECT *, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM g),
n AS (SELECT doc_id, i, sum((p IS NULL OR i > p + 50)::INT) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM e),
r AS (SELECT doc_id, k, min(i) AS lo, max(i) + 50 AS hi FROM n GROUP BY ALL),
t AS (SELECT r.doc_id, r.lo, r.hi, coalesce(lag(hi) OVER (PARTITION BY r.doc_id ORDER BY lo), 0) AS prev FROM r),
c AS (SELECT t.doc_id, sum(hi - lo)::BIGINT AS n_removed, count(*) AS n_spans, max(hi) AS last,
        string_agg(substr(x.h, 2 * prev + 1, 2 * (lo - prev)), '' ORDER BY lo) AS kept FROM t JOIN x ON x.doc_id = t.doc_id GROUP BY t.doc_id)
SELECT x.doc_id, (length(x.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN c.doc_id IS NULL THEN x.h ELSE kept || substr(x.h, 2 * last + 1) END)) AS kept_sha256
FROM x LEFT JOIN c ON c.doc_id = x.doc_id
"""


@_query("op7_suffix_dedup", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the 50-byte passages of earlier ones."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@_query("op8_url_filter")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or classifier verdict on every page URL."""
    return url_filter.judge(table(spark, sf_dir, "pages"))


@_query("op9_quality_classifier")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.train(docs, table(spark, sf_dir, "labels")))


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
     d AS (SELECT page_id, strlen(payload) AS n, sha1(payload) AS h, max(page_id) OVER (PARTITION BY payload) AS keep FROM p),
     b AS (SELECT *, array_to_string([['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010',
             '1011', '1100', '1101', '1110', '1111'][instr('0123456789abcdef', h[i])] FOR i IN range(1, 41)], '') AS bits FROM d)
SELECT page_id, n::BIGINT AS payload_bytes,
       array_to_string(['ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + 16 * bits[5 * i + 1]::INT + 8 * bits[5 * i + 2]::INT
         + 4 * bits[5 * i + 3]::INT + 2 * bits[5 * i + 4]::INT + bits[5 * i + 5]::INT] FOR i IN range(0, 32)], '') AS payload_digest,
       CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keep THEN keep END AS refers_to
FROM b
"""


@_query("op10_warc", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives and read back."""
    manifest, out = warc.archive_pages(table(spark, sf_dir, "pages"))
    return warc.read_archives(manifest, out).drop("url")


@_query("op11_quality_rules")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics, base rules and the outlier verdict of every document."""
    return outliers.judge(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\x20\x09]+') IF x <> ''] AS ws FROM p),
t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
f AS MATERIALIZED (SELECT lang, k, g, count(*) AS f FROM (
    SELECT lang, k, ws[i:i + k - 1] AS g FROM w, LATERAL (SELECT unnest([1, 2, 3, 4]) AS k), LATERAL (SELECT unnest(range(1, len(ws)::BIGINT - k + 2)) AS i)
    WHERE len(ws) >= k) GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k, g, f AS a FROM f WHERE k >= 2),
s AS (SELECT c.lang, c.k, c.g, c.a, x.f AS l, y.f AS r, j, (2000000::HUGEINT * c.a // (x.f + y.f))::BIGINT AS score
      FROM c, LATERAL (SELECT unnest(range(1, c.k)) AS j)
      JOIN f x ON x.lang = c.lang AND x.g = c.g[1:j] JOIN f y ON y.lang = c.lang AND y.g = c.g[j + 1:c.k]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
e AS (SELECT lang, sub, max(a) AS a FROM (
    SELECT lang, a, g[i:i + m - 1] AS sub FROM c, LATERAL (SELECT unnest(range(2, c.k)) AS m), LATERAL (SELECT unnest(range(1, c.k - m + 2)) AS i))
    GROUP BY ALL),
z AS (SELECT b.lang, array_to_string(b.g, ' ') AS phrase, b.a, b.l, b.r, b.score
      FROM b LEFT JOIN e ON e.lang = b.lang AND e.sub = b.g WHERE e.a IS NULL OR 100::HUGEINT * e.a < 80::HUGEINT * b.a)
SELECT z.lang, row_number() OVER (PARTITION BY z.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, t.n, score
FROM z JOIN t ON t.lang = z.lang QUALIFY rank <= 2000
"""


@_query("op12_phrases", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collocations of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH x AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
t AS MATERIALIZED (SELECT kind, id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM x),
c AS MATERIALIZED (SELECT kind, id, term, count(*) AS tf FROM t GROUP BY ALL),
n AS (SELECT id, sum(tf)::BIGINT AS n FROM c WHERE kind = 'd' GROUP BY id),
s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n),
w AS (SELECT term, floor(1000 * ln((2 * any_value(s.docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM c, s WHERE kind = 'd' GROUP BY term),
p AS (SELECT i.id AS item_id, d.id AS doc_id,
        sum(i.tf * w * ((1000000000 * d.tf) // (1000 * d.tf + 12 * (100 - 25 + (25 * n.n * s.docs) // s.terms))))::BIGINT AS score
      FROM c i JOIN c d ON i.term = d.term AND i.kind = 'i' AND d.kind = 'd' JOIN w ON w.term = i.term JOIN n ON n.id = d.id, s GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM p WHERE score > 0 QUALIFY rank <= 20
"""


@_query("op13_ranked_search", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
