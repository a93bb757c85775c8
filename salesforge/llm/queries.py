"""The registered queries of this package and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (byte_bpe, chat_format, collocations, line_dedup, near_dedup, packing, pii, quality_rules, secret_links,
               spelling_variants, topk_search, url_filter, warc_convert)
from .common import materialize, read_table, scratch_folder


def op1_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base entities and discovered identifiers of every document."""
    return pii.entities(read_table(spark, sf_dir, "documents"))


def op2_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as legacy archives, converted to WARC, and read back."""
    with scratch_folder(spark, "archives") as folder:
        warc_convert.write_arc(read_table(spark, sf_dir, "pages"), f"{folder}/arc")
        warc_convert.convert(spark, f"{folder}/arc", f"{folder}/warc")
        return materialize(warc_convert.read_records(spark, f"{folder}/warc"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded to ids and decoded again, as digests."""
    return byte_bpe.digests(read_table(spark, sf_dir, "documents"))


def op4_bfd_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op5_block_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best partners of every hundredth vector among all vectors."""
    return topk_search.top_k(read_table(spark, sf_dir, "embeddings"))


def op6_url_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return url_filter.judge(read_table(spark, sf_dir, "pages"), url_filter.rule_table(spark))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the learned decision list over every document."""
    docs = read_table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.fit(docs, read_table(spark, sf_dir, "labels")))


def op9_chat_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are control strings, formatted and read back."""
    text = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)],
                                 "conv_id long, turn long, role string, text string")
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.digests(rows.union(more))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated line runs over all documents: what is deleted and a digest of the text that is left."""
    return line_dedup.deletions(read_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language over all documents."""
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


def op12_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base secrets and linked parts of credentials of every document."""
    return secret_links.digests(secret_links.secrets(read_table(spark, sf_dir, "documents")))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, form and root."""
    return spelling_variants.variants(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_bootstrap": op1_pii_bootstrap,
    "op2_arc_to_warc": op2_arc_to_warc,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_bfd_packing": op4_bfd_packing,
    "op5_block_topk": op5_block_topk,
    "op6_url_bloom": op6_url_bloom,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_quality_rules": op8_quality_rules,
    "op9_chat_layouts": op9_chat_layouts,
    "op10_line_dedup": op10_line_dedup,
    "op11_collocations": op11_collocations,
    "op12_secret_links": op12_secret_links,
    "op13_spelling_variants": op13_spelling_variants,
}

# Base32 by hand: the digest's 160 bits in groups of five.
OP2_SQL = """
WITH records AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), digests AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex FROM records
), bits AS (
  SELECT hex, array_to_string(list_transform(range(1, 41), lambda i: (
           ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100',
            '1101', '1110', '1111'])[position(substr(hex, i, 1) IN '0123456789abcdef')]), '') AS b
  FROM (SELECT DISTINCT hex FROM digests)
), names AS (
  SELECT hex, array_to_string(list_transform(range(0, 32), lambda g: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + 16 * CAST(substr(b, 5 * g + 1, 1) AS INT) + 8 * CAST(substr(b, 5 * g + 2, 1) AS INT)
             + 4 * CAST(substr(b, 5 * g + 3, 1) AS INT) + 2 * CAST(substr(b, 5 * g + 4, 1) AS INT)
             + CAST(substr(b, 5 * g + 5, 1) AS INT), 1)), '') AS payload_digest
  FROM bits
), firsts AS (
  SELECT hex, min(page_id) AS first_id FROM digests GROUP BY hex
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM digests JOIN names USING (hex) JOIN firsts USING (hex)
"""

# Escaping puts a backslash before each of four characters; the marks of a turn have a fixed length.
OP9_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), marked AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^\<\[\]\\]', '', 'g'))
            + CASE role WHEN 'assistant' THEN 4 WHEN 'user' THEN 16
                   ELSE 17 + length(role) + length(regexp_replace(role, '[^\<\[\]\\]', '', 'g')) END AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

OP5_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row_id, vec_id AS id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.row_id AS query_row, q.id AS query_id, c.row_id AS vec_row, c.id AS vec_id,
         CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.id % 100 = 0 AND q.row_id <> c.row_id
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id, vec_row) AS place FROM scored)
WHERE place <= 10
"""

OP6_SQL = r"""
WITH urls AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages
), rules(rule_host, rule_path, listed) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
         ('org', '/fr/', 'allow')
), judged AS (
  SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(listed, length(rule_host || rule_path)) AS listed
  FROM (SELECT DISTINCT host, path FROM urls) JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path
)
SELECT page_id, host, path, rule, coalesce(listed, 'allow') AS verdict FROM urls LEFT JOIN judged USING (host, path)
"""

# All pairs on exact sets, components by reachability: for small tables.
OP7_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0B\f\r]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT row_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT row_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM docs WHERE len(w) > 0)
), sizes AS (
  SELECT row_id, count(*) AS n FROM shingles GROUP BY row_id
), shared AS (
  SELECT a.row_id AS u, b.row_id AS v, count(*) AS together FROM shingles a JOIN shingles b ON a.s = b.s AND a.row_id < b.row_id
  GROUP BY ALL
), links AS (
  SELECT u, v FROM shared JOIN sizes x ON x.row_id = u JOIN sizes y ON y.row_id = v
  WHERE 100 * together >= 75 * (x.n + y.n - together)
), both_ways AS (
  SELECT u, v FROM links UNION ALL SELECT v, u FROM links
), reached AS (
  SELECT row_id AS u, row_id AS v FROM docs
  UNION SELECT r.u, b.v FROM reached r JOIN both_ways b ON b.u = r.v
), components AS (
  SELECT r.u AS row_id, min(d.doc_id) AS component_id FROM reached r JOIN docs d ON d.row_id = r.v GROUP BY r.u
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM docs JOIN components USING (row_id) LEFT JOIN sizes USING (row_id)
"""

# Windows of 1, 2, 4 ... lines whose text occurs earlier, at least MIN_CHARS code points long, cover the lines that go.
OP10_SQL = """
WITH docs AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), windows AS (
  SELECT doc_id, p, p + w - 1 AS last, md5(CAST(list_slice(lines, p, p + w - 1) AS VARCHAR)) AS h, w,
         list_sum(list_transform(list_slice(lines, p, p + w - 1), lambda x: length(x))) AS chars
  FROM (SELECT doc_id, lines, w, unnest(range(1, len(lines) - w + 2)) AS p
        FROM docs, (SELECT CAST(pow(2, k) AS BIGINT) AS w FROM range(0, 20) t(k)) WHERE len(lines) >= w)
), later AS (
  SELECT doc_id, p, last FROM (
    SELECT *, row_number() OVER (PARTITION BY w, h ORDER BY doc_id, p) AS nth FROM windows)
  WHERE nth > 1 AND chars >= 20
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, last + 1)) AS i FROM later
), runs AS (
  SELECT doc_id, min(i) - 1 AS a, max(i) - 1 AS b FROM (
    SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS island FROM gone)
  GROUP BY doc_id, island
), joined AS (
  SELECT doc_id, string_agg(a || '-' || b, ',' ORDER BY a) AS runs, sum(b - a + 1) AS n FROM runs GROUP BY doc_id
), left_over AS (
  SELECT d.doc_id, len(d.lines) AS n_lines, coalesce(j.n, 0) AS n_removed, coalesce(j.runs, '') AS runs,
         coalesce(array_to_string(list_filter(d.lines, lambda x, i: NOT list_contains(coalesce(g.all_i, []), i)), chr(10)),
                  '') AS left_text
  FROM docs d LEFT JOIN joined j USING (doc_id)
  LEFT JOIN (SELECT doc_id, list(i) AS all_i FROM gone GROUP BY doc_id) g USING (doc_id)
)
SELECT doc_id, n_lines, CAST(n_removed AS BIGINT) AS n_removed, runs, length(left_text) AS n_chars,
       sha256(left_text) AS text_sha256
FROM left_over
"""

OP11_SQL = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) AS piece
    FROM documents)
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM pieces GROUP BY lang
), grams AS (
  SELECT lang, k, list_slice(w, i, i + k - 1) AS words, CAST(count(*) AS HUGEINT) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 6) t(k) WHERE len(w) >= k)
  GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT g.lang, g.k, g.words, g.f AS a, c AS cut, x.f AS l, y.f AS r, n, (1000 * g.f * n) // (x.f * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS c FROM grams WHERE k > 1) g JOIN totals USING (lang)
  JOIN grams x ON x.lang = g.lang AND x.words = list_slice(g.words, 1, c)
  JOIN grams y ON y.lang = g.lang AND y.words = list_slice(g.words, c + 1, g.k)
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, cut) = 1
), inside AS (
  SELECT DISTINCT s.lang, s.words FROM lowest s
  JOIN (SELECT lang, a, k, unnest(list_transform(range(1, k), lambda i: list_slice(words, i, i + 1))) AS part FROM lowest
        WHERE k > 2
        UNION ALL SELECT lang, a, k, unnest(list_transform(range(1, k - 1), lambda i: list_slice(words, i, i + 2)))
        FROM lowest WHERE k > 3
        UNION ALL SELECT lang, a, k, unnest(list_transform(range(1, k - 2), lambda i: list_slice(words, i, i + 3)))
        FROM lowest WHERE k > 4) t ON t.lang = s.lang AND t.part = s.words AND 100 * t.a >= 100 * s.a
), ranks AS (
  SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, n, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(words, ' '))) AS rank
  FROM lowest ANTI JOIN inside USING (lang, words)
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranks WHERE rank <= 2000
"""

# The checksum by its bits; near words meet by what is left after one letter is cut.
OP13_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(0, 256), lambda i: list_reduce(list_prepend(i, range(0, 8)), lambda c, k:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                             'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, strlen(named) * 2, 2),
           lambda p: CAST('0x' || substr(hex(encode(named)), p, 2) AS BIGINT))),
           lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1])), 4294967295) AS h
  FROM (SELECT *, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS named FROM runs), crc_table
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
    FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cut AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (
    SELECT word, n, unnest(range(0, length(word))) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION ALL SELECT DISTINCT w.word, c.word, c.n FROM words w JOIN cut c ON w.word = c.rest
  UNION ALL SELECT DISTINCT c.word, w.word, w.n FROM words w JOIN cut c ON w.word = c.rest
), near AS (
  SELECT word, count(*) AS n_near, max(other_n) AS best_n FROM pairs GROUP BY word
), best AS (
  SELECT word, n_near, best_n, min(other) AS best FROM near JOIN pairs USING (word) WHERE other_n = best_n GROUP BY ALL
), forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * w.n THEN best END AS form,
         CASE WHEN best_n >= 10 * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS root, 0 AS steps FROM forms
  UNION ALL SELECT c.word, f.form, steps + 1 FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL
)
SELECT word, form, arg_max(root, steps) AS root, n, n_near, form_n FROM forms JOIN chain USING (word) GROUP BY ALL
"""

ORACLE: dict[str, str] = {
    "op2_arc_to_warc": OP2_SQL,
    "op5_block_topk": OP5_SQL,
    "op6_url_bloom": OP6_SQL,
    "op7_minhash_near_dedup": OP7_SQL,
    "op9_chat_layouts": OP9_SQL,
    "op10_line_dedup": OP10_SQL,
    "op11_collocations": OP11_SQL,
    "op13_spelling_variants": OP13_SQL,
}
