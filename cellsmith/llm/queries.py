"""The operators' queries: each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellsmith.llm import (
    language_id, line_dedup, lm_score, merkle, mixing, near_dup, packing, pii, prefix_trie, quality, sig_tree, simhash,
    toxicity)
from cellsmith.llm.common import cut

#: Stands for the secret that a production run passes in.
PII_KEY = "demonstration key"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the three-line windows that occurred before."""
    out = line_dedup.deduped_lines(documents(spark, sf_dir))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", "text")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact unigram score and the filter model's score of every document."""
    return lm_score.lm_scores(documents(spark, sf_dir))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document; links at a similarity of 0.75 of 5-word shingles."""
    out = near_dup.near_duplicates(documents(spark, sf_dir))
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in packed sequences."""
    return packing.packed(documents(spark, sf_dir))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those of four folds in five."""
    return language_id.languages(documents(spark, sf_dir))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text; for every 50th
    document also how many documents lie within the radius."""
    prints = cut(simhash.fingerprint_report(documents(spark, sf_dir)), "report")
    return prints.join(simhash.near_counts(prints), "doc_id", "left")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document; hosts are the sources."""
    return quality.judged(documents(spark, sf_dir))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix_report(documents(spark, sf_dir))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of four folds in five."""
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with personal data replaced by pseudonyms."""
    out = pii.pseudonymised(documents(spark, sf_dir), key=PII_KEY)
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_replaced", "text")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and verdict of every document; those of a third of the ids are tampered with."""
    return merkle.audit(documents(spark, sf_dir))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return prefix_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document; links at a similarity of 0.8 of 5-word shingles."""
    return sig_tree.jaccard_components(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_near_dedup": op3_near_dedup,
    "op4_packing": op4_packing,
    "op5_language_id": op5_language_id,
    "op6_fingerprints": op6_fingerprints,
    "op7_quality_rules": op7_quality_rules,
    "op8_mixing": op8_mixing,
    "op9_toxicity": op9_toxicity,
    "op10_pii": op10_pii,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_ngram_jaccard": op13_ngram_jaccard,
}

#: crc32 of a decimal number's digits, as a scalar expression over its text and the table ``tab``.
_TAB = """tab AS (
  SELECT list(list_reduce([i, 1, 1, 1, 1, 1, 1, 1, 1],
                          lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256))::BIGINT AS i))"""


def _crc(text: str) -> str:
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), "
            "lambda x: ascii(x)::BIGINT)), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295)")


def _field(c: str) -> str:
    return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"


_LEAF = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))

def _near(percent: int, more: str = "") -> str:
    """Components of documents by 5-word shingles: all pairs that share one are counted."""
    return rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, md5(array_to_string(list_slice(w, i, i + 4), ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b ON a.h = b.h AND a.doc_id < b.doc_id
         GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * pairs.n >= {percent} * (x.n + y.n - pairs.n)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l ON l.a = r.b)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, c.component_id{more}
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id
"""


ORACLE: dict[str, str] = {
    "op3_near_dedup": _near(75, ", d.doc_id = c.component_id AS kept"),
    "op13_ngram_jaccard": _near(80),
    "op1_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS n
  FROM documents WHERE text IS NOT NULL),
filled AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS p
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
win AS (
  SELECT doc_id, p, n AS from_n, lead(n, 2) OVER w AS to_n,
         md5(line) || md5(lead(line) OVER w) || md5(lead(line, 2) OVER w) AS h
  FROM filled WINDOW w AS (PARTITION BY doc_id ORDER BY n)),
later AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, p) AS k FROM win WHERE h IS NOT NULL)
  WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(from_n, to_n)) AS n FROM later),
left_over AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.n) AS text
  FROM lines l ANTI JOIN gone g ON l.doc_id = g.doc_id AND l.n = g.n GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0) AS n_lines,
       coalesce(g.k, 0) AS n_removed,
       CASE WHEN g.k IS NULL THEN d.text ELSE coalesce(o.text, '') END AS text
FROM documents d
LEFT JOIN (SELECT doc_id, count(*) AS k FROM gone GROUP BY doc_id) g USING (doc_id)
LEFT JOIN left_over o USING (doc_id)
""",
    "op7_quality_rules": r"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, unnest(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS word,
             generate_subscripts(regexp_extract_all(t, '[^\x20\x09-\x0D]+'), 1) AS i FROM t),
runs AS (
  SELECT doc_id, i, string_agg(word, ' ') OVER r AS run, count(*) OVER r AS c
  FROM w WINDOW r AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, md5(run)) AS k FROM runs WHERE c = 8)
          WHERE k > 1),
rep AS (SELECT doc_id, count(*) AS n FROM
          (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 7)) AS i FROM twice) GROUP BY doc_id),
ws AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY doc_id),
ls AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
       FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM t)
       WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT t.doc_id, t.source, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
         length(regexp_replace(t.t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         length(regexp_replace(t.t, '\P{Lu}', '', 'g'))::BIGINT AS n_upper,
         coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM t LEFT JOIN ws USING (doc_id) LEFT JOIN ls USING (doc_id) LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
j AS (SELECT *, base_failed OR 10 * n_symbols > 3 * n_words OR 5 * n_upper > 2 * word_chars
             OR 2 * n_dup_lines > n_lines AS failed FROM f),
h AS (SELECT source, count(*)::DOUBLE AS n, count(*) FILTER (failed)::DOUBLE AS k FROM j GROUP BY source),
a AS (SELECT sum(k) / sum(n) AS m, count(*) AS hosts, sum(n) AS n FROM h),
v AS (SELECT m, greatest((SELECT sum(n * (k / n - m) * (k / n - m)) FROM h) / n - m * (1 - m) * hosts / n, 0.0) AS v
      FROM a),
r AS (SELECT source, CASE WHEN m IN (0, 1) OR v = 0 THEN m
             ELSE (k + greatest(m * (1 - m) / v - 1, 0) * m) / (n + greatest(m * (1 - m) / v - 1, 0)) END AS rate
      FROM h, v)
SELECT j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       failed AS rule_failed, r.rate AS host_rate,
       NOT failed AND NOT (j.source IS NOT NULL AND r.rate > 0.6) AS kept
FROM j JOIN r ON j.source IS NOT DISTINCT FROM r.source
""",
    "op8_mixing": r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || left(md5(concat_ws(':', '17', doc_id::VARCHAR)), 8))::BIGINT AS u FROM documents),
sources AS (
  SELECT source, size, 2.0::DOUBLE * size AS clamp,
         [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM (SELECT source, sum(size)::BIGINT AS size FROM sizes GROUP BY source)),
-- the level if exactly the sources with a smaller clamp per weight are clamped; right where it lies below its own
levels AS (
  SELECT clamp / weight AS ratio, (1.5::DOUBLE * sum(size) OVER () - coalesce(sum(clamp) OVER under, 0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER under, 0)) AS level
  FROM sources
  WINDOW under AS (ORDER BY clamp / weight RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP)),
plan AS (
  SELECT source, size, least(weight * (SELECT arg_min(level, ratio) FROM levels WHERE level <= ratio), clamp) AS target
  FROM sources),
drawn AS (
  SELECT s.doc_id, s.size, p.size AS source_size, p.target, s.source,
         CASE WHEN p.size > 0 THEN floor(p.target / p.size)::BIGINT ELSE 0 END AS whole,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.u RANGE UNBOUNDED PRECEDING)::BIGINT AS upto
  FROM sizes s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
-- of all fronts of a source's order, the empty one included, the one whose words come nearest to the rest
fronts AS (
  SELECT DISTINCT source, upto, target - whole * source_size AS rest FROM drawn
  UNION SELECT source, 0, target - whole * source_size FROM drawn),
nearest AS (SELECT source, arg_min(upto, (abs(upto - rest), upto)) AS words FROM fronts GROUP BY source)
SELECT doc_id, size, source_size, target, (whole + (upto <= words)::BIGINT) * size AS taken
FROM drawn JOIN nearest ON drawn.source IS NOT DISTINCT FROM nearest.source
""",
    "op11_merkle_manifest": f"""
WITH RECURSIVE {_TAB},
leaf AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
         count(*) OVER (PARTITION BY lang) AS n
  FROM (SELECT doc_id, lang, sha256({_LEAF} || {_field('text')}) AS leaf,
               CASE WHEN {_crc("coalesce(doc_id::VARCHAR, '')")} % 3 = 0
                    THEN sha256({_LEAF} || {_field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")})
               END AS forged FROM documents, tab)),
node AS (
  SELECT 0 AS k, lang, p, n, leaf AS h FROM leaf
  UNION ALL
  SELECT k + 1, lang, p // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY p))
  FROM node WHERE n > 1 GROUP BY k, lang, p // 8, n),
sub AS (SELECT lang, k AS height, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS p, count(*) OVER () AS n
        FROM node WHERE n = 1),
top AS (
  SELECT 0 AS k, p, n, h FROM sub
  UNION ALL
  SELECT k + 1, p // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY p)) FROM top WHERE n > 1 GROUP BY k, p // 8, n),
step AS (
  SELECT k, lang, p, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
         coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
  FROM node WHERE n > 1 WINDOW w AS (PARTITION BY lang, k, p // 8 ORDER BY p)),
over_step AS (
  SELECT k, p, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
         coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
  FROM top WHERE n > 1 WINDOW w AS (PARTITION BY k, p // 8 ORDER BY p)),
way AS (
  SELECT l.lang, l.p, s.k, s.b, s.a
  FROM leaf l JOIN step s ON s.lang IS NOT DISTINCT FROM l.lang AND s.p = l.p // (8 ** s.k)::BIGINT
  UNION ALL
  SELECT l.lang, l.p, sub.height + s.k, s.b, s.a
  FROM leaf l JOIN sub ON sub.lang IS NOT DISTINCT FROM l.lang JOIN over_step s ON s.p = sub.p // (8 ** s.k)::BIGINT),
fold AS (
  SELECT lang, p, 0 AS k, coalesce(forged, leaf) AS h FROM leaf
  UNION ALL
  SELECT f.lang, f.p, f.k + 1, sha256(w.b || f.h || w.a)
  FROM fold f JOIN way w ON w.lang IS NOT DISTINCT FROM f.lang AND w.p = f.p AND w.k = f.k),
proof AS (SELECT lang, p, sha256(string_agg(b || a, '' ORDER BY k)) AS proof FROM way GROUP BY lang, p),
root AS (SELECT h AS root FROM top WHERE n = 1)
SELECT l.doc_id, l.leaf, sub.h AS subroot, root, coalesce(proof, sha256('')) AS proof_sha256, f.h AS folded_root,
       f.h = root AS verified
FROM leaf l JOIN sub ON sub.lang IS NOT DISTINCT FROM l.lang
JOIN (SELECT lang, p, arg_max(h, k) AS h FROM fold GROUP BY lang, p) f
  ON f.lang IS NOT DISTINCT FROM l.lang AND f.p = l.p
LEFT JOIN proof ON proof.lang IS NOT DISTINCT FROM l.lang AND proof.p = l.p, root
""",
    "op12_prefix_trie": f"""
WITH {_TAB},
turns AS (
  SELECT conv_id, md5(strlen(role) || ':' || role || text) AS m, length(text) AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)) AS p
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        WHERE conv_id IS NOT NULL)),
conv AS (SELECT conv_id, {_crc('conv_id::VARCHAR')} % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns), tab),
whole AS (
  SELECT conv_id, m, chars, row_number() OVER (PARTITION BY conv_id ORDER BY part, p) AS d FROM (
    SELECT c.conv_id, 0 AS part, t.p, t.m, t.chars
    FROM conv c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.p <= c.h
    UNION ALL
    SELECT c.conv_id, 1, t.p, t.m, t.chars FROM conv c JOIN turns t ON t.conv_id = c.conv_id AND t.p > c.h)),
keyed AS (
  SELECT conv_id, 0 AS d, '' AS k, NULL AS up, 0 AS chars FROM conv
  UNION ALL
  SELECT conv_id, d, k, coalesce(lag(k) OVER (PARTITION BY conv_id ORDER BY d), ''), chars FROM (
    SELECT conv_id, d, chars, md5(string_agg(m, '') OVER (PARTITION BY conv_id ORDER BY d)) AS k FROM whole)),
node AS (SELECT k, any_value(up) AS up, any_value(d) AS depth, any_value(chars) AS chars, min(conv_id) AS conv_id,
                count(*) AS n_convs FROM keyed GROUP BY k),
kids AS (SELECT up AS k, count(*) AS n FROM node WHERE up IS NOT NULL GROUP BY up),
below AS (SELECT DISTINCT a.k AS top, b.k AS k FROM keyed a JOIN keyed b ON a.conv_id = b.conv_id AND b.d >= a.d),
sums AS (
  SELECT below.top AS k, count(*) FILTER (kids.n IS NULL) AS n_leaves, sum((node.n_convs - 1) * node.chars) AS saved
  FROM below JOIN node ON node.k = below.k LEFT JOIN kids ON kids.k = below.k GROUP BY below.top),
ends AS (SELECT k, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
         FROM (SELECT conv_id, arg_max(k, d) AS k FROM keyed GROUP BY conv_id) GROUP BY k)
SELECT node.conv_id, node.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, node.n_convs,
       coalesce(kids.n, 0) AS n_children, sums.n_leaves, sums.saved::BIGINT AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM node JOIN sums ON sums.k = node.k LEFT JOIN node up ON up.k = node.up LEFT JOIN kids ON kids.k = node.k
LEFT JOIN ends ON ends.k = node.k
""",
}
