"""One query opN_<name> for each operator, over its whole table with production parameters, and SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neardup import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import contaminated

    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_extract_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .htmltext import extract_pages

    return extract_pages(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table has one label of toxicity, whatever its kind. With the label of quality it makes a chain of three: whether
    the text is junk, whether it is prose that is toxic, and last whether it is toxic, which is the verdict."""
    from pyspark.sql import functions as F

    from .toxicity import classify, train_chain

    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    known = labels.withColumns({"junk": 1 - F.col("quality"), "toxic_prose": F.col("toxic") * F.col("quality")})
    judged = classify(docs, train_chain(docs, known, ["junk", "toxic_prose", "toxic"]))
    return judged.select("doc_id", "p_junk", "p_toxic_prose", "p_toxic", F.col("is_toxic").alias("toxic"))


def op5_dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .linedupe import dedup_lines

    kept = dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_rules import kept_by, ledger

    rows = ledger(_table(spark, sf_dir, "documents"))
    judged = rows.withColumns({"base_failed": ~kept_by("base"), "kept": kept_by("v1")})
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import digests, format_conversations

    return digests(format_conversations(_table(spark, sf_dir, "conversations"))).drop("rewrites_at")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .importance import resample

    return resample(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")).drop("text")


def op9_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffixes import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents"), digests=True)


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sources

    return mix_sources(_table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The six ASCII white space characters, in DuckDB.
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES: dict[str, str] = {
    "op1_near_duplicates": f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^ \t\n\x0B\f\r]+') AS w FROM documents
), elements AS (
  SELECT DISTINCT doc_id, md5(unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS e
  FROM worded WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM elements GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM elements a JOIN elements b USING (e) WHERE a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 5 * n_both >= 4 * (x.n + y.n - n_both)
), either AS (
  SELECT a, b FROM links UNION SELECT b, a FROM links
), reached AS (
  SELECT doc_id, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM reached r JOIN either e ON e.a = r.doc_id
)
SELECT doc_id, min(root) AS class_id FROM reached GROUP BY doc_id""",
    "op9_remove_repeats": """
WITH texts AS (
  SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents
), pieces AS (  -- pieces of 1000 starts, so that a string is cut out of little
  SELECT doc_id, k, substr(h, CAST(2000 * k + 1 AS BIGINT), 2398) AS p FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2000 + 1)) AS k FROM texts WHERE length(h) >= 400)
), starts AS (
  SELECT doc_id, 1000 * k + j AS pos, md5(substr(p, CAST(2 * j + 1 AS BIGINT), 400)) AS s
  FROM (SELECT doc_id, k, p, unnest(range(0, least(1000, length(p) // 2 - 199))) AS j FROM pieces WHERE length(p) >= 400)
), repeated AS (
  SELECT doc_id, pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY s) AS n FROM starts) WHERE n > 1
), numbered AS (
  SELECT doc_id, pos, sum(new) OVER (PARTITION BY doc_id ORDER BY pos) AS span
  FROM (SELECT doc_id, pos, CASE WHEN pos <= lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 200 THEN 0 ELSE 1 END AS new FROM repeated)
), spans AS (
  SELECT doc_id, span, min(pos) AS a, max(pos) + 200 AS b FROM numbered GROUP BY doc_id, span
), gaps AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans
), cut AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last_b, string_agg(substr(h, CAST(2 * before + 1 AS BIGINT), CAST(2 * (a - before) AS BIGINT)), '' ORDER BY a) AS kept
  FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(from_hex(coalesce(kept, '') || substr(h, CAST(2 * coalesce(last_b, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM texts LEFT JOIN cut USING (doc_id)""",
    "op2_decontaminate": """
WITH d AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^ \t\n\x0B\f\r]+') AS w FROM documents)
), b AS (
  SELECT item_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^ \t\n\x0B\f\r]+') AS w FROM benchmark) WHERE len(w) >= 10
), equal_words AS (
  SELECT doc_id, item_id, d.pos - b.pos AS diagonal, b.pos AS pos FROM d JOIN b USING (word)
), dense AS (
  SELECT * FROM equal_words QUALIFY count(*) OVER (PARTITION BY doc_id, item_id, diagonal) >= 10
), counted AS (
  SELECT doc_id, item_id, count(*) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY pos RANGE BETWEEN 12 PRECEDING AND CURRENT ROW) AS n FROM dense
)
SELECT doc_id, item_id, CAST(max(n) AS BIGINT) AS matched FROM counted WHERE n >= 10 GROUP BY doc_id, item_id""",
    "op6_quality_rules": f"""
WITH worded AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w FROM documents
), grams AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM worded)
), again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT pos) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 5)) AS pos FROM again) GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM worded) WHERE length(trim(line, {BLANKS})) > 0 GROUP BY doc_id
), measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, coalesce(n_lines, 0) AS n_lines,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_shouted
  FROM worded LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 5 * n_symbols > n_words OR 2 * n_shouted > n_words
       OR (n_lines >= 4 AND 2 * n_dup_lines > n_lines) OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM measured""",
    "op5_dedup_lines": f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents
), keyed AS (
  SELECT doc_id, n, line, translate(trim(line, {BLANKS}), '{UPPER}', '{LOWER}') AS k FROM lines
), repeated AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT doc_id, n, line, r.k IS NOT NULL AND doc_id <> r.keeper AS gone FROM keyed LEFT JOIN repeated r USING (k)
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op7_format_chats": """
WITH turns AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
), sized AS (
  SELECT *, length(role) + length(text) + length('<turn >.</turn>.')
    + length(role) + length(text) - length(translate(role, '\\<>', '')) - length(translate(text, '\\<>', '')) AS chars FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id""",
}
