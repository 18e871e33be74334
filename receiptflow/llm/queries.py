"""One query for each operator over the driver's tables, and DuckDB SQL where it can say the same."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from receiptflow.llm.conversation_repair import audit_conversations
from receiptflow.llm.decontaminate import decontaminate
from receiptflow.llm.html_text import extract_text
from receiptflow.llm.jaccard_join import class_name, jaccard_groups
from receiptflow.llm.language_id import identify
from receiptflow.llm.lexical_search import search
from receiptflow.llm.line_dedup import dedup_lines
from receiptflow.llm.quality_classifier import classify_quality
from receiptflow.llm.quality_rules import VOTES, judge_quality
from receiptflow.llm.sentencepiece_codec import encode_texts
from receiptflow.llm.sharding import shard_documents
from receiptflow.llm.url_filter import Rule, filter_urls
from receiptflow.llm.warc import archive_pages


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]

#: The method's own globs, for URLs that none of the rules above fits: hosts and paths that rarely hold prose.
OWN_GLOBS = [
    Rule("block", "ads*.*", "/"),
    Rule("block", "*track*.*", "/"),
    Rule("block", "*.xxx", "/"),
    Rule("block", "*", "/*.exe"),
    Rule("block", "*", "/*.zip"),
    Rule("block", "*", "/*/log?n"),
    Rule("block", "*", "/cart/"),
    Rule("allow", "*.edu", "/*/track"),
]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    text, clean = (F.coalesce(c, F.lit("")) for c in ("text", "clean_text"))
    removed = F.aggregate("removed_spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select(
        "doc_id",
        (F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1).cast("long").alias("n_lines"),
        removed.alias("n_removed_lines"),
        F.length(clean).cast("long").alias("clean_chars"),
        F.sha2(clean, 256).alias("clean_sha256"),
    )


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "html")
    return extract_text(pages).select("page_id", "text", F.length("text").cast("long").alias("n_chars"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages, URL_RULES, own=OWN_GLOBS).select("page_id", "host", "path", "rule", "verdict", "own_glob")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = jaccard_groups(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.select("doc_id", "class_id", class_name(F.col("key")).alias("text_key"), "n_links", "n_copies", "kept")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    found = identify(docs.drop("lang"), docs.filter(fold != 2))
    return found.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = archive_pages(_table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    found = classify_quality(docs, _table(spark, sf_dir, "labels"), F.col("source"), F.concat_ws("/", "source", "lang"))
    return found.select("doc_id", "host", "path", "p_text", "host_prior", "path_prior", "p_good", "kept")


#: The public vocabulary the codec queries use.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    back = encode_texts(docs, PIECE_MODEL, decoded="decoded")
    return back.select("doc_id", "n_tokens", "ids", F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return judged.select(*base, (F.round(1e6 * F.col("p_good")) / 1e6).alias("p_good"), "kept")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def damaged(turns: DataFrame) -> DataFrame:
    """``conversations`` with faults put in by a checksum of identifier and turn; nulls are one space."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    out = turns.filter(fault != 0).withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))))
    return out.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(blank("role")).alias("role"), text.alias("text"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = audit_conversations(damaged(turns)).withColumnRenamed("conv_id", "found")
    every = turns.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("found")) & F.col("audit").isNotNull(), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return every.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard_documents(docs, texts=False).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_html_text": op2_html_text,
    "op3_url_filter": op3_url_filter,
    "op4_decontaminate": op4_decontaminate,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_language_id": op6_language_id,
    "op7_warc": op7_warc,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_quality_rules": op10_quality_rules,
    "op11_lexical_search": op11_lexical_search,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_sharding": op13_sharding,
}

def _pattern(glob: str) -> str:
    """A glob as a regular expression."""
    return re.sub(r"[^\w/]", lambda m: {"*": ".*", "?": "."}.get(m[0], "\\" + m[0]), glob)


_GLOB_ROWS = ", ".join(rf"('{r.verdict}', '{r.text}', '(?s)^(.*\.)?{_pattern(r.host)}$', '(?s)^{_pattern(r.path)}', {i})" for i, r in enumerate(OWN_GLOBS))
_RULE_ROWS = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}', {i})" for i, r in enumerate(URL_RULES))

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _quality_sql() -> str:
    """Measures, votes, EM over counted vote patterns in a recursive query, posterior and verdict."""
    k = range(1, len(VOTES) + 1)
    votes = ", ".join(f"CASE WHEN {v.good} THEN 1 WHEN {v.bad} THEN -1 ELSE 0 END" for v in VOTES)
    odds = "ln(prior / (1 - prior)) + " + " + ".join(f"votes[{j}] * ln(rights[{j}] / (1 - rights[{j}]))" for j in k)
    right = ", ".join(
        f"""CASE WHEN sum(abs(votes[{j}]) * c) > 0 THEN least(0.95, greatest(0.55, sum(CASE votes[{j}] WHEN 1 THEN c * p WHEN -1 THEN c * (1 - p) ELSE 0 END)
            / sum(abs(votes[{j}]) * c))) ELSE any_value(rights[{j}]) END"""
        for j in k
    )
    return rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
runs AS (
  SELECT doc_id, p, words[p] || ' ' || words[p + 1] || ' ' || words[p + 2] AS run FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS p FROM texts)),
twice AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, run) AS n FROM runs) WHERE n > 1),
repeats AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(p, p + 3)) AS place FROM twice) GROUP BY doc_id),
measures AS (
  SELECT t.doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '[.!?"'')\]][\x20\x09-\x0D]*\z')))::BIGINT AS n_ended_lines
  FROM texts t LEFT JOIN repeats r ON r.doc_id = t.doc_id),
voted AS MATERIALIZED (SELECT *, [{votes}] AS votes FROM measures),
patterns AS MATERIALIZED (SELECT votes, count(*) AS c FROM voted GROUP BY votes),
em(k, prior, rights) AS (
  SELECT 0, 0.7::DOUBLE, {[0.8] * len(VOTES)}::DOUBLE[]
  UNION ALL
  SELECT k + 1, least(0.95, greatest(0.05, sum(c * p) / sum(c))), [{right}]
  FROM (SELECT k, rights, votes, c, 1 / (1 + exp(-({odds}))) AS p FROM em, patterns WHERE k < 50) GROUP BY k),
fitted AS (SELECT * FROM em WHERE k = 50),
judged AS (
  SELECT v.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, 1 / (1 + exp(-({odds}))) AS p FROM voted v, fitted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, round(1e6 * p) / 1e6 AS p_good, NOT base_failed AND p >= 0.5 AS kept
FROM judged"""


#: A list of CRC-32's 256 codes, made by its polynomial, and (column, crc) of each row of a table of texts.
_CRC_CODES = """crc_codes AS MATERIALIZED (SELECT list(c ORDER BY b) AS codes FROM (
  SELECT b, list_reduce(list_concat([b], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM range(256) r(b)))"""


def _crc32(text: str) -> str:
    """SQL for the CRC-32 of the UTF-8 bytes of ``text``, where ``crc_codes`` is joined."""
    step = "xor(c >> 8, codes[(xor(c, x) & 255) + 1])"
    found = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(4294967295, list_reduce(list_concat([4294967295], {found}), lambda c, x: {step}))"


def _repair_sql() -> str:
    """Damage, faults, then for each place between turns, from the last, the cheapest edits of the rest as cost and letters in a string."""
    start, system, user, assistant = (f"f[{k}]" for k in range(1, 5))

    def more(rest: str, cost: str, letter: str) -> str:
        return f"printf('%08d%s', substr({rest}, 1, 8)::INT + {cost}, '{letter}' || substr({rest}, 9))"

    def turn(here: str, to: str, letter: str, others: str = "") -> str:
        keep = f"CASE WHEN NOT gone AND own = '{letter}' THEN {more(to, 'cut', 'K')} END"
        return f"least({more(here, '3', 'D')}, {keep}, CASE WHEN NOT gone THEN {more(to, '2 + cut', 'R')} END{others})"

    first = f", CASE WHEN NOT gone AND own = 's' THEN {more(system, 'cut', 'K')} END"
    raw = f"[{turn(start, user, 'u', first)}, {turn(system, user, 'u')}, {turn(user, assistant, 'a')}, {turn(assistant, user, 'u')}]"
    both = f"[g[1], g[2], least(g[3], {more('g[4]', '2', 'I')}), least(g[4], {more('g[3]', '2', 'I')})]"
    full = f"[least(h[1], {more('h[3]', '2', 'I')}), least(h[2], {more('h[3]', '2', 'I')}), h[3], h[4]]"
    return rf"""
WITH RECURSIVE {_CRC_CODES},
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
faulty AS (SELECT *, {_crc32("key")} % 20 AS fault FROM keyed, crc_codes),
after AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM faulty)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS p FROM after),
looked AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 AS again,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS open, substr(role, 1, 1) AS own,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY p) AS own_before
  FROM placed),
turns AS MATERIALIZED (SELECT *, blank OR again AS gone, (open AND NOT blank AND NOT again)::INT AS cut FROM looked),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
         count(*) FILTER (WHERE again AND NOT blank) AS duplicate, sum(cut) AS truncated,
         count(*) FILTER (WHERE own_before || own NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY conv_id),
edits(conv_id, p, f) AS (
  SELECT conv_id, n + 1, ['00000000', '00000004II', '00000002I', '00000000'] FROM counts
  UNION ALL
  SELECT conv_id, p, {full} FROM (
    SELECT conv_id, p, {both} AS h FROM (
      SELECT e.conv_id, t.p, {raw} AS g FROM edits e JOIN turns t ON t.conv_id IS NOT DISTINCT FROM e.conv_id AND t.p = e.p - 1))),
audits AS (SELECT conv_id, substr(f[1], 1, 8)::BIGINT AS cost, substr(f[1], 9) AS audit FROM edits WHERE p = 1),
letters AS (
  SELECT conv_id, k, letter, sum((letter <> 'I')::INT) OVER w AS p, sum((letter <> 'D')::INT) OVER w AS j
  FROM (SELECT conv_id, unnest(range(1, length(audit) + 1)) AS k, unnest(string_split(audit, '')) AS letter FROM audits WHERE audit <> '')
  WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
edited AS (
  SELECT l.*, t.role, CASE WHEN letter = 'I' THEN '' ELSE t.text END AS text,
         max((letter = 'K' AND j = 1 AND own = 's')::INT) OVER (PARTITION BY l.conv_id) AS later
  FROM letters l LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM l.conv_id AND t.p = l.p),
mended AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (j + later) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY k) AS whole
  FROM edited WHERE letter <> 'D' GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN mended m ON m.conv_id IS NOT DISTINCT FROM o.conv_id"""


ORACLE_SQL = {
    "op10_quality_rules": _quality_sql(),
    "op1_line_dedup": r"""
WITH raw AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS pos
  FROM documents),
counted AS (
  SELECT doc_id, pos, trim(line, ' ') AS line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM raw),
placed AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS past FROM counted WHERE words > 0),
runs AS (
  SELECT doc_id, pos AS first, max(pos) OVER w AS last, string_agg(line, chr(10)) OVER w AS run, sum(words) OVER w AS n
  FROM (SELECT *, past - words AS start FROM placed)
  WINDOW w AS (PARTITION BY doc_id ORDER BY start RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
  UNION ALL
  SELECT doc_id, min(pos) OVER w, pos, string_agg(line, chr(10)) OVER w, sum(words) OVER w
  FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY past RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
long_runs AS (SELECT doc_id, first, last, md5(run) AS run FROM runs WHERE n >= 50),
origins AS (SELECT run, min({'d': doc_id, 'f': first}) AS origin FROM long_runs GROUP BY run),
later AS (
  SELECT DISTINCT r.doc_id, r.first, r.last FROM long_runs r JOIN origins o ON r.run = o.run
  WHERE {'d': r.doc_id, 'f': r.first} > o.origin),
gone AS (SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS pos FROM later),
lines AS (SELECT r.*, g.pos IS NOT NULL AS cut FROM raw r LEFT JOIN gone g ON r.doc_id = g.doc_id AND r.pos = g.pos)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE cut) AS n_removed_lines,
       length(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT cut), '')) AS clean_chars,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT cut), '')) AS clean_sha256
FROM lines GROUP BY doc_id""",
    "op3_url_filter": rf"""
WITH parsed AS (
  SELECT page_id,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '') AS raw_host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
canonical AS (
  SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parsed),
rules(verdict, rule_host, rule_path, k) AS (VALUES {_RULE_ROWS}),
globs(verdict, spelled, host_like, path_like, k) AS (VALUES {_GLOB_ROWS}),
judged AS (
  SELECT page_id, host, path,
       (SELECT {{'rule': r.rule_host || r.rule_path, 'verdict': r.verdict}} FROM rules r
        WHERE ends_with('.' || c.host, '.' || r.rule_host) AND starts_with(c.path, r.rule_path)
        ORDER BY length(r.rule_host || r.rule_path) DESC, r.k LIMIT 1) AS r,
       (SELECT {{'spelled': g.spelled, 'verdict': g.verdict}} FROM globs g
        WHERE regexp_matches(c.host, g.host_like) AND regexp_matches(c.path, g.path_like)
        ORDER BY length(g.spelled) DESC, g.k LIMIT 1) AS g
  FROM canonical c)
SELECT page_id, host, path, r.rule AS rule, coalesce(r.verdict, g.verdict, 'allow') AS verdict,
       CASE WHEN r.rule IS NULL THEN g.spelled END AS own_glob FROM judged""",
    "op4_decontaminate": rf"""
WITH docs AS (SELECT doc_id, coalesce({_ITEM_WORDS}, []) AS w FROM documents),
items AS (SELECT item_id::VARCHAR AS id, w, least(13, len(w)) AS size FROM (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
item_windows AS (SELECT DISTINCT id, size, array_to_string(w[p : p + size - 1], ' ') AS run FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS p FROM items)),
sizes AS (SELECT DISTINCT size FROM items),
doc_windows AS (
  SELECT doc_id, size, p, array_to_string(w[p : p + size - 1], ' ') AS run
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS p FROM docs JOIN sizes ON len(w) >= size)),
hits AS (SELECT doc_id, id, size, p FROM doc_windows JOIN item_windows USING (size, run)),
words_hit AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT DISTINCT doc_id, unnest(range(p, p + size)) AS place FROM hits) GROUP BY doc_id),
items_hit AS (SELECT doc_id, list_sort(list(DISTINCT id)) AS ids FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AND 20 * coalesce(n, 0) >= len(w) AS contaminated
FROM docs d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)""",
    "op5_jaccard_join": rf"""
WITH RECURSIVE docs AS (SELECT doc_id, w, CASE WHEN len(w) > 0 THEN sha256(array_to_string(w, ' '))[1:32] END AS key FROM (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents)),
nodes AS MATERIALIZED (SELECT key, any_value(w) AS w, min(doc_id) AS id, count(*) AS n_copies FROM docs WHERE key IS NOT NULL GROUP BY key),
grams AS MATERIALIZED (SELECT DISTINCT key, array_to_string(w[p : p + 4], ' ') AS gram FROM (SELECT key, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS p FROM nodes)),
sizes AS (SELECT key, count(*) AS n FROM grams GROUP BY key),
shared AS (SELECT a.key AS x, b.key AS y, count(*) AS n FROM grams a JOIN grams b ON a.gram = b.gram AND a.key <> b.key GROUP BY a.key, b.key),
links AS MATERIALIZED (SELECT x, y FROM shared s JOIN sizes a ON a.key = x JOIN sizes b ON b.key = y WHERE 5 * s.n >= 4 * (a.n + b.n - s.n)),
reached(key, other) AS (SELECT key, key FROM nodes UNION SELECT r.key, l.y FROM reached r JOIN links l ON l.x = r.other),
classes AS (SELECT r.key, min(n.id) AS class_id FROM reached r JOIN nodes n ON n.key = r.other GROUP BY r.key),
counts AS (SELECT x AS key, count(*) AS n FROM links GROUP BY x)
SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id, d.key AS text_key, coalesce(l.n, 0)::BIGINT AS n_links, coalesce(n.n_copies, 1)::BIGINT AS n_copies,
       coalesce(c.class_id, d.doc_id) = d.doc_id AS kept
FROM docs d LEFT JOIN nodes n ON n.key = d.key LEFT JOIN classes c ON c.key = d.key LEFT JOIN counts l ON l.key = d.key""",
    "op7_warc": """
WITH payloads AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT payload_digest, min(page_id) AS first FROM payloads WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, payload_bytes, p.payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM payloads p LEFT JOIN firsts f ON p.payload_digest = f.payload_digest AND payload_bytes >= 100""",
    "op11_lexical_search": rf"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, w FROM (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents) WHERE len(w) > 0),
corpus AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM docs),
norms AS (SELECT r, doc_id, 100 - 50 + (50 * len(w) * n_docs) // n_terms AS m FROM docs, corpus),
asked AS (SELECT item_id, row_number() OVER () AS q, list_distinct(w) AS w FROM (SELECT item_id, {_ITEM_WORDS} AS w FROM (SELECT DISTINCT item_id, text FROM benchmark)) WHERE len(w) > 0),
terms AS (SELECT q, unnest(w) AS term FROM asked),
found AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM docs) WHERE term IN (SELECT term FROM terms) GROUP BY r, term),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM found, corpus GROUP BY term, n_docs),
scores AS (
  SELECT q, r, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM terms JOIN weights USING (term) JOIN found USING (term) JOIN norms USING (r) GROUP BY q, r),
ranked AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scores JOIN norms USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked JOIN asked USING (q) WHERE rank <= 50""",
    "op12_conversation_repair": _repair_sql(),
    "op13_sharding": f"""
WITH RECURSIVE {_CRC_CODES},
docs AS MATERIALIZED (SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size, {_crc32("coalesce(text, '')")} AS text_crc32, sha256(coalesce(text, '')) AS sha FROM documents, crc_codes),
copies AS (SELECT sha, sum(size) AS bytes FROM docs GROUP BY sha),
units AS MATERIALIZED (
  SELECT sha, bytes, CASE WHEN bytes * 10240 >= (SELECT sum(size) FROM docs) THEN sha ELSE (('0x' || sha[1:8])::BIGINT % 10240)::VARCHAR END AS unit FROM copies),
lined AS MATERIALIZED (
  SELECT unit, bytes, row_number() OVER (ORDER BY bytes DESC, name) AS k FROM (SELECT unit, sum(bytes)::BIGINT AS bytes, min(sha) AS name FROM units GROUP BY unit)),
dealt(k, shard, loads) AS (
  SELECT 0::BIGINT, 0::BIGINT, list_transform(range(40), lambda x: 0::BIGINT)
  UNION ALL
  SELECT l.k, least, list_transform(loads, lambda x, i: CASE WHEN i = least THEN x + l.bytes ELSE x END)
  FROM (SELECT *, list_position(loads, list_min(loads))::BIGINT AS least FROM dealt) d JOIN lined l ON l.k = d.k + 1),
shards AS (SELECT sha, shard - 1 AS shard FROM units JOIN lined USING (unit) JOIN dealt USING (k))
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard::INT AS shard,
       (row_number() OVER (PARTITION BY shard ORDER BY sha, doc_id NULLS FIRST) - 1)::BIGINT AS slot, NULL::INT AS grown_shard
FROM docs JOIN shards USING (sha)""",
}
