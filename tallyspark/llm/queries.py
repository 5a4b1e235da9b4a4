"""Registered queries of the subpackage: thin wrappers that give each operator its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (conversation_repair, decontaminate, html_main, jaccard, lexical_search, minhash_dedup, packing, pii, quality_mil, quality_rules, suffix_dedup, toxicity,
               urlfilter)
from .common import fold_of, table

# The URL rules that the query applies.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def _scored(docs: DataFrame, held_out, score, threshold: float) -> DataFrame:
    f = docs.select("doc_id", held_out.alias("held_out"), score.alias("score"))
    return f.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_mil.fit(docs, labels.where(fold_of(F.col("doc_id"), 4) != 2))
    return _scored(docs, fold_of(F.col("doc_id"), 4) == 2,
                   quality_mil.score_column(spark, model, F.col("text")), quality_mil.GOOD_AT)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"), urlfilter.rules_frame(spark, URL_RULES))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(packing.TOKENIZER))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), trusted)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_report(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(fold_of(F.col("doc_id"), 3) != 1))
    return _scored(docs, fold_of(F.col("doc_id"), 3) == 1,
                   toxicity.score_column(spark, model, F.col("text")), toxicity.REJECT_AT)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), size=4, percent=85)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_main.extract(pages, html_main.fit(pages))


def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.minhash_components(table(spark, sf_dir, "documents"), size=4, percent=80)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_report(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_quality_classifier, op2_pii, op3_url_filters, op4_packing, op5_quality_rules, op6_suffix_dedup,
        op7_toxicity, op8_jaccard_join, op9_decontamination, op10_html_extraction,
        op11_minhash_dedup, op12_lexical_search, op13_conversation_repair)}


# Each URL rule as a condition of its own, longest first.
_OP3 = """
WITH parts AS (
  SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0
                       THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM parts),
ruled AS (
  SELECT page_id, host, path, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule FROM split)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""


# Per kind: its pattern for DuckDB (runs of a character class stand for look-around) and the condition on a match m
# with the text before it.
_D = "regexp_replace(m, '[^0-9]', '', 'g')"
_OP2_KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
           "len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3"
           " OR ('0' || substr(ltrim(p, '0'), 1, 3))::INT > 255)) = 0"),
    "card": (r"[0-9]([\x20-]?[0-9])+",
             f"length({_D}) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length({_D}) + 1), lambda i:"
             f" CASE WHEN i % 2 = 1 THEN substr(reverse({_D}), i::INT, 1)::INT"
             f" ELSE [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][substr(reverse({_D}), i::INT, 1)::INT + 1] END)) % 10 = 0"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_D}) BETWEEN 9 AND 15"),
    "iban": (r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}\b",
             "list_reduce(list_prepend(0::BIGINT, list_transform(string_split(substr(replace(m, ' ', ''), 5) ||"
             " substr(m, 1, 4), ''), lambda h: CASE WHEN h BETWEEN '0' AND '9' THEN ascii(h) - 48 ELSE ascii(h) - 55"
             " END::BIGINT)), lambda r, x: CASE WHEN x < 10 THEN (r * 10 + x) % 97 ELSE (r * 100 + x) % 97 END) = 1"),
    "ssn": (r"[0-9-]+", "regexp_full_match(m, '[0-9]{3}-[0-9]{2}-[0-9]{4}') AND"
            " regexp_matches(near, 'ssn|social security|social insurance|tax id')"),
    "secret": (r"[A-Za-z0-9_-]{16,}", f"regexp_matches(m, '[A-Za-z]') AND length({_D}) >= 3 AND"
               r" regexp_matches(near, '(?:token|secret|passw(?:or)?d|pwd|key)[^a-z0-9_-]{1,5}\z')"),
}
_OP2 = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
cut AS ({" UNION ALL ".join(
    f"SELECT r, t, {k} AS place, '{kind}' AS kind, regexp_extract_all(t, '{pattern}') AS ms,"
    f" regexp_split_to_array(t, '{pattern}') AS bs FROM docs" for k, (kind, (pattern, _)) in enumerate(_OP2_KINDS.items()))}),
matches AS (SELECT r, t, place, kind, unnest(ms) AS m, unnest(bs[1:len(ms)]) AS b, generate_subscripts(ms, 1) AS i
            FROM cut WHERE len(ms) > 0),
placed AS (SELECT *, sum(length(b) + length(m)) OVER (PARTITION BY r, place ORDER BY i)::BIGINT AS stop FROM matches),
started AS (SELECT *, stop - length(m) AS start, lower(substr(t, greatest(stop - length(m) - 40, 0) + 1,
                   least(stop - length(m), 40))) AS near FROM placed),
found AS (SELECT r, place, kind, start, kind || ':' || start || ':' || stop AS span FROM started
          WHERE CASE {" ".join(f"WHEN kind = '{kind}' THEN {check}" for kind, (_, check) in _OP2_KINDS.items())} END),
joined AS (SELECT r, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
                  count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
                  string_agg(span, ',' ORDER BY place, start) FILTER (place < 4) AS base,
                  string_agg(span, ',' ORDER BY place, start) AS spans FROM found GROUP BY r)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (r)
"""


# Components of shared 4-word shingles: every pair of different texts that share one, counted in full.
_LINKED = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, w, min(doc_id) OVER (PARTITION BY w) AS c FROM (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents)),
words AS (SELECT c, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS i
          FROM (SELECT DISTINCT c, w FROM docs)),
runs AS (SELECT c, n, i, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o) AS s
         FROM words WINDOW o AS (PARTITION BY c ORDER BY i)),
shingles AS (SELECT DISTINCT c, s FROM runs WHERE i <= greatest(n - 3, 1)),
sizes AS (SELECT c, count(*) AS n FROM shingles GROUP BY c),
shared AS (SELECT a.c AS x, b.c AS y, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.c < b.c
           GROUP BY a.c, b.c),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.c = x JOIN sizes q ON q.c = y
          WHERE 100 * shared.n >= {percent} * (p.n + q.n - shared.n)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT c, c AS least FROM sizes UNION SELECT y, least FROM reach JOIN edges ON x = c WHERE least < y),
found AS (SELECT c, min(least) AS least FROM reach GROUP BY c),
result AS (
  SELECT doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, coalesce(least, doc_id)::BIGINT AS component_id
  FROM docs LEFT JOIN sizes ON sizes.c = docs.c LEFT JOIN found ON found.c = docs.c)
"""
_OP8 = _LINKED.format(percent=85) + "SELECT * FROM result"
_OP11 = _LINKED.format(percent=80) + "SELECT *, doc_id = component_id AS kept FROM result"

# Every string of 50 bytes as hexadecimal digits, cut from parts of the text.
_OP6 = r"""
WITH raw AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT doc_id, h, length(h) // 2 AS n FROM raw),
parts AS (SELECT doc_id, base, least(500, n - 49 - base) AS starts, substr(h, 2 * base + 1, 2 * 549) AS part
          FROM (SELECT *, unnest(range(0, n - 49, 500)) AS base FROM sized)),
strings AS (SELECT doc_id, base + o AS pos, substr(part, 2 * o + 1, 100) AS s
            FROM (SELECT *, unnest(range(0, starts)) AS o FROM parts)),
least_ AS (SELECT s, min(doc_id) AS least FROM strings GROUP BY s HAVING min(doc_id) < max(doc_id)),
hits AS (SELECT doc_id, pos FROM strings JOIN least_ USING (s) WHERE doc_id > least),
heads AS (SELECT doc_id, pos, CASE WHEN pos <= lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 50 THEN 0 ELSE 1 END AS head
          FROM hits),
spans AS (SELECT doc_id, min(pos) AS a, max(pos) + 50 AS b FROM (
            SELECT doc_id, pos, sum(head) OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM heads) GROUP BY doc_id, k),
around AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
kept AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
                string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS k
         FROM around JOIN sized USING (doc_id) GROUP BY doc_id)
SELECT sized.doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(from_hex(coalesce(k, h))) AS kept_sha256
FROM sized LEFT JOIN kept ON kept.doc_id = sized.doc_id
"""


_OP12 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+') AS terms FROM documents),
sizes AS (SELECT r, doc_id, len(terms) AS n FROM docs WHERE len(terms) > 0),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM sizes),
entries AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs) GROUP BY r, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM entries, total GROUP BY term, docs),
items AS (SELECT row_number() OVER () AS q, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)),
asked AS (
  SELECT q, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS term FROM items),
scored AS (
  SELECT q, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words))))::BIGINT AS score
  FROM asked JOIN entries USING (term) JOIN weights USING (term) JOIN sizes USING (r), total GROUP BY q, item_id, r, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def _least(*ways: str) -> str:
    return f"list_min([{', '.join(ways)}])"


def _way(state: str, cost: int, edit: str, line: str | None = None, extra: bool = True) -> str:
    """One edit after the best way to ``state``."""
    lines = f"{state}.l" if line is None else f"list_append({state}.l, {line})"
    more = " + extra" if extra and edit in "KR" else ""
    return f"{{'c': {state}.c + {cost}{more}, 'e': {state}.e || '{edit}', 'l': {lines}}}"


# The cheapest edits row by row: the best (cost, audit, lines) by last role so far, n none, s system, u user, a assistant;
# iu and ia with insertions before the next row.  Structs compare by cost, then audit, which no two ways share.
_KEPT, _USER, _ASSISTANT = "role || ':' || text", "'user:' || text", "'assistant:' || text"
_IA = _least("a", _way("iu", 3, "I", "'assistant:'"))
_OP13 = rf"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
crcs AS (  -- CRC-32 bit by bit; the keys are ASCII
  SELECT k, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(k) + 1),
    lambda i: ascii(substr(k, i::INT, 1))::BIGINT)), lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)),
    lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384::BIGINT) ELSE r >> 1 END)), 4294967295::BIGINT) % 20 AS fault
  FROM (SELECT DISTINCT k FROM raw)),
hit AS (
  SELECT conv_id, turn, fault, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM raw JOIN crcs USING (k) WHERE fault <> 0),
after AS (SELECT conv_id, turn, role, text FROM hit UNION ALL SELECT conv_id, turn, role, text FROM hit WHERE fault = 3),
placed AS (
  SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ink, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, substr(text, 1, 64), md5(text)) AS place FROM after),
judged AS (
  SELECT *, CASE WHEN ink = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
                 WHEN right(ink, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         substr(role, 1, 1) AS i,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY place) || substr(role, 1, 1) AS pair FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(place) AS last
  FROM judged GROUP BY conv_id),
ways AS (
  SELECT conv_id, 0::BIGINT AS place, {{'c': 0::BIGINT, 'e': '', 'l': []::VARCHAR[]}} AS n, NULL::STRUCT(c BIGINT, e VARCHAR, l VARCHAR[]) AS s,
         NULL::STRUCT(c BIGINT, e VARCHAR, l VARCHAR[]) AS u, NULL::STRUCT(c BIGINT, e VARCHAR, l VARCHAR[]) AS a FROM counts
  UNION ALL
  SELECT conv_id, place, {_way('n', 4, 'D')} AS n,
         CASE WHEN s.c IS NULL AND (forced OR i <> 's') THEN NULL WHEN forced OR i <> 's' THEN {_way('s', 4, 'D')}
              WHEN s.c IS NULL THEN {_way('n', 0, 'K', _KEPT)}
              ELSE {_least(_way('s', 4, 'D'), _way('n', 0, 'K', _KEPT))} END AS s,
         CASE WHEN forced THEN du WHEN i = 'u' THEN {_least('du', _way('n', 0, 'K', _KEPT), 'ks', 'ka')}
              ELSE {_least('du', _way('n', 3, 'R', _USER), 'rs', 'ra')} END AS u,
         CASE WHEN forced THEN da WHEN i = 'a' THEN {_least('da', _way('iu', 0, 'K', _KEPT))}
              ELSE {_least('da', _way('iu', 3, 'R', _ASSISTANT))} END AS a
  FROM (SELECT *, CASE WHEN u.c IS NOT NULL THEN {_way('u', 4, 'D')} END AS du,
               CASE WHEN a.c IS NOT NULL THEN {_way('a', 4, 'D')} END AS da,
               CASE WHEN s.c IS NOT NULL THEN {_way('s', 0, 'K', _KEPT)} END AS ks, {_way('ia', 0, 'K', _KEPT)} AS ka,
               CASE WHEN s.c IS NOT NULL THEN {_way('s', 3, 'R', _USER)} END AS rs, {_way('ia', 3, 'R', _USER)} AS ra
        FROM (SELECT *, {_IA} AS ia FROM (
          SELECT w.conv_id, j.place, n, s, u, a, role, text, i, j.fault IN ('blank', 'duplicate') AS forced,
                 CASE WHEN j.fault = 'truncated' THEN 3 ELSE 0 END AS extra,
                 {_least("u", _way('n', 3, 'I', "'user:'"),
                         f"CASE WHEN s.c IS NOT NULL THEN {_way('s', 3, 'I', repr('user:'))} END",
                         f"CASE WHEN a.c IS NOT NULL THEN {_way('a', 3, 'I', repr('user:'))} END")} AS iu
          FROM ways w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.place = w.place + 1)))),
ends AS (
  SELECT counts.conv_id, gaps, blank, duplicate, truncated, illegal, {_least(
      'n', 'a', f"CASE WHEN u.c IS NOT NULL THEN {_way('u', 3, 'I', repr('assistant:'))} END",
      "CASE WHEN s.c IS NOT NULL THEN {'c': s.c + 6, 'e': s.e || 'II', "
      "'l': list_append(list_append(s.l, 'user:'), 'assistant:')} END")} AS w
  FROM ways JOIN counts ON ways.conv_id IS NOT DISTINCT FROM counts.conv_id AND place = last)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(w.c, 0) AS cost,
       coalesce(w.e, '') AS audit, sha256(coalesce(array_to_string(w.l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_pii": _OP2, "op3_url_filters": _OP3, "op6_suffix_dedup": _OP6, "op8_jaccard_join": _OP8,
            "op11_minhash_dedup": _OP11, "op12_lexical_search": _OP12, "op13_conversation_repair": _OP13}
