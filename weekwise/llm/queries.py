"""The registered query of each operator, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekwise.llm import (
    block_dedup, chat_format, decontaminate, hard_negatives, html_crf, overlap_join, pii, quality, token_scan, toxicity,
    trie_bpe, turn_repair, url_filter,
)
from weekwise.llm.common import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies among all documents."""
    return block_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def word_bpe_file() -> str:
    """The tokenizer file of the queries."""
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all documents' ids and decoded texts."""
    return trie_bpe.round_trip(table(spark, sf_dir, "documents"), word_bpe_file())


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-copy components of all documents."""
    return overlap_join.near_duplicates(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return html_crf.main_text(table(spark, sf_dir, "pages"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations that no other continues, rendered."""
    return chat_format.render(table(spark, sf_dir, "conversations"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents from flat token files."""
    import public_tokenizers

    tokenizer = str(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN
    return token_scan.document_token_counts(table(spark, sf_dir, "documents"), tokenizer)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repair of all conversations after their damage."""
    conversations = table(spark, sf_dir, "conversations")
    return turn_repair.Repair(turn_repair.damage(conversations)).report(conversations)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector among all vectors."""
    vec_id, label = F.col("vec_id"), F.col("label").cast("long")
    shifted = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), shifted, vec_id % 50 == 0)


# The entries of the contract.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_exact_dedup, op2_bpe, op3_toxicity, op4_ngram_jaccard_join, op5_pii, op6_html_extraction,
        op7_benchmark_decontamination, op8_chat_formatting, op9_quality, op10_token_counts,
        op11_conversation_repair, op12_hard_negatives, op13_url_filter)}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = f"""
WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents),
n AS (SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id,
             count(*) OVER (PARTITION BY t) AS group_size,
             row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) AS place FROM d)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, place = 1 AS kept, sha256(t) AS text_sha256
FROM n
"""

OP4_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g
  FROM d),
size AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n FROM s),
e AS (SELECT doc_id, unnest(g) AS gram FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM e a JOIN e b ON a.gram = b.gram AND a.doc_id <> b.doc_id
      GROUP BY 1, 2),
link AS (SELECT x, y FROM p JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y
         WHERE 100 * common >= 90 * (a.n + b.n - common)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents
          UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y)
SELECT size.doc_id, n AS n_shingles, min(reach.y) AS component_id
FROM size JOIN reach ON reach.x = size.doc_id GROUP BY 1, 2
"""

_WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP7_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
b AS (SELECT item_id, {_WORDS.format(_LOWER)} AS w FROM benchmark),
i AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[k:k + n - 1], ' ') AS g
       FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM i)),
lengths AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, lengths WHERE len(w) >= n)),
h AS (SELECT doc_id, k, dw.n, item_id FROM dw JOIN iw ON dw.g = iw.g AND dw.n = iw.n),
pos AS (SELECT DISTINCT doc_id, unnest(range(k, k + n)) AS p FROM h),
np AS (SELECT doc_id, count(*) AS n_hit FROM pos GROUP BY 1),
it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
              string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
       FROM h GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN np USING (doc_id) LEFT JOIN it USING (doc_id)
"""


OP8_SQL = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list(role || chr(0) || text ORDER BY turn NULLS FIRST) AS whole,
             string_agg('<|' || replace(role, '<|', '< |') || '|>' || chr(10) || replace(text, '<|', '< |')
                        || '<|end|>' || chr(10), '' ORDER BY turn NULLS FIRST) AS rendered
      FROM t GROUP BY conv_id),
u AS (SELECT min(conv_id) AS conv_id, whole, min(rendered) AS rendered, count(*) AS copies FROM c GROUP BY whole),
p AS (SELECT DISTINCT whole[1:k] AS part FROM (SELECT whole, unnest(range(1, len(whole))) AS k FROM u))
SELECT conv_id, CAST(len(whole) AS BIGINT) AS n_turns, CAST(copies AS BIGINT) AS copies, rendered
FROM u WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.part = u.whole)
"""


# crc32 by its bits; then, row after row, the cheapest and ASCII-least audit with its lines for every state that
# the roles kept so far can end in (c0, a0, l0: nothing yet; 1: system; 2: user; 3: assistant).
_EDIT = "struct_pack(c := {c}, a := {a}, l := {l})"
_NO = "struct_pack(c := 1000000000, a := '', l := CAST([] AS VARCHAR[]))"


def _op11_step(state: int) -> str:
    """All ways into ``state`` over one row, the insertions after it among them, as a list of edits."""
    came = {0: [], 1: [0], 2: [0, 1, 3], 3: [2]}[state]
    initial, name = " sua"[state], [None, None, "user", "assistant"][state]
    ways = [_EDIT.format(c=f"p.s{state}.c + 4", a=f"p.s{state}.a || 'D'", l=f"p.s{state}.l")]
    for s in came:
        keep = _EDIT.format(c=f"p.s{s}.c + r.cut", a=f"p.s{s}.a || 'K'", l=f"list_append(p.s{s}.l, r.role || ':' || r.text)")
        ways.append(f"CASE WHEN NOT r.gone AND r.initial = '{initial}' THEN {keep} ELSE {_NO} END")
        if name:
            rerole = _EDIT.format(c=f"p.s{s}.c + 3 + r.cut", a=f"p.s{s}.a || 'R'",
                                  l=f"list_append(p.s{s}.l, '{name}:' || r.text)")
            ways.append(f"CASE WHEN NOT r.gone THEN {rerole} ELSE {_NO} END")
    return f"list_min([{', '.join(ways)}])"


def _op11_insert(state: int, source: str) -> str:
    """The best way into ``state`` at a place, with up to two insertions."""
    def insert(s: int, into: int, way: str | None = None) -> str:
        way = way or f"{source}.s{s}"
        name = {2: "user:", 3: "assistant:"}[into]
        return _EDIT.format(c=f"({way}).c + 3", a=f"({way}).a || 'I'", l=f"list_append(({way}).l, '{name}')")
    ways = [f"{source}.s{state}"]
    if state == 2:
        ways += [insert(s, 2) for s in (0, 1, 3)]
    if state == 3:
        ways += [insert(2, 3)] + [insert(2, 3, insert(s, 2)) for s in (0, 1)]
    return f"list_min([{', '.join(ways)}])"


def _op11_row(states: list[str]) -> str:
    return ", ".join(f"s{k} := {x}" for k, x in enumerate(states))


OP11_SQL = f"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations),
c AS (
  SELECT *, xor(4294967295, list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)],
                list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda crc, b: list_reduce(list_concat([xor(crc, b)], [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
                               lambda x, _: xor(x >> 1, 3988292384 * (x & 1))))) % 20 AS kind FROM k),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM c WHERE kind <> 0),
o AS (
  SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text
           ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
         NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS open_end, left(role, 1) AS initial,
         lag(left(role, 1)) OVER w || left(role, 1) AS pair
  FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
r AS (
  SELECT conv_id, i, role, text, initial, blank OR seen AS gone,
         CASE WHEN open_end THEN 3 ELSE 0 END AS cut FROM o),
n AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count_if(blank) AS blank, count_if(seen AND NOT blank) AS duplicate,
         count_if(open_end AND NOT seen AND NOT blank) AS truncated,
         count_if(pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM o GROUP BY conv_id),
p AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {{none}} AS p FROM n
  UNION ALL
  SELECT q.conv_id, q.i, struct_pack({{inserted}}) AS p FROM (
    SELECT r.conv_id, r.i, struct_pack({{stepped}}) AS q
    FROM p JOIN r ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = p.i + 1) q),
e AS (
  SELECT n.conv_id, gaps, blank, duplicate, truncated, illegal, list_min([p.s0, p.s3]) AS best
  FROM p JOIN n ON n.conv_id IS NOT DISTINCT FROM p.conv_id AND n.n = p.i),
a AS (SELECT DISTINCT conv_id FROM conversations)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.l, chr(10)), '')) AS repaired_sha256
FROM a LEFT JOIN e ON a.conv_id IS NOT DISTINCT FROM e.conv_id
""".format(
    none="struct_pack(" + _op11_row([_EDIT.format(c=c, a=f"'{a}'", l=f"CAST({l} AS VARCHAR[])") for c, a, l in (
        (0, "", "[]"), (1000000000, "", "[]"), (3, "I", "['user:']"), (6, "II", "['user:', 'assistant:']"))]) + ")",
    stepped=_op11_row([_op11_step(s) for s in range(4)]),
    inserted=_op11_row([_op11_insert(s, "q.q") for s in range(4)]))

OP12_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
             CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
      FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id IS DISTINCT FROM b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

OP13_SQL = """
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u),
k AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r AS (SELECT page_id, host, path, CASE
        WHEN '.' || host LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
        WHEN '.' || host LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
        WHEN '.' || host LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
        WHEN '.' || host LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
        WHEN '.' || host LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule FROM k)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": OP1_SQL, "op4_ngram_jaccard_join": OP4_SQL,
            "op7_benchmark_decontamination": OP7_SQL, "op8_chat_formatting": OP8_SQL,
            "op11_conversation_repair": OP11_SQL, "op12_hard_negatives": OP12_SQL, "op13_url_filter": OP13_SQL}
