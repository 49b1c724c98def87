"""DuckDB SQL equal to each registered query (same column names and types).

The views ``documents``, ``pages`` ... are registered by the checker. The
snippets below spell the same rules as the Spark expressions: papers view,
token rule, seeded md5 order, exact split sizes, span split.
"""

from __future__ import annotations

from titlecorpus.plans import queries as Q
from titlecorpus.schema import (
    DEFAULT_ABSTRACT,
    DEFAULT_CATEGORIES,
    DEFAULT_JOURNAL_REF,
    DEFAULT_TITLE,
    INVALID_INPUT_MESSAGE,
    NA_TOKENS,
    PREDICTION_ERROR_PREFIX,
    TASK_PREFIX,
)

WS = ("[\\x{09}-\\x{0d}\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
      "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]")
SPAN = "[.!?]+[ \\t\\n\\x{0b}\\f\\r]+"


def tok(x: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({x}), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"


def norm(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '{WS}+', ' ', 'g'), '^ | $', '', 'g')"


def md5key(seed: str, key: str = "id") -> str:
    return f"md5('{seed}:' || {key})"


PAPERS = """papers AS (
  SELECT doc_id AS id,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, 1, strpos(text, chr(10)) - 1) ELSE text END AS title,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) END AS abstract,
         CAST(NULL AS VARCHAR) AS journal_ref,
         concat_ws(' ', lang, source) AS categories
  FROM documents)"""

PAIRS = PAPERS + """,
pairs AS (SELECT id, abstract AS input_text, title AS target_text FROM papers
          WHERE abstract IS NOT NULL AND title IS NOT NULL)"""

SPLIT = PAIRS + f""",
ranked AS (SELECT *, row_number() OVER (ORDER BY {md5key(Q.SEED)}, id) AS rn, count(*) OVER () AS n FROM pairs),
split AS (SELECT id, input_text, target_text,
                 CASE WHEN rn <= round_even({Q.EVAL_FRAC}::DOUBLE * n, 0) THEN 'eval' ELSE 'train' END AS split,
                 rn FROM ranked),
train AS (SELECT id, input_text, target_text FROM split WHERE split = 'train'),
eval AS (SELECT id, input_text, target_text, rn FROM split WHERE split = 'eval')"""

MODEL = SPLIT + f""",
occ AS (SELECT unnest(list_distinct({tok('input_text')})) AS token,
               list_distinct({tok('target_text')}) AS t FROM train),
cnt AS (SELECT token, count(*) AS n_abs, count(*) FILTER (WHERE list_contains(t, token)) AS n_both
        FROM occ GROUP BY token),
model AS (SELECT token, n_abs, n_both, (2000000 * n_both + 1000000) // (2 * n_abs + 2) AS weight FROM cnt)"""

THREE = PAIRS + f""",
ranked AS (SELECT *, row_number() OVER (ORDER BY {md5key(Q.SEED)}, id) AS rn, count(*) OVER () AS n FROM pairs),
sized AS (SELECT *, ceil({Q.HELD_FRAC}::DOUBLE * n) AS held FROM ranked),
three AS (SELECT id, input_text, target_text,
                 CASE WHEN rn <= ceil(0.5 * held) THEN 'test' WHEN rn <= held THEN 'validation'
                      ELSE 'train' END AS split FROM sized)"""


def json_fields() -> str:
    return f"""
  CASE WHEN id % 7 = 3 THEN '{DEFAULT_TITLE}' WHEN id % 11 = 5 THEN NULL ELSE title END AS title,
  CASE WHEN id % 5 = 1 THEN '{DEFAULT_ABSTRACT}' ELSE abstract END AS abstract,
  CASE WHEN id % 3 = 0 THEN '{DEFAULT_JOURNAL_REF}' WHEN id % 3 = 1 THEN NULL ELSE 'J. ' || source END AS journal_ref,
  CASE WHEN id % 13 = 7 THEN '{DEFAULT_CATEGORIES}' ELSE categories END AS categories"""


JSON_SRC = PAPERS + """,
d AS (SELECT p.*, doc.source FROM papers p JOIN documents doc ON doc.doc_id = p.id)"""


def na(col: str) -> str:
    tokens = ", ".join("'" + t.replace("'", "''") + "'" for t in NA_TOKENS)
    return f"CASE WHEN {col} IN ({tokens}) THEN NULL ELSE {col} END AS {col}"


def generate_sql(rows_cte: str, text: str, max_len: int, beams: int = 1,
                 no_repeat2: bool = False) -> tuple[str, str]:
    """(extra CTEs, final SELECT): best spans of ``rows_cte(id, <text>)`` under ``model``."""
    keep = "len(toks) > 0"
    if no_repeat2:
        bigrams = "list_transform(range(1, len(toks)), lambda i: toks[i] || ' ' || toks[i + 1])"
        keep += f" AND len(list_distinct({bigrams})) = len({bigrams})"
    beam_col = ", CAST(beam AS INTEGER) AS beam" if beams > 1 else ""
    ctes = f""",
spans AS (SELECT id, unnest(range(0, len(sp))) AS span_pos, unnest(sp) AS span
          FROM (SELECT id, regexp_split_to_array({text}, '{SPAN}') AS sp FROM {rows_cte})),
whole AS (SELECT id, span_pos, {tok('span')} AS every FROM spans),
stoks AS (SELECT id, span_pos, part, every[part * {max_len} + 1:(part + 1) * {max_len}] AS toks
          FROM (SELECT id, span_pos, every, unnest(range(0, greatest(1, (len(every) + {max_len} - 1) // {max_len}))) AS part FROM whole)),
kept AS (SELECT * FROM stoks WHERE {keep}),
occ2 AS (SELECT id, span_pos, part, unnest(toks) AS token FROM kept),
scored AS (SELECT o.id, o.span_pos, o.part, sum(coalesce(m.weight, 0)) / count(*) AS score
           FROM occ2 o LEFT JOIN model m ON o.token = m.token GROUP BY o.id, o.span_pos, o.part),
best AS (SELECT s.id, s.span_pos, s.score, k.toks,
                row_number() OVER (PARTITION BY s.id ORDER BY s.score DESC, s.span_pos, s.part) AS beam
         FROM scored s JOIN kept k ON k.id = s.id AND k.span_pos = s.span_pos AND k.part = s.part)"""
    final = f"""SELECT r.id, array_to_string(b.toks, ' ') AS predicted_title, b.score{beam_col}
FROM {rows_cte} r LEFT JOIN best b ON b.id = r.id AND b.beam <= {beams}"""
    return ctes, final


def _sql() -> dict[str, str]:
    s: dict[str, str] = {}
    s["json_extract_defaults"] = f"""WITH {JSON_SRC}
SELECT row_number() OVER (ORDER BY id) AS line_no, {json_fields()} FROM d"""
    # The dump leaves the categories key out of lines with id % 13 = 7 (see
    # fixtures.json_dump_lines); such a line cannot match a category filter.
    # All lines are read; the condition only mirrors that key state.
    s["json_select"] = f"""WITH {JSON_SRC}
SELECT {json_fields()} FROM d
WHERE id % 13 <> 7 AND contains(categories, '{Q.CATEGORY}') ORDER BY id LIMIT {Q.HEAD_N}"""
    s["corpus_build"] = f"""WITH {JSON_SRC}
SELECT row_number() OVER (ORDER BY id) AS id, title, abstract, journal_ref, categories FROM (
  SELECT id, {json_fields()} FROM d
  WHERE id % 13 <> 7 AND contains(categories, '{Q.CATEGORY}') ORDER BY id LIMIT {Q.HEAD_N})"""
    s["direct_load"] = f"""WITH {JSON_SRC}
SELECT row_number() OVER (ORDER BY id) AS id, {json_fields()} FROM d ORDER BY d.id LIMIT {Q.HEAD_N}"""
    s["file_head"] = f"WITH {PAPERS} SELECT title, abstract, journal_ref, categories FROM papers ORDER BY id LIMIT {Q.HEAD_N}"
    s["file_sample"] = f"""WITH {PAPERS},
lines AS (SELECT *, row_number() OVER (ORDER BY id) AS pos FROM papers),
drawn AS (SELECT *, row_number() OVER (ORDER BY {md5key(Q.SEED, 'pos')}, pos) - 1 AS index FROM lines)
SELECT index, title, abstract, journal_ref, categories FROM drawn WHERE index < {Q.SAMPLE_N}"""
    s["sample_strict"] = f"WITH {PAPERS} SELECT * FROM papers ORDER BY {md5key(Q.SEED)}, id LIMIT {Q.SAMPLE_N}"
    s["json_count"] = f"""WITH {PAPERS}
SELECT count(*) AS n_found FROM papers WHERE id % 13 <> 7 AND contains(categories, '{Q.CATEGORY}')"""
    s["csv_roundtrip"] = f"""WITH {PAPERS}
SELECT {na('title')}, {na('abstract')}, {na('journal_ref')}, {na('categories')} FROM papers"""
    s["csv_split_read"] = f"""WITH {PAPERS}
SELECT row_number() OVER (ORDER BY id) AS row_no, {na('title')}, {na('abstract')}, {na('journal_ref')}, {na('categories')} FROM papers"""
    s["parquet_roundtrip"] = f"""WITH {PAPERS}
SELECT title, abstract, journal_ref, categories FROM papers"""
    s["append_ids"] = f"""WITH {PAPERS}
SELECT row_number() OVER (ORDER BY b, doc_id) AS id, title, abstract, journal_ref, categories
FROM (SELECT 1 AS b, id AS doc_id, title, abstract, journal_ref, categories FROM papers
      UNION ALL SELECT 2, id, title, abstract, journal_ref, categories FROM papers)"""
    thrice = f"""WITH {PAPERS}
SELECT row_number() OVER (ORDER BY b, doc_id) AS id, title, abstract, journal_ref, categories
FROM (SELECT b, id AS doc_id, title, abstract, journal_ref, categories FROM papers CROSS JOIN (VALUES (1), (2), (3)) t(b))"""
    s["table_first_n"] = f"SELECT * FROM ({thrice}) WHERE id <= (SELECT count(*) FROM documents) + {Q.HEAD_N}"
    s["table_record_at"] = f"SELECT * FROM ({thrice}) WHERE id = (SELECT count(*) FROM documents) + {Q.RECORD_INDEX + 1}"
    s["scan_limit"] = f"WITH {PAPERS} SELECT * FROM papers ORDER BY id LIMIT {Q.SCAN_LIMIT}"
    s["pairs_limit"] = f"WITH {PAPERS} SELECT id, abstract, title FROM papers ORDER BY id LIMIT {Q.PAIRS_LIMIT}"
    s["record_at"] = f"WITH {PAPERS} SELECT * FROM papers ORDER BY id LIMIT 1 OFFSET {Q.RECORD_INDEX}"
    body = "regexp_extract(html, '(?is)<body[^>]*>(.*)</body>', 1)"
    body = f"regexp_replace({body}, '(?is)<script[^>]*>.*?</script>', ' ', 'g')"
    body = f"regexp_replace({body}, '(?is)<style[^>]*>.*?</style>', ' ', 'g')"
    body = f"regexp_replace({body}, '<[^>]*>', ' ', 'g')"
    title = "regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"
    s["pages_pairs"] = f"SELECT page_id AS id, {norm(body)} AS input_text, {norm(title)} AS target_text FROM pages"
    s["category_filter"] = f"WITH {PAPERS} SELECT * FROM papers WHERE contains(categories, '{Q.CATEGORY}')"
    s["category_count"] = f"WITH {PAPERS} SELECT count(*) AS n_found FROM papers WHERE contains(categories, '{Q.CATEGORY}')"
    s["normalize_ws"] = f"SELECT doc_id AS id, {norm('text')} AS text FROM documents"
    s["pair_projection"] = f"WITH {PAIRS} SELECT * FROM pairs"
    s["task_prefix"] = f"WITH {PAIRS} SELECT id, '{TASK_PREFIX}' || input_text AS input_text, target_text FROM pairs"
    blank = f"coalesce(regexp_replace(abstract, '{WS}+', '', 'g') = '', true)"
    s["validate_request"] = f"""WITH {PAPERS}
SELECT id, abstract,
       CASE WHEN NOT {blank} THEN regexp_replace(abstract, '^{WS}+|{WS}+$', '', 'g') END AS clean,
       CASE WHEN {blank} THEN '{INVALID_INPUT_MESSAGE}' END AS error
FROM papers"""
    s["head_n"] = f"WITH {PAPERS} SELECT * FROM papers ORDER BY id LIMIT {Q.HEAD_N}"
    s["sample_n"] = f"WITH {PAPERS} SELECT * FROM papers ORDER BY {md5key(Q.SEED)}, id LIMIT {Q.SAMPLE_N}"
    s["sample_n_reindexed"] = f"""WITH {PAPERS}
SELECT *, row_number() OVER (ORDER BY {md5key(Q.SEED)}, id) - 1 AS index
FROM papers ORDER BY {md5key(Q.SEED)}, id LIMIT {Q.SAMPLE_N}"""
    s["split_fraction"] = f"WITH {SPLIT} SELECT id, input_text, target_text, split FROM split"
    s["split_complement"] = f"WITH {SPLIT} SELECT id, input_text, target_text FROM train"
    s["split_three_way"] = f"WITH {THREE} SELECT * FROM three"
    s["split_read"] = f"WITH {THREE} SELECT * FROM three WHERE split = 'validation'"
    s["eval_first_k"] = f"""WITH {SPLIT}
SELECT id, input_text, target_text, 'eval' AS split FROM eval ORDER BY rn LIMIT {Q.EVAL_FIRST_K}"""
    s["draw_with_replacement"] = f"""WITH {SPLIT},
draws AS (SELECT d AS draw,
                 CAST('0x' || substr({md5key(Q.DRAW_SEED, 'd')}, 1, 8) AS BIGINT) % (SELECT count(*) FROM eval) + 1 AS rank
          FROM range({Q.DRAWS}) t(d))
SELECT e.rn AS rank, e.id, e.input_text, e.target_text, draws.draw FROM draws JOIN eval e ON e.rn = draws.rank"""
    s["batch_groups"] = f"""WITH {SPLIT},
per_epoch AS (SELECT CAST(unnest(range({Q.EPOCHS})) AS INTEGER) AS epoch, id FROM train),
pos AS (SELECT epoch, id, row_number() OVER (PARTITION BY epoch ORDER BY md5('{Q.SEED}:' || epoch || ':' || id), id) AS position
        FROM per_epoch)
SELECT epoch, id, position, (position - 1) // {Q.BATCH_SIZE} AS batch_id FROM pos"""
    vocab = SPLIT + f""",
vt AS (SELECT unnest(list_concat({tok('input_text')}, {tok('target_text')})) AS token FROM train),
vc AS (SELECT token, count(*) AS count FROM vt GROUP BY token),
vocab AS (SELECT token, count, CAST(row_number() OVER (ORDER BY count DESC, token) + 1 AS INTEGER) AS token_id
          FROM vc)"""
    s["vocab"] = f"WITH {vocab} SELECT * FROM vocab"

    def enc(mask: bool) -> str:
        labels = f"list_resize(coalesce(lab, []::INTEGER[]), {Q.LABEL_LEN}, 0)"
        if mask:
            labels = f"list_transform({labels}, lambda x: CASE WHEN x = 0 THEN -100 ELSE x END)"
        return f"""WITH {vocab},
items AS (SELECT id, 0 AS side, unnest(range(1, len(a) + 1)) AS pos, unnest(a) AS token
          FROM (SELECT id, {tok('input_text')}[1:{Q.INPUT_LEN}] AS a FROM pairs)
          UNION ALL
          SELECT id, 1, unnest(range(1, len(a) + 1)), unnest(a)
          FROM (SELECT id, {tok('target_text')}[1:{Q.LABEL_LEN}] AS a FROM pairs)),
coded AS (SELECT i.id, i.side, i.pos, coalesce(v.token_id, 1) AS tid FROM items i LEFT JOIN vocab v ON v.token = i.token),
grouped AS (SELECT id, list(tid ORDER BY pos) FILTER (WHERE side = 0) AS inp,
                   list(tid ORDER BY pos) FILTER (WHERE side = 1) AS lab FROM coded GROUP BY id)
SELECT p.id, list_resize(coalesce(inp, []::INTEGER[]), {Q.INPUT_LEN}, 0) AS input_ids, {labels} AS labels
FROM pairs p LEFT JOIN grouped g ON g.id = p.id"""
    s["encode_padded"] = enc(False)
    s["encode_masked_labels"] = enc(True)
    s["decode_ids"] = f"""WITH {vocab},
items AS (SELECT id, unnest(range(1, len(a) + 1)) AS pos, unnest(a) AS token
          FROM (SELECT id, {tok('input_text')}[1:{Q.INPUT_LEN}] AS a FROM pairs)),
shown AS (SELECT i.id, string_agg(coalesce(v.token, '{Q.UNKNOWN}'), ' ' ORDER BY pos) AS text
          FROM items i LEFT JOIN vocab v ON v.token = i.token GROUP BY i.id)
SELECT p.id, coalesce(text, '') AS text FROM pairs p LEFT JOIN shown s ON s.id = p.id"""
    s["sample_nine_tenths"] = f"""WITH {SPLIT}
SELECT id, input_text, target_text FROM ranked WHERE rn <= round_even(0.9::DOUBLE * n, 0)"""
    s["split_80_10_10"] = f"""WITH {SPLIT}
SELECT id, input_text, target_text, CASE WHEN rn <= ceil(0.5::DOUBLE * ceil(0.2::DOUBLE * n)) THEN 'test'
       WHEN rn <= ceil(0.2::DOUBLE * n) THEN 'validation' ELSE 'train' END AS split FROM ranked"""
    s["json_sample"] = f"""WITH {JSON_SRC},
lines AS (SELECT *, row_number() OVER (ORDER BY id) AS line_no FROM d),
drawn AS (SELECT *, row_number() OVER (ORDER BY md5('{Q.SEED}:' || line_no), line_no) AS place FROM lines)
SELECT place, {json_fields()} FROM drawn WHERE place <= {Q.SAMPLE_N}"""
    s["predict_with_failures"] = f"""WITH {PAPERS},
w AS (SELECT id, abstract, list_filter(regexp_split_to_array(abstract, '{WS}+'), lambda t: t <> '') AS ws FROM papers),
e AS (SELECT *, CASE WHEN len(coalesce(ws, [])) = 0 THEN '{INVALID_INPUT_MESSAGE}'
             WHEN len(ws) % 7 = 3 THEN '{PREDICTION_ERROR_PREFIX}' || len(ws) || ' words' END AS error FROM w)
SELECT id, abstract, CASE WHEN error IS NULL THEN array_to_string(ws[1:5], ' ') END AS predicted_title, error FROM e"""
    s["model_fit"] = f"WITH {MODEL} SELECT * FROM model"
    ctes, final = generate_sql("eval", "input_text", Q.TITLE_LEN)
    s["predict_titles"] = f"WITH {MODEL}{ctes}\n{final}"
    ctes_k, final_k = generate_sql("eval", "input_text", Q.BEAM_TITLE_LEN, Q.BEAMS, True)
    s["predict_topk"] = f"WITH {MODEL}{ctes_k}\n{final_k}"
    ctes_c, final_c = generate_sql("conv", "text", Q.TITLE_LEN)
    s["predict_conversations"] = f"""WITH {MODEL},
conv AS (SELECT conv_id || ':' || turn AS id, role, text FROM conversations){ctes_c}
""" + final_c.replace("SELECT r.id,", "SELECT r.id, r.role,", 1)
    s["eval_loss"] = f"""WITH {SPLIT},
counts AS (SELECT token, count(*) AS k FROM (SELECT unnest({tok('target_text')}) AS token FROM train) GROUP BY token),
seen AS (SELECT token, count(*) AS m FROM (SELECT unnest({tok('target_text')}) AS token FROM eval) GROUP BY token)
SELECT round(-sum(m * ln(coalesce(k, 0) + 1)) / sum(m)
             + ln((SELECT coalesce(sum(k), 0) + count(*) + 1 FROM counts)), 6) AS eval_loss,
       CAST(coalesce(sum(m), 0) AS BIGINT) AS n_tokens
FROM seen LEFT JOIN counts USING (token)"""
    s["side_by_side"] = f"""WITH {MODEL}{ctes},
pred AS ({final})
SELECT e.id, e.target_text AS true_title, p.predicted_title, e.input_text AS abstract,
       CAST(len(list_intersect({tok('e.target_text')}, coalesce({tok('p.predicted_title')}, []::VARCHAR[]))) AS INTEGER) AS overlap
FROM eval e LEFT JOIN pred p ON p.id = e.id"""
    ctes_v, final_v = generate_sql("valid", "clean", Q.TITLE_LEN)
    blank_r = f"coalesce(regexp_replace(abstract, '{WS}+', '', 'g') = '', true)"
    s["stream_predict"] = f"""WITH {MODEL},
reqs AS (SELECT id, abstract,
                CASE WHEN NOT {blank_r} THEN regexp_replace(abstract, '^{WS}+|{WS}+$', '', 'g') END AS clean,
                CASE WHEN {blank_r} THEN '{INVALID_INPUT_MESSAGE}' END AS error FROM papers),
valid AS (SELECT id, clean FROM reqs WHERE error IS NULL){ctes_v},
gen AS ({final_v})
SELECT r.id, r.abstract, g.predicted_title, r.error FROM reqs r LEFT JOIN gen g ON g.id = r.id"""
    s["map_batches"] = f"""SELECT doc_id AS id,
       CAST(len(list_filter(regexp_split_to_array(text, '{WS}+'), lambda x: x <> '')) AS BIGINT) AS n_words
FROM documents"""
    return s


ORACLE_SQL: dict[str, str] = _sql()
