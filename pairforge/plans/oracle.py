"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written from the operator definitions, not from the Spark plans: row numbers
and ``QUALIFY`` stand in for the distributed threshold selection, plain joins
for the views. The tables are the driver's pre-registered views.
"""

from __future__ import annotations

# Fixed values, written out here so that the oracle does not lean on the code it
# checks: Python's white space, a run of other characters, the instruction.
WS_CODEPOINTS = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8192, 8193, 8194, 8195, 8196, 8197, 8198, 8199, 8200, 8201, 8202, 8232, 8233, 8239, 8287, 12288]
NON_WS_RUN = r"[^\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}-\x{2029}\x{202f}\x{205f}\x{3000}]+"
SYSTEM_PROMPT = 'You are a medical text simplifier. Rewrite the following medical text into plain language that a patient with no medical background can understand. Preserve all key findings and conclusions. Do not add information not present in the original text.'

WS_SQL = "(" + "||".join(f"chr({c})" for c in WS_CODEPOINTS) + ")"


def strip(x: str) -> str:
    return f"trim(CAST({x} AS VARCHAR), {WS_SQL})"


def words(x: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, '{NON_WS_RUN}')) AS BIGINT)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


PAIRS_CONV = """pairs_conv AS (
  SELECT u.conv_id, u.turn, u.text AS query, a.text AS answer
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""

PAIRS_DOC = """pairs_doc AS (
  SELECT s.doc_id, s.text AS Source, t.text AS Target
  FROM documents s JOIN documents t ON t.doc_id = s.doc_id + 1)"""


def _prep(name, ordinal, view, o_part, o_row, key, inp, out, trunc):
    a = strip(inp)
    if trunc:
        a = f"left({a}, {trunc})"
    return f"""prep_{name} AS (
  SELECT * FROM (
    SELECT '{name}' AS source, CAST({ordinal} AS INTEGER) AS source_ord,
           CAST({o_part} AS BIGINT) AS o_part, '' AS o_file, CAST({o_row} AS BIGINT) AS o_row,
           {key} AS pair_key, {a} AS abstract, {strip(out)} AS plain_summary
    FROM {view}) x
  WHERE length(abstract) > 50 AND length(plain_summary) > 50)"""


PREP_CONV = _prep("conv", 0, "pairs_conv", "conv_id", "turn", "'conv:' || conv_id || ':' || turn", "query", "answer", None)
PREP_DOC = _prep("doc", 1, "pairs_doc", "0", "doc_id", "'doc:' || doc_id", "Source", "Target", None)


def _cap(name, n):
    return f"""cap_{name} AS (
  SELECT * FROM prep_{name} QUALIFY row_number() OVER (ORDER BY o_part, o_file, o_row) <= {n})"""


UNION = ",\n".join(
    [
        PAIRS_CONV,
        PAIRS_DOC,
        PREP_CONV,
        PREP_DOC,
        "union_all AS (SELECT * FROM prep_conv UNION ALL SELECT * FROM prep_doc)",
    ]
)

SPLIT = UNION + """,
hashed AS (SELECT *, md5('42|' || pair_key) AS shuffle_hash FROM union_all),
ranked AS (SELECT *, row_number() OVER (ORDER BY shuffle_hash, pair_key) AS rn, count(*) OVER () AS n FROM hashed),
split AS (SELECT *, CASE WHEN rn <= floor(n * CAST(0.1 AS DOUBLE)) THEN 'val' ELSE 'train' END AS split FROM ranked)"""

SYS = q(SYSTEM_PROMPT)


def _flat3(src: str, keep: str) -> str:
    return f"""SELECT {keep}, CAST(3 AS BIGINT) AS n_messages,
  'system' AS role_0, {SYS} AS content_0, 'user' AS role_1, abstract AS content_1,
  'assistant' AS role_2, plain_summary AS content_2 FROM {src}"""


SQL: dict[str, str] = {
    "strip_text": f"""
SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS BIGINT) AS pos, {strip('unnest(parts)')} AS stripped
FROM (SELECT doc_id, string_split(text, '.') AS parts FROM documents)""",
    "truncate_text": f"""
SELECT doc_id, truncated, CAST(length(truncated) AS BIGINT) AS n_chars, {strip('truncated')} <> truncated AS ends_in_ws
FROM (SELECT doc_id, left({strip('text')}, 1500) AS truncated FROM documents)""",
    "word_count": f"SELECT doc_id, {words('text')} AS words FROM documents",
    "pick_columns": f"""WITH {PAIRS_DOC}
SELECT doc_id, 'Source' AS input_col, 'Target' AS output_col, Source AS abstract, Target AS plain_summary FROM pairs_doc""",
    "filter_pairs": f"""WITH {PAIRS_CONV}, {PAIRS_DOC},
c AS (SELECT 'conv:' || conv_id || ':' || turn AS pair_key, {strip('query')} AS a, {strip('answer')} AS b FROM pairs_conv
      UNION ALL
      SELECT 'doc:' || doc_id, {strip('Source')}, {strip('Target')} FROM pairs_doc)
SELECT pair_key, CAST(length(a) AS BIGINT) AS abstract_chars, CAST(length(b) AS BIGINT) AS plain_chars,
       length(a) > 50 AND length(b) > 50 AS keep FROM c""",
    "prepare_pairs": f"""WITH {PAIRS_CONV}, {PAIRS_DOC}, {PREP_CONV}, {PREP_DOC}
SELECT * FROM prep_conv UNION ALL SELECT * FROM prep_doc""",
    # doc_id equals the row position inside documents.parquet at every scale factor
    "scan_ordered": "SELECT CAST(0 AS INTEGER) AS path_ord, CAST(doc_id AS BIGINT) AS row_index, doc_id, lang FROM documents",
    "cap_pairs": f"""WITH {PAIRS_CONV}, {PAIRS_DOC}, {PREP_CONV}, {PREP_DOC}, {_cap('conv', 100)}, {_cap('doc', 200)}
SELECT source, pair_key, o_part, o_row FROM cap_conv UNION ALL SELECT source, pair_key, o_part, o_row FROM cap_doc""",
    "union_sources": f"WITH {UNION} SELECT * FROM union_all",
    "source_counts": f"""WITH {UNION},
per AS (SELECT s.source, s.source_ord, CAST(count(u.pair_key) AS BIGINT) AS pairs
        FROM (VALUES ('conv', 0), ('doc', 1)) s(source, source_ord) LEFT JOIN union_all u ON u.source = s.source
        GROUP BY s.source, s.source_ord)
SELECT source, CAST(source_ord AS INTEGER) AS source_ord, pairs, false AS is_total FROM per
UNION ALL SELECT NULL, NULL, CAST(sum(pairs) AS BIGINT), true FROM per""",
    "shuffle_seeded": f"""WITH {UNION} SELECT pair_key, md5('42|' || pair_key) AS shuffle_hash,
  row_number() OVER (ORDER BY md5('42|' || pair_key), pair_key) - 1 AS position FROM union_all""",
    "train_val_split": f"WITH {SPLIT} SELECT pair_key, split FROM split",
    "split_counts": f"""WITH {SPLIT}
SELECT s.split, CAST(count(x.pair_key) AS BIGINT) AS records
FROM (VALUES ('train'), ('val')) s(split) LEFT JOIN split x ON x.split = s.split GROUP BY s.split""",
    "subsample_k": f"""WITH {SPLIT}
SELECT pair_key, split FROM split
QUALIFY row_number() OVER (PARTITION BY split ORDER BY shuffle_hash, pair_key) <= CASE split WHEN 'train' THEN 300 ELSE 50 END""",
    "preview_pair": f"""WITH {UNION}
SELECT source, pair_key, left(abstract, 200) || '...' AS abstract_preview, left(plain_summary, 200) || '...' AS plain_preview
FROM union_all ORDER BY source_ord, o_part, o_file, o_row LIMIT 1""",
    "format_chat": f"WITH {UNION} " + _flat3("union_all", "pair_key"),
    "format_prompt": f"""SELECT doc_id, CAST(2 AS BIGINT) AS n_messages, 'system' AS role_0, {SYS} AS content_0,
  'user' AS role_1, text AS content_1 FROM documents""",
    "render_prompt": f"""SELECT doc_id, '<|im_start|>system' || chr(10) || {SYS} || '<|im_end|>' || chr(10)
  || '<|im_start|>user' || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS prompt
FROM documents""",
    "to_jsonl": f"""WITH {UNION}
SELECT pair_key, CAST(to_json({{'messages': [{{'role': 'system', 'content': {SYS}}}, {{'role': 'user', 'content': abstract}},
  {{'role': 'assistant', 'content': plain_summary}}]}}) AS VARCHAR) AS value FROM union_all""",
    "split_roundtrip": f"WITH {SPLIT} " + _flat3("split", "split"),
}


_GROUPED = f"""WITH {SPLIT},
g AS (SELECT *, md5(length(abstract) || ':' || abstract) AS group_key, {words('abstract')} + {words('plain_summary')} AS words FROM split),
o AS (SELECT group_key, count(*) AS n, sum(words) AS w, md5('42|' || group_key) AS h FROM g GROUP BY group_key),
c AS (SELECT group_key, sum(n) OVER (ORDER BY h) AS n_upto, sum(w) OVER (ORDER BY h) AS w_upto, sum(n) OVER () AS n_all, sum(w) OVER () AS w_all FROM o),
s AS (SELECT group_key, n_upto <= floor(n_all * CAST(0.1 AS DOUBLE)) AS val_n, w_upto <= floor(w_all * CAST(0.1 AS DOUBLE)) AS val_w FROM c)"""


def _leaks(is_val: str, unit: str) -> str:
    return f"""SELECT CAST(count(*) AS BIGINT) AS groups, CAST(count_if(v > 0 AND v < n) AS BIGINT) AS leaked,
  CAST(coalesce(sum(v) FILTER (v > 0 AND v < n), 0) AS BIGINT) AS leaked_val_rows, '{unit}' AS unit
FROM (SELECT count(*) AS n, count_if({is_val}) AS v FROM g JOIN s USING (group_key) GROUP BY group_key)"""


SQL["group_split"] = _GROUPED + " SELECT pair_key, group_key, CASE WHEN val_w THEN 'val' ELSE 'train' END AS split FROM g JOIN s USING (group_key)"
SQL["split_leakage"] = _GROUPED + " " + _leaks("split = 'val'", "row") + " UNION ALL " + _leaks("val_n", "group")


# ---- validation ---------------------------------------------------------

CHAT_RECORDS = """chat_records AS (
  SELECT conv_id, start, list({'role': role, 'content': text} ORDER BY pos) AS messages
  FROM (SELECT conv_id, turn - pos AS start, pos, role, text
        FROM (SELECT conv_id, turn, role, text, unnest([0, 1, 2]) AS pos FROM conversations) e
        WHERE turn - pos >= 0) x
  GROUP BY conv_id, start)"""

_ROLE, _BODY = "struct_extract(m, 'role')", "struct_extract(m, 'content')"
_NL = "chr(10)"
_SYS_FIRST = "struct_extract(messages[1], 'role') = 'system'"


def _each(expr: str) -> str:
    """The messages, each as ``expr`` of role r and content c, put together."""
    return "array_to_string(list_transform({src}, lambda m: " + expr + "), '')"


def _system_into_user(head: str, tail: str) -> str:
    prefix = f"{head} || {strip('struct_extract(messages[1], ' + q('content') + ')')} || {tail}"
    joined = f"{{'role': struct_extract(messages[2], 'role'), 'content': {prefix} || {strip('struct_extract(messages[2], ' + q('content') + ')')}}}"
    return f"""CASE WHEN {_SYS_FIRST} AND len(messages) = 1 THEN [{{'role': 'user', 'content': {prefix}}}]
      WHEN {_SYS_FIRST} THEN list_concat([{joined}], messages[3:]) ELSE messages END"""


RENDERED = CHAT_RECORDS + f""",
placed AS (SELECT conv_id, start, messages, {_system_into_user("''", _NL + " || " + _NL)} AS t,
  {_system_into_user("'<<SYS>>' || " + _NL, _NL + " || '<</SYS>>' || " + _NL + " || " + _NL)} AS i FROM chat_records)
SELECT conv_id, start,
  {_each(f"'<|im_start|>' || {_ROLE} || {_NL} || {_BODY} || '<|im_end|>' || {_NL}").format(src='messages')} || '<|im_start|>assistant' || {_NL} AS chatml,
  '<|begin_of_text|>' || {_each(f"'<|start_header_id|>' || {_ROLE} || '<|end_header_id|>' || {_NL} || {_NL} || {strip(_BODY)} || '<|eot_id|>'").format(src='messages')}
    || '<|start_header_id|>assistant<|end_header_id|>' || {_NL} || {_NL} AS headers,
  '<bos>' || {_each(f"'<start_of_turn>' || CASE {_ROLE} WHEN 'assistant' THEN 'model' ELSE {_ROLE} END || {_NL} || {strip(_BODY)} || '<end_of_turn>' || {_NL}").format(src='t')}
    || '<start_of_turn>model' || {_NL} AS turns,
  {_each(f"CASE {_ROLE} WHEN 'user' THEN '<s>[INST] ' || {strip(_BODY)} || ' [/INST]' WHEN 'assistant' THEN ' ' || {strip(_BODY)} || ' </s>' ELSE {strip(_BODY)} END").format(src='i')} AS inst
FROM placed"""
SQL["render_templates"] = "WITH " + RENDERED

VALIDATED = CHAT_RECORDS + f""",
validated AS (
  SELECT conv_id, start, messages, list_concat(
    CASE WHEN len(messages) = 3 AND struct_extract(messages[1], 'role') = 'system'
              AND struct_extract(messages[2], 'role') = 'user' AND struct_extract(messages[3], 'role') = 'assistant'
         THEN []::VARCHAR[]
         ELSE ['unexpected role order: [' || array_to_string(list_transform(messages, lambda m: '''' || struct_extract(m, 'role') || ''''), ', ') || ']'] END,
    list_transform(list_filter(messages, lambda m: {strip("struct_extract(m, 'content')")} = ''),
                   lambda m: 'empty content for role ''' || struct_extract(m, 'role') || '''')) AS problems
  FROM chat_records)"""


def _stats(src: str, group: str | None) -> str:
    """Per-role word stats over ``src(role, wc[, group])``."""
    if group:
        frame = f"(SELECT {group}, unnest(['user', 'assistant']) AS role FROM (SELECT DISTINCT {group} FROM recs) g) r"
        on = f"w.{group} = r.{group} AND w.role = r.role"
        keys = f"r.{group}, r.role"
    else:
        frame = "(VALUES ('user'), ('assistant')) r(role)"
        on = "w.role = r.role"
        keys = "r.role"
    return f"""SELECT {keys}, CAST(count(w.wc) AS BIGINT) AS n, min(w.wc) AS min_words,
  CAST(percentile_disc(0.5) WITHIN GROUP (ORDER BY w.wc DESC) AS BIGINT) AS median_words, max(w.wc) AS max_words,
  CAST(sum(w.wc) // count(w.wc) AS BIGINT) AS mean_words
FROM {frame} LEFT JOIN {src} w ON {on} GROUP BY {keys}"""


def _render3(a: str, b: str) -> str:
    nl = "chr(10)"
    return (
        f"'<|im_start|>system' || {nl} || {SYS} || '<|im_end|>' || {nl} || '<|im_start|>user' || {nl} || {a}"
        f" || '<|im_end|>' || {nl} || '<|im_start|>assistant' || {nl} || {b} || '<|im_end|>' || {nl}"
    )


HOSTILE = """hostile AS (
  SELECT event_id + 1 AS line_no, CASE WHEN event_id % 7 = 3 THEN ' ' || chr(9)
    WHEN event_id % 5 = 2 THEN left(props, length(props) - 1) ELSE props END AS value FROM events)"""
WS_CLASS_SQL = "[" + NON_WS_RUN[2:-2] + "]"

SQL.update({
    "jsonl_parse": f"""WITH {HOSTILE}
SELECT line_no, json_valid(value) AS valid,
  CASE WHEN json_valid(value) THEN CAST(json_extract(value, '$.k') AS BIGINT) END AS k FROM hostile WHERE {strip('value')} <> ''""",
    "bad_lines": f"""WITH {HOSTILE}
SELECT line_no, value FROM (SELECT row_number() OVER (ORDER BY line_no) AS line_no, value FROM hostile)
WHERE {strip('value')} <> '' AND NOT json_valid(value)""",
    "validate_records": f"""WITH {VALIDATED}
SELECT conv_id, start, CAST(len(problems) AS BIGINT) AS n_problems, array_to_string(problems, ', ') AS problems FROM validated""",
    "invalid_records": f"""WITH {VALIDATED}
SELECT conv_id, start, array_to_string(problems, ', ') AS problems FROM validated WHERE len(problems) > 0""",
    "problem_head": f"""WITH {VALIDATED},
numbered AS (SELECT *, row_number() OVER (ORDER BY conv_id, start) - 1 AS idx FROM validated),
bad AS (SELECT * FROM numbered WHERE len(problems) > 0)
SELECT CAST(idx AS BIGINT) AS idx, array_to_string(problems, ', ') AS problems,
  CAST(greatest((SELECT count(*) FROM bad) - 5, 0) AS BIGINT) AS more
FROM bad ORDER BY idx LIMIT 5""",
    "length_stats": f"""WITH {CHAT_RECORDS},
m AS (SELECT unnest(messages) AS m FROM chat_records),
words AS (SELECT struct_extract(m, 'role') AS role, {words("struct_extract(m, 'content')")} AS wc FROM m
          WHERE struct_extract(m, 'role') IN ('user', 'assistant'))
{_stats('words', None)}""",
    "validation_summary": f"""WITH {SPLIT}, {VALIDATED},
recs AS (
  SELECT split AS file, 0 AS bad, [{{'role': 'system', 'content': {SYS}}}, {{'role': 'user', 'content': abstract}},
          {{'role': 'assistant', 'content': plain_summary}}] AS messages FROM split
  UNION ALL
  SELECT 'chat', CASE WHEN len(problems) > 0 THEN 1 ELSE 0 END, messages FROM validated),
counts AS (SELECT file, CAST(count(*) AS BIGINT) AS records, CAST(sum(bad) AS BIGINT) AS invalid FROM recs GROUP BY file),
m AS (SELECT file, unnest(messages) AS m FROM recs),
words AS (SELECT file, struct_extract(m, 'role') AS role, {words("struct_extract(m, 'content')")} AS wc FROM m
          WHERE struct_extract(m, 'role') IN ('user', 'assistant')),
st AS ({_stats('words', 'file')}),
txt AS (SELECT file,
  max(CASE WHEN role = 'user' THEN CASE WHEN n = 0 THEN 'no data' ELSE 'min=' || min_words || ', median=' || median_words || ', max=' || max_words || ', mean=' || mean_words END END) AS user_words,
  max(CASE WHEN role = 'assistant' THEN CASE WHEN n = 0 THEN 'no data' ELSE 'min=' || min_words || ', median=' || median_words || ', max=' || max_words || ', mean=' || mean_words END END) AS assistant_words
  FROM st GROUP BY file)
SELECT c.file, records, invalid,
  CASE WHEN invalid > 0 THEN 'PROBLEMS found in ' || invalid || ' records' ELSE 'all records valid' END AS status,
  user_words, assistant_words
FROM counts c JOIN txt t ON t.file = c.file""",
    "token_budget": f"""WITH {SPLIT},
t AS (SELECT split, {words(_render3('abstract', 'plain_summary'))} AS tok FROM split)
SELECT split, CAST(count(*) AS BIGINT) AS records, CAST(count_if(tok > 1536) AS BIGINT) AS over_budget,
  CAST(max(tok) AS BIGINT) AS max_tokens, CAST(count_if(tok > 1536) AS DOUBLE) / count(*) AS share_over
FROM t GROUP BY split""",
})

# ---- rewriting and evaluation ----------------------------------------------

SQUEEZE = f"regexp_replace({strip('text')}, '{NON_WS_RUN.replace('[^', '[')}', ' ', 'g')"
SENTENCES = f"regexp_replace({SQUEEZE}, '([.!?]) ', '\\1' || chr(10), 'g')"
BLANK = f"coalesce({strip('text')}, '') = ''"
CMP = f"""cmp AS (
  SELECT doc_id, text,
    CASE WHEN {BLANK} THEN '' ELSE {SQUEEZE} END AS before,
    CASE WHEN {BLANK} THEN 'Please paste some medical text above to see the rewrite.' ELSE {SENTENCES} END AS after
  FROM documents)"""
NUM = "'\\d+(?:[.,]\\d+)*'"


def _ratio(c: str) -> str:
    return f"CAST({words(c)} AS DOUBLE) / {words('text')}"


def _wps(c: str) -> str:
    return f"CASE WHEN {words(c)} > 0 THEN {words(c)} / greatest(CAST(len(regexp_extract_all({c}, '[.!?]+')) AS BIGINT), 1) END"


def _cpw(c: str) -> str:
    return f"CASE WHEN {words(c)} > 0 THEN length(regexp_replace({c}, '{WS_CLASS_SQL}', '', 'g')) / {words(c)} END"


def _unsupported(c: str) -> str:
    return f"CAST(len(list_filter(list_distinct(regexp_extract_all({c}, {NUM})), lambda x: NOT list_contains(regexp_extract_all(text, {NUM}), x))) AS BIGINT)"


SQL.update({
    "guard_input": f"""SELECT doc_id, NOT ({BLANK}) AS needs_rewrite,
  CASE WHEN {BLANK} THEN '' END AS before,
  CASE WHEN {BLANK} THEN 'Please paste some medical text above to see the rewrite.' END AS after
FROM (SELECT doc_id, CASE WHEN doc_id % 9 = 4 THEN ' ' || chr(10) || chr(9) ELSE text END AS text FROM documents)""",
    "batch_rewrite": f"SELECT doc_id, {SQUEEZE} AS rewrite FROM documents WHERE NOT ({BLANK})",
    "resume_rewrite": f"SELECT doc_id, {SQUEEZE} AS rewrite FROM documents WHERE NOT ({BLANK})",
    "compare_rewrites": f"WITH {CMP} SELECT doc_id, before, after FROM cmp",
    "eval_length": f"""WITH {CMP}
SELECT CAST(count(*) AS BIGINT) AS rows, round(avg({_ratio('before')}), 6) AS before_ratio,
  round(avg({_ratio('after')}), 6) AS after_ratio FROM cmp WHERE {words('text')} > 0""",
    "eval_numbers": f"""WITH {CMP}
SELECT doc_id, CAST(len(list_distinct(regexp_extract_all(text, {NUM}))) AS BIGINT) AS source_numbers,
  {_unsupported('before')} AS unsupported_before, {_unsupported('after')} AS unsupported_after FROM cmp""",
    "eval_readability": f"""WITH {CMP}
SELECT doc_id, {_wps('text')} AS source_words_per_sentence, {_cpw('text')} AS source_chars_per_word,
  {_wps('before')} AS before_words_per_sentence, {_cpw('before')} AS before_chars_per_word,
  {_wps('after')} AS after_words_per_sentence, {_cpw('after')} AS after_chars_per_word FROM cmp""",
})

SQL["validate_files"] = SQL["validation_summary"].replace(
    "FROM counts c JOIN txt t ON t.file = c.file", "FROM counts c JOIN txt t ON t.file = c.file WHERE c.file <> 'chat'"
)

_TWO_SPLITS = UNION + """,
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('42|' || pair_key), pair_key) AS rn, count(*) OVER (PARTITION BY source) AS n FROM union_all),
split AS (SELECT *, CASE WHEN rn <= floor(n * CAST(0.1 AS DOUBLE)) THEN 'val' ELSE 'train' END AS split FROM ranked)"""
SQL["report_incremental"] = SQL["validate_files"].replace(f"WITH {SPLIT}, ", f"WITH {_TWO_SPLITS}, ")

SQL["subsample_files"] = f"""WITH {SPLIT},
lines AS (
  SELECT split, CAST(to_json({{'messages': [{{'role': 'system', 'content': {SYS}}}, {{'role': 'user', 'content': abstract}},
    {{'role': 'assistant', 'content': plain_summary}}]}}) AS VARCHAR) AS value FROM split)
SELECT split, value FROM lines
QUALIFY row_number() OVER (PARTITION BY split ORDER BY md5('42|' || value)) <= CASE split WHEN 'train' THEN 300 ELSE 50 END"""

SQL["stream_validate"] = f"""WITH {SPLIT}
SELECT split, CAST(count(*) AS BIGINT) AS records, CAST(0 AS BIGINT) AS invalid FROM split GROUP BY split"""

_JSON3 = f"""CAST(to_json({{'messages': [{{'role': 'system', 'content': {SYS}}}, {{'role': 'user', 'content': abstract}},
    {{'role': 'assistant', 'content': plain_summary}}]}}) AS VARCHAR)"""

SQL["split_order"] = f"""WITH {SPLIT}
SELECT split, row_number() OVER (PARTITION BY split ORDER BY shuffle_hash, pair_key) - 1 AS position, {_JSON3} AS value FROM split"""

SQL["first_record"] = f"""WITH {SPLIT}
SELECT {_JSON3} AS value FROM split WHERE split = 'train' ORDER BY shuffle_hash, pair_key LIMIT 1"""

SQL["report_empty_val"] = f"""WITH {UNION}
SELECT 'train' AS file, CAST(count(*) AS BIGINT) AS records, CAST(0 AS BIGINT) AS invalid, 'all records valid' AS status FROM union_all
UNION ALL SELECT 'val', CAST(0 AS BIGINT), CAST(0 AS BIGINT), 'missing'"""

SQL["publish_versions"] = f"""WITH {UNION}, n AS (SELECT count(*) AS n FROM union_all),
v AS (SELECT version, CAST(floor(n * ratio) AS BIGINT) AS val, n FROM n, (VALUES (1, CAST(0.1 AS DOUBLE)), (2, CAST(0.2 AS DOUBLE))) r(version, ratio)),
s AS (SELECT version, 'val' AS split, val AS records FROM v UNION ALL SELECT version, 'train', n - val FROM v)
SELECT CAST(version AS BIGINT) AS version, split, CAST(records AS BIGINT) AS records, CAST(3 * records AS BIGINT) AS messages FROM s WHERE records > 0"""

SQL["file_sources"] = f"""WITH {PAIRS_CONV}, {PAIRS_DOC},
f AS (SELECT conv_id % 3 AS o, CASE WHEN conv_id % 3 = 1 THEN turn % 4 ELSE 0 END AS p, conv_id, turn,
        {strip('query')} AS abstract, {strip('answer')} AS plain_summary FROM pairs_conv WHERE conv_id % 3 < 2),
d AS (SELECT {strip('Source')} AS abstract, {strip('Target')} AS plain_summary FROM pairs_doc)
SELECT * FROM (SELECT 'files' AS source, abstract, plain_summary FROM f
  WHERE length(abstract) > 50 AND length(plain_summary) > 50
  QUALIFY row_number() OVER (ORDER BY o, p, conv_id, turn) <= 120)
UNION ALL SELECT 'whole', abstract, plain_summary FROM f WHERE length(abstract) > 50 AND length(plain_summary) > 50
UNION ALL SELECT 'array', abstract, plain_summary FROM d WHERE length(abstract) > 50 AND length(plain_summary) > 50"""

SQL["mixed_schemas"] = f"""WITH {PAIRS_CONV}
SELECT CASE WHEN conv_id % 5 = 2 THEN CAST(conv_id * 1000000 + turn + 10000 AS VARCHAR) ELSE {strip('query')} END AS abstract, {strip('answer')} AS plain_summary
FROM pairs_conv WHERE conv_id % 5 IN (1, 2, 3) AND (conv_id % 5 = 2 OR length({strip('query')}) > 4) AND length({strip('answer')}) > 4"""

SQL["json_array_split"] = "SELECT doc_id AS id, text, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents"

_WRONG = "unexpected role order: [''system'', ''assistant'', ''user'']"
SQL["validate_hostile"] = f"""WITH b AS (SELECT doc_id, coalesce({strip('text')}, '') = '' AS blank FROM documents),
p AS (SELECT doc_id, CASE
    WHEN doc_id % 5 = 3 THEN ['missing ''messages'' key']
    WHEN doc_id % 5 = 4 THEN list_concat(['{_WRONG}'], CASE WHEN blank THEN ['empty content for role ''assistant''', 'empty content for role ''user'''] ELSE []::VARCHAR[] END)
    ELSE list_concat(CASE WHEN blank OR doc_id % 5 = 1 THEN ['empty content for role ''user'''] ELSE []::VARCHAR[] END,
                     CASE WHEN blank OR doc_id % 5 = 2 THEN ['empty content for role ''assistant'''] ELSE []::VARCHAR[] END) END AS problems FROM b)
SELECT doc_id, CAST(len(problems) AS BIGINT) AS n_problems, array_to_string(problems, ', ') AS problems FROM p"""
