"""DuckDB SQL for the queries that SQL can express, written from their contracts.

Not expressible, and tested against brute force instead: extraction (op1), random
rounding (op3), learned scores (op4), components of hashed candidates (op8, op11)
and tokenizer output (op10).
"""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _starts(width: int) -> str:
    return f"unnest(generate_series(1, len(ws) - {width - 1}))"


QUALITY = rf"""WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i+7], ' ') AS k FROM (SELECT doc_id, ws, {_starts(8)} AS i FROM w)),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + 7)) AS p FROM twice) GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
    len(list_filter(generate_series(2, len(ws)), lambda i: ws[i] = ws[i - 1])) AS n_stutter
  FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines OR 10 * n_stutter > 3 * n_words
       OR word_chars < 2 * n_words OR word_chars > 25 * n_words) AS kept FROM b"""

LINES = f"""WITH l AS (
  SELECT doc_id, line, i, translate(trim(line, {SPACE}), '{UPPER}', '{LOWER}') AS key
  FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
hot AS (SELECT key, max(doc_id) AS last_doc FROM l WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT l.doc_id, line, i, coalesce(l.doc_id <> hot.last_doc, false) AS gone FROM l LEFT JOIN hot ON hot.key = l.key)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count_if(gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM j GROUP BY doc_id"""

_ITEM_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
LEAKS = f"""WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, ws, least(len(ws), 10) AS span
  FROM (SELECT item_id, {_ITEM_WORDS} AS ws FROM benchmark WHERE item_id IS NOT NULL) WHERE len(ws) > 0),
bw AS (SELECT DISTINCT item_id, span, array_to_string(ws[i:i+span-1], ' ') AS k
  FROM (SELECT *, unnest(generate_series(1, len(ws) - span + 1)) AS i FROM b)),
d AS (SELECT doc_id, {_ITEM_WORDS} AS ws FROM documents),
dw AS (SELECT doc_id, span, i, array_to_string(ws[i:i+span-1], ' ') AS k
  FROM (SELECT doc_id, ws, span, unnest(generate_series(1, len(ws) - span + 1)) AS i FROM d, (SELECT DISTINCT span FROM bw))),
h AS (SELECT doc_id, dw.span, i, item_id FROM dw JOIN bw ON bw.span = dw.span AND bw.k = dw.k),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + span - 1)) AS p FROM h) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(its.n, 0) AS BIGINT) AS n_items, sha256(coalesce(its.ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id"""

REPEATS = f"""WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i+34], ' ') AS k FROM (SELECT doc_id, ws, {_starts(35)} AS i FROM w)),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY k) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS p FROM twice),
one AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
kept AS (SELECT one.doc_id, string_agg(word, ' ' ORDER BY one.p) FILTER (gone.p IS NULL) AS k, count(gone.p) AS n
  FROM one LEFT JOIN gone ON gone.doc_id = one.doc_id AND gone.p = one.p GROUP BY one.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.k, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id"""

_BASE32 = " || ".join(
    f"substr('{UPPER}234567', CAST(((CAST('0x' || substr(hex, {5 * g + 1}, 5) AS BIGINT) >> {s}) & 31) + 1 AS BIGINT), 1)" for g in range(8) for s in (15, 10, 5, 0)
)
ARCHIVES = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS lead FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> lead THEN lead END AS refers_to FROM g"""


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        for _ in range(8):
            i = i >> 1 ^ (0xEDB88320 if i & 1 else 0)
        out.append(i)
    return out


_CRC_TABLE = f"crc_table AS (SELECT {_crc_table()}::BIGINT[] AS tbl)"


def _crc(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes; ``tbl`` is in scope."""
    byte = f"list_transform(generate_series(1, strlen({text})), lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i - 1, 2) AS BIGINT))"
    return f"xor(list_reduce({byte}, lambda r, b: xor(tbl[(xor(r, b) & 255) + 1], r >> 8), CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"


_FEATURES = "list_concat(ws, list_transform(generate_series(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1]))"
RESAMPLE = f"""WITH {_CRC_TABLE},
d AS (SELECT doc_id, row_number() OVER () AS r, {_ITEM_WORDS} AS ws FROM documents),
f AS (SELECT r, unnest({_FEATURES}) AS x FROM d),
bf AS (SELECT unnest({_FEATURES}) AS x FROM (SELECT {_ITEM_WORDS} AS ws FROM benchmark)),
x AS (SELECT x, {_crc("x")} % 10000 AS bucket FROM (SELECT x FROM f UNION SELECT x FROM bf), crc_table),
s AS (SELECT bucket, count(*) AS s FROM f JOIN x USING (x) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bf JOIN x USING (x) GROUP BY bucket),
n AS (SELECT CAST((SELECT count(*) FROM f) AS DOUBLE) AS s_all, CAST((SELECT count(*) FROM bf) AS DOUBLE) AS t_all),
g AS (SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t, 0) AS DOUBLE) + 1) * (s_all + 10000) / ((CAST(s AS DOUBLE) + 1) * (t_all + 10000)))) AS BIGINT) AS gain
  FROM s LEFT JOIN t USING (bucket), n),
w AS (SELECT r, count(*) AS n_features, CAST(floor(CAST(sum(gain) AS DOUBLE) / count(*)) AS BIGINT) AS weight FROM f JOIN x USING (x) JOIN g USING (bucket) GROUP BY r),
h AS (SELECT d.r, doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN w ON w.r = d.r),
sc AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((CAST(h AS DOUBLE) + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score FROM h),
o AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS k, count(*) OVER () AS n FROM sc WHERE n_words >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CAST(CASE WHEN k <= 25 * n // 100 THEN k END AS BIGINT) AS rank FROM sc LEFT JOIN o ON o.r = sc.r"""

_LEVELS = 8  # of a tree of 8^8 leaves


def _field(value: str) -> str:
    return f"coalesce(CAST(strlen(CAST({value} AS VARCHAR)) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, bottom: str) -> list[str]:
    """CTEs of a tree's runs by level: name0r (tree, up, run, size) and the nodes
    above, name1, name2 ... (tree, i, h, size); a lone node has no run."""
    out = [f"{name}0 AS ({bottom})"]
    for k in range(_LEVELS):
        out.append(f"{name}{k}r AS (SELECT tree, i // 8 AS up, list(h ORDER BY i) AS run, size FROM {name}{k} WHERE size > 1 GROUP BY tree, i // 8, size)")
        out.append(f"{name}{k + 1} AS (SELECT tree, up AS i, sha256(array_to_string(run, '')) AS h, (size + 7) // 8 AS size FROM {name}{k}r)")
    return out


def _tops(name: str) -> str:
    return " UNION ALL ".join(f"SELECT tree, h FROM {name}{k} WHERE size = 1" for k in range(_LEVELS + 1))


def _climb(name: str, start: str, place: str, tree: str) -> list[str]:
    """CTEs that fold each row's digest ``f`` with its siblings, ``p`` their list."""
    out, at = [], start
    for k in range(_LEVELS):
        slot = f"CAST(({place} // {8**k}) % 8 AS BIGINT) + 1"
        out.append(
            f"{name}c{k} AS (SELECT a.* EXCLUDE (f, p), CASE WHEN run IS NULL THEN f ELSE "
            f"sha256(array_to_string(list_concat(run[1:{slot} - 1], [f], run[{slot} + 1:]), '')) END AS f, "
            f"CASE WHEN run IS NULL THEN p ELSE list_concat(p, run[1:{slot} - 1], run[{slot} + 1:]) END AS p "
            f"FROM {at} a LEFT JOIN {name}{k}r b ON b.tree = a.{tree} AND b.up = a.{place} // {8 ** (k + 1)})"
        )
        at = f"{name}c{k}"
    return out


MERKLE = ",\n".join(
    [
        f"WITH {_CRC_TABLE}",
        f"""l AS (SELECT doc_id, lang, {_leaf("text")} AS leaf, coalesce(CASE WHEN {_crc("CAST(doc_id AS VARCHAR)")} % 3 = 0
    THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END, {_leaf("text")}) AS shown FROM documents, crc_table)""",
        "langs AS (SELECT lang, count(*) AS n, row_number() OVER (ORDER BY CASE WHEN lang IS NULL THEN 0 ELSE 1 END, encode(lang)) - 1 AS li, count(*) OVER () AS n_langs FROM l GROUP BY lang)",
        "pl AS (SELECT doc_id, leaf, shown, li, n, n_langs, row_number() OVER (PARTITION BY li ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM l JOIN langs ON langs.lang IS NOT DISTINCT FROM l.lang)",
        *_tree("a", "SELECT li AS tree, i, leaf AS h, n AS size FROM pl"),
        f"sub AS ({_tops('a')})",
        *_tree("t", "SELECT 0 AS tree, sub.tree AS i, h, n_langs AS size FROM sub JOIN langs ON li = sub.tree"),
        f"root AS ({_tops('t')})",
        "c AS (SELECT *, shown AS f, CAST([] AS VARCHAR[]) AS p, 0 AS top FROM pl)",
        *_climb("a", "c", "i", "li"),
        *_climb("t", f"ac{_LEVELS - 1}", "li", "top"),
    ]
) + f"""
SELECT doc_id, leaf, sub.h AS subroot, root.h AS root, sha256(array_to_string(p, '')) AS proof_sha256, f AS folded_root, f = root.h AS verified
FROM tc{_LEVELS - 1} c JOIN sub ON sub.tree = c.li JOIN root ON root.tree = c.top"""

SQL: dict[str, str] = {
    "op2_quality_ledger": QUALITY,
    "op5_line_dedup": LINES,
    "op6_decontaminate": LEAKS,
    "op7_substring_dedup": REPEATS,
    "op9_warc": ARCHIVES,
    "op12_importance_resample": RESAMPLE,
    "op13_merkle_manifest": MERKLE,
}
