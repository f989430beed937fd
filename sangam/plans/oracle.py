"""DuckDB SQL for the registered queries, over the given tables as views."""

from __future__ import annotations

WS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}]"
)
NOT_WS = WS.replace("[", "[^", 1)
URL = rf"(?i)(https?://{NOT_WS}+|www\.{NOT_WS}+|t\.co/{NOT_WS}+)"
MENTION = r"@[\p{L}\p{N}_]+"
NO_URL = f"regexp_replace({{0}}, '{URL}', '', 'g')"
NO_MENTION = f"regexp_replace({{0}}, '{MENTION}', '', 'g')"
ONE_BLANK = f"trim(regexp_replace({{0}}, '{WS}+', ' ', 'g'), ' ')"


def cleaned(col: str) -> str:
    for step in (NO_URL, NO_MENTION, ONE_BLANK):
        col = step.replace("{0}", col)
    return col


def tokens(col: str) -> str:
    return f"list_filter(regexp_split_to_array({col}, '{WS}+'), lambda x: x <> '')"


def tags(items: str) -> str:
    return f"list_transform({items}, lambda x: CASE WHEN length(x) % 2 = 0 THEN 'lang1' ELSE 'lang2' END)"


def text_of(items: str, sep: str = " ") -> str:
    return f"coalesce(array_to_string({items}, '{sep}'), '')"


def count_of(col: str, chars: str) -> str:
    return f"length(regexp_replace({col}, '[^{chars}]', '', 'g'))"


DEVA, LATIN = r"\x{900}-\x{97f}", "A-Za-z"


def label(col: str) -> str:
    return (
        f"CASE WHEN {count_of(col, DEVA)} + {count_of(col, LATIN)} = 0 THEN 'unknown' "
        f"WHEN {count_of(col, DEVA)} = 0 THEN 'roman_only' "
        f"WHEN {count_of(col, LATIN)} = 0 THEN 'devanagari_only' ELSE 'mixed_script' END"
    )


def pct(part: str, total: str) -> str:
    return f"CASE WHEN {total} > 0 THEN {part} / {total} * 100 ELSE 0.0::DOUBLE END"


def round1_exact(value: str) -> str:
    """Printing with one decimal rounds the exact value of a double."""
    return f"printf('%.1f', {value})::DOUBLE"


def round1(value: str) -> str:
    return f"round_even(({value}) * 10, 0) / 10"


RAW = r"""
line AS (
  SELECT doc_id, lang AS source,
    CASE WHEN doc_id % 10 <= 5 THEN 'train' WHEN doc_id % 10 = 6 THEN 'validation'
         WHEN doc_id % 10 = 7 THEN 'test' WHEN doc_id % 10 = 8 THEN '' END AS split,
    unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS line_no
  FROM documents),
raw AS (
  SELECT doc_id, line_no::BIGINT AS line_no, source, split,
    CASE WHEN (doc_id + line_no) % 19 = 0 THEN '<3 <3 <3'
         WHEN (doc_id + line_no) % 17 = 0 THEN regexp_replace(line, '[A-Za-z]', 'क', 'g')
         WHEN (doc_id + line_no) % 13 = 0 THEN translate(line, 'aeiou', 'अएइउओ')
         WHEN (doc_id + line_no) % 11 = 0 THEN '@user_' || (doc_id % 50) || ' ' || line
         WHEN (doc_id + line_no) % 7 = 0 THEN line || ' https://ex.org/p/' || doc_id || ' ok'
         ELSE line END AS text
  FROM line)"""

CLEAN = f"""{RAW},
clean AS (SELECT * REPLACE ({cleaned('text')} AS text), text AS before FROM raw),
firsts AS (
  SELECT * FROM clean
  QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id, line_no) = 1),
kept AS (
  SELECT row_number() OVER (ORDER BY doc_id, line_no) - 1 AS sentence_id, *,
    len({tokens('text')}) AS n_tokens, {label('text')} AS script_type
  FROM firsts WHERE len({tokens('text')}) BETWEEN 3 AND 100)"""

FINAL = f"""{CLEAN},
open_rows AS (
  SELECT sentence_id, source || '__' || script_type AS stratum,
    row_number() OVER (PARTITION BY source || '__' || script_type
                       ORDER BY md5('42|' || sentence_id), sentence_id) AS r,
    count(*) OVER (PARTITION BY source || '__' || script_type) AS n
  FROM kept WHERE coalesce(split, '') = ''),
usable AS (SELECT count(*) AS usable FROM open_rows WHERE n >= 3),
assigned AS (
  SELECT sentence_id,
    CASE WHEN n < 3 OR usable < 10 OR r <= (8 * n + 5) // 10 THEN 'train'
         WHEN r <= (8 * n + 5) // 10 + (n - (8 * n + 5) // 10 + 1) // 2 THEN 'validation'
         ELSE 'test' END AS new_split
  FROM open_rows CROSS JOIN usable),
final AS (
  SELECT kept.* REPLACE (coalesce(new_split, split) AS split)
  FROM kept LEFT JOIN assigned USING (sentence_id))"""


#: The same with sizes over all strata, apportioned by largest remainders; ``rows`` are those without a split.
EXACT = """,
stratum_rows AS (
  SELECT sentence_id, source || '__' || script_type AS stratum,
    row_number() OVER (PARTITION BY source || '__' || script_type ORDER BY md5('42|' || sentence_id), sentence_id) AS r
  FROM {rows}),
stratum AS (SELECT stratum, count(*) AS n FROM stratum_rows GROUP BY stratum),
usable_stratum AS (SELECT *, sum(n) OVER () AS whole FROM stratum WHERE n >= 3),
train_share AS (
  SELECT *, 8 * n // 10 + (row_number() OVER (ORDER BY 8 * n % 10 DESC, stratum)
    <= (8 * whole + 5) // 10 - sum(8 * n // 10) OVER ())::BIGINT AS n_train FROM usable_stratum),
held_share AS (
  SELECT *, (n - n_train) // 2 + (row_number() OVER (ORDER BY (n - n_train) % 2 DESC, stratum)
    <= (whole - (8 * whole + 5) // 10 + 1) // 2 - sum((n - n_train) // 2) OVER ())::BIGINT AS n_validation FROM train_share),
exact AS (
  SELECT sentence_id, CASE WHEN n_train IS NULL OR whole < 10 OR r <= n_train THEN 'train'
    WHEN r <= n_train + n_validation THEN 'validation' ELSE 'test' END AS exact_split
  FROM stratum_rows LEFT JOIN held_share USING (stratum))"""

#: Tokens after cleaning, with the tag of the token that each came from: cleaning one by one.
ALIGNED = f"""{CLEAN},
token AS (
  SELECT sentence_id, unnest({tokens('before')}) AS word, unnest(range(len({tokens('before')}))) AS place FROM kept),
piece AS (
  SELECT sentence_id, place, word, unnest({tokens(cleaned('word'))}) AS item,
    unnest(range(len({tokens(cleaned('word'))}))) AS part FROM token),
aligned AS (
  SELECT sentence_id, string_agg(item, '|' ORDER BY place, part) AS tokens,
    string_agg(CASE WHEN length(word) % 2 = 0 THEN 'lang1' ELSE 'lang2' END, ' ' ORDER BY place, part) AS lid_tags
  FROM piece GROUP BY sentence_id)"""


def over(cte: str, body: str) -> str:
    return f"WITH {cte.strip()}\n{body}"


def distribution(cte: str, table: str, column: str) -> str:
    return over(
        cte,
        f"""SELECT {column}, n, pct, repeat('#', floor(pct / 2)::INTEGER) AS bar FROM (
  SELECT {column}, count(*) AS n, count(*) / sum(count(*)) OVER () * 100 AS pct
  FROM {table} GROUP BY {column}) WHERE {column} IS NOT NULL""",
    )


def summary(cte: str, table: str) -> str:
    avg = round1("sum(n_tokens)::DOUBLE / count(*)")
    return over(
        cte,
        f"""SELECT source, split, count(*) AS sentence_count, {avg} AS avg_length
FROM {table} WHERE split IS NOT NULL GROUP BY source, split
UNION ALL
SELECT source, 'TOTAL', count(*), {avg} FROM {table} GROUP BY source""",
    )


REPORT = """SELECT rows_before, dropped_duplicates, dropped_length, rows_after,
  dropped_duplicates + dropped_length AS total_dropped,
  dropped_duplicates / rows_before * 100 AS pct_duplicates,
  dropped_length / rows_before * 100 AS pct_length,
  (dropped_duplicates + dropped_length) / rows_before * 100 AS pct_dropped
FROM (SELECT (SELECT count(*) FROM raw) AS rows_before,
  (SELECT count(*) FROM raw) - (SELECT count(*) FROM firsts) AS dropped_duplicates,
  (SELECT count(*) FROM firsts) - (SELECT count(*) FROM kept) AS dropped_length,
  (SELECT count(*) FROM kept) AS rows_after)"""

SENTENCES = f"""
sentences AS (
  SELECT row_number() OVER (ORDER BY {{order}}) - 1 AS sentence_id, *, {tokens('text')} AS items
  FROM raw WHERE len({tokens('text')}) > 0)"""

# Position of each part of the corpus in the manifests of the file queries.
PART = (
    "CASE coalesce(split, '') WHEN 'train' THEN 0 WHEN 'validation' THEN 1 "
    "WHEN 'test' THEN 2 ELSE 3 END"
)
#: Tokens with hard characters, printed as arrays of strings are, and parsed again.
CSV_ROWS = rf"""{RAW},
hard AS (
  SELECT *, list_transform({tokens('text')}, lambda t, i:
    CASE WHEN (doc_id + line_no + i - 1) % 23 = 0 THEN t || '''s'
      WHEN (doc_id + line_no + i - 1) % 29 = 0 THEN '"' || t || '"'
      WHEN (doc_id + line_no + i - 1) % 31 = 0 THEN '''' || t || '"'
      WHEN (doc_id + line_no + i - 1) % 37 = 0 THEN t || '\' || t ELSE t END) AS words
  FROM raw),
printed AS (
  SELECT *, '[' || array_to_string(list_transform(words, lambda t, i:
    CASE WHEN i = 1 THEN '' WHEN i % 2 = 1 THEN chr(10) || ' ' ELSE ' ' END ||
    CASE WHEN contains(t, '''') AND NOT contains(t, '"') THEN '"' || replace(t, '\', '\\') || '"'
      ELSE '''' || replace(replace(t, '\', '\\'), '''', '\''') || '''' END), '') || ']' AS cell
  FROM hard),
cells AS (
  SELECT *, regexp_extract_all(cell, '''((?:[^''\\]|\\.)*)''', 1) AS items,
    list_transform(regexp_extract_all(cell, '''(?:[^''\\]|\\.)*''|"(?:[^"\\]|\\.)*"'),
      lambda q: substring(q, 2, length(q) - 2)) AS strict_items
  FROM printed)"""
CSV_FILES = over(
    CSV_ROWS,
    f"""SELECT row_number() OVER (ORDER BY {PART}, doc_id, line_no) - 1 AS sentence_id,
  nullif(split, '') AS split, {text_of('items')} AS text, {text_of('items', '|')} AS tokens,
  {text_of(tags('words'))} AS lid_tags FROM cells""",
)

TASKS = """
task_line AS (
  SELECT lang AS task, lang || '/' || source AS file, source AS name, doc_id,
    CASE WHEN regexp_extract(source, '(\\d+)$', 1)::INTEGER % 5 = 0 AND lang <> 'en'
         THEN text ELSE doc_id::VARCHAR END AS value
  FROM documents),
kinds AS (
  SELECT task, file, name,
    coalesce(bool_and(regexp_full_match(trim(value), '[0-9]+')) FILTER (trim(value) <> ''), false)
      AS id_only
  FROM task_line GROUP BY task, file, name),
verdicts AS (
  SELECT task, count(*) AS n_files, count(*) FILTER (id_only) AS n_id_files,
    count(*) FILTER (NOT id_only) AS n_text_files, min(file) FILTER (id_only) AS first_id_file,
    CASE WHEN bool_or(NOT id_only) THEN 'has_text' ELSE 'id_only' END AS status
  FROM kinds GROUP BY task
  UNION ALL SELECT 'absent', 0, 0, 0, NULL, 'missing')"""

TASK_FOLDERS = """SELECT 'task=' || name AS task, coalesce(n_files, 0) + hidden * 2 AS n_files,
  coalesce(n_id_files, 0) + hidden AS n_id_files, coalesce(n_text_files, 0) + hidden AS n_text_files,
  CASE WHEN name = 'void' THEN 'empty' WHEN n_files IS NULL AND hidden = 0 THEN 'missing'
    WHEN n_text_files > 0 OR hidden = 1 THEN 'has_text' ELSE 'id_only' END AS status
FROM (SELECT unnest(['en', 'de', 'es', 'fr', 'it', 'pt', 'void', 'gone']) AS name)
LEFT JOIN verdicts ON task = name, LATERAL (SELECT (name = 'fr')::BIGINT AS hidden)"""

MANIFEST = f"""
SELECT rank, source, split, kind, required, present, n,
  CASE WHEN present AND n > 0 THEN 'loaded' WHEN present THEN 'empty' WHEN required THEN 'failed' ELSE 'missing' END AS status
FROM (
  SELECT 0 AS rank, 'tagged' AS source, 'train' AS split, 'conll' AS kind, true AS required, true AS present,
    (SELECT count(*) FROM sentences WHERE split = 'train') AS n
  UNION ALL SELECT 1, 'tagged', 'other', 'conll', true, true,
    (SELECT count(*) FROM sentences WHERE coalesce(split, '') IN ('', 'validation'))
  UNION ALL SELECT 2, 'tagged', 'gone', 'conll', false, false, 0
  UNION ALL SELECT 3, 'printed', 'all', 'array_csv', false, true, (SELECT count(*) FROM raw)
  UNION ALL SELECT 4, 'printed', 'test', 'array_csv', false, true, (SELECT count(*) FROM raw WHERE split = 'test')
  UNION ALL SELECT 5, 'printed', 'gone', 'array_csv', false, false, 0
  UNION ALL SELECT 6, 'tagged', 'needed', 'conll', true, false, 0)"""

SHARES = """shares AS (
  SELECT count(*) FILTER (split = 'train') / count(*) * 100 AS train,
    count(*) FILTER (split = 'validation') / count(*) * 100 AS validation,
    count(*) FILTER (split = 'test') / count(*) * 100 AS test FROM final),
gates AS (
  SELECT 'train_min_pct' AS "check", train AS observed, 60.0::DOUBLE AS threshold,
    train < 60 AS bad FROM shares
  UNION ALL SELECT 'train_max_pct', train, 95, train > 95 FROM shares
  UNION ALL SELECT 'validation_min_pct', validation, 3, validation < 3 FROM shares
  UNION ALL SELECT 'test_min_pct', test, 3, test < 3 FROM shares)"""

FINAL_VIEW = over(
    FINAL,
    f"""SELECT sentence_id, source, split, text, {text_of(tokens('text'))} AS tokens,
  {text_of(tags(tokens('before')))} AS lid_tags, script_type FROM final""",
)


def sql() -> dict[str, str]:
    total = f"({count_of('text', DEVA)} + {count_of('text', LATIN)})"
    out = {
        "strip_urls": over(RAW, f"SELECT doc_id, line_no, {NO_URL.replace('{0}', 'text')} AS text FROM raw"),
        "strip_urls_html": f"SELECT page_id, {NO_URL.replace('{0}', 'url')} AS url, "
        f"{NO_URL.replace('{0}', 'html')} AS html FROM pages",
        "strip_mentions": over(
            RAW, f"SELECT doc_id, line_no, {NO_MENTION.replace('{0}', 'text')} AS text FROM raw"
        ),
        "collapse_ws": f"SELECT doc_id, {ONE_BLANK.replace('{0}', 'text')} AS text FROM documents",
        "clean_text": over(RAW, f"SELECT doc_id, line_no, {cleaned('text')} AS text FROM raw"),
        "clean_text_html": f"SELECT page_id, {cleaned('html')} AS html FROM pages",
        "retokenize": f"SELECT doc_id, {text_of(tokens('text'), '|')} AS tokens, "
        f"len({tokens('text')}) AS token_count FROM documents",
        "parse_array_repr": over(
            CSV_ROWS,
            f"SELECT doc_id, line_no, {text_of('items', '|')} AS items, len(items) AS n FROM cells",
        ),
        "parse_array_repr_strict": over(
            CSV_ROWS,
            f"""SELECT doc_id, line_no, {text_of('strict_items', '|')} AS items, len(strict_items) AS n
FROM cells""",
        ),
        "array_to_string": over(
            RAW, f"SELECT doc_id, line_no, {text_of(tokens('text'), '|')} AS items FROM raw"
        ),
        "script_counts": over(
            RAW,
            f"""SELECT doc_id, line_no, {count_of('text', DEVA)} AS devanagari,
  {count_of('text', LATIN)} AS latin, {total} AS total_alpha,
  {round1_exact(pct(count_of('text', DEVA), total))} AS deva_pct,
  {round1_exact(pct(count_of('text', LATIN), total))} AS latin_pct FROM raw""",
        ),
        "script_label": over(RAW, f"SELECT doc_id, line_no, {label('text')} AS script_type FROM raw"),
        "previews": over(
            RAW,
            rf"""SELECT doc_id, line_no, substring(text, 1, 80) AS text_80,
  substring(regexp_replace(text, '[^\x00-\x7f]', '?', 'g'), 1, 70) AS ascii_70,
  {text_of(tokens('text') + '[1:10]', '|')} AS tokens_10 FROM raw""",
        ),
        "unify_ids": over(
            RAW,
            f"""SELECT row_number() OVER (ORDER BY frame, a, b) - 1 AS sentence_id, source, split, text,
  {text_of(tokens('text'))} AS tokens, {text_of(tags(tokens('text')))} AS lid_tags
FROM (SELECT 0 AS frame, doc_id AS a, line_no AS b, source, split, text FROM raw
      UNION ALL
      SELECT 1, conv_id, turn, 'chat_' || role, NULL, text FROM conversations)""",
        ),
        "dedup_first": over(CLEAN, "SELECT doc_id, line_no, source, split, text FROM firsts"),
        "length_filter": over(
            CLEAN,
            f"SELECT doc_id, line_no, text FROM clean WHERE len({tokens('text')}) BETWEEN 3 AND 100",
        ),
        "cleaned_corpus": over(
            CLEAN,
            f"""SELECT sentence_id, source, split, text, {text_of(tokens('text'))} AS tokens,
  {text_of(tags(tokens('before')))} AS lid_tags FROM kept""",
        ),
        "cleaning_report": over(CLEAN, REPORT),
        "aligned_tags": over(ALIGNED, "SELECT sentence_id, text, tokens, lid_tags FROM kept JOIN aligned USING (sentence_id)"),
        "misaligned_by_source": over(
            CLEAN,
            f"""SELECT mode, source, count(*) AS n,
  count(*) FILTER (mode = 'as_read' AND len({tokens('before')}) <> len({tokens('text')})) AS n_misaligned
FROM clean, (VALUES ('as_read'), ('aligned')) v(mode) GROUP BY mode, source""",
        ),
        "dropped_by_source": over(
            CLEAN,
            """SELECT source, raw_count, coalesce(clean_count, 0) AS clean_count,
  raw_count - coalesce(clean_count, 0) AS dropped
FROM (SELECT source, count(*) AS raw_count FROM raw GROUP BY source)
LEFT JOIN (SELECT source, count(*) AS clean_count FROM kept GROUP BY source) USING (source)""",
        ),
        "length_stats": over(
            CLEAN,
            """SELECT min(n_tokens) AS min_length, max(n_tokens) AS max_length,
  sum(n_tokens)::DOUBLE / count(*) AS mean_length,
  median(n_tokens)::DOUBLE AS median_length FROM kept""",
        ),
        "length_sketch": over(
            CLEAN,
            """SELECT source, coalesce(split, '') AS split, count(*) AS n, true AS near FROM kept GROUP BY source, coalesce(split, '')
UNION ALL SELECT source, 'TOTAL', count(*), true FROM kept GROUP BY source
UNION ALL SELECT 'TOTAL', 'TOTAL', count(*), true FROM kept""",
        ),
        "ids_unique": over(RAW, "SELECT count(*) AS n_rows, true AS ids_unique FROM raw"),
        "counts_by_source": over(RAW, "SELECT source, count(*) AS n FROM raw GROUP BY source"),
        "counts_by_split": distribution(RAW, "raw", "split"),
        "script_distribution": distribution(CLEAN, "kept", "script_type"),
        "source_by_script": over(
            CLEAN, "SELECT source, script_type, count(*) AS n FROM kept GROUP BY ALL"
        ),
        "source_by_split_pct": over(
            FINAL,
            """SELECT s.source, v.split, count(f.sentence_id) AS n, count(f.sentence_id) / any_value(total) * 100 AS pct
FROM (SELECT source, count(*) AS total FROM final GROUP BY source) s
CROSS JOIN (VALUES ('train'), ('validation'), ('test')) v(split)
LEFT JOIN final f ON f.source = s.source AND f.split = v.split GROUP BY s.source, v.split""",
        ),
        "script_by_split": over(
            FINAL,
            """SELECT script_type, count(*) FILTER (split = 'train') AS train,
  count(*) FILTER (split = 'validation') AS validation, count(*) FILTER (split = 'test') AS test
FROM final GROUP BY script_type""",
        ),
        "load_counts_rollup": over(
            RAW,
            """SELECT source, split, count(*) AS n, grouping_id(source, split)::BIGINT AS level
FROM raw GROUP BY ROLLUP (source, split)""",
        ),
        "summary": summary(CLEAN, "kept"),
        "script_pivot": over(
            CLEAN,
            """SELECT source, count(*) FILTER (script_type = 'roman_only') AS roman_only,
  count(*) FILTER (script_type = 'mixed_script') AS mixed_script,
  count(*) FILTER (script_type = 'devanagari_only') AS devanagari_only,
  count(*) FILTER (script_type = 'unknown') AS unknown FROM kept GROUP BY source""",
        ),
        "tag_vocab": over(
            RAW, f"SELECT DISTINCT unnest({tags(tokens('text'))}) AS tag FROM raw"
        ),
        "distinct_sources": "SELECT DISTINCT source FROM documents",
        "id_null_checks": over(
            RAW,
            """SELECT count(*) AS n_rows, count(DISTINCT (doc_id, line_no)) AS n_ids,
  count(*) FILTER (text IS NULL) AS null_texts,
  count(*) = count(DISTINCT (doc_id, line_no)) AS ids_unique FROM raw""",
        ),
        "examples_per_script": over(
            CLEAN,
            rf"""SELECT script_type, rn, sentence_id,
  substring(regexp_replace(text, '[^\x00-\x7f]', '?', 'g'), 1, 70) AS preview,
  {round1_exact(pct(count_of('text', DEVA), total))} AS deva_pct,
  {round1_exact(pct(count_of('text', LATIN), total))} AS latin_pct
FROM (SELECT *, row_number() OVER (PARTITION BY script_type ORDER BY sentence_id) AS rn FROM kept)
WHERE rn <= 3""",
        ),
        "report_lines": over(
            CLEAN,
            f"""SELECT script_type, format('{{:,}}', n) AS n,
  printf('%.1f', {round1('pct')}) || '%' AS pct, repeat('#', floor(pct / 2)::INTEGER) AS bar
FROM (SELECT script_type, count(*) AS n, count(*) / sum(count(*)) OVER () * 100 AS pct
      FROM kept GROUP BY script_type)""",
        ),
        "conll_sentences": over(
            RAW + "," + SENTENCES.replace("{order}", "source, doc_id, line_no"),
            f"""SELECT sentence_id, source, {text_of('items')} AS text, {text_of('items', '|')} AS tokens,
  {text_of(tags('items'))} AS lid_tags FROM sentences""",
        ),
        "conll_files": over(
            RAW + "," + SENTENCES.replace("{order}", f"{PART}, doc_id, line_no"),
            f"""SELECT sentence_id, nullif(split, '') AS split, {text_of('items')} AS text,
  {text_of('items', '|')} AS tokens, {text_of(tags('items'))} AS lid_tags FROM sentences""",
        ),
        "array_csv_rows": over(
            CSV_ROWS,
            f"""SELECT doc_id, line_no, {text_of('items')} AS text, len(items) AS n_tokens,
  {text_of(tags('words'))} AS lid_tags FROM cells""",
        ),
        "array_csv_files": CSV_FILES,
        "array_csv_split_files": CSV_FILES,
        "manifest_loads": over(RAW + "," + SENTENCES.replace("{order}", "doc_id, line_no"), MANIFEST),
        "task_folders": over(TASKS, TASK_FOLDERS),
        "id_only_files": over(TASKS, "SELECT task, file, name, id_only FROM kinds"),
        "task_verdicts": over(TASKS, "SELECT * FROM verdicts"),
        "task_sample_ids": over(
            TASKS,
            """SELECT task, file, line_no, value FROM (
  SELECT l.task, l.file, trim(l.value) AS value,
    row_number() OVER (PARTITION BY l.task, l.file ORDER BY doc_id) AS line_no
  FROM task_line l JOIN verdicts v ON v.task = l.task AND v.first_id_file = l.file)
WHERE line_no <= 3 AND value <> ''""",
        ),
        "skip_decision": over(
            TASKS,
            """SELECT no_text, tasks_with_text, CASE WHEN no_text THEN 'skip' ELSE 'inspect' END AS decision
FROM (SELECT bool_and(status <> 'has_text') AS no_text,
        count(*) FILTER (status = 'has_text') AS tasks_with_text FROM verdicts)""",
        ),
        "missing_files": """SELECT 'src' || i AS source FROM range(24) t(i)
EXCEPT SELECT source FROM documents""",
        "stratum_sizes": over(
            CLEAN,
            """SELECT source || '__' || script_type AS stratum, count(*) AS n, count(*) < 3 AS rare
FROM kept WHERE coalesce(split, '') = '' GROUP BY ALL""",
        ),
        "assign_splits": over(FINAL, "SELECT sentence_id, source, script_type, split FROM final"),
        "assign_splits_exact": over(
            CLEAN + EXACT.replace("{rows}", "(SELECT * FROM kept WHERE coalesce(split, '') = '')"),
            "SELECT sentence_id, source, script_type, coalesce(exact_split, split) AS split FROM kept LEFT JOIN exact USING (sentence_id)",
        ),
        "split_totals": over(
            CLEAN + EXACT.replace("{rows}", "kept"),
            "SELECT exact_split AS split, count(*) AS n, true AS exact FROM exact GROUP BY exact_split",
        ),
        "split_gate": over(
            f"{FINAL},\n{SHARES}",
            """SELECT "check", observed, threshold,
  CASE WHEN bad THEN 'failed' ELSE 'passed' END AS status FROM gates""",
        ),
        "gate_verdict": over(
            f"{FINAL},\n{SHARES}",
            "SELECT CASE WHEN bool_or(bad) THEN 'failed' ELSE 'passed' END AS status FROM gates",
        ),
        "quality_gates": over(
            f"""{CLEAN},
report AS ({REPORT}),
expected AS (
  SELECT count(*) AS of, count(*) FILTER (source IN (SELECT source FROM raw)) AS n
  FROM (VALUES ('en'), ('de'), ('es'), ('fr'), ('it'), ('pt')) v(source))""",
            """SELECT 'train_rows' AS "check", n::DOUBLE AS observed, 25000.0::DOUBLE AS threshold,
  CASE WHEN n >= 25000 THEN 'passed' ELSE 'warning' END AS status
FROM (SELECT count(*) AS n FROM raw WHERE split = 'train')
UNION ALL SELECT 'sources_loaded', n, of, CASE WHEN n = of THEN 'passed' WHEN n > 0 THEN 'partial' ELSE 'failed' END
  FROM expected
UNION ALL SELECT 'empty_sources', of - n, 0, CASE WHEN n = of THEN 'passed' ELSE 'failed' END FROM expected
UNION ALL SELECT 'repeated_ids', n, 0, CASE WHEN n = 0 THEN 'passed' ELSE 'failed' END
  FROM (SELECT count(*) - count(DISTINCT (doc_id, line_no)) AS n FROM raw)
UNION ALL SELECT 'null_texts', n, 0, CASE WHEN n = 0 THEN 'passed' ELSE 'failed' END
  FROM (SELECT count(*) FILTER (text IS NULL) AS n FROM raw)
UNION ALL SELECT 'pct_dropped', pct_dropped, 50,
  CASE WHEN pct_dropped > 90 THEN 'failed' WHEN pct_dropped > 50 THEN 'warning' ELSE 'passed' END
  FROM report
UNION ALL SELECT 'missing_script_types', n, 0, CASE WHEN n = 0 THEN 'passed' ELSE 'failed' END
  FROM (SELECT 1 - count(DISTINCT script_type) FILTER (script_type = 'roman_only') AS n FROM kept)""",
        ),
        "final_dataset": FINAL_VIEW,
        "final_summary": summary(FINAL, "final"),
        "parquet_roundtrip": FINAL_VIEW,
        "csv_roundtrip": FINAL_VIEW,
        "summary_file": summary(FINAL, "final"),
        "script_pivot_file": over(
            CLEAN,
            """SELECT source, count(*) FILTER (script_type = 'roman_only') AS roman_only,
  count(*) FILTER (script_type = 'mixed_script') AS mixed_script,
  count(*) FILTER (script_type = 'devanagari_only') AS devanagari_only,
  count(*) FILTER (script_type = 'unknown') AS unknown FROM kept GROUP BY source""",
        ),
        "outputs_check": """SELECT name, CASE WHEN n > 0 THEN 'ok' ELSE 'missing_or_empty' END AS status
FROM (VALUES ('dataset.parquet'), ('dataset.csv'), ('summary.csv'), ('script_pivot.csv')) v(name),
  (SELECT count(*) AS n FROM documents)""",
    }
    return out
