"""DuckDB SQL that states the result of each named query from the supplied tables."""

from __future__ import annotations

from razonete.operators.elements import PROMPT
from razonete.operators.evaluate import EXPECTED_HEAD, EXPECTED_TAIL
from razonete.operators.normalize import FLAT_NUMBERS, FLAT_TEXTS
from razonete.sources.dictionary import ANYWHERE, FIELDS, NO_COMMENT, REQUIRED_KEYS, SECTION_TITLES, synonym_rows

BLANKS = "' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# One row per document, entity type and year.
FX = """
fx AS (
  SELECT c_custkey k, '/in/' || c_mktsegment || '/c' || c_custkey || '.pdf' path,
    CASE o_orderstatus WHEN 'F' THEN 'CONSOLIDADO' WHEN 'O' THEN 'CONTROLADORA' ELSE 'INDIVIDUAL' END tipo,
    year(o_orderdate) || '-12-31' periodo, c_name rs,
    sum(CAST(o_totalprice AS DECIMAL(18,2))) ativo,
    sum(CASE WHEN o_orderpriority LIKE '1%' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) lucro
  FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL)
"""

# The statements that survive normalisation, with exact liabilities.
STM = FX + """,
stm AS (
  SELECT k, 'c' || k || '.pdf' document_name, tipo tipo_entidade, periodo, rs razao_social,
    CAST(ativo AS DOUBLE) ativo, CAST(lucro AS DOUBLE) lucro,
    CAST(CAST((CAST(ativo * 100 AS HUGEINT) * (200 + k % 5) + 100) // 200 AS DECIMAL(30,0)) AS DOUBLE) / 100 passivo,
    CAST(ativo AS VARCHAR) ativo_text
  FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY tipo, periodo) rn FROM fx)
  WHERE k % 12 NOT IN (0, 1, 4, 5, 7) AND (k % 12 <> 6 OR rn = 1))
"""

LOG = """
log AS (
  SELECT 'c' || o_custkey || '.pdf' document_name,
    CASE o_orderkey % 6 WHEN 0 THEN 'ativo_total' WHEN 1 THEN 'dre.lucro_liquido' WHEN 2 THEN 'razao_social'
      WHEN 3 THEN 'identificacao.moeda' WHEN 4 THEN 'passivo_circulante.fornecedores' ELSE 'observacao' END campo,
    '9' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) valor_extraido,
    CASE o_orderkey % 6 WHEN 1 THEN replace(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '.', ',')
      WHEN 2 THEN 'CUSTOMER#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') WHEN 3 THEN 'BRL'
      ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END valor_correto,
    CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'tag-a' WHEN 3 THEN 'tag-b' ELSE 'free' END comentario,
    o_orderdate criado_em, o_orderkey seq
  FROM orders),
corr AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY document_name, campo ORDER BY criado_em DESC, seq DESC) = 1)
"""

# Corrections of a document side by side.
FIXES = """
fixes AS (
  SELECT document_name, count(*) corrections,
    max(CASE WHEN campo = 'ativo_total' THEN valor_correto END) fix_ativo,
    max(CASE WHEN campo = 'dre.lucro_liquido' THEN valor_correto END) fix_lucro,
    max(CASE WHEN campo = 'razao_social' THEN valor_correto END) fix_nome,
    max(CASE WHEN campo = 'identificacao.moeda' THEN valor_correto END) fix_moeda,
    max(CASE WHEN campo = 'passivo_circulante.fornecedores' THEN valor_correto END) fix_fornecedores
  FROM corr GROUP BY 1),
cells AS (SELECT * FROM stm LEFT JOIN fixes USING (document_name))
"""

# The record shown first per document.
FIRST = """
first_stm AS (SELECT * FROM stm QUALIFY row_number() OVER (PARTITION BY document_name ORDER BY tipo_entidade, periodo DESC) = 1)
"""

# Extracted text at a correction's path in a statement row.
AT_CAMPO = """CASE campo WHEN 'ativo_total' THEN CAST(s.ativo AS VARCHAR) WHEN 'dre.lucro_liquido' THEN CAST(s.lucro AS VARCHAR)
  WHEN 'razao_social' THEN s.razao_social WHEN 'identificacao.moeda' THEN CASE WHEN s.document_name IS NOT NULL THEN 'BRL' END END"""

LINES = """
matched AS (
  SELECT 'c' || o_custkey || '.pdf' document_name, o_orderstatus tipo_entidade, year(o_orderdate) || '-12-31' periodo,
    CASE WHEN l_returnflag IN ('A', 'N') THEN 'ativo_circulante.disponibilidades'
      WHEN l_linestatus = 'F' THEN 'ativo_circulante.estoques' ELSE 'ativo_nao_circulante.estoques' END path,
    CASE l_returnflag WHEN 'A' THEN 'disponibilidades' WHEN 'N' THEN 'caixa e equivalentes' ELSE 'estoques' END
      || CASE l_linestatus WHEN 'F' THEN '' ELSE ' liquidos' END label,
    CAST(l_extendedprice AS DECIMAL(18,2)) value
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
"""

SHEETS = """
cells AS (
  SELECT o_custkey k, year(o_orderdate) // 2 block, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END kind, l_linenumber % 4 item,
    CASE o_orderstatus WHEN 'F' THEN 'CONSOLIDADO' WHEN 'O' THEN 'CONTROLADORA' ELSE 'INDIVIDUAL' END tipo_entidade,
    year(o_orderdate) || '-12-31' periodo,
    CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * CAST(l_extendedprice AS DECIMAL(18,2)) value
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
blocks AS (
  SELECT k, block, kind, CASE WHEN kind = 1 THEN 0 ELSE (k + block) % 8 END shape FROM cells GROUP BY ALL)
"""

_FORM = """array_to_string(list_transform(list_filter(string_split(trim(regexp_replace({0}, '[^\\p{{L}}\\p{{N}}.]+', ' ', 'g')), ' '),
    lambda w: w NOT IN ('', '.', 'a', 'as', 'ao', 'com', 'da', 'das', 'de', 'do', 'dos', 'e', 'em', 'o', 'os', 'p', 'para', 'por', 'sobre')),
    lambda w: regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(rtrim(w, '.'),
      '(oes|aes)$', 'ao'), 'ais$', 'al'), '(eis)$', 'el'), '(r|z)es$', '\\1'), 's$', '')), ' ')"""


def _labels() -> str:
    """Every distinct label against every name."""
    named = [(label, path) for label, section, path in synonym_rows()
             if section == ANYWHERE and len(label) >= 12 and "/" not in label and "(" not in label]
    fields = ", ".join(f"({i}, {quote(label)}, {quote(path)})" for i, (label, path) in enumerate(named))
    names = ", ".join(f"({quote(label)}, {quote(section or '')}, {quote(path)})" for label, section, path in synonym_rows())
    return f"""
field(i, name, path) AS (VALUES {fields}),
lines AS (
  SELECT CASE l_partkey % 6 WHEN 0 THEN 'exact' WHEN 1 THEN 'lost letter' WHEN 2 THEN 'other letter' WHEN 3 THEN 'plural'
      WHEN 4 THEN 'abbreviation' ELSE 'none' END AS variant,
    CASE l_partkey % 6 WHEN 0 THEN name WHEN 1 THEN left(name, cut) || substr(name, cut + 2) WHEN 2 THEN left(name, cut) || 'y' || substr(name, cut + 2)
      WHEN 3 THEN name || 's' WHEN 4 THEN concat_ws(' ', left(string_split(name, ' ')[1], 5) || '.', array_to_string(string_split(name, ' ')[2:], ' '))
      ELSE reverse(name) || ' q' END AS label,
    CASE WHEN l_partkey % 6 <> 5 THEN path END AS path
  FROM (SELECT *, CAST(4 + l_suppkey % 5 AS INTEGER) AS cut FROM lineitem) JOIN field ON i = l_orderkey % {len(named)}),
labels AS (SELECT label, {_FORM.format("label")} AS form FROM (SELECT DISTINCT label FROM lines)),
known(name, section, path) AS (SELECT {_FORM.format("name")}, section, path FROM (VALUES {names}) v(name, section, path)),
near AS (SELECT label, section, path, levenshtein(form, name) AS distance FROM labels, known
  WHERE form <> '' AND levenshtein(form, name) <= least(length(form) // 6, 3)),
parts AS (SELECT label, list_filter(string_split(trim(regexp_replace(label, '[^\\p{{L}}\\p{{N}}.]+', ' ', 'g')), ' '), lambda w: w NOT IN
  ('', '.', 'a', 'as', 'ao', 'com', 'da', 'das', 'de', 'do', 'dos', 'e', 'em', 'o', 'os', 'p', 'para', 'por', 'sobre')) AS w FROM labels
  WHERE contains(label, '.')),
short AS (SELECT label, section, path, 0 AS distance FROM parts, known
  WHERE len(w) = len(string_split(name, ' ')) AND starts_with(string_split(name, ' ')[1], rtrim(w[1], '.'))
    AND {_FORM.format("array_to_string(w[2:], ' ')")} = array_to_string(string_split(name, ' ')[2:], ' ') AND ends_with(w[1], '.')),
found AS (SELECT * FROM near UNION SELECT * FROM short),
holding AS (SELECT *, min(distance) OVER (PARTITION BY label) AS least FROM found WHERE section IN ('*', '')),
resolved AS (
  SELECT label, CASE WHEN count(DISTINCT h.path) = 1 THEN any_value(h.path) END AS path, any_value(h.least) AS distance,
    CASE WHEN label NOT IN (SELECT label FROM found) THEN 'unknown' WHEN count(h.path) = 0 THEN 'no_section'
      WHEN count(DISTINCT h.path) > 1 THEN 'ambiguous' END AS reason
  FROM labels LEFT JOIN (SELECT * FROM holding WHERE distance = least) h USING (label) GROUP BY label)
"""


PARSED = """
parsed AS (
  SELECT 'd' || doc_id || '.pdf' path,
    CASE WHEN doc_id % 10 <> 0 THEN array_to_string(string_split(text, chr(10)), chr(10) || chr(10)) END raw_parsed,
    CASE WHEN doc_id % 10 = 0 THEN 'unreadable' END error_status
  FROM documents),
tagged AS (
  SELECT *, CASE WHEN error_status IS NOT NULL THEN 'parse_error' WHEN trim(raw_parsed, """ + BLANKS + """) = '' THEN 'empty_text' END reason
  FROM parsed)
"""

CUSTOMER_TEXTS = """
named AS (
  SELECT 'c' || c_custkey || '.pdf' document_name,
    CASE WHEN doc_id IS NULL AND c_acctbal < 0 THEN 'empty_text' WHEN doc_id IS NULL THEN 'no_text'
      WHEN trim(text, """ + BLANKS + """) = '' THEN 'empty_text' END reason
  FROM customer LEFT JOIN documents ON doc_id = c_custkey)
"""

REJECTS = """
rejected AS (
  SELECT k, CASE k % 12 WHEN 0 THEN 'no_answer' WHEN 1 THEN 'call_error' WHEN 4 THEN 'bad_json' WHEN 5 THEN 'parse_failed' ELSE 'bad_record' END reason
  FROM (SELECT DISTINCT k FROM fx) WHERE k % 12 IN (0, 1, 4, 5, 7))
"""

EVALUATED = """
texts AS (SELECT 'c' || doc_id || '.pdf' document_name, text FROM documents),
first_corr AS (SELECT document_name, campo, valor_correto FROM corr
  QUALIFY row_number() OVER (PARTITION BY document_name ORDER BY campo) = 1),
evaluated AS (
  SELECT t.document_name, t.text, c.campo, c.valor_correto, s.ativo, s.passivo, """ + AT_CAMPO + """ found
  FROM texts t LEFT JOIN first_stm s ON s.document_name = t.document_name LEFT JOIN first_corr c ON c.document_name = t.document_name)
"""


def with_(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + select


def _field_score(found: str, wanted: str) -> tuple[str, str]:
    """(metric, value) of comparing two texts."""
    x, y = (f"try_cast(replace({t}, ',', '.') AS DOUBLE)" for t in (found, wanted))
    numeric = f"({x} IS NOT NULL AND {y} IS NOT NULL)"
    value = (f"CASE WHEN {numeric} THEN CASE WHEN {y} = 0 THEN {x} = 0 ELSE abs({x} - {y}) / abs({y}) <= 0.01 END "
             f"ELSE lower(coalesce({found}, 'None')) = lower(coalesce({wanted}, 'None')) END")
    return f"CASE WHEN {numeric} THEN 'numeric_accuracy' ELSE 'text_match' END", value


def _wide() -> str:
    known = {
        "razao_social": "coalesce(fix_nome, razao_social)",
        "identificacao.periodo": "periodo",
        "identificacao.moeda": "coalesce(fix_moeda, 'BRL')",
        "ativo_total": "CASE WHEN fix_ativo IS NULL THEN ativo ELSE try_cast(fix_ativo AS DOUBLE) END",
        "passivo_total": "passivo",
        "dre.lucro_liquido": "CASE WHEN fix_lucro IS NULL THEN lucro ELSE try_cast(fix_lucro AS DOUBLE) END",
        "passivo_circulante.fornecedores": "try_cast(fix_fornecedores AS DOUBLE)",
    }
    columns = [f"{known.get(f.path, 'CAST(NULL AS DOUBLE)' if f.is_number else quote(''))} AS {f.column}" for f in FIELDS]
    return with_(STM, LOG, FIXES, select=f"""
      SELECT document_name, tipo_entidade, periodo, {', '.join(columns)}, corrections,
        CASE WHEN fix_lucro IS NOT NULL AND try_cast(fix_lucro AS DOUBLE) IS NULL
          THEN '{{"dre.lucro_liquido":"' || fix_lucro || '"}}' END AS text_cells
      FROM cells""")


def _long(paths: set[str] | None = None, with_ord: bool = True) -> str:
    ords = {f.path: f.ord for f in FIELDS}
    number = "CASE WHEN {fix} IS NULL THEN {raw} ELSE try_cast({fix} AS DOUBLE) END"
    text_left = "CASE WHEN {fix} IS NOT NULL AND try_cast({fix} AS DOUBLE) IS NULL THEN {fix} END"
    rows = {
        "razao_social": ("coalesce(fix_nome, razao_social)", "NULL", "fix_nome IS NOT NULL"),
        "identificacao.periodo": ("periodo", "NULL", "false"),
        "identificacao.moeda": ("coalesce(fix_moeda, 'BRL')", "NULL", "fix_moeda IS NOT NULL"),
        "ativo_total": (text_left.format(fix="fix_ativo"), number.format(fix="fix_ativo", raw="ativo"), "fix_ativo IS NOT NULL"),
        "passivo_total": ("NULL", "passivo", "false"),
        "dre.lucro_liquido": (text_left.format(fix="fix_lucro"), number.format(fix="fix_lucro", raw="lucro"), "fix_lucro IS NOT NULL"),
        "passivo_circulante.fornecedores": (
            text_left.format(fix="fix_fornecedores"), "try_cast(fix_fornecedores AS DOUBLE)", "fix_fornecedores IS NOT NULL"),
    }
    selects = []
    for path, (text, value, corrected) in rows.items():
        if paths is None or path in paths:
            ord_ = f"CAST({ords[path]} AS INTEGER) AS ord, " if with_ord else ""
            where = " WHERE fix_fornecedores IS NOT NULL" if path.endswith("fornecedores") else ""
            selects.append(f"SELECT document_name, tipo_entidade, periodo, {ord_}{quote(path)} AS path, "
                           f"CAST({text} AS VARCHAR) AS value_text, CAST({value} AS DOUBLE) AS value_num, "
                           f"{corrected} AS corrected FROM cells{where}")
    return with_(STM, LOG, FIXES, select=" UNION ALL ".join(f"\n{s}" for s in selects))


def _flat() -> str:
    texts = {"razao_social": "razao_social", "periodo": "periodo", "moeda": "'BRL'"}
    numbers = {"ativo_total": "ativo", "passivo_total": "passivo", "lucro_liquido": "lucro"}
    columns = [f"{texts.get(n, 'CAST(NULL AS VARCHAR)')} AS {n}" for n in FLAT_TEXTS]
    columns += [f"{numbers.get(n, 'CAST(NULL AS DOUBLE)')} AS {n}" for n in FLAT_NUMBERS]
    return with_(STM, select=f" SELECT document_name, {', '.join(columns)} FROM stm")


def _dictionary() -> str:
    rows = ", ".join(f"({f.ord}, {quote(f.section)}, {quote(f.path)}, {quote(f.kind)}, {f.is_total}, {quote(f.label)})"
                     for f in FIELDS)
    return with_(LOG, select=f"""
      SELECT ord, section, path, kind, is_total, label, count(campo) AS n_corrections
      FROM (VALUES {rows}) f(ord, section, path, kind, is_total, label) LEFT JOIN corr ON campo = path GROUP BY ALL""")


# The character references of the pages.
PAGE_REFERENCES = {"&quot;": '"', "&copy;": "©", "&middot;": "·", "&amp;": "&"}


def _page_elements() -> str:
    """Elements end at the tags that the pages have and that are no inline ones; all text, by taking every tag out."""
    decoded = "{}"
    for reference, character in PAGE_REFERENCES.items():
        decoded = f"replace({decoded}, {quote(reference)}, {quote(character)})"
    return f"""
      WITH shown AS (
        SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script.*?</script>', '', 'g'),
          '(?is)<style.*?</style>', '', 'g'), '(?s)<!--.*?-->', '', 'g') AS h FROM pages),
      parts AS (
        SELECT page_id, h, list_filter(list_transform(string_split(regexp_replace(regexp_replace(h,
          '(?i)</?(!doctype|p|li|head|title|nav|ul|div|article|h1|footer|html|body|br|meta)( [^>]*)?>', chr(30), 'g'), '<[^>]*>', '', 'g'),
          chr(30)), lambda t: trim({decoded.format("t")}, {BLANKS})), lambda t: t <> '') AS parts
        FROM shown)
      SELECT page_id, len(parts) AS n_elements, array_to_string(parts, chr(10) || chr(10)) AS raw_parsed,
        regexp_replace({decoded.format("regexp_replace(h, '<[^>]*>', '', 'g')")}, '[ \\t\\n\\r\\f\\v]', '', 'g') AS letters
      FROM parts"""


def _sections() -> str:
    rows = ", ".join(f"({quote(key)}, {i}, {quote(title)})" for i, (key, title) in enumerate(SECTION_TITLES.items(), 1))
    return with_(STM, select=f"""
      SELECT document_name, section, CAST(coalesce(section_ord, 999) AS INTEGER) AS section_ord,
        coalesce(section_label, section) AS section_label, n_entries
      FROM (SELECT document_name, unnest(['', 'dre']) AS section, count(*) AS n_entries FROM stm GROUP BY 1, 2)
      LEFT JOIN (VALUES ('', 0, 'Geral'), {rows}) t(section, section_ord, section_label) USING (section)""")


# CRC-32 byte by byte with the usual table of 256 remainders.
_CRC_BUCKETS = """
  WITH crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) remainders),
  crc AS (
    SELECT xor(list_reduce(
      list_concat([4294967295], list_transform(string_split('/in/d' || doc_id || '.pdf', ''), lambda x: CAST(ord(x) AS BIGINT))),
      lambda c, b: xor(c >> 8, remainders[(xor(c, b) & 255) + 1])), 4294967295) v
    FROM documents, crc_table)
  SELECT CAST(v % 8 AS INTEGER) AS bucket, count(*) AS n FROM crc GROUP BY 1"""

_ALL_METRIC, _ALL_VALUE = _field_score("found", "valor_correto")

ORACLE: dict[str, str] = {
    "normalize_results": with_(STM, select="""
      SELECT document_name, tipo_entidade, periodo, razao_social, '' AS cnpj, ativo AS ativo_total, lucro AS lucro_liquido FROM stm"""),
    "normalize_rejects": with_(FX, REJECTS, select=" SELECT reason, count(*) AS n FROM rejected GROUP BY 1"),
    "strip_fences": """
      SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN chr(10) || text || chr(10) WHEN 1 THEN regexp_replace(text, '^json', '')
        ELSE trim(text, """ + BLANKS + """) END AS body FROM documents""",
    "unwrap_envelope": with_(FX, select="""
      SELECT 'c' || k || '.pdf' AS document_name, CASE k % 12 WHEN 0 THEN 'no_answer' WHEN 1 THEN 'call_error' WHEN 4 THEN 'bad_json' END AS reason,
        CASE WHEN k % 12 IN (0, 1, 4) THEN NULL WHEN k % 12 IN (5, 6, 7) THEN 1 ELSE count(*) END AS n_records
      FROM fx GROUP BY k"""),
    "path_get": """
      SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k.deeper') AS deeper
      FROM events""",
    "safe_double": with_(STM, select="""
      SELECT document_name, tipo_entidade, periodo, lucro AS from_text, CAST(0 AS DOUBLE) AS from_name,
        CAST(0 AS DOUBLE) AS from_nothing FROM stm"""),
    "tag_parse_failures": with_(FX, select="""
      SELECT DISTINCT 'c' || k || '.pdf' AS document_name, '[{"error":"parse_failed","raw":"not json"}]' AS extracted
      FROM fx WHERE k % 12 = 4"""),
    "flatten_statement": _flat(),
    "dedupe_batch": """
      SELECT 'c' || o_custkey || '.pdf' AS document_name, o_orderstatus AS tipo_entidade, year(o_orderdate) || '-12-31' AS periodo,
        arg_max(o_totalprice, o_orderkey) AS ativo_total, arg_max(o_orderpriority, o_orderkey) AS razao_social
      FROM orders GROUP BY 1, 2, 3""",

    "document_list": with_(STM, select="""
      SELECT document_name, max(razao_social) AS razao_social, '' AS cnpj, max(periodo) AS periodo,
        max(ativo) AS ativo_total, max(lucro) AS lucro_liquido FROM stm GROUP BY document_name"""),
    "document_cards": with_(STM, select="""
      SELECT document_name, razao_social AS title, substr(max(periodo), 1, 10) AS period,
        'R$' || chr(160) || replace(format('{:,.0f}', max(ativo)), ',', '.') AS assets
      FROM stm GROUP BY document_name, razao_social"""),
    "document_detail": with_(STM, select=" SELECT document_name, tipo_entidade, periodo, ativo AS ativo_total FROM stm"),
    "document_by_name": with_(STM, select="""
      SELECT document_name, tipo_entidade, periodo, ativo AS ativo_total FROM stm
      WHERE document_name = (SELECT min(document_name) FROM stm)"""),
    "default_record": with_(STM, FIRST, select="""
      SELECT document_name, tipo_entidade, periodo, razao_social, ativo AS ativo_total FROM first_stm"""),
    "record_labels": with_(STM, select="""
      SELECT document_name, tipo_entidade, periodo, tipo_entidade || ' · ' || substr(periodo, 1, 10) AS record_label,
        razao_social AS title FROM stm"""),
    "document_key": "SELECT doc_id, 'd' || doc_id || '.pdf' AS document_key FROM documents",
    "statement_combos": """
      SELECT 'c' || o_custkey || '.pdf' AS document_name, o_orderstatus AS tipo_entidade,
        year(o_orderdate) || '-12-31' AS periodo, count(*) AS n_records FROM orders GROUP BY 1, 2, 3""",
    "latest_status": """
      SELECT 'c' || c_custkey || '.pdf' AS document_name, coalesce(status, 'unknown') AS status
      FROM customer LEFT JOIN (SELECT user_id, event_type AS status FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) ON user_id = c_custkey""",

    "latest_corrections": with_(LOG, select="""
      SELECT document_name, campo, valor_correto, comentario, strftime(criado_em, '%Y-%m-%d %H:%M:%S') AS criado_em, seq FROM corr"""),
    "corrections_after_delete": with_(LOG, select="""
      SELECT document_name, campo, valor_correto, seq FROM corr WHERE comentario IS DISTINCT FROM 'free'"""),
    "correction_workflow": with_(LOG, select="""
      SELECT document_name, campo, valor_extraido, valor_correto, comentario, seq FROM corr WHERE comentario IS DISTINCT FROM 'free'"""),
    "corrections_by_name": with_(LOG, select="""
      SELECT campo, valor_extraido, valor_correto, comentario, strftime(criado_em, '%Y-%m-%d %H:%M:%S') AS criado_em FROM corr
      WHERE comentario IS DISTINCT FROM 'free' AND document_name = (SELECT min(document_name) FROM log)"""),
    "compact_roundtrip": with_(LOG, select="""
      SELECT document_name, campo, valor_correto, seq, CAST(1 AS BIGINT) AS batch_id FROM corr"""),
    "correction_overlay": _long({"ativo_total", "dre.lucro_liquido"}, with_ord=False),

    "metrics_totals": with_(STM, LOG, select="""
      SELECT s.total_docs, s.distinct_docs, c.total_corrections, c.docs_with_corrections,
        round_even((1 - c.total_corrections / (s.total_docs * 70)) * 100, 1) AS accuracy_pct,
        s.total_docs - c.docs_with_corrections AS docs_without_errors
      FROM (SELECT count(*) total_docs, count(DISTINCT document_name) distinct_docs FROM stm) s,
        (SELECT count(*) total_corrections, count(DISTINCT document_name) docs_with_corrections FROM corr) c"""),
    "metrics_by_field": with_(LOG, select="""
      SELECT campo, total, CAST(total AS DOUBLE) / max(total) OVER () * 100 AS share_pct
      FROM (SELECT campo, count(*) total FROM corr GROUP BY 1) ORDER BY total DESC, campo LIMIT 15"""),
    "metrics_by_type": with_(LOG, select=f"""
      SELECT tipo, total, CAST(total AS DOUBLE) / max(total) OVER () * 100 AS share_pct
      FROM (SELECT CASE WHEN comentario IS NULL OR comentario = '' THEN '{NO_COMMENT}' ELSE comentario END tipo, count(*) total
        FROM corr GROUP BY 1)"""),
    "metrics_by_document": with_(STM, LOG, select="""
      SELECT c.document_name, count(*) AS corrections, s.razao_social FROM corr c LEFT JOIN stm s ON s.document_name = c.document_name
      GROUP BY c.document_name, s.razao_social ORDER BY corrections DESC, c.document_name LIMIT 10"""),
    "metrics_by_document_distinct": with_(STM, LOG, select="""
      SELECT c.document_name, count(*) AS corrections, max(s.razao_social) AS razao_social
      FROM corr c LEFT JOIN (SELECT DISTINCT document_name, razao_social FROM stm) s ON s.document_name = c.document_name
      GROUP BY c.document_name ORDER BY corrections DESC, c.document_name LIMIT 10"""),

    "export_long": _long(),
    "export_wide": _wide(),
    "export_corrections": with_(LOG, select="""
      SELECT document_name, campo, valor_extraido, valor_correto, comentario FROM corr"""),
    "export_provenance": with_(STM, select="""
      SELECT document_name, tipo_entidade, periodo, 'Ativo Total' AS label, 'linha ' || ativo_text AS fonte, 'ativo_total' AS path FROM stm
      UNION ALL SELECT document_name, tipo_entidade, periodo, 'Lucro Líquido', 'calc', 'dre.lucro_liquido' FROM stm"""),
    "provenance_by_section": _sections(),
    "field_dictionary": _dictionary(),

    "incremental_by_path": """
      SELECT '/in/o' || o_orderkey || '.pdf' AS path FROM orders WHERE o_orderkey NOT IN (SELECT event_id FROM events)""",
    "incremental_by_name": """
      SELECT 'c' || c_custkey || '.pdf' AS document_name, '/in/' || c_mktsegment || '/c' || c_custkey || '.pdf' AS path
      FROM customer WHERE c_custkey NOT IN (SELECT doc_id FROM documents)""",
    "incremental_bootstrap": "SELECT '/in/o' || o_orderkey || '.pdf' AS path FROM orders",
    "ingest_counts": """
      SELECT count(*) AS total, count(event_id) AS done, count(*) - count(event_id) AS to_process
      FROM orders LEFT JOIN events ON event_id = o_orderkey""",
    "name_collisions": """
      SELECT 'u' || user_id || '.pdf' AS document_name, count(DISTINCT event_type) AS n_paths,
        '/' || min(event_type) || '/u' || user_id || '.pdf' AS first_path, '/' || max(event_type) || '/u' || user_id || '.pdf' AS last_path
      FROM events GROUP BY user_id HAVING count(DISTINCT event_type) > 1""",
    "parse_status_split": with_(PARSED, select=" SELECT path, raw_parsed, error_status, reason FROM tagged"),
    "parse_counts": with_(PARSED, select=" SELECT count(raw_parsed) AS succeeded, count(*) - count(raw_parsed) AS failed FROM tagged"),
    "blank_text_split": with_(CUSTOMER_TEXTS, select=" SELECT document_name, reason FROM named"),
    "run_summary": with_(STM, select="""
      SELECT count(*) AS total_rows, count(DISTINCT document_name) AS distinct_documents,
        count(*) FILTER (WHERE periodo LIKE '2000%') AS new_rows FROM stm"""),
    "run_errors": with_(FX, REJECTS, CUSTOMER_TEXTS, select="""
      SELECT reason, count(*) AS n, count(DISTINCT document_name) AS documents, reason NOT IN ('no_text', 'empty_text') AS is_hard
      FROM (SELECT 'c' || k || '.pdf' document_name, reason FROM rejected
        UNION ALL SELECT document_name, reason FROM named WHERE reason IS NOT NULL) GROUP BY reason"""),

    "upsert_results": """
      SELECT coalesce(l_orderkey, o_orderkey) AS order_key, coalesce(CAST(l.price AS DOUBLE), o_totalprice) AS price
      FROM (SELECT * FROM orders WHERE o_orderstatus <> 'P') o
      FULL JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) price FROM lineitem GROUP BY 1) l
        ON l_orderkey = o_orderkey""",
    "bucketed_upsert": """
      SELECT coalesce(l_orderkey, o_orderkey) AS order_key, coalesce(CAST(l.price AS DOUBLE), o_totalprice) AS price
      FROM (SELECT * FROM orders WHERE o_orderstatus <> 'P') o
      FULL JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) price FROM lineitem GROUP BY 1) l
        ON l_orderkey = o_orderkey""",
    "bucketed_missing": """
      SELECT o_orderstatus AS status, o_orderstatus <> 'P' AS stored, count(*) AS n_orders FROM orders GROUP BY ALL""",
    "bucketed_corrections": with_(LOG, select="SELECT document_name, campo, valor_correto, seq FROM corr"),
    "append_roundtrip": "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders",
    "overwrite_roundtrip": "SELECT o_orderkey, o_orderpriority FROM orders",

    "score_field": """
      SELECT o_orderkey, 'numeric_accuracy' AS name, abs(x - y) / abs(y) <= 0.5 AS value,
        CASE WHEN y IS NULL THEN 'Sem correção registrada'
          ELSE printf('Extraído: %.2f | Correto: %.2f | Delta: %.2f', x, y, abs(x - y)) END AS rationale
      FROM (SELECT o_orderkey, o_totalprice x, CAST(price AS DOUBLE) y FROM orders
        LEFT JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) price FROM lineitem GROUP BY 1) l
          ON l_orderkey = o_orderkey)""",
    "score_structure": with_(STM, select="""
      SELECT document_name, tipo_entidade, periodo, false AS value, 'Campos ausentes: """ + ", ".join(
        k for k in REQUIRED_KEYS if k not in ("razao_social", "identificacao", "ativo_total", "passivo_total", "dre")) + """' AS rationale
      FROM stm"""),
    "score_structure_whole": f"""
      SELECT o_orderkey, o_orderkey % 3 = 0 AS value, CASE o_orderkey % 3 WHEN 0 THEN 'Estrutura OK'
        WHEN 1 THEN 'Campos ausentes: {REQUIRED_KEYS[0]}' ELSE 'Output não é um objeto' END AS rationale FROM orders""",
    "score_field_close": """
      SELECT l_orderkey, l_linenumber, 'numeric_accuracy' AS name, abs(x - y) / abs(y) <= 0.01 AS value
      FROM (SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) x,
          CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(l_quantity AS DECIMAL(10,0)) AS DOUBLE) y
        FROM lineitem JOIN part ON l_partkey = p_partkey)""",
    "score_balance": with_(STM, select="""
      SELECT document_name, tipo_entidade, periodo, delta <= 1.0 AS value,
        format('Ativo: {:,.2f} | Passivo: {:,.2f} | Delta: {:,.2f}%', ativo, passivo, delta) AS rationale
      FROM (SELECT *, abs(ativo - passivo) / abs(ativo) * 100 delta FROM stm)"""),
    "score_field_all": with_(STM, LOG, FIRST, select=f"""
      SELECT document_name, campo, {_ALL_METRIC} AS metric, {_ALL_VALUE} AS value
      FROM (SELECT c.document_name, c.campo, c.valor_correto, {AT_CAMPO} found
        FROM corr c LEFT JOIN first_stm s ON s.document_name = c.document_name)"""),
    "evaluation_set": with_(STM, LOG, FIRST, EVALUATED, select="""
      SELECT document_name, text, ativo AS ativo_total, campo, valor_correto FROM evaluated"""),
    "evaluation_metrics": with_(STM, LOG, FIRST, EVALUATED, select=f"""
      SELECT metric, avg(CAST(value AS DOUBLE)) AS mean, count(value) AS n_scored, count(*) AS n FROM (
        SELECT 'json_structure_valid' metric, false AS value FROM evaluated
        UNION ALL SELECT 'balanco_equilibrado', abs(ativo - passivo) / abs(ativo) * 100 <= 1.0 FROM evaluated
        UNION ALL SELECT CASE WHEN campo IS NULL THEN 'numeric_accuracy' ELSE {_ALL_METRIC} END,
          CASE WHEN campo IS NOT NULL THEN {_ALL_VALUE} END FROM evaluated) GROUP BY metric"""),
    "tuning_set": with_(STM, LOG, FIRST, EVALUATED, select=f"""
      SELECT document_name, text, {quote(EXPECTED_HEAD)} || notes || {quote(EXPECTED_TAIL)} AS expected_response
      FROM (SELECT document_name, string_agg('- Campo ''' || campo || ''': deve ser ''' || valor_correto || ''' (era ''' || valor_extraido || '''). '
            || coalesce(comentario, ''), chr(10) ORDER BY campo) notes
        FROM corr GROUP BY 1) JOIN texts USING (document_name)"""),
    "tuning_readiness": with_(LOG, select="""
      SELECT n AS corrected_docs, n >= 5 AS ready, CAST(greatest(5 - n, 0) AS BIGINT) AS missing_docs
      FROM (SELECT count(DISTINCT document_name) n FROM corr
        WHERE document_name IN (SELECT 'c' || doc_id || '.pdf' FROM documents))"""),

    "join_elements": """
      SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: trim(x, """ + BLANKS + """) <> ''),
        chr(10) || chr(10)) AS raw_parsed FROM documents""",
    "page_elements": _page_elements(),
    "prompt_rows": f"SELECT doc_id, {quote(PROMPT)} || text AS prompt FROM documents",
    "batch_score": """
      SELECT doc_id, CASE WHEN length(text) % 7 > 1 THEN substr(text, 1, 5) END AS result,
        CASE length(text) % 7 WHEN 0 THEN 'ValueError: no answer' WHEN 1 THEN 'TimeoutError: slow (3 tries)' END AS error_message,
        CAST(CASE length(text) % 7 WHEN 1 THEN 3 ELSE 1 END AS INTEGER) AS attempts
      FROM documents""",
    "calls_in_flight": """
      SELECT doc_id, CASE WHEN length(text) % 97 > 1 THEN substr(text, 1, 5) END AS result,
        CASE length(text) % 97 WHEN 0 THEN 'TimeoutError: no answer within 2 s (2 tries)' WHEN 1 THEN 'RuntimeError: bad gateway (2 tries)' END
          AS error_message,
        CAST(CASE WHEN length(text) % 97 < 2 THEN 2 ELSE 1 END AS INTEGER) AS attempts
      FROM documents""",
    "preview_text": "SELECT doc_id, substr(text, 1, 150) AS preview, length(text) AS n_chars FROM documents",
    "last_message": """
      SELECT conv_id, CASE conv_id % 6 WHEN 0 THEN arg_min(text, turn) WHEN 3 THEN '> ' || arg_min(text, turn)
        ELSE arg_max(text, turn) END AS text FROM conversations GROUP BY conv_id""",
    "line_items": with_(LINES, select="""
      SELECT document_name, tipo_entidade, periodo, path, CAST(sum(value) AS DOUBLE) AS value, count(*) AS n_lines
      FROM matched GROUP BY 1, 2, 3, 4"""),
    "line_items_scaled": with_(LINES, select="""
      SELECT document_name, tipo_entidade, periodo, path, CAST(sum(value) AS DOUBLE) AS value, count(*) AS n_lines
      FROM matched GROUP BY 1, 2, 3, 4"""),
    "statement_text_records": with_(LINES, select="""
      SELECT document_name, CASE tipo_entidade WHEN 'F' THEN 'CONSOLIDADO' ELSE 'CONTROLADORA' END AS tipo_entidade, periodo,
        CAST(coalesce(sum(value) FILTER (WHERE path = 'ativo_circulante.disponibilidades'), 0) AS DOUBLE) AS disponibilidades,
        CAST(coalesce(sum(value) FILTER (WHERE path = 'ativo_circulante.estoques'), 0) AS DOUBLE) AS estoques
      FROM matched WHERE tipo_entidade IN ('F', 'O') AND periodo IN ('1994-12-31', '1995-12-31') GROUP BY 1, 2, 3"""),
    "statement_sheets": with_(SHEETS, select="""
      SELECT 'c' || k || '.pdf' AS document_name, tipo_entidade, periodo,
        CASE item WHEN 1 THEN 'ativo_circulante.estoques' WHEN 2 THEN 'ativo_nao_circulante.estoques'
          WHEN 3 THEN 'passivo_circulante.fornecedores' ELSE 'passivo_nao_circulante.fornecedores' END AS path,
        CAST(sum(value) AS DOUBLE) AS value, CAST(1 AS BIGINT) AS n_lines
      FROM cells GROUP BY k, tipo_entidade, periodo, item"""),
    "page_statements": with_(SHEETS, select="""
      SELECT 'c' || k || '.pdf' AS document_name, tipo_entidade, periodo,
        CASE item WHEN 1 THEN 'ativo_circulante.estoques' WHEN 2 THEN 'ativo_nao_circulante.estoques'
          WHEN 3 THEN 'passivo_circulante.fornecedores' ELSE 'passivo_nao_circulante.fornecedores' END AS path,
        CAST(sum(value) AS DOUBLE) AS value
      FROM cells GROUP BY k, tipo_entidade, periodo, item"""),
    "similar_labels": with_(_labels(), select=" SELECT label, path, CAST(distance AS INTEGER) AS distance, reason FROM resolved"),
    "similar_label_quality": with_(_labels(), select="""
      SELECT variant, count(*) AS n_lines, count(r.path) AS n_found, count(*) FILTER (WHERE r.path = l.path) AS n_right
      FROM lines l JOIN resolved r USING (label) GROUP BY variant"""),
    "statement_lines_left_out": with_(SHEETS, select="""
      SELECT 'no_amounts' AS reason, CAST(sum(6 + CASE shape WHEN 2 THEN 0 ELSE 1 END + k % 2) AS BIGINT) AS n_lines FROM blocks
      UNION ALL SELECT 'no_columns', count(DISTINCT k) FROM blocks
      UNION ALL SELECT 'unclear_columns', count(*) FROM blocks WHERE shape = 7"""),
    "line_item_provenance": with_(LINES, select="""
      SELECT document_name, tipo_entidade, periodo, path,
        CASE WHEN sum(n) = 1 THEN string_agg(part, ' + ' ORDER BY label) || ': leitura direta'
          ELSE string_agg(part, ' + ' ORDER BY label) || ' = ' || translate(format('{:,.2f}', CAST(sum(v) AS DOUBLE)), ',.', '.,') || ': soma'
        END AS fonte
      FROM (SELECT document_name, tipo_entidade, periodo, path, label, sum(value) v, count(*) n,
          label || ' (' || translate(format('{:,.2f}', CAST(sum(value) AS DOUBLE)), ',.', '.,')
            || CASE WHEN count(*) > 1 THEN ', ' || count(*) || ' linhas' ELSE '' END || ')' part
        FROM matched GROUP BY 1, 2, 3, 4, 5) GROUP BY 1, 2, 3, 4 HAVING sum(v) <> 0"""),
    "assemble_records": with_(LINES, select="""
      SELECT document_name, tipo_entidade, periodo,
        CAST(coalesce(sum(value) FILTER (WHERE path = 'ativo_circulante.disponibilidades'), 0) AS DOUBLE) AS disponibilidades,
        CAST(coalesce(sum(value) FILTER (WHERE path = 'ativo_circulante.estoques'), 0) AS DOUBLE) AS estoques,
        CAST(coalesce(sum(value) FILTER (WHERE path = 'ativo_nao_circulante.estoques'), 0) AS DOUBLE) AS estoques_lp,
        CAST(0 AS DOUBLE) AS lucro_liquido, count(DISTINCT path) AS n_fontes
      FROM matched GROUP BY 1, 2, 3"""),
    "format_money": """
      SELECT o_orderkey, CASE WHEN x < 0 THEN '-' ELSE '' END || 'R$' || chr(160) || translate(format('{:,.2f}', abs(x)), ',.', '.,') AS money,
        printf('%.2f', x) AS plain
      FROM (SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) - 250000 AS DOUBLE) x FROM orders)""",

    "hash_buckets": _CRC_BUCKETS,

    **{name: """
      SELECT lang, sum(strlen(text) + 1) AS n_bytes, sum(strlen(text) + 1) AS n_read,
        sum(length(text) - length(replace(text, chr(10), '')) + 1) AS n_lines FROM documents GROUP BY lang"""
       for name in ("scan_files", "read_contents", "stream_ingest")},
    "spread_by_size": """
      SELECT count(*) AS n_files,
        CAST(sum(strlen(text)) + 3 * sum(strlen(text)) - coalesce(sum(strlen(text)) FILTER (WHERE doc_id IN (1, 2, 3)), 0) AS BIGINT) AS n_bytes,
        CAST(3 AS BIGINT) AS n_alone, CAST(0 AS BIGINT) AS n_overfull
      FROM documents""",
    "known_by_content": """
      WITH f AS (SELECT lang, source, string_agg(text, chr(10) ORDER BY doc_id) AS t FROM documents GROUP BY ALL),
      asked AS (SELECT * FROM f WHERE trim(t, """ + BLANKS + """) <> '')
      SELECT files, count(*) AS n_files, count(DISTINCT t) AS n_answers
      FROM asked, (VALUES ('first'), ('copied'), ('changed')) v(files) WHERE files <> 'changed' OR lang = 'en' GROUP BY files""",
    "three_stages": """
      WITH f AS (SELECT coalesce(lang, '') || '/' || coalesce(source, '') AS name, lang, coalesce(string_agg(text, chr(10)), '') AS t
        FROM documents GROUP BY lang, source),
      runs AS (SELECT name, CAST(1 + len(regexp_extract_all(t, '[^\\n]+')) AS DOUBLE) AS n_lines,
          CAST(length(name) + length(replace(t, chr(10), '')) AS DOUBLE) AS n_chars, lang, 0 AS batch_id FROM f),
      asked AS (SELECT * FROM runs UNION ALL SELECT name, n_lines + 1, n_chars + 5, lang, 1 FROM runs WHERE lang = 'en')
      SELECT name, batch_id, n_lines, n_chars, count(*) AS n FROM asked WHERE n_lines % 5 <> 0 GROUP BY ALL
      UNION ALL SELECT 'bad_json', r.batch_id, NULL, NULL, count(*) FROM asked, (VALUES (0), (1)) r(batch_id)
      WHERE n_lines % 5 = 0 AND asked.batch_id <= r.batch_id GROUP BY r.batch_id""",
    "stream_counts": with_(LOG, select=" SELECT campo, count(*) AS total FROM log GROUP BY 1"),
    "stream_current_counts": with_(LOG, select="""
      SELECT campo, count(*) AS total FROM corr WHERE comentario IS DISTINCT FROM 'free' GROUP BY 1"""),
    "stream_upsert": with_(LOG, select=" SELECT document_name, campo, valor_correto FROM corr"),
    "stream_normalize": with_(STM, select="""
      SELECT document_name, tipo_entidade, periodo, razao_social, ativo AS ativo_total FROM stm"""),
}
