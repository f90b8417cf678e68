"""The same queries as SQL for DuckDB, to check the results against.

Written apart from the operators: sections are cut at a marker character and
packed with ``list_reduce``, duplicates found with ``row_number``, and so on.
Only patterns and other fixed values are shared.
"""

from __future__ import annotations

from docloom import fixed_values as fv
from docloom.plans import views
from docloom.plans.queries import OUTLINE, SYSTEM_PROMPT


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _view(name: str, columns: tuple[str, ...], source: str = "documents") -> str:
    return f"{name} AS (SELECT {', '.join(columns)} FROM {source})"


def _drop(text: str, pattern: str) -> str:
    return f"regexp_replace({text}, {_quoted(pattern)}, '', 'g')"


def _strip(text: str) -> str:
    return f"trim({text}, {_quoted(fv.SPACE_CHARS)})"


def _lines(pattern: str) -> str:
    return "(?m)" + pattern


_MD = _view("md_documents", views.MD_COLUMNS)
_ADOC = _view("adoc_documents", views.ADOC_COLUMNS)


# --- cleaning and chunking -------------------------------------------------


def _clean(text: str, strict: bool = False) -> str:
    images = fv.MD_IMAGE_WITH_DATA_URI_STRICT if strict else fv.MD_IMAGE_WITH_DATA_URI
    uris = fv.BARE_DATA_URI_STRICT if strict else fv.BARE_DATA_URI
    for pattern in (fv.FIGURE_BLOCK, fv.IMG_WITH_DATA_URI, images, uris, fv.ATTRIBUTE_REFERENCE):
        text = _drop(text, pattern)
    return text


_CLEANED = f"cleaned AS (SELECT doc_id, source, {_clean('md')} AS md FROM md_documents)"

_SECTION_LIST = (
    f"list_filter(string_split(regexp_replace(md, {_quoted(_lines('(' + fv.SECTION_HEADER + ')'))},"
    f" concat(chr(1), '\\1'), 'g'), chr(1)), lambda s: {_strip('s')} <> '')"
)


def _chunk_lists(max_chars: int) -> str:
    """``open`` is the pending text, ``done`` the list of finished ones."""
    empty = "{'open': ''::VARCHAR, 'done': []::VARCHAR[]}"
    sliced = f"list_transform(range(0, length(p), {max_chars}), lambda i: substring(p, CAST(i AS INTEGER) + 1, {max_chars}))"
    inner = f"""list_reduce(list_prepend({empty}, list_transform(string_split_regex(s, '{fv.PARAGRAPH_BREAK}'),
        lambda q: {{'open': q, 'done': []::VARCHAR[]}})),
      lambda b, t: list_transform([t.open], lambda p:
        CASE WHEN length(b.open) + length(p) + 2 < {max_chars}
               THEN {{'open': CASE WHEN b.open = '' THEN p ELSE concat(b.open, chr(10), chr(10), p) END, 'done': b.done}}
             WHEN length(p) >= {max_chars}
               THEN {{'open': ''::VARCHAR, 'done': list_concat(list_append(b.done, b.open), {sliced})}}
             ELSE {{'open': p, 'done': list_append(b.done, b.open)}} END)[1])"""
    outer = f"""list_reduce(list_prepend({empty}, list_transform(secs, lambda z: {{'open': z, 'done': []::VARCHAR[]}})),
      lambda a, u: list_transform([u.open], lambda s:
        CASE WHEN length(a.open) + length(s) < {max_chars}
               THEN {{'open': concat(a.open, s), 'done': a.done}}
             WHEN length(s) >= {max_chars}
               THEN {{'open': ''::VARCHAR, 'done': list_transform([{inner}], lambda o:
                      list_concat(list_append(a.done, a.open), list_append(o.done, o.open)))[1]}}
             ELSE {{'open': s, 'done': list_append(a.done, a.open)}} END)[1])"""
    return f"""section_lists AS (SELECT doc_id, source, {_SECTION_LIST} AS secs FROM cleaned),
packed AS (SELECT doc_id, source, {outer} AS st FROM section_lists),
chunk_lists AS (SELECT doc_id, source, list_filter(list_transform(list_append(st.done, st.open), lambda c: {_strip('c')}),
  lambda c: c <> '') AS chunks FROM packed),
chunks AS (SELECT doc_id, source, CAST(generate_subscripts(chunks, 1) - 1 AS INTEGER) AS pos, unnest(chunks) AS chunk FROM chunk_lists)"""


def _with_chunks(select: str, max_chars: int = fv.MAX_CHUNK_CHARS, more: str = "") -> str:
    return f"WITH {_MD},\n{_CLEANED},\n{_chunk_lists(max_chars)}{more}\n{select}"


_MERGED = """merged AS (SELECT source, doc_id // 256 AS part, count(*) AS n_docs,
  string_agg(md, concat(chr(10), chr(10), '---', chr(10), chr(10)) ORDER BY doc_id) AS md FROM md_documents GROUP BY 1, 2)"""

_SETTINGS = ", ".join(_quoted(v) for v in (str(fv.MAX_CHUNK_CHARS), "sentences", fv.DOMAIN, OUTLINE))
_INPUTS = f""",
ranked AS (SELECT doc_id, pos, chunk, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, pos) AS rn FROM chunks),
inputs AS (SELECT sha256(concat_ws(chr(31), {_SETTINGS}, chunk)) AS chunk_id, doc_id, pos, chunk AS document,
  {_quoted(OUTLINE)} AS document_outline, {_quoted(fv.DOMAIN)} AS domain FROM ranked WHERE rn = 1)"""


def _with_inputs(select: str, more: str = "") -> str:
    return _with_chunks(select, more=_INPUTS + more)


# --- AsciiDoc --------------------------------------------------------------

_DEFAULT_NAMES = "[" + ", ".join(_quoted(n) for n, _ in fv.DEFAULT_ATTRIBUTES) + "]"
_DEFAULT_VALUES = "[" + ", ".join(_quoted(v) for _, v in fv.DEFAULT_ATTRIBUTES) + "]"


def _attributes(source: str, definition: str = fv.ATTRIBUTE_LINE) -> str:
    """One row per attribute: place of its first, value of its last mention."""
    pattern = _quoted(_lines(definition))
    return f"""mentions AS (SELECT doc_id,
    unnest(list_concat({_DEFAULT_NAMES}, regexp_extract_all(text, {pattern}, 1))) AS name,
    unnest(list_concat({_DEFAULT_VALUES}, regexp_extract_all(text, {pattern}, 2))) AS value,
    generate_subscripts(list_concat({_DEFAULT_NAMES}, regexp_extract_all(text, {pattern}, 1)), 1) AS i FROM {source}),
attributes AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY min(i)) - 1 AS INTEGER) AS ord,
    name, arg_max(value, i) AS value FROM mentions GROUP BY doc_id, name)"""


def _shared_attributes() -> str:
    """The same with shared rows between defaults and own ones.  The rows a
    text asks for refer to others two levels deep."""

    def names(text: str) -> str:
        return f"regexp_extract_all({text}, {_quoted('[{]([^{}]+)[}]')}, 1)"

    shared = [column.replace(" div ", " // ") for column in views.SHARED_COLUMNS]
    return f"""{_view("shared", shared)},
adoc_shared AS (SELECT {', '.join(views.ADOC_SHARED_COLUMNS)} FROM adoc_documents),
asked AS (SELECT doc_id, unnest({names('text')}) AS name FROM adoc_shared),
hits0 AS (SELECT DISTINCT doc_id, name, value FROM asked JOIN shared USING (name)),
hits1 AS (SELECT DISTINCT h.doc_id, s.name, s.value FROM (SELECT doc_id, unnest({names('value')}) AS used FROM hits0) h JOIN shared s ON s.name = used),
hits2 AS (SELECT DISTINCT h.doc_id, s.name, s.value FROM (SELECT doc_id, unnest({names('value')}) AS used FROM hits1) h JOIN shared s ON s.name = used),
hits3 AS (SELECT DISTINCT h.doc_id, s.name, s.value FROM (SELECT doc_id, unnest({names('value')}) AS used FROM hits2) h JOIN shared s ON s.name = used),
hits AS (FROM hits0 UNION FROM hits1 UNION FROM hits2 UNION FROM hits3),
{_attributes("adoc_shared").replace("attributes AS", "own_only AS")},
ordered AS (SELECT doc_id, name, value, CASE WHEN i <= {len(fv.DEFAULT_ATTRIBUTES)} THEN 0 ELSE 2 END AS stage, '' AS place, i FROM mentions
  UNION ALL SELECT doc_id, name, value, 1, name, 0 FROM hits),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY stage, place, i) AS r FROM ordered),
attributes AS (SELECT doc_id, min(r) AS ord, name, arg_max(value, r) AS value FROM ranked GROUP BY doc_id, name)"""


def _adoc_cleaned(source: str, attributes: str = "") -> str:
    text = "s.done"
    for pattern in (fv.ATTRIBUTE_REFERENCE,):
        text = _drop(text, pattern)
    directives = "^(?:" + "|".join(fv.CONDITIONAL_STARTS) + ").*$"
    for pattern in (f"^{fv.INCLUDE_START}.*$", fv.BLOCK_ID_LINE, directives, f"{fv.DEFINITION_START}.*$"):
        text = _drop(text, _lines(pattern))
    return f"""{attributes or _attributes(source)},
attribute_lists AS (SELECT doc_id, list({{'name': name, 'value': value}} ORDER BY ord) AS l FROM attributes GROUP BY doc_id),
substituted AS (SELECT d.doc_id, list_reduce(list_prepend({{'name': '', 'value': d.text}}, a.l),
    lambda x, y: {{'name': '', 'value': replace(x.value, concat('{{', y.name, '}}'), y.value)}}).value AS done
  FROM {source} d JOIN attribute_lists a USING (doc_id)),
adoc_cleaned AS (SELECT doc_id, {text} AS text FROM substituted s)"""


_REFERENCES = (
    (r"xref:([^\s\[\]]*[.#][^\s\[\]]*)\[([^\]\n]+)\]", r"[\2](\1)"),
    (r"xref:([^\s\[\]]+)\[([^\]\n]+)\]", r"[\2](#\1)"),
    (r"<<([^\s<>,]+),[ ]*([^<>\n]+)>>", r"[\2](#\1)"),
    (r"<<([^\s<>,]+)>>", r"[\1](#\1)"),
    (r"link:([^\s\[\]]+)\[([^\]\n]+)\]", r"[\2](\1)"),
    (r"link:([^\s\[\]]+)\[\]", r"<\1>"),
    (r"(^|[^\w:])(https?://[^\s\[\]<>]+)\[([^\]\n]+)\]", r"\1[\3](\2)"),
    (r"(^|[^\w:])(https?://[^\s\[\]<>]+)\[\]", r"\1<\2>"),
)


def _replaced(text: str, steps) -> str:
    for pattern, new in steps:
        text = f"regexp_replace({text}, {_quoted(pattern)}, {_quoted(new)}, 'g')"
    return text


def _prose(text: str) -> str:
    """Marks at the start of a line may be up to twelve long."""
    steps = [(f"(?m)^{'=' * n} ", "#" * n + " ") for n in range(1, 7)]
    steps += [(rf"(?m)^\*{{{n}}} +", "  " * (n - 1) + "- ") for n in range(1, 13)]
    steps += [(rf"(?m)^\.{{{n}}} +", "   " * (n - 1) + "1. ") for n in range(1, 13)]
    steps += [(r"(?m)^image::([^\s\[\]]+)\[([^\],\n]*)[^\]\n]*\][ \t]*$", r"![\2](\1)")]
    return _replaced(text, (*steps, *_REFERENCES))


def _blocks() -> str:
    """Every mark with its own alternative: these patterns have no back references."""
    marks = [(rf"-{{{n}}}", r"|\z") for n in range(4, 13)]
    marks += [(rf"{mark}{{{n}}}", "") for mark in (r"\.", "/") for n in range(4, 13)]
    marks += [(rf"\|={{{n}}}", "") for n in range(3, 13)]
    return "(?m)^(?:" + "|".join(rf"{m}[ \t]*$(?s:.*?)(?:^{m}[ \t]*${end})" for m, end in marks) + ")"


_SOURCE_LINE = _quoted(r"(?m)^\[source,[ \t]*([A-Za-z0-9_+#-]+)[^\]\n]*\]\n\z")
_TABLE_LINE = _quoted(r"(?m)^\[[^\[\]\n]*\]\n\z")
_CELL = _replaced(r"regexp_replace(trim(c, concat(' ', chr(9), chr(10))), '[ \t]*\n\s*', ' ', 'g')", _REFERENCES)
_MARKDOWN = rf"""WITH {_ADOC},
{_view("adoc_markup", views.ADOC_MARKUP_COLUMNS, "adoc_documents")},
{_adoc_cleaned("adoc_markup")},
numbered AS (SELECT doc_id, string_split_regex(text, {_quoted(_blocks())}) AS p, regexp_extract_all(text, {_quoted(_blocks())}) AS b FROM adoc_cleaned),
parts AS (SELECT doc_id, generate_subscripts(p, 1) AS i, unnest(p) AS part, unnest(list_resize(b, len(p))) AS block FROM numbered),
kinds AS (SELECT *, left(block, 1) AS kind,
  regexp_replace(regexp_replace(block, '\A[-.]+[ \t]*', ''), '\n(-+|\.+)[ \t]*\z', chr(10)) AS body,
  regexp_extract(regexp_extract(part, {_TABLE_LINE}), 'cols="([^"]*)"', 1) AS told,
  string_split(regexp_replace(regexp_replace(replace(block, concat(chr(92), '|'), chr(1)), '\A\|=+[ \t]*', ''), '\|=+[ \t]*\z', ''), '|') AS bars FROM parts),
fences AS (SELECT *, repeat('`', coalesce(list_max(list_transform(regexp_extract_all(body, '`{{3,}}'), lambda x: len(x))) + 1, 3)) AS fence,
  greatest(CASE WHEN regexp_matches(told, '^[0-9]{{1,3}}\*$') THEN CAST(rtrim(told, '*') AS INTEGER)
    WHEN told <> '' THEN len(string_split(told, ','))
    ELSE len(string_split(regexp_extract(array_to_string(bars, '|'), '[^\n]*\|[^\n]*'), '|')) - 1 END, 1) AS width,
  list_transform(bars[2:], lambda c: replace({_CELL}, chr(1), concat(chr(92), '|'))) AS cells FROM kinds),
drawn AS (SELECT *, list_transform(range(0, len(cells), width), lambda r: concat('| ', array_to_string(cells[r + 1 : r + width], ' | '), ' |')) AS lines FROM fences),
shown AS (SELECT doc_id, i, concat(
  CASE WHEN kind IN ('-', '.') THEN {_prose(f"regexp_replace(part, {_SOURCE_LINE}, '')")} WHEN kind = '|' THEN {_prose(f"regexp_replace(part, {_TABLE_LINE}, '')")} ELSE {_prose('part')} END,
  CASE WHEN kind IN ('-', '.') THEN concat(fence, regexp_extract(part, {_SOURCE_LINE}, 1), body, CASE WHEN suffix(body, chr(10)) THEN '' ELSE chr(10) END, fence)
    WHEN kind = '|' AND len(bars) < 2 THEN block
    WHEN kind = '|' THEN array_to_string(list_concat([lines[1], concat('|', repeat(' --- |', width))], lines[2:]), chr(10)) END) AS s FROM drawn)
SELECT doc_id, string_agg(s, '' ORDER BY i) AS md FROM shown GROUP BY doc_id"""


# --- question-answer rows --------------------------------------------------

_QA_RAW = f"""qa_raw AS (SELECT conv_id * 100 + turn AS qa_id, {', '.join(views.QA_CASES)}
  FROM (SELECT conv_id, turn, role, text,
      lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text,
      lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role
    FROM conversations) p
  WHERE role = 'user' AND next_role = 'assistant')"""


def _without_traces(text: str) -> str:
    either = "|".join(f"<{tag}>.*?</{tag}>" for tag in fv.REASONING_TAGS)
    return _strip(f"regexp_replace({text}, {_quoted(either)}, '', 'gs')")


_STRIPPED = (
    f"{_QA_RAW},\nstripped AS (SELECT qa_id, {_without_traces('question')} AS question,"
    f" {_without_traces('response')} AS response FROM qa_raw)"
)
_VALID = f"{_STRIPPED},\nvalid AS (SELECT * FROM stripped WHERE question <> '' AND response <> '')"


def _messages(question: str, response: str | None = None, system: str = "") -> str:
    turns = [("system", _quoted(system))] if system else []
    turns.append(("user", question))
    if response:
        turns.append(("assistant", response))
    listed = ", ".join(f"{{'role': '{role}', 'content': {content}}}" for role, content in turns)
    return f"CAST(to_json([{listed}]) AS VARCHAR)"


_EVAL = """eval_answers AS (
SELECT item_id AS question_id, 'reference' AS model, text AS question, text AS answer FROM benchmark
UNION ALL
SELECT item_id, 'tuned', text, concat('T: ', text) FROM benchmark WHERE item_id % 5 <> 4)"""

_GENERATED = """,
facts AS (SELECT chunk_id, domain, CAST(generate_subscripts(f, 1) - 1 AS INTEGER) AS fact_no, unnest(f) AS fact FROM (
  SELECT chunk_id, domain, list_filter(list_transform(string_split_regex(document, '[.!?\\n]+'), lambda s: {strip}),
    lambda s: s <> '') AS f FROM inputs)),
words AS (SELECT *, string_split(fact, ' ') AS w FROM facts)
SELECT chunk_id, fact_no, fact, 0 AS qa_no,
  concat('What does the ', domain, ' documentation say about: ', array_to_string(w[1:3], ' '), '?') AS question, fact AS response FROM words
UNION ALL
SELECT chunk_id, fact_no, fact, 1, concat('How many words has the statement: ', fact, '?'), CAST(len(w) AS VARCHAR) FROM words"""


def oracle_sql() -> dict[str, str]:
    words = ", ".join(
        f"CAST(sum(CAST(concat('0x', substring(h, {8 * i + 1}, 8)) AS BIGINT)) AS VARCHAR)" for i in range(8)
    )
    generated = _with_inputs("", more=_GENERATED.replace("{strip}", _strip("s")))
    ext = r"lower(regexp_extract(path, '(\.[^./]*)$', 1))"
    text_with_crlf = "replace(text, chr(13), '')"
    batches = f", numbered AS (SELECT *, (row_number() OVER (ORDER BY doc_id, pos) - 1) AS idx FROM inputs), batches AS (SELECT *, idx // {fv.BATCH_SIZE} AS batch_no FROM numbered)"
    side = """CASE WHEN base_answer IS NULL AND tuned_answer IS NULL THEN 'both' WHEN base_answer IS NULL THEN 'base'
      WHEN tuned_answer IS NULL THEN 'tuned' ELSE 'none' END AS missing_side"""
    return {
        "clean_technical": f"WITH {_MD},\n{_CLEANED} SELECT doc_id, md FROM cleaned",
        "clean_technical_strict": f"WITH {_MD} SELECT doc_id, {_clean('md', strict=True)} AS md FROM md_documents",
        "split_sections": f"""WITH {_MD},\n{_CLEANED}, section_lists AS (SELECT doc_id, {_SECTION_LIST} AS secs FROM cleaned)
SELECT doc_id, CAST(generate_subscripts(secs, 1) - 1 AS INTEGER) AS pos, unnest(secs) AS section FROM section_lists""",
        "chunk_documents": _with_chunks("SELECT doc_id, source, pos, chunk FROM chunks"),
        "chunk_documents_small": _with_chunks("SELECT doc_id, pos, chunk FROM chunks", max_chars=300),
        "chunks_per_document": _with_chunks(
            "SELECT doc_id, source, CAST(len(chunks) AS INTEGER) AS n_chunks FROM chunk_lists"
        ),
        "chunk_counts": _with_chunks(
            "SELECT count(*) AS n_chunks, count(DISTINCT chunk) AS n_distinct,"
            " count(*) - count(DISTINCT chunk) AS n_duplicates FROM chunks"
        ),
        "dedup_chunks": _with_inputs("SELECT doc_id, pos, document, document_outline, domain FROM inputs"),
        "source_metadata": _with_chunks(
            "SELECT c.doc_id, pos, chunk AS document, coalesce(document_outline, '') AS document_outline,"
            " coalesce(domain, 'General') AS domain FROM chunks c LEFT JOIN metadata m ON c.source = m.source",
            more=", metadata AS (SELECT source, concat('About ', source) AS document_outline, min(lang) AS domain"
            " FROM documents WHERE source <> 'src7' GROUP BY source)",
        ),
        "fingerprints": "SELECT doc_id, substring(sha256(text), 1, 12) AS fingerprint FROM documents",
        "corpus_fingerprint": f"""SELECT count(*) AS n_docs,
  substring(sha256(concat_ws(':', CAST(count(*) AS VARCHAR), {words})), 1, 12) AS fingerprint
FROM (SELECT sha256(text) AS h FROM documents)""",
        "adoc_attributes": f"WITH {_ADOC},\n{_attributes('adoc_documents')} SELECT doc_id, ord, name, value FROM attributes",
        "adoc_attributes_across_lines": f"WITH {_ADOC},\n{_attributes('adoc_documents', fv.ATTRIBUTE_ACROSS_LINES)}"
        " SELECT doc_id, ord, name, value FROM attributes",
        "adoc_clean": f"WITH {_ADOC},\n{_adoc_cleaned('adoc_documents')} SELECT doc_id, text FROM adoc_cleaned",
        "adoc_clean_shared": f"WITH {_ADOC},\n{_adoc_cleaned('adoc_shared', _shared_attributes())} SELECT doc_id, text FROM adoc_cleaned",
        "adoc_to_markdown": _MARKDOWN,
        "source_status": f"""WITH {_ADOC} SELECT doc_id, path, {ext} AS ext,
  CASE WHEN {ext} IN ('.adoc', '.pdf') THEN 'supported' ELSE 'unsupported' END AS status FROM adoc_documents""",
        "decode_documents": f"""WITH {_ADOC} SELECT doc_id,
  CASE WHEN doc_id % 50 <> 7 THEN {text_with_crlf} END AS text,
  CASE WHEN doc_id % 50 = 7 THEN 'not valid UTF-8' END AS error FROM adoc_documents""",
        "discover_documents": f"""WITH {_ADOC}, tree AS (SELECT {views.TREE_PATH}, text,
  doc_id % 6 = 2 OR doc_id % 5 = 1 AS hidden, doc_id % 10 IN (7, 9) AS other FROM adoc_documents)
SELECT path, CASE WHEN hidden THEN 'hidden' WHEN other THEN 'unsupported' ELSE 'supported' END AS status,
  octet_length(encode(text)) AS length, CASE WHEN NOT hidden AND NOT other THEN sha256(text) END AS content_sha256 FROM tree""",
        "conversion_report": f"""WITH {_ADOC} SELECT {ext} AS ext,
  CASE WHEN {ext} = '.adoc' AND doc_id % 50 <> 7 THEN 'converted' ELSE 'failed' END AS status, count(*) AS n_docs
FROM adoc_documents GROUP BY 1, 2""",
        "merge_corpus": f"WITH {_MD},\n{_MERGED} SELECT source, part, n_docs, md FROM merged",
        "merged_chunks": f"""WITH {_MD},
merged AS (SELECT source, string_agg(md, concat(chr(10), chr(10), '---', chr(10), chr(10)) ORDER BY doc_id) AS md
  FROM md_documents GROUP BY source),
cleaned AS (SELECT row_number() OVER (ORDER BY source) AS doc_id, source, {_clean('md')} AS md FROM merged),
{_chunk_lists(fv.MAX_CHUNK_CHARS)}
SELECT source, CAST(pos AS BIGINT) AS pos, chunk FROM chunks""",
        "last_per_basename": f"""WITH {_view("named", views.NAMED_COLUMNS)},
ordered AS (SELECT *, regexp_replace(regexp_extract(path, '[^/]*$'), '\\.adoc$', '') AS base_name FROM named),
ranked AS (SELECT *, row_number() OVER (PARTITION BY base_name ORDER BY path DESC, doc_id DESC) AS rn FROM ordered)
SELECT base_name, doc_id, path, md FROM ranked WHERE rn = 1""",
        "generate_qa": generated,
        "resumable_generation": generated,
        "batch_plan": _with_inputs(
            "SELECT batch_no, min(idx) + 1 AS first_chunk, max(idx) + 1 AS last_chunk, count(*) AS n_chunks,"
            " min(doc_id) AS first_doc_id, max(doc_id) AS last_doc_id FROM batches GROUP BY batch_no",
            more=batches,
        ),
        "resume_pending": _with_inputs("SELECT chunk_id, doc_id, pos FROM inputs WHERE doc_id % 2 <> 0"),
        "generation_progress": _with_inputs(
            "SELECT count(DISTINCT batch_no) FILTER (WHERE batch_no % 2 = 0) AS batches_done,"
            " max(batch_no) FILTER (WHERE batch_no % 2 = 0) AS last_batch,"
            " count(*) FILTER (WHERE batch_no % 2 = 0) AS chunks_done, count(*) AS chunks_total FROM batches",
            more=batches,
        ),
        "strip_traces": f"WITH {_STRIPPED} SELECT qa_id, question, response FROM stripped",
        "valid_qa": f"WITH {_VALID} SELECT qa_id, question, response FROM valid",
        "qa_counts": f"""WITH {_STRIPPED} SELECT count(*) AS n_rows,
  count(*) FILTER (WHERE question <> '' AND response <> '') AS n_valid FROM stripped""",
        "chat_messages": f"WITH {_VALID} SELECT qa_id, {_messages('question', 'response', SYSTEM_PROMPT)} AS messages FROM valid",
        "chat_messages_no_system": f"WITH {_VALID} SELECT qa_id, {_messages('question', 'response')} AS messages FROM valid",
        "jsonl_round_trip": f"WITH {_VALID} SELECT {_messages('question', 'response', SYSTEM_PROMPT)} AS messages FROM valid",
        "csv_round_trip": f"WITH {_STRIPPED} SELECT qa_id, nullif(question, '') AS question, nullif(response, '') AS response FROM stripped",
        "prompt_messages": f"SELECT item_id, {_messages('text', system=SYSTEM_PROMPT)} AS messages FROM benchmark",
        "side_by_side": f"""WITH {_EVAL} SELECT *, {side} FROM (SELECT question_id, coalesce(b.question, t.question) AS question,
  b.answer AS base_answer, t.answer AS tuned_answer
FROM (SELECT * FROM eval_answers WHERE model = 'reference') b
FULL JOIN (SELECT * FROM eval_answers WHERE model = 'tuned') t USING (question_id))""",
        "join_answers": f"""WITH {_EVAL} SELECT *, {side} FROM (SELECT question_id, max(question) AS question,
  max(answer) FILTER (WHERE model = 'reference' AND question_id % 6 <> 1) AS base_answer,
  max(answer) FILTER (WHERE model = 'tuned') AS tuned_answer
FROM eval_answers WHERE model = 'tuned' OR question_id % 6 <> 1 GROUP BY question_id)""",
        "resolve_models": f"""WITH {_view("configs", views.CONFIG_COLUMNS)} SELECT doc_id,
  coalesce(nullif(override, ''), json_extract_string(config, '$.base_model_name_or_path')) AS base_model FROM configs""",
    }
