"""DuckDB SQL for the rows of the registered queries.

Four corpora have one header level each, and code and tables in different ones, which their SQL may rely on. The nested one
has three levels, code and tables together; its SQL states what its lines and blocks are from the tables it is made of.
"""

from __future__ import annotations

from blockloom.sources.corpora import corpus_sql

WS = r"[\s\x{85}\p{Z}\x{1c}-\x{1f}]"
MAX = 450


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def lines(*names: str) -> str:
    """CTEs docs, l (lines) and c (classified lines)."""
    docs = " UNION ALL ".join(f"({corpus_sql(n, 'duckdb')})" for n in names)
    return f"""
    docs AS ({docs}),
    parts AS (SELECT file_path, string_split(regexp_replace(text, '\\r\\n?', chr(10), 'g'), chr(10)) AS p FROM docs),
    each AS (SELECT file_path, len(p) AS n, unnest(p) AS part, unnest(range(0, len(p))) AS idx FROM parts),
    l AS (SELECT file_path, idx, part || CASE WHEN idx < n - 1 THEN chr(10) ELSE '' END AS text FROM each WHERE NOT (idx = n - 1 AND part = '')),
    s AS (SELECT *, {strip("text")} AS st FROM l),
    c AS (SELECT file_path, idx, text, st,
        CASE WHEN regexp_matches(text, '^{WS}*(`{{3,}}|~{{3,}})') THEN 'fence' WHEN regexp_matches(st, '^#{{1,6}}{WS}+') THEN 'header'
             WHEN regexp_matches(st, '^#[^#\\s\\x{{85}}\\p{{Z}}\\x{{1c}}-\\x{{1f}}]+$') THEN 'tag' WHEN regexp_matches(st, '^(\\|[^\\n]*)\\|$') THEN 'table' ELSE 'text' END AS kind FROM s),
    h AS (SELECT *, CASE WHEN kind = 'header' THEN len(regexp_extract(st, '^(#{{1,6}})', 1)) ELSE 0 END AS header_level,
        CASE WHEN kind = 'header' THEN {strip(f"regexp_extract(st, '^#{{1,6}}{WS}+(.*)$', 1, 's')")} ELSE st END AS clean FROM c)"""


def tags() -> str:
    """CTE t over h: parsed tags."""
    return """
    raw AS (SELECT file_path, idx, CASE WHEN starts_with(st, '#?') THEN '#seed/' || substring(st, 3) ELSE st END AS original_text FROM h WHERE kind = 'tag'),
    t AS (SELECT file_path, idx, original_text, CASE WHEN contains(original_text, '/') THEN substring(split_part(original_text, '/', 1), 2) ELSE 'topic' END AS tag_key,
        CASE WHEN contains(original_text, '/') THEN substring(original_text, position('/' IN original_text) + 1) ELSE substring(original_text, 2) END AS tag_value FROM raw)"""


def state(*names: str) -> str:
    """CTEs up to e: lines with section, title, code parity, events and segments."""
    upto = "OVER (PARTITION BY file_path ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    before = "OVER (PARTITION BY file_path ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""{lines(*names)},
    a AS (SELECT *, (count(*) FILTER (kind = 'header') {upto})::BIGINT AS sec, coalesce(last_value(CASE WHEN kind = 'header' THEN header_level END IGNORE NULLS) {upto}, 0)::BIGINT AS lvl,
        last_value(CASE WHEN kind = 'header' THEN clean END IGNORE NULLS) {upto} AS heading, coalesce((count(*) FILTER (kind = 'fence') {before}) % 2 = 1, false) AS in_code,
        kind = 'table' AND coalesce(lag(kind) OVER (PARTITION BY file_path ORDER BY idx), '') <> 'table' AS run_start FROM h),
    b AS (SELECT *, CASE WHEN lvl = 0 THEN '' ELSE repeat('null/', lvl - 1) || heading END AS title, kind = 'fence' AND NOT in_code AS opens,
        kind = 'header' OR (kind = 'text' AND NOT in_code) AS buf FROM a),
    e AS (SELECT *, (count(*) FILTER (kind = 'header' OR opens OR run_start) {upto})::BIGINT AS seg, last_value(CASE WHEN opens THEN idx END IGNORE NULLS) {upto} AS gid,
        last_value(CASE WHEN run_start THEN idx END IGNORE NULLS) {upto} AS run_id FROM b)"""


def pieces(*names: str) -> str:
    """CTEs up to piece: the overflow fold as a recursion over row numbers, all segments at once."""
    return f"""{state(*names)},
    r AS (SELECT file_path, seg, sec, title, idx, text, len(text) AS n, kind = 'header' AS head, {strip("text")} = '' AS blank, row_number() OVER (PARTITION BY file_path, seg ORDER BY idx) - 1 AS j FROM e WHERE buf),
    fold AS (
        SELECT DISTINCT file_path, seg, -1::BIGINT AS j, 0::BIGINT AS acc, 0::BIGINT AS start, 0::BIGINT AS full_rows, false AS over, false AS alone, 0::BIGINT AS a FROM r
        UNION ALL
        SELECT r.file_path, r.seg, r.j, CASE WHEN NOT (NOT head AND acc + n > {MAX}) THEN acc + n WHEN n > {MAX} THEN 0 ELSE n END,
            CASE WHEN NOT (NOT head AND acc + n > {MAX}) THEN start WHEN n > {MAX} THEN r.j + 1 ELSE r.j END,
            CASE WHEN NOT (NOT head AND acc + n > {MAX}) THEN full_rows ELSE 0 END + CASE WHEN blank OR (NOT head AND acc + n > {MAX} AND n > {MAX}) THEN 0 ELSE 1 END,
            NOT head AND acc + n > {MAX}, NOT head AND acc + n > {MAX} AND n > {MAX} AND full_rows > 0, start
        FROM fold JOIN r ON r.file_path = fold.file_path AND r.seg = fold.seg AND r.j = fold.j + 1),
    done AS (SELECT file_path, seg, max(j) AS j, arg_max(start, j) AS start FROM fold GROUP BY ALL),
    piece AS (SELECT file_path, seg, a AS first_row, j AS last_row, true AS overflowed FROM fold WHERE over UNION ALL SELECT file_path, seg, j, j, true FROM fold WHERE alone
        UNION ALL SELECT file_path, seg, start, j, false FROM done WHERE start <= j)"""


def text_blocks(*names: str) -> str:
    """CTEs up to blk: text blocks with their tags and flags."""
    return f"""{pieces(*names)},{tags()},
    flush AS (SELECT file_path, seg, max(idx) + 1 AS fl FROM e GROUP BY ALL),
    place AS (SELECT p.*, CASE WHEN overflowed THEN x.idx ELSE fl END AS fl, x.sec, x.title FROM piece p JOIN r x ON x.file_path = p.file_path AND x.seg = p.seg AND x.j = p.last_row JOIN flush f ON f.file_path = p.file_path AND f.seg = p.seg),
    edge AS (SELECT place.file_path, place.seg, first_row, last_row, overflowed, fl, place.sec, place.title, min(idx) AS s0, max(idx) AS e0 FROM place JOIN r ON r.file_path = place.file_path AND r.seg = place.seg AND r.j BETWEEN first_row AND last_row WHERE NOT blank GROUP BY ALL),
    body AS (SELECT edge.file_path, edge.seg, first_row, fl, edge.sec, edge.title, s0, e0, {strip("string_agg(r.text, '' ORDER BY r.j)")} AS content FROM edge JOIN r ON r.file_path = edge.file_path AND r.seg = edge.seg AND r.idx BETWEEN s0 AND e0 AND r.j BETWEEN first_row AND last_row GROUP BY ALL),
    kept AS (SELECT * FROM body WHERE len(list_filter(string_split(content, chr(10)), lambda x: NOT regexp_matches({strip("x")}, '^#{{1,6}} '))) > 0),
    tsec AS (SELECT t.*, e.sec FROM t JOIN e USING (file_path, idx)),
    tagged AS (SELECT k.file_path, k.seg, k.first_row, k.fl, string_agg(tag_key || '=' || tag_value, ';' ORDER BY t.sec, t.idx) AS tl FROM kept k JOIN tsec t ON t.file_path = k.file_path AND t.idx < k.fl AND t.sec IN (0, k.sec) GROUP BY ALL),
    cut AS (SELECT file_path, sec, min(fl) AS first_cut FROM place WHERE overflowed GROUP BY ALL),
    blk AS (SELECT k.file_path, row_number() OVER (PARTITION BY k.file_path ORDER BY k.fl, k.first_row, s0) AS block_seq, md5(k.file_path || '_' || s0 || '_' || e0 || '_' || substring(md5(content), 1, 16)) AS block_id, content,
        (s0 + 1)::BIGINT AS start_line, (e0 + 1)::BIGINT AS end_line, coalesce(tl || ';', '') || 'file_path=' || k.file_path || CASE WHEN title <> '' THEN ';title=' || title ELSE '' END AS tags,
        coalesce(first_cut <= k.fl, false) AS is_splited, '' AS element, false AS protected_element_overlength, title
        FROM kept k LEFT JOIN tagged USING (file_path, seg, first_row, fl) LEFT JOIN cut ON cut.file_path = k.file_path AND cut.sec = k.sec)"""


def chunked(source: str, key: str, limit: int, table: bool) -> str:
    """CTEs up to chunk: greedy chunks of whole lines of `source` (key, content); tables repeat their first two lines."""
    head = 2 if table else 0
    return f"""
    ln AS (SELECT {key}, string_split(content, chr(10)) AS x FROM {source}),
    row_ AS (SELECT {key}, unnest(x) AS y, unnest(range(0, len(x))) AS j FROM ln),
    hd AS (SELECT {key}, list_slice(x, 1, {head}) AS top, coalesce(list_sum(list_transform(list_slice(x, 1, {head}), lambda v: len(v) + 1)), 0)::BIGINT AS cost, len(x) AS n FROM ln),
    cf AS (SELECT {key}, {head - 1}::BIGINT AS j, cost::BIGINT AS acc, 0::BIGINT AS k, 0::BIGINT AS i FROM hd
        UNION ALL SELECT cf.{key}, row_.j, CASE WHEN k > 0 AND acc + len(y) + 1 > {limit} THEN cost ELSE acc END + len(y) + 1, CASE WHEN k > 0 AND acc + len(y) + 1 > {limit} THEN 1 ELSE k + 1 END, CASE WHEN k > 0 AND acc + len(y) + 1 > {limit} THEN i + 1 ELSE i END
        FROM cf JOIN row_ ON row_.{key} = cf.{key} AND row_.j = cf.j + 1 JOIN hd ON hd.{key} = cf.{key}),
    own AS (SELECT cf.{key}, cf.i, list(y ORDER BY cf.j) AS ys FROM cf JOIN row_ ON row_.{key} = cf.{key} AND row_.j = cf.j WHERE cf.j >= {head} GROUP BY ALL),
    chunk AS (SELECT {key}, i, array_to_string(list_concat(top, ys), chr(10)) AS chunk FROM own JOIN hd USING ({key}) UNION ALL SELECT {key}, 0, array_to_string(top, chr(10)) FROM hd WHERE n <= {head} AND {head} > 0)"""


def ranges(first: str, last: str) -> str:
    """CTE rng over chunk joined with whole (key, content, first, last): estimated line ranges."""
    total, share = f"({last} - {first} + 1)", f"greatest(1, trunc(({last} - {first} + 1) * (len(chunk) / len(content)))::BIGINT)"
    start = f"({first} + trunc(({total} - {share}) * i / n)::BIGINT)"
    return f"CASE WHEN n = 1 THEN {first} ELSE {start} END AS start_line, CASE WHEN n = 1 OR i = n - 1 THEN {last} ELSE {start} + {share} - 1 END AS end_line"


TABLES = f"""run AS (SELECT file_path, run_id, min(idx) AS first, max(idx) AS last, {strip("string_agg(text, '' ORDER BY idx)")} AS content, sum(len(text)) AS size, any_value(title) AS title FROM e WHERE kind = 'table' GROUP BY ALL)"""
BLOCK = "file_path, block_id, content, start_line, end_line, tags, is_splited, element, protected_element_overlength"
TOKENS = r"greatest(1, trunc(len(regexp_replace(coalesce(text, ''), '[^\x{4e00}-\x{9fff}]', '', 'g')) * 1.3::DOUBLE + (len(coalesce(text, '')) - len(regexp_replace(coalesce(text, ''), '[^\x{4e00}-\x{9fff}]', '', 'g'))) * 0.25::DOUBLE)::BIGINT)"
TURNS = f"turns AS (SELECT conv_id::VARCHAR AS conv, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS block_seq, {TOKENS} AS tokens FROM conversations)"
CONV, W = "conversations", "WITH RECURSIVE"

NESTED = """ent AS (SELECT c_custkey, max(c_mktsegment) OVER (PARTITION BY c_custkey) AS seg, o_orderstatus AS st, o_orderkey AS ok, row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey) - 1 AS k,
        count(*) OVER (PARTITION BY c_custkey) AS n, 'cust/' || c_custkey || '.md' AS file_path, 'customer ' || c_custkey AS t1 FROM customer JOIN orders ON o_custkey = c_custkey),
    ln AS (SELECT *, 3 + 13 * k + o AS idx FROM (SELECT *, unnest(range(0, CASE WHEN k < n - 1 THEN 13 ELSE 12 END)) AS o FROM ent))"""


def nested_block(first: int, last: int, content: str, depth: int, split: bool, element: str = "") -> str:
    """One kind of block of each entry: its lines, content, number of headings above it."""
    shift = 1 if element else 0
    title = "t1 || '/status ' || st" + (" || '/order ' || ok" if depth == 3 else "")
    tags = "'segment=' || seg || ';state=' || st" + (" || ';seed=order/' || ok" if depth == 3 else "")
    at = lambda o: f"(3 + 13 * k + {o})"
    return f"""SELECT file_path, {at(first)} AS place, md5(file_path || '_' || ({at(first)} + {shift}) || '_' || ({at(last)} + {shift}) || '_' || substring(md5({content}), 1, 16)) AS block_id, {content} AS content,
        ({at(first)} + 1)::BIGINT AS start_line, ({at(last)} + 1)::BIGINT AS end_line, {tags} || ';file_path=' || file_path || ';title=' || {title} AS tags, {"true" if split else "false"} AS is_splited, '{element}' AS element FROM ent"""


NL = " || chr(10) || "
NESTED_BLOCKS = " UNION ALL ".join(
    [
        nested_block(0, 2, f"'## status ' || st{NL}'between'", 2, False),
        nested_block(5, 7, f"'| key |'{NL}'|---|'{NL}'| ' || ok || ' |'", 3, True, "table"),
        nested_block(8, 10, f"'```'{NL}'code'{NL}'```'", 3, True, "code"),
        nested_block(11, 11, "'after'", 3, True),
        f"""SELECT DISTINCT file_path, 0, md5(file_path || '_0_2_' || substring(md5('# ' || t1{NL}'about'), 1, 16)), '# ' || t1{NL}'about', 1, 3, 'segment=' || seg || ';file_path=' || file_path || ';title=' || t1, false, '' FROM ent""",
    ]
)

ORACLE: dict[str, str] = {
    "nested_titles": f"""WITH {NESTED} SELECT file_path, idx, CASE WHEN o < 3 THEN 2 + 2 * k ELSE 3 + 2 * k END AS sec, CASE WHEN o < 3 THEN 2 ELSE 3 END::BIGINT AS lvl, t1 || '/status ' || st || CASE WHEN o < 3 THEN '' ELSE '/order ' || ok END AS title FROM ln
        UNION ALL SELECT file_path, unnest(range(0, 3)), 1, 1, t1 FROM (SELECT DISTINCT file_path, t1 FROM ent)""",
    "nested_tags": f"""WITH {NESTED} SELECT file_path, idx, 'segment=' || seg || ';state=' || st || CASE WHEN o < 5 THEN '' ELSE ';seed=order/' || ok END AS tags FROM ln WHERE o NOT IN (0, 1, 3, 4)
        UNION ALL SELECT DISTINCT file_path, 2, 'segment=' || seg FROM ent""",
    "nested_blocks": f"""WITH {NESTED}, b AS ({NESTED_BLOCKS}) SELECT file_path, row_number() OVER (PARTITION BY file_path ORDER BY place) AS block_seq, block_id, content, start_line, end_line, tags, is_splited, element, false AS protected_element_overlength FROM b""",
    "lines": f"{W} {lines(CONV)} SELECT file_path, idx::BIGINT AS idx, text FROM l",
    "row_classify": f"{W} {lines(CONV, 'orders', 'pages')} SELECT file_path, idx::BIGINT AS idx, kind, header_level::BIGINT AS header_level FROM h",
    "row_kind_counts": f"{W} {lines(CONV, 'orders', 'pages', 'documents')} SELECT kind, count(*) AS n, sum(len(text))::BIGINT AS chars FROM h GROUP BY kind",
    "headers": f"{W} {lines(CONV, 'orders')} SELECT file_path, idx::BIGINT AS idx, header_level::BIGINT AS level, clean AS heading FROM h WHERE kind = 'header'",
    "tags_parsed": f"{W} {lines(CONV, 'orders', 'documents')},{tags()} SELECT file_path, idx::BIGINT AS idx, tag_key, tag_value, original_text FROM t",
    "tags_excluded": f"{W} {lines(CONV)},{tags()} SELECT count(*) FILTER (starts_with(original_text, '#role/')) AS excluded, count(*) FILTER (NOT starts_with(original_text, '#role/')) AS kept FROM t",
    "heading_path": f"{W} {state(CONV, 'orders')} SELECT file_path, idx::BIGINT AS idx, sec, lvl, title FROM e",
    "active_tags": f"""{W} {state(CONV, "orders")},{tags()}, tsec AS (SELECT t.*, e.sec FROM t JOIN e USING (file_path, idx))
        SELECT e.file_path, e.idx::BIGINT AS idx, coalesce(string_agg(tag_key || '=' || tag_value, ';' ORDER BY tsec.sec, tsec.idx), '') AS tags
        FROM e LEFT JOIN tsec ON tsec.file_path = e.file_path AND tsec.idx < e.idx AND tsec.sec IN (0, e.sec) WHERE e.kind NOT IN ('tag', 'header') GROUP BY e.file_path, e.idx""",
    "table_runs": f"{W} {state('orders')} SELECT file_path, run_id::BIGINT AS run_id, count(*) AS n_rows, max(idx)::BIGINT AS last_line FROM e WHERE kind = 'table' GROUP BY ALL",
    "code_groups": f"{W} {state('pages')} SELECT file_path, gid::BIGINT AS gid, count(*) AS n_rows, sum(len(text))::BIGINT AS chars FROM e WHERE kind = 'fence' OR (kind = 'text' AND in_code) GROUP BY ALL",
    "segments": f"{W} {state(CONV, 'orders', 'pages')} SELECT file_path, seg, count(*) AS n_rows, sum(len(text))::BIGINT AS chars, min(idx)::BIGINT AS first_line FROM e WHERE buf GROUP BY ALL",
    "text_overflow_pieces": f"{W} {pieces(CONV, 'documents')} SELECT file_path, seg, first_row, last_row, overflowed FROM piece",
    "code_chunks": f"{W} src AS (SELECT page_id, coalesce(html, '') AS content FROM pages), {chunked('src', 'page_id', 450, False)} SELECT page_id, i, chunk FROM chunk",
    "table_chunks": f"{W} {state('orders')}, {TABLES}, {chunked('run', 'file_path', 80, True)} SELECT file_path, i, chunk FROM chunk",
    "generic_chunks": """WITH RECURSIVE g AS (
        SELECT doc_id, coalesce(text, '') AS t, 0::BIGINT AS s, 0::BIGINT AS e FROM documents
        UNION ALL SELECT doc_id, t, e, CASE WHEN e + 400 >= len(t) THEN len(t) WHEN nl > 280 THEN e + nl WHEN sp > 280 THEN e + sp ELSE e + 400 END
        FROM (SELECT *, CASE WHEN position(chr(10) IN w) = 0 THEN -1 ELSE len(w) - position(chr(10) IN w) END AS nl, CASE WHEN position(' ' IN w) = 0 THEN -1 ELSE len(w) - position(' ' IN w) END AS sp
              FROM (SELECT *, reverse(array_to_string(string_split(substring(t, e + 1, 400), ''), '')) AS w FROM g WHERE e < len(t)))),
        """
    + f"""p AS (SELECT doc_id, s, CASE WHEN len(t) <= 400 THEN t ELSE {strip("substring(t, s + 1, e - s)")} END AS chunk, len(t) AS n FROM g WHERE e > 0)
        SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1)::BIGINT AS i, md5(chunk) AS chunk_md5, len(chunk)::BIGINT AS chars FROM (SELECT doc_id, s, chunk FROM p WHERE chunk <> '' UNION ALL SELECT doc_id, 0, '' FROM documents WHERE coalesce(text, '') = '')""",
    "subchunk_line_ranges": f"""{W} {state("orders")}, {TABLES}, {chunked("run", "file_path", 80, True)},
        every AS (SELECT chunk.*, run.content, run.first + 1 AS f, run.last + 1 AS z, count(*) OVER (PARTITION BY file_path) AS n FROM chunk JOIN run USING (file_path)) SELECT file_path, i, {ranges("f", "z")} FROM every""",
    "blocks_all": f"{W} {text_blocks(CONV)} SELECT {BLOCK}, block_seq FROM blk",
    "blocks_text": f"{W} {text_blocks('documents')} SELECT {BLOCK} FROM blk",
    "blocks_protected": f"""{W} {state("orders")}, {TABLES},{tags()}, long AS (SELECT file_path, content FROM run WHERE size > {MAX}), {chunked("long", "file_path", MAX, True)},
        tl AS (SELECT file_path, string_agg(tag_key || '=' || tag_value, ';' ORDER BY idx) || ';' AS tl FROM t GROUP BY file_path),
        every AS (SELECT file_path, i, chunk, count(*) OVER (PARTITION BY file_path) AS n, true AS cut FROM chunk UNION ALL SELECT file_path, 0, content, 1, false FROM run WHERE size <= {MAX}),
        full_ AS (SELECT every.*, run.content, run.first + 1 AS f, run.last + 1 AS z, title, tl FROM every JOIN run USING (file_path) LEFT JOIN tl USING (file_path))
        SELECT file_path, md5(file_path || '_' || f || '_' || z || '_' || substring(md5(content), 1, 16)) || CASE WHEN cut THEN '_' || printf('%03d', i + 1) ELSE '' END AS block_id, chunk AS content, {ranges("f", "z")},
            coalesce(tl, '') || 'file_path=' || file_path || ';title=' || title AS tags, true AS is_splited, 'table' AS element, false AS protected_element_overlength FROM full_""",
    "blocks_code": f"""{W} {state("pages")},
        code AS (SELECT file_path, gid, min(idx) + 1 AS f, max(idx) + 1 AS z, {strip("string_agg(text, '' ORDER BY idx)")} AS content, sum(len(text)) AS size, any_value(title) AS title FROM e WHERE kind = 'fence' OR (kind = 'text' AND in_code) GROUP BY ALL),
        long AS (SELECT file_path, content FROM code WHERE size > {MAX}), {chunked("long", "file_path", MAX, False)},
        every AS (SELECT file_path, i, chunk, count(*) OVER (PARTITION BY file_path) AS n, true AS cut FROM chunk UNION ALL SELECT file_path, 0, content, 1, false FROM code WHERE size <= {MAX}),
        full_ AS (SELECT every.*, content, f, z, title FROM every JOIN code USING (file_path))
        SELECT file_path, md5(file_path || '_' || f || '_' || z || '_' || substring(md5(content), 1, 16)) || CASE WHEN cut THEN '_' || printf('%03d', i + 1) ELSE '' END AS block_id, chunk AS content, {ranges("f", "z")},
            'file_path=' || file_path || ';title=' || title AS tags, true AS is_splited, 'code' AS element, false AS protected_element_overlength FROM full_
        UNION ALL SELECT file_path, md5(file_path || '_' || idx || '_' || idx || '_' || substring(md5('end'), 1, 16)), 'end', idx + 1, idx + 1, 'file_path=' || file_path || ';title=' || title, true, '', false FROM e WHERE kind = 'text' AND NOT in_code AND st = 'end'""",
    "heading_only_discarded": "SELECT count(DISTINCT l_orderkey) AS discarded, count(DISTINCT l_orderkey) AS kept FROM orders JOIN lineitem ON o_orderkey = l_orderkey",
    "split_flags": f"{W} {text_blocks(CONV)} SELECT file_path, is_splited, count(*) AS n FROM blk GROUP BY ALL",
    "block_ids": f"{W} {text_blocks(CONV)} SELECT file_path, block_id FROM blk",
    "augmented_text": f"{W} {text_blocks(CONV)}, g AS (SELECT block_id, replace(replace(tags, '=', ': '), ';', ' ') || ' ' || content AS x FROM blk) SELECT block_id, md5(x) AS text_md5, len(x)::BIGINT AS chars FROM g",
    "metadata_flat": f"""{W} {text_blocks(CONV)}, kv AS (SELECT block_id, unnest(string_split(tags, ';')) AS x, unnest(range(0, len(string_split(tags, ';')))) AS i FROM blk)
        SELECT block_id, 'tag_' || split_part(x, '=', 1) AS meta_key, arg_max(substring(x, position('=' IN x) + 1), i) AS meta_value FROM kv GROUP BY block_id, split_part(x, '=', 1)""",
    "token_estimate": f"SELECT doc_id, {TOKENS} AS tokens FROM documents",
    "request_batches": f"""{W} {TURNS}, f AS (SELECT conv, block_seq, CASE WHEN tokens > 200 THEN 0 ELSE 1 END::BIGINT AS n, CASE WHEN tokens > 200 THEN 0 ELSE tokens END::BIGINT AS acc, 0::BIGINT AS request FROM turns WHERE block_seq = 1
        UNION ALL SELECT t.conv, t.block_seq, CASE WHEN tokens > 200 THEN 0 WHEN n = 0 OR n >= 4 OR acc + tokens > 200 THEN 1 ELSE n + 1 END, CASE WHEN tokens > 200 THEN 0 WHEN n = 0 OR n >= 4 OR acc + tokens > 200 THEN tokens ELSE acc + tokens END,
            CASE WHEN tokens > 200 OR n = 0 OR n >= 4 OR acc + tokens > 200 THEN request + 1 ELSE request END FROM f JOIN turns t ON t.conv = f.conv AND t.block_seq = f.block_seq + 1)
        SELECT conv, block_seq, request FROM f""",
    "outer_batches": f"WITH {TURNS} SELECT conv, ((block_seq - 1) // 4)::BIGINT AS batch, count(*) AS n FROM turns GROUP BY ALL",
    "embed_status": "SELECT count(*) AS success, 0::BIGINT AS failure, 0::BIGINT AS n_failed_ids FROM conversations",
    "dimension_check": "SELECT len(embedding)::BIGINT AS dimension, count(*) AS n, count(*) FILTER (len(embedding) = 64) AS fits FROM embeddings GROUP BY ALL",
    "store_append": "SELECT count(DISTINCT vec_id) AS added, min(vec_id)::BIGINT AS first_id FROM embeddings WHERE vec_id >= (SELECT max(vec_id) * 0.75 FROM embeddings)",
    "cosine_topk": """SELECT query_id, vec_id, round(s, 6) AS score, rank FROM (SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(v.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS s,
        row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(v.embedding::DOUBLE[], q.embedding::DOUBLE[]) DESC, v.vec_id) AS rank FROM embeddings v, embeddings q WHERE q.vec_id % 50 = 0) WHERE rank <= 5""",
    "rate_window": """SELECT event_id, count(*) OVER w AS rpm, (sum(floor(abs(value))::BIGINT) OVER w)::BIGINT AS tpm, epoch_us(min(ts) OVER w) AS oldest FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING AND CURRENT ROW)""",
    "tag_key_counts": f"{W} {text_blocks(CONV)}, kv AS (SELECT unnest(string_split(tags, ';')) AS x FROM blk) SELECT split_part(x, '=', 1) AS tag_key, count(*) AS n, count(DISTINCT substring(x, position('=' IN x) + 1)) AS n_values FROM kv GROUP BY 1",
    "block_stats": f"{W} {text_blocks(CONV)} SELECT file_path, count(*) AS n_blocks, sum(len(content))::BIGINT AS chars, count(*) FILTER (is_splited) AS n_split FROM blk GROUP BY file_path",
}
