"""SQL with the results of the q_ queries, written independently of the expressions it checks."""

from __future__ import annotations

from corpusloom.functions import chunks, hosts, prompts, signals, titles
from corpusloom.operators import planning


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(xs) -> str:
    return "[" + ", ".join(map(_text, xs)) + "]"


_SPACE = "[\\s\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{85}\\x{0B}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


def _fold(x: str) -> str:
    return f"translate(replace(lower(replace({x}, 'İ', 'i̇')), 'ß', 'ss'), 'ςſ', 'σs')"


def _keep(x: str) -> str:
    return f"""coalesce({_strip(x)} <> '' AND NOT (contains({x}, ':') AND list_contains({_list(titles.BLOCKED_NAMESPACES)}, {_fold(_strip(f"split_part({x}, ':', 1)"))})), false)"""


def _any(x: str, parts) -> str:
    return f"list_bool_or(list_transform({_list(parts)}, lambda p: contains({x}, p)))"


_SAFE = "'[<>:\"/\\\\|?*]'"
_SOURCE = "regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//([^/?#]*)', 1)"


def _safe(x: str) -> str:
    return _strip(f"regexp_replace({x}, {_SAFE}, '', 'g')")


_DOMAIN = f"regexp_replace(split_part(list_extract(string_split({_fold(_SOURCE)}, '@'), -1), ':', 1), '^www\\.', '')"


def _trusted(d: str, more) -> str:
    known = " OR ".join(f"{d} = {_text(x)} OR ends_with({d}, {_text('.' + x)})" for x in (*hosts.TRUSTED_DOMAINS, *more))
    return f"(NOT {_any(d, hosts.NOISY_HOST_PARTS)} AND ({known} OR list_has_any(string_split({d}, '.'), {_list(hosts.TRUSTED_LABELS)}) OR {_any(d, hosts.TRUSTED_HOST_PARTS)}))"


_LINES = f"list_filter(list_transform(regexp_split_to_array(text, '\\r\\n|[\\n\\r\\x0B\\x0C\\x1C-\\x1E\\x{{85}}\\x{{2028}}\\x{{2029}}]'), lambda s: {_strip('s')}), lambda s: s <> '')"
_NAVLINE = "(starts_with(s, '[') OR starts_with(s, '- [') OR starts_with(s, '* [')) AND len(regexp_split_to_array(s, '" + _SPACE + "+')) <= 4"
_PHRASES = f"len(list_filter({_list(signals.NAVIGATION_PHRASES)}, lambda p: contains(folded, p)))"
_SIGNALS = f"""
    n AS (SELECT *, {_PHRASES} AS n_phrases, len(ls) AS n_lines, len(list_filter(ls, lambda s: {_NAVLINE})) AS n_navigation_lines
          FROM (SELECT *, {_fold('text')} AS folded, {_LINES} AS ls FROM d)),
    v AS (SELECT *, n_phrases >= 2 OR (n_lines >= 20 AND n_navigation_lines / n_lines > 0.35) AS has_navigation FROM n)"""


def _bfs(result: str, depth: int = 4) -> str:
    out = [
        f"e AS (SELECT * FROM links WHERE src IS NOT NULL AND {_keep('dst')})",
        "l0 AS (SELECT title AS seed, title, 0 AS depth, NULL::VARCHAR AS parent, 1::BIGINT AS rank, max_depth, entity_limit FROM seeds)",
        "a0 AS (SELECT * FROM l0)",
        "s0 AS (SELECT seed, title FROM l0)",
    ]
    for k in range(1, depth + 1):
        p = k - 1
        out.append(f"""f{k} AS (SELECT f.seed, e.dst, min(struct_pack(r := f.rank, o := e.ord, s := e.src)) AS c, any_value(f.max_depth) AS max_depth, any_value(f.entity_limit) AS entity_limit
            FROM l{p} f JOIN e ON e.src = f.title WHERE f.depth < f.max_depth AND f.rank < f.entity_limit
              AND NOT EXISTS (SELECT 1 FROM s{p} x WHERE x.seed = f.seed AND x.title = e.dst) GROUP BY f.seed, e.dst)""")
        out.append(f"""r{k} AS (SELECT f.seed, dst AS title, {k} AS depth, c.s AS parent, (SELECT count(*) FROM a{p} x WHERE x.seed = f.seed) + row_number() OVER (PARTITION BY f.seed ORDER BY c.r, c.o, dst) AS rank,
            max_depth, entity_limit, c FROM f{k} f)""")
        out.append(f"l{k} AS (SELECT seed, title, depth, parent, rank, max_depth, entity_limit FROM r{k} WHERE rank <= entity_limit)")
        out.append(f"a{k} AS (SELECT * FROM a{p} UNION ALL SELECT * FROM l{k})")
        out.append(f"s{k} AS (SELECT * FROM s{p} UNION ALL SELECT seed, title FROM r{k})")
    claims = " UNION ALL ".join(f"SELECT seed, parent, (row_number() OVER (PARTITION BY seed, parent ORDER BY c.o, title) - 1)::INTEGER AS pos, title AS child FROM r{k}" for k in range(1, depth + 1))
    last = f"SELECT seed, title, depth, parent, rank FROM a{depth}" if result == "entities" else claims
    return "WITH " + ",\n".join(out) + "\n" + last


def _windows(start: str, length: str) -> str:
    return f"""list_transform(range(0, CASE WHEN {length} <= 0 THEN 0 WHEN {length} <= 3500 THEN 1 ELSE ceil(({length} - 3500) / 3300.0)::INTEGER + 1 END),
        lambda i: struct_pack(start := ({start} + i * 3300)::INTEGER, len := least(3500, {length} - i * 3300)::INTEGER))"""


# Section-packed chunks: a fold over section lengths, as in the text of the task.
_CHUNKS = f"""
    sec AS (SELECT doc_id, text, list_transform(string_split(regexp_replace(text, '\\n#', chr(10) || chr(1) || '#', 'g'), chr(1)), lambda s: length(s)::INTEGER) AS ns,
                   regexp_matches(text, '(^|\\n)#') AS headed FROM documents),
    fold AS (SELECT *, list_reduce(ns, lambda a, n:
        CASE WHEN n.len > 4000 THEN struct_pack(out := list_concat(CASE WHEN a.len > 0 THEN list_append(a.out, struct_pack(start := a.start, len := a.len, big := false)) ELSE a.out END,
                                                  [struct_pack(start := a.start + a.len, len := n.len, big := true)]), start := a.start + a.len + n.len, len := 0)
             WHEN a.len > 0 AND a.len + n.len > 4000 THEN struct_pack(out := list_append(a.out, struct_pack(start := a.start, len := a.len, big := false)), start := a.start + a.len, len := n.len)
             ELSE struct_pack(out := a.out, start := a.start, len := a.len + n.len) END) AS acc
        FROM (SELECT * REPLACE (list_concat([struct_pack(out := []::STRUCT(start INTEGER, len INTEGER, big BOOLEAN)[], start := 0, len := 0)],
                list_transform(ns, lambda n: struct_pack(out := []::STRUCT(start INTEGER, len INTEGER, big BOOLEAN)[], start := 0, len := n))) AS ns) FROM sec)),
    spans AS (SELECT doc_id, text, CASE WHEN coalesce(text, '') = '' THEN [] WHEN headed THEN
        flatten(list_transform(CASE WHEN acc.len > 0 THEN list_append(acc.out, struct_pack(start := acc.start, len := acc.len, big := false)) ELSE acc.out END,
            lambda c: CASE WHEN c.big THEN {_windows('c.start', 'c.len')} ELSE [struct_pack(start := c.start, len := c.len)] END))
        ELSE {_windows('0', 'length(text)')} END AS sp FROM fold),
    chunk AS (SELECT doc_id, no - 1 AS chunk_no, sp[no].start AS start, sp[no].len AS length, substring(text, sp[no].start + 1, sp[no].len) AS chunk
        FROM (SELECT doc_id, text, sp, unnest(range(1, len(sp) + 1)) AS no FROM spans))"""

# Batches: the same kind of fold over chunk sizes.
_BATCHES = (
    _CHUNKS
    + f""",
    packed AS (SELECT doc_id, list_reduce(list_concat([struct_pack(out := []::INTEGER[], no := 0, used := 0)], list_transform(list(length ORDER BY chunk_no), lambda n: struct_pack(out := []::INTEGER[], no := 0, used := n::INTEGER + {chunks.PART_COST}))),
        lambda a, n: CASE WHEN a.used > 0 AND a.used + n.used > 12000 THEN struct_pack(out := list_append(a.out, a.no + 1), no := a.no + 1, used := n.used)
                          ELSE struct_pack(out := list_append(a.out, a.no), no := a.no, used := a.used + n.used) END).out AS bs
        FROM chunk GROUP BY doc_id),
    batch AS (SELECT c.doc_id, p.bs[c.chunk_no + 1] AS batch_no, list(c.chunk ORDER BY c.chunk_no) AS parts FROM chunk c JOIN packed p USING (doc_id) GROUP BY ALL),
    formatted AS (SELECT doc_id, batch_no, parts, list_aggregate(list_transform(parts, lambda c, i: '{chunks.SEPARATOR}' || chr(10) || 'PART ' || i::VARCHAR || chr(10) || chr(10) || c), 'string_agg', chr(10) || chr(10)) AS text FROM batch),
    replied AS (SELECT *, CASE length(text) % 6 WHEN 0 THEN NULL
        WHEN 1 THEN replace(text, chr(10) || 'PART 1' || chr(10), chr(10) || 'PART 2' || chr(10))
        WHEN 2 THEN 'Here it is.' || chr(10) || chr(10) || text
        WHEN 3 THEN text || chr(10) || chr(10) || '{chunks.SEPARATOR}' || chr(10) || 'PART 99' || chr(10) || chr(10) || 'more'
        WHEN 4 THEN '{chunks.SEPARATOR}' || chr(10) || 'PART 1' || chr(10) || chr(10) || ' {chunks.EMPTY_MARKER} ' || chr(10)
        ELSE replace(text, 'e', 'E') END AS reply FROM formatted),
    cutup AS (SELECT *, list_transform(regexp_extract_all(reply, '(?m)^={{20}}\\s*\\nPART\\s+(\\d+)\\s*$', 1), lambda k: try_cast(k AS INTEGER)) AS ks,
        list_transform(regexp_split_to_array(reply, '(?m)^={{20}}\\s*\\nPART\\s+\\d+\\s*$')[2:], lambda b: CASE WHEN {_strip('b')} = {_text(chunks.EMPTY_MARKER)} THEN '' ELSE {_strip('b')} END) AS bodies FROM replied),
    parsed AS (SELECT *, CASE WHEN len(ks) = len(parts) AND len(list_distinct(ks)) = len(parts) AND coalesce(list_min(ks) >= 1 AND list_max(ks) <= len(parts), false)
        THEN list_transform(range(1, len(parts) + 1), lambda k: bodies[list_position(ks, k)]) END AS ps FROM cutup)"""
)

_ENRICHED = f"""
    e AS (SELECT title, arg_max(struct_pack(depth := depth, parent := parent), struct_pack(l := loaded_at, d := depth, i := entity_id)) AS r FROM entities GROUP BY title),
    p AS (SELECT title, max(struct_pack(s := coalesce(summary, ''), k := coalesce(array_to_string(categories, chr(10)), ''), n := coalesce(len(categories), 0))) AS b FROM page_info WHERE title IS NOT NULL GROUP BY title),
    x AS (SELECT e.title, e.r.depth AS depth, e.r.parent AS parent, coalesce(p.b.s, '') AS summary, coalesce(p.b.n, 0)::INTEGER AS n_categories, coalesce(p.b.k, '') AS categories FROM e LEFT JOIN p ON p.title = e.title)"""

_ESC = "replace(replace(regexp_replace(coalesce({x}, ''), '[\\x00-\\x1F]', ' ', 'g'), chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"')"
_REPLIES = f"""
    b AS (SELECT DISTINCT decision_id, '{{"include": ' || coalesce(include::VARCHAR, 'null') || ', "expand": ' || coalesce(expand::VARCHAR, 'null') || ', "entity_type": {{"name": "' || {_ESC.format(x='entity_type.name')}
             || '"}}, "reason": "' || {_ESC.format(x='reason')} || '"}}' AS body FROM decisions),
    r AS (SELECT decision_id, CASE length(body) % 6 WHEN 0 THEN body WHEN 1 THEN '```json' || chr(10) || body || chr(10) || '```' WHEN 2 THEN 'Here is the decision:' || chr(10) || body || chr(10) || 'Done.'
             WHEN 3 THEN 'x [1] ' || body WHEN 4 THEN substring(body, 1, 20) ELSE 'no decision for ' || decision_id::VARCHAR END AS reply FROM b),
    f AS (SELECT *, CASE WHEN regexp_matches(reply, '(?s)```(?:json)?\\s*(.*?)```') THEN trim(regexp_extract(reply, '(?s)```(?:json)?\\s*(.*?)```', 1), chr(10) || ' ') ELSE trim(reply, chr(10) || ' ') END AS body FROM r),
    j AS (SELECT *, CASE WHEN json_valid(body) THEN body WHEN json_valid(regexp_extract(body, '(?s)(\\{{.*\\}}|\\[.*\\])', 1)) THEN regexp_extract(body, '(?s)(\\{{.*\\}}|\\[.*\\])', 1) END AS doc FROM f)"""

_VALID = """
    d AS (SELECT DISTINCT ON (decision_id) * FROM decisions),
    v AS (SELECT *, include IS NOT NULL AND expand IS NOT NULL AND entity_type IS NOT NULL AND entity_type.name IS NOT NULL AND reason IS NOT NULL
             AND len(list_filter(coalesce(information_to_collect, []), lambda i: NOT coalesce(i.name IS NOT NULL AND i.priority BETWEEN 1 AND 5, false))) = 0 AS valid FROM d)"""
_DECIDED = _VALID + f""",
    w AS (SELECT decision_id, entity_id, valid, CASE WHEN valid THEN include ELSE true END AS include, CASE WHEN valid THEN expand ELSE true END AS expand,
             CASE WHEN valid THEN entity_type.name ELSE {_text(planning.DEFAULT_TYPE)} END AS type_name, CASE WHEN valid THEN coalesce(len(information_to_collect), 0) ELSE 3 END::INTEGER AS n_items FROM v)"""

_RESULTS = """
    once AS (SELECT DISTINCT ON (plan_id) * FROM search_plan),
    t AS (SELECT plan_id, entity_id, unnest(range(len(tasks)))::INTEGER AS task_no, unnest(tasks) AS t FROM once),
    r AS (SELECT plan_id, entity_id, task_no, t.information AS information, t.query AS query, unnest(range(len(t.results)))::INTEGER AS result_no, unnest(t.results) AS x FROM t)"""



def _prompt(template: str, *values: str) -> str:
    """A prompt's template with SQL expressions in its gaps."""
    parts = template.split("%s")
    return " || ".join(x for pair in zip(map(_text, parts), (*values, "''")) for x in pair)


_TYPES = "(SELECT string_agg('- ' || name || ': ' || description, chr(10) ORDER BY type_id) FROM entity_types)"
_KINDS = "(SELECT string_agg('- ' || name, chr(10) ORDER BY info_id) FROM information_types)"
_PAGE = """p AS (SELECT title, max(struct_pack(s := coalesce(summary, ''), k := coalesce(array_to_string(categories, chr(10)), ''))) AS b FROM page_info WHERE title IS NOT NULL GROUP BY title)"""


SQL = {
    "q_bfs": _bfs("entities"),
    "q_bfs_children": _bfs("claims"),
    "q_links_scan": "SELECT src, (row_number() OVER (PARTITION BY src ORDER BY ord, dst NULLS FIRST) - 1)::INTEGER AS pos, dst FROM links",
    "q_title_filter": f"SELECT DISTINCT dst AS title, {_keep('dst')} AS kept FROM links",
    "q_article_url": "SELECT DISTINCT title, 'https://tr.wiki.example/wiki/' || replace(url_encode(replace(title, ' ', '_')), '%2F', '/') AS article_url FROM entities",
    "q_output_filename": f"""SELECT DISTINCT title, depth, regexp_replace({_safe('title')}, '{_SPACE}+', '_', 'g') || '_depth_' || depth::VARCHAR || '.json' AS file_name
        FROM (SELECT title, depth FROM entities UNION ALL SELECT title, max_depth FROM seeds)""",
    "q_sanitize": f"SELECT doc_id, {_safe('url')} AS safe_url, {_safe('title')} AS safe_title FROM documents",
    "q_enrich": f"WITH {_ENRICHED} SELECT * FROM x",
    "q_fixed_batches": "SELECT title, ((row_number() OVER (ORDER BY title) - 1) // 50)::BIGINT AS batch_no, ((row_number() OVER (ORDER BY title) - 1) % 50)::INTEGER AS batch_pos FROM (SELECT DISTINCT title FROM entities)",
    "q_url_source": f"SELECT doc_id, {_SOURCE} AS url_source FROM documents",
    "q_url_domain": f"SELECT doc_id, {_DOMAIN} AS url_domain FROM documents",
    "q_source_route": f"SELECT doc_id, {_any('d', hosts.NOISY_HOST_PARTS)} AS noisy, {_trusted('d', ('wiki.example', 'invalid'))} AS trusted FROM (SELECT doc_id, {_DOMAIN} AS d FROM documents)",
    "q_nav_artifacts": f"WITH d AS (SELECT doc_id, text FROM documents), {_SIGNALS} SELECT doc_id, n_phrases::INTEGER AS n_phrases, n_lines::INTEGER AS n_lines, n_navigation_lines::INTEGER AS n_navigation_lines, has_navigation FROM v",
    "q_prose_flags": f"SELECT doc_id, {_any('f', signals.PERSONAL_PHRASES)} AS personal FROM (SELECT doc_id, {_fold('text')} AS f FROM documents)",
    "q_chunk_overlap": f"""SELECT doc_id, pos::INTEGER AS pos, s.start AS start, s.len AS length, md5(substring(text, s.start + 1, s.len)) AS digest FROM (
        SELECT doc_id, text, unnest(w) AS s, unnest(range(len(w))) AS pos FROM (SELECT doc_id, text, {_windows('0', 'length(text)')} AS w FROM documents))""",
    "q_chunk_sections": f"WITH {_CHUNKS} SELECT doc_id, chunk_no::INTEGER AS chunk_no, start, length, md5(chunk) AS digest FROM chunk",
    "q_batch_pack": f"WITH {_BATCHES} SELECT doc_id, batch_no, len(parts)::INTEGER AS n_parts, list_sum(list_transform(parts, lambda p: length(p)))::INTEGER AS size FROM batch",
    "q_batch_format": f"WITH {_BATCHES} SELECT doc_id, batch_no, length(text)::INTEGER AS length, md5(text) AS digest FROM formatted",
    "q_batch_parse": f"WITH {_BATCHES} SELECT doc_id, batch_no, ps IS NOT NULL AS usable, md5(array_to_string(ps, chr(10) || chr(10))) AS digest FROM parsed",
    "q_clean_apply": f"""SELECT doc_id, length(c)::INTEGER AS length, md5(c) AS digest FROM (
        SELECT doc_id, CASE length(text) % 4 WHEN 0 THEN text WHEN 1 THEN '' WHEN 2 THEN text ELSE '* ' || text END AS c FROM documents)""",
    "q_chunk_merge": f"""WITH {_BATCHES} SELECT doc_id, sum(len(coalesce(ps, parts)))::INTEGER AS n_parts, md5(string_agg(array_to_string(coalesce(ps, parts), chr(10) || chr(10)), chr(10) || chr(10) ORDER BY batch_no)) AS digest FROM parsed GROUP BY doc_id""",
    "q_route": f"""WITH d AS (SELECT doc_id, url, {_strip('text')} AS text FROM documents), {_SIGNALS}
        SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN 'drop'
            WHEN coalesce({_trusted(_DOMAIN, ('invalid',))} AND NOT has_navigation AND NOT {_any('folded', signals.PERSONAL_PHRASES)}, false) THEN 'pass'
            WHEN length(text) <= 12000 THEN 'single' ELSE 'batch' END AS route FROM v""",
    "q_extract_best": """SELECT entity_title, doc_id, length(text)::INTEGER AS length FROM documents
        QUALIFY row_number() OVER (PARTITION BY entity_title ORDER BY length(coalesce(text, '')) DESC, doc_id) = 1""",
    "q_title_fallback": f"""SELECT doc_id, coalesce(nullif({_strip('title')}, ''), nullif({_strip("regexp_extract(text, '(?m)^#[ \\t\\r\\n]+(.+?)[ \\t\\r]*$', 1)")}, ''), '') AS best_title FROM documents""",
    "q_json_extract": f"WITH {_REPLIES} SELECT decision_id, doc IS NOT NULL AS parsed, try_cast(json_extract_string(doc, '$.include') AS BOOLEAN) AS include, json_extract_string(doc, '$.entity_type.name') AS type_name FROM j",
    "q_json_quarantine": f"WITH {_REPLIES} SELECT decision_id, md5(reply) AS digest FROM j WHERE doc IS NULL",
    "q_plan_validate": f"WITH {_VALID} SELECT decision_id, valid FROM v",
    "q_plan_fallback": f"WITH {_DECIDED} SELECT decision_id, include, expand, type_name, n_items, valid FROM w",
    "q_plan_split": f"WITH {_DECIDED} SELECT decision_id, entity_id, CASE WHEN include THEN 'kept' ELSE 'rejected' END AS side FROM w",
    "q_run_counters": f"WITH {_DECIDED} SELECT count(*) AS n_planned, count(*) FILTER (include) AS n_included, count(*) FILTER (NOT include) AS n_excluded, count(*) FILTER (NOT valid) AS n_fallback FROM w",
    "q_search_topk": f"""WITH {_RESULTS} SELECT plan_id, entity_id, task_no, information, query, result_no, x.url AS url, x.title AS title, x.score AS score, 'Search score: ' || coalesce(x.score::VARCHAR, 'N/A') AS reason
        FROM r WHERE result_no < 2""",
    "q_doc_upsert": f"""WITH {_RESULTS} SELECT entity_id::VARCHAR AS entity_key, {_safe(_SOURCE)} AS source_key, plan_id, task_no, result_no, url FROM (SELECT *, x.url AS url FROM r)
        QUALIFY row_number() OVER (PARTITION BY entity_id, {_safe(_SOURCE)} ORDER BY plan_id DESC, task_no DESC, result_no DESC) = 1""",
    "q_incremental_skip": f"SELECT DISTINCT title FROM entities WHERE title IS NULL OR {_safe('title')} NOT IN (SELECT {_safe('entity_title')} FROM documents WHERE entity_title IS NOT NULL)",
    "q_prompt_fields": f"""WITH f AS (SELECT * FROM ({_bfs("entities")})), {_PAGE},
        x AS (SELECT f.seed, f.title, f.parent, coalesce(p.b.s, '') AS summary, coalesce(p.b.k, '') AS categories FROM f LEFT JOIN p ON p.title = f.title)
        SELECT seed, title, length(q)::INTEGER AS length, md5(q) AS digest FROM (SELECT seed, title, {_prompt(prompts.PLAN, "seed", "coalesce(parent, 'None')", "title", "summary", "categories", _TYPES, _KINDS)} AS q FROM x)""",
    "q_search_prompt": f"""WITH {_VALID}, {_PAGE}, n AS (SELECT entity_id, min(title) AS title FROM entities GROUP BY entity_id),
        k AS (SELECT decision_id, entity_id, CASE WHEN valid THEN array_to_string(list_transform(coalesce(information_to_collect, []), lambda i: i.name), ', ') ELSE {_text(", ".join(x for x, _ in planning.DEFAULT_ITEMS))} END AS kinds FROM v WHERE NOT valid OR include)
        SELECT decision_id, length(q)::INTEGER AS length, md5(q) AS digest FROM (SELECT decision_id, {_prompt(prompts.SEARCH, "n.title", "coalesce(p.b.s, '')", "coalesce(kinds, '')")} AS q FROM k JOIN n USING (entity_id) LEFT JOIN p ON p.title = n.title)""",
    "q_clean_prompt": f"SELECT doc_id, length(q)::INTEGER AS length, md5(q) AS digest FROM (SELECT doc_id, {_prompt(prompts.CLEAN, _text(chunks.EMPTY_MARKER), 'text')} AS q FROM documents)",
    "q_clean_batch_prompt": f"WITH {_BATCHES} SELECT doc_id, batch_no, length(q)::INTEGER AS length, md5(q) AS digest FROM (SELECT doc_id, batch_no, {_prompt(prompts.CLEAN_BATCH, 'len(parts)::VARCHAR', _text(chunks.EMPTY_MARKER), 'text')} AS q FROM formatted)",
    "q_pipeline": f"""WITH f AS (SELECT DISTINCT title FROM ({_bfs("entities")})),
        kept AS (SELECT title FROM f WHERE {_safe('title')} NOT IN (SELECT {_safe('entity_title')} FROM documents WHERE entity_title IS NOT NULL)),
        ids AS (SELECT DISTINCT entity_id, title AS entity FROM entities WHERE title IN (SELECT title FROM kept)), {_RESULTS},
        d AS (SELECT ids.entity, plan_id, task_no, result_no, x.url AS url FROM r JOIN ids USING (entity_id) WHERE result_no < 2 AND x.url IS NOT NULL),
        s AS (SELECT *, {_safe('entity')} AS entity_key, {_safe(_SOURCE)} AS source_key FROM d)
        SELECT entity_key, source_key, entity, plan_id, task_no, result_no, url, url AS page_title, CASE WHEN {_trusted(_DOMAIN, ())} THEN 'pass' ELSE 'single' END AS route, length(url) + 19 AS length FROM s
        QUALIFY row_number() OVER (PARTITION BY entity_key, source_key ORDER BY plan_id DESC, task_no DESC, result_no DESC) = 1""",
}
