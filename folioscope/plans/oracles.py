"""Constants of the queries and their DuckDB SQL."""

from __future__ import annotations

from folioscope.functions.text import STOP_WORDS
from folioscope.operators.claims import KEYS
from folioscope.operators.sections import DROP, KEEP

TOPICS = {"warm": ["hot", "red"], "cool": ["cold", "blue widget", "the cold", "blue bolt"], "fasteners": ["bolt", "ring", "hot rod"], "large things": ["large", "large anvil"], "never": ["four words never match"]}
RULES = [("scarce", ["purple"]), ("sizes", ["large", "small"]), ("metal", ["bolt", "anvil", "rod"]), ("rest", ["e"])]
KEYWORDS = ["the", "er", "thor", "onan", "der die", "of the", "que"]
GAP_TOPICS = [("articles", ["the", "der"]), ("phrases", ["of the", "and the", "de la"]), ("starts", ["er", "sch"]), ("none", ["zzz"])]
STAGES = {"signup": ("started", "processing"), "click": ("done", "other"), "purchase": ("done", "processing"), "error": ("done", "rag_error"), "view": ("done", "rag")}


def _list(xs) -> str:  # type: ignore[no-untyped-def]
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"


def _words(x: str) -> str:
    return f"regexp_extract_all(lower(regexp_replace(strip_accents({x}), '[^\\x00-\\x7F]', '', 'g')), '[a-z0-9]+')"


def _norm(x: str) -> str:
    return f"array_to_string({_words(x)}, ' ')"


def _key(x: str) -> str:
    return f"regexp_replace(regexp_replace(strip_accents(lower({x})), '[^\\x00-\\x7F]', '', 'g'), '[^a-z0-9]+', '', 'g')"


def _split(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '[\\s\\x{{0B}}\\x{{85}}\\p{{Z}}]+'), lambda t: t <> '')"


_TITLED = "titled AS (SELECT doc_id AS paper_id, split_part(text, chr(10), 1) AS title, n_chars AS citation_count FROM documents)"
_SHORT = "short AS (SELECT p_partkey AS paper_id, p_name AS title, 1970 + p_size AS year, CAST(floor(p_retailprice) AS INTEGER) AS citation_count, p_brand AS journal FROM part)"


def _terms(table: str) -> str:
    return f"""
    tok AS (SELECT *, list_filter({_words("title")}, lambda t: NOT list_contains({_list(STOP_WORDS)}, t)) AS t FROM {table}),
    gram AS (SELECT paper_id, title, citation_count, 1 AS n, unnest(t) AS term FROM tok
             UNION ALL SELECT paper_id, title, citation_count, 2, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM tok
             UNION ALL SELECT paper_id, title, citation_count, 3, unnest(list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])) FROM tok),
    paper_terms AS (SELECT paper_id, term, count(*) AS times FROM gram GROUP BY 1, 2),
    stats AS (SELECT term, count(*) AS doc_freq, CAST(sum(times) AS BIGINT) AS total_freq FROM paper_terms GROUP BY 1)"""


_TOPICS = (
    "given(topic, pos, keyword) AS (VALUES " + ", ".join(f"('{t}', {i}, '{k}')" for i, (t, ks) in enumerate(TOPICS.items()) for k in ks) + "),"
    f" topics AS (SELECT topic, pos, min(keyword) AS keyword, term FROM (SELECT *, array_to_string(list_filter({_words('keyword')}, lambda t: NOT list_contains({_list(STOP_WORDS)}, t)), ' ') AS term FROM given WHERE keyword <> 'the cold') GROUP BY ALL),"
    " matches AS (SELECT paper_id, topic, pos, array_to_string(list_sort(list(DISTINCT keyword)), ', ') AS kw FROM paper_terms JOIN topics USING (term) GROUP BY ALL)"
)
_AUDIT = f"WITH {_SHORT}, {_terms('short')}, {_TOPICS}"


def _hit(text: str, keyword: str) -> str:
    return f"contains({text}, '{keyword}')" if " " in keyword else f"contains(' ' || {text}, ' {keyword}')"


def _joined(pairs: list[tuple[str, str]]) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in pairs) + "], lambda x: x IS NOT NULL)"


_LINES = "lines AS (SELECT doc_id, CAST(unnest(range(0, len(s))) AS INTEGER) AS ord, unnest(s) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)), counted AS (SELECT *, len(" + _split("line") + ") AS w FROM lines)"
_SQUEEZED = "array_to_string(" + _split("title") + ", ' ')"
_UPPER = f"({_SQUEEZED} <> '' AND length({_SQUEEZED}) <= 80 AND NOT regexp_matches({_SQUEEZED}, '[.,;]$') AND len({_split("replace(title, ':', '')")}) <= 8 AND regexp_matches(title, '\\p{{L}}') AND NOT regexp_matches(title, '\\p{{Ll}}'))"
_ABSTRACT = f"upper({_SQUEEZED}) IN ('ABSTRACT', 'SUMMARY', 'EXECUTIVE SUMMARY')"
_LEVELS = f"""
    headings AS (SELECT doc_id, ord, line AS title, CAST(length(line) % 4 AS INTEGER) AS raw FROM counted WHERE w BETWEEN 1 AND 3),
    told AS (SELECT *, {_UPPER} AS up, {_ABSTRACT} AS ab FROM headings),
    stated AS (SELECT *, coalesce(last_value(CASE WHEN raw > 1 THEN false WHEN ab THEN true WHEN up THEN NULL ELSE false END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS inside FROM told),
    levels AS (SELECT doc_id, ord, title, CAST(CASE WHEN raw > 1 THEN raw WHEN ab THEN 1 WHEN up AND inside THEN 2 ELSE 1 END AS INTEGER) AS level FROM stated)"""
_TEXT = """
    body AS (SELECT doc_id, ord, line, w BETWEEN 1 AND 3 AS head FROM counted WHERE NOT w > 200),
    placed AS (SELECT *, last_value(CASE WHEN head THEN ord END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section_ord FROM body),
    sections AS (SELECT doc_id, section_ord, max(CASE WHEN head THEN trim(line, ' ') END) AS title, coalesce(string_agg(CASE WHEN NOT head AND trim(line, ' ') <> '' THEN trim(line, ' ') END, chr(10) || chr(10) ORDER BY ord), '') AS text FROM placed GROUP BY 1, 2)"""
_TREE = """
    parents AS (SELECT l.doc_id, l.ord, l.level, l.title, (SELECT max(p.ord) FROM levels p WHERE p.doc_id = l.doc_id AND p.ord < l.ord AND p.level < l.level) AS parent_ord,
                       'sec_' || lpad(CAST(row_number() OVER (PARTITION BY l.doc_id ORDER BY l.ord) AS VARCHAR), CAST(greatest(3, length(CAST(row_number() OVER (PARTITION BY l.doc_id ORDER BY l.ord) AS VARCHAR))) AS INTEGER), '0') AS section_id FROM levels l),
    up AS (SELECT doc_id, ord, ord AS anc FROM parents UNION ALL SELECT u.doc_id, u.ord, p.parent_ord FROM up u JOIN parents p ON p.doc_id = u.doc_id AND p.ord = u.anc WHERE p.parent_ord IS NOT NULL)"""
_SECTIONS = f"WITH RECURSIVE {_LINES}, {_LEVELS}, {_TEXT}, {_TREE}, tree AS (SELECT p.*, s.text FROM parents p JOIN sections s ON s.doc_id = p.doc_id AND s.section_ord = p.ord)"


def _pruned(dropped: str, text: str) -> str:
    return f"""
    flagged AS (SELECT *, {dropped} AS dropped, {text} AS final_text FROM tree),
    good AS (SELECT doc_id, ord FROM flagged f WHERE (contains(final_text, 'Table:') OR len({_split("final_text")}) > 10)
             AND NOT EXISTS (SELECT 1 FROM up u JOIN flagged d ON d.doc_id = u.doc_id AND d.ord = u.anc WHERE u.doc_id = f.doc_id AND u.ord = f.ord AND d.dropped)),
    live AS (SELECT DISTINCT u.doc_id, u.anc AS ord FROM up u JOIN good g ON g.doc_id = u.doc_id AND g.ord = u.ord)"""


_TITLE_WORDS = "string_split(array_to_string(" + _split("translate(lower(title), ':;,.!?()[]{}', '            ')") + ", ' '), ' ')"
_DROPS = f"(list_has_any({_TITLE_WORDS}, {_list(DROP)}) AND NOT list_has_any({_TITLE_WORDS}, {_list(KEEP)}))"
_BLOCK = "regexp_replace(array_to_string(" + _split("b") + ", ' '), '^(?:[-*•†‡]+\\s*)+', '')"
_DEFINITION = f"({_BLOCK} <> '' AND (regexp_matches({_BLOCK}, '(?i)^(patient or population|setting|intervention|comparison|risk of bias|publication bias|imprecision|indirectness|inconsistency)\\s*:') OR length({_BLOCK}) - length(replace({_BLOCK}, '=', '')) >= 2 OR (length({_BLOCK}) - length(replace({_BLOCK}, ':', '')) >= 2 AND len({_split(_BLOCK)}) <= 45)))"
_CLEAN = f"trim(array_to_string(list_transform(list_filter(string_split(text, chr(10) || chr(10)), lambda b: NOT {_DEFINITION} AND trim(b, ' ') <> ''), lambda b: trim(b, ' ')), chr(10) || chr(10)), ' ')"
_META = f"WITH {_TITLED}, meta AS (SELECT '10.5555/d' || paper_id AS doi, * FROM titled), done AS (SELECT DISTINCT '10.5555/d' || doc_id AS doi FROM labels WHERE quality = 0)"


def _preferred(candidates: str) -> str:
    return f"""SELECT item, base_name FROM (SELECT item, base_name, c, row_number() OVER (PARTITION BY item ORDER BY c DESC, base_name) AS r, lead(c) OVER (PARTITION BY item ORDER BY c DESC, base_name) AS nxt
               FROM (SELECT item, base_name, max(coalesce(citations, -1)) AS c FROM {candidates} GROUP BY 1, 2)) WHERE r = 1 AND (nxt IS NULL OR nxt < c)"""


_PAIRS = f"""
    items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_key("text")} AS key FROM benchmark),
    records AS (SELECT 'doi-' || doc_id AS base_name, {_key("text")} AS key, n_chars AS citations FROM documents),
    pairs AS (SELECT item, base_name, CAST(max(least(length(i.key), length(r.key))) AS INTEGER) AS score, max(citations) AS citations FROM items i JOIN records r
              ON length(i.key) >= 24 AND length(r.key) >= 24 AND (contains(i.key, r.key) OR contains(r.key, i.key)) GROUP BY 1, 2)"""
_STATUS = """
    WITH have AS (SELECT 'doi-' || d.doc_id AS base_name, true AS metadata, d.lang = 'en' AS pdf, d.doc_id % 2 = 0 AS docling, l.doc_id IS NOT NULL AS filtered,
                  coalesce(l.quality = 1, false) AS final, coalesce(l.toxic = 0, false) AS claims FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
    status AS (SELECT base_name, coalesce(pdf, false) AS pdf, metadata, docling, filtered, final, claims, filtered AND final AS heuristics, docling AND filtered AND final AND claims AS completed FROM have)"""


def _excluded(term: str) -> str:
    return f"""(len(list_filter(string_split({term}, ' '), lambda w: regexp_full_match(w, '[0-9]{{4}}'))) > 0 OR regexp_full_match(split_part({term}, ' ', 1), '[0-9]+') OR regexp_full_match(split_part({term}, ' ', -1), '[0-9]+')
        OR (contains({term}, ' ') AND len(list_filter(string_split({term}, ' '), lambda w: w NOT IN ('global', 'worldwide', 'national', 'international', 'european', 'american'))) = 0))"""


def _rules() -> str:
    """Each rule takes what those before it left, or nothing where too few terms match."""
    out = f"WITH {_SHORT}, {_terms('short')}, l0 AS (SELECT term FROM gram WHERE n <= 2 AND NOT {_excluded('term')} GROUP BY 1 HAVING count(DISTINCT paper_id) >= 2)"
    for k, (_, patterns) in enumerate(RULES):
        hit = " OR ".join(f"contains(term, '{p}')" for p in patterns)
        out += f", m{k} AS (SELECT term FROM l{k} WHERE ({hit}) AND (SELECT count(*) FROM l{k} WHERE {hit}) >= 2), l{k + 1} AS (SELECT term FROM l{k} WHERE term NOT IN (SELECT term FROM m{k}))"
    return out + " UNION ALL ".join(f" SELECT * FROM (SELECT '{t}' AS topic, term AS keyword, row_number() OVER (ORDER BY term) AS keyword_pos FROM m{k}) WHERE keyword_pos <= 10" for k, (t, _) in enumerate(RULES))


def _cascade() -> str:
    """Files by their own name, a DOI within it, and then the titles of each source, whole before in part."""
    key = _key("CASE WHEN hint <> '' THEN hint ELSE trim(stem, ' ') END")
    out = f"""WITH {_TITLED}, d AS (SELECT *, 'doi-10.5555-d' || paper_id AS base_name, '10.5555/d' || paper_id AS doi, {_key('title')} AS tkey FROM titled),
        names AS (SELECT DISTINCT CASE WHEN paper_id % 10 = 5 THEN 'D' || paper_id || '__' || base_name || '.pdf' WHEN paper_id % 5 = 0 THEN base_name || '.pdf' WHEN paper_id % 5 = 1 THEN 'copy of 10.5555/d' || paper_id || '_.pdf'
                         WHEN paper_id % 5 = 2 THEN 'A - 2004 - ' || title || '.pdf' WHEN paper_id % 5 = 3 THEN substr(title, 1, 60) || '.PDF' ELSE 'scan ' || paper_id || '.pdf' END AS file FROM d),
        stems AS (SELECT file, stem, trim(regexp_extract(stem, '\\s-\\s[0-9]{{4}}\\s-\\s(.+)$', 1), ' ') AS hint FROM (SELECT file, regexp_replace(file, '(?i)\\.pdf$', '') AS stem FROM names)),
        f AS (SELECT file, stem, regexp_extract(stem, '^(?:[^_]+__)?(doi-.+)$', 1) AS named, lower(regexp_replace(regexp_extract(stem, '(?i)10\\.[0-9]{{4,9}}/[-._;()/:a-z0-9]+'), '[.,;:_-]+$', '')) AS doi, {key} AS key FROM stems),
        r0 AS (SELECT file, named AS base_name, CASE WHEN stem = named THEN 'named' ELSE 'legacy' END AS strategy FROM f WHERE named <> '' UNION ALL SELECT DISTINCT file, d.base_name, 'doi' FROM f JOIN d ON d.doi = f.doi WHERE named = ''),
        l0 AS (SELECT file AS item, key FROM f WHERE file NOT IN (SELECT file FROM r0))"""
    found = ["SELECT * FROM r0"]
    for k, (name, some) in enumerate((("bib", "paper_id % 2 = 0"), ("relations", "paper_id % 3 = 0"), ("metadata", "true"))):
        out += f""", s{k} AS (SELECT base_name, tkey AS key, citation_count AS citations FROM d WHERE {some}),
        c{k} AS (SELECT item, base_name, citations FROM l{k} JOIN s{k} USING (key) WHERE key <> ''), e{k} AS ({_preferred(f"c{k}")}),
        h{k} AS (SELECT * FROM l{k} WHERE item NOT IN (SELECT item FROM e{k})),
        p{k} AS (SELECT item, base_name, max(least(length(i.key), length(r.key))) AS score, max(citations) AS citations FROM h{k} i JOIN s{k} r ON length(i.key) >= 24 AND length(r.key) >= 24 AND (contains(i.key, r.key) OR contains(r.key, i.key)) GROUP BY 1, 2),
        q{k} AS (SELECT *, max(score) OVER (PARTITION BY item) AS top, nth_value(score, 2) OVER (PARTITION BY item ORDER BY score DESC, base_name ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second FROM p{k}),
        t{k} AS (SELECT * FROM q{k} WHERE score = top AND top - second < 8),
        w{k} AS (SELECT item, base_name FROM q{k} WHERE score = top AND (second IS NULL OR top - second >= 8) UNION ALL {_preferred(f"t{k}")}),
        l{k + 1} AS (SELECT * FROM h{k} WHERE item NOT IN (SELECT item FROM w{k}))"""
        found += [f"SELECT item, base_name, '{name}_exact' FROM e{k}", f"SELECT item, base_name, '{name}_partial' FROM w{k}"]
    return out + f", resolved AS ({' UNION ALL '.join(found)} UNION ALL SELECT item, NULL, NULL FROM l3)"


_LATEX = lambda x: f"regexp_replace({x}, '([&%$#_])', '\\\\\\1', 'g')"
_BIB = f"""WITH {_SHORT}, r AS (SELECT *, CASE WHEN paper_id % 4 = 0 THEN '' ELSE 'Ann ' || upper(title[1]) || split_part(title, ' ', 1)[2:] END AS author, CASE WHEN paper_id % 2 = 0 THEN journal END AS j FROM short),
    b AS (SELECT *, CASE WHEN author = '' THEN substr(printf('part%08d', paper_id), 1, 8) ELSE split_part(author, ' ', 2) || year END AS base FROM r), k AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY paper_id) - 1 AS n FROM b)
    SELECT CASE WHEN n = 0 THEN base ELSE base || n END AS citekey, '@article{{' || (CASE WHEN n = 0 THEN base ELSE base || n END) || chr(44) || chr(10) || array_to_string(list_filter(['  title = {{' || {_LATEX("title || ' & 100%'")} || '}}', '  author = {{' || author || '}}', '  year = {{' || year || '}}',
        CASE WHEN j <> '' THEN '  journal = {{' || {_LATEX("j")} || '}}' END, '  doi = {{10.5555/' || paper_id || '}}'], lambda x: x IS NOT NULL), chr(44) || chr(10)) || chr(10) || '}}' AS entry FROM k"""


def _claims() -> str:
    """The outputs of the query, made alike, and judged claim by claim as JSON."""
    full = ", ".join(f'"{k}": "x"' for k in KEYS if k not in ("keywords", "statistics", "confidence"))
    good = "[{" + full + ', "keywords": ["a"], "statistics": {"p_value": "0.1"}, "confidence": 0.9}]'
    text = " ".join(f"WHEN coalesce(json_type(c, '$.{k}') <> 'VARCHAR', true) OR trim(json_extract_string(c, '$.{k}'), ' ') = '' THEN 'invalid {k}'" for k in ("claim_family", "support_section", "claim_text", "evidence_span"))
    return f"""WITH o AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '{good}' WHEN 1 THEN replace('{good}', '"confidence": 0.9', '"confidence": "high"') WHEN 2 THEN replace('{good}', '"arm": "x", ', '') WHEN 3 THEN '{{}}' ELSE 'no json' END AS output FROM documents),
        j AS (SELECT doc_id, CASE WHEN json_valid(output) THEN CAST(output AS JSON) END AS v FROM o),
        c AS (SELECT doc_id, unnest(range(0, CAST(json_array_length(v) AS BIGINT))) AS pos, unnest(json_extract(v, '$[*]')) AS c FROM j WHERE json_type(v) = 'ARRAY'),
        w AS (SELECT doc_id, pos, CASE WHEN coalesce(json_type(c) <> 'OBJECT', true) THEN 'not an object' WHEN len(list_filter({_list(KEYS)}, lambda k: NOT list_contains(json_keys(c), k))) > 0 THEN 'missing ' || array_to_string(list_sort(list_filter({_list(KEYS)}, lambda k: NOT list_contains(json_keys(c), k))), ', ')
              {text} WHEN coalesce(json_type(c, '$.confidence') NOT IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'BOOLEAN'), true) THEN 'invalid confidence' WHEN coalesce(json_type(c, '$.keywords') <> 'ARRAY', true) THEN 'invalid keywords' WHEN coalesce(json_type(c, '$.statistics') <> 'OBJECT', true) THEN 'invalid statistics' END AS why FROM c),
        x AS (SELECT doc_id, arg_min('claim ' || pos || ' ' || why, pos) AS why FROM w WHERE why IS NOT NULL GROUP BY 1), y AS (SELECT doc_id, CASE WHEN v IS NULL THEN 'not JSON' WHEN json_type(v) <> 'ARRAY' THEN 'not an array' ELSE why END AS reason FROM j LEFT JOIN x USING (doc_id))
        SELECT doc_id, reason IS NULL AS valid, reason FROM y"""


_CASE = lambda k: "CASE event_type " + " ".join(f"WHEN '{e}' THEN '{v[k]}'" for e, v in STAGES.items()) + " END"

SQL: dict[str, str] = {
    "term_stats": f"WITH {_TITLED}, {_terms('titled')} SELECT * FROM stats",
    "term_index": f"WITH {_TITLED}, {_terms('titled')} SELECT term, string_agg(CAST(paper_id AS VARCHAR), ',' ORDER BY paper_id) AS paper_ids FROM paper_terms GROUP BY 1",
    "paper_topics": f"""{_AUDIT} SELECT s.paper_id, any_value(s.title) AS title, coalesce(string_agg(m.topic, '; ' ORDER BY pos), '') AS matched_topics,
        coalesce(string_agg(m.topic || ':' || kw, '; ' ORDER BY pos), '') AS matched_terms FROM short s LEFT JOIN matches m USING (paper_id) GROUP BY 1""",
    "topic_stats": f"{_AUDIT} SELECT topic, count(DISTINCT paper_id) AS paper_count, count(DISTINCT paper_id) / (SELECT count(*) FROM short) AS relative_frequency FROM matches GROUP BY 1",
    "topic_cooccurrence": f"{_AUDIT} SELECT a.topic AS topic_a, b.topic AS topic_b, count(*) AS pair_count FROM matches a JOIN matches b ON a.paper_id = b.paper_id AND a.topic < b.topic GROUP BY 1, 2",
    "unclassified_papers": f"{_AUDIT} SELECT paper_id, title, year, journal FROM short WHERE paper_id NOT IN (SELECT paper_id FROM matches)",
    "unmapped_terms": f"{_AUDIT} SELECT * FROM stats WHERE doc_freq >= 2 AND term NOT IN (SELECT term FROM topics)",
    "audit_summary": f"{_AUDIT} SELECT (SELECT count(*) FROM short) AS paper_count, count(DISTINCT paper_id) AS classified_paper_count, (SELECT count(*) FROM short) - count(DISTINCT paper_id) AS unclassified_paper_count FROM matches",
    "papers_by_year": f"WITH {_SHORT} SELECT paper_id, title, year FROM short WHERE year BETWEEN 1990 AND 2005",
    "citation_filter": "SELECT * FROM (SELECT l_orderkey AS seed, l_partkey AS paper, CAST(floor(l_extendedprice) AS INTEGER) AS citations, CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem) WHERE citations >= 40000 AND year >= 1995",
    "storage_state": "SELECT d.doc_id AS paper, CASE WHEN d.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 'kept' WHEN d.doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) THEN 'discarded' ELSE 'new' END AS state FROM documents d",
    "selection_batches": "SELECT o_custkey, CAST(floor((r - 1) / 5) AS BIGINT) AS batch_no, count(*) AS n FROM (SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders) GROUP BY 1, 2",
    "decision_merge": """SELECT d.doc_id AS id, CASE WHEN quality = 1 THEN 'keep' WHEN quality = 0 AND toxic = 0 THEN 'drop' ELSE 'uncertain' END AS decision,
        CASE WHEN quality = 1 OR (quality = 0 AND toxic = 0) THEN 'quality ' || quality ELSE 'missing_from_model_output' END AS reason FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "metadata_merge": """SELECT o_custkey AS key, max_by(o_orderpriority, o_orderkey) FILTER (WHERE o_orderkey % 3 <> 0) AS journal, max_by(CAST(year(o_orderdate) AS INTEGER), o_orderkey) FILTER (WHERE o_orderkey % 2 = 0) AS year,
        array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS parents, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS seeds, bool_or(o_totalprice > 400000) AS is_seed FROM orders GROUP BY 1""",
    "discard_merge": "SELECT conv_id AS key, max_by(sha256(text), turn) FILTER (WHERE role = 'user') AS selection, array_to_string(list_sort(list(DISTINCT role)), ',') AS parents FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1",
    "discard_buckets": "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS bucket_date, 'gap-rag' AS mode, count(*) AS moved_count FROM events WHERE event_type = 'error' GROUP BY 1",
    "seed_frontier": "SELECT '10.5555/d' || o_custkey AS doi, min(o_orderkey) AS pos FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1",
    "content_hash": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
    "ingest_unique": "SELECT sha256(text) AS sha256, min(doc_id) AS doc_id FROM documents GROUP BY 1",
    "abstract_preview": f"SELECT doc_id, array_to_string(w[1:40], ' ') || CASE WHEN len(w) > 40 THEN '...' ELSE '' END AS preview FROM (SELECT doc_id, {_split('text')} AS w FROM documents)",
    "claim_limits": f"""SELECT doc_id, word_count, e AS extra_claims, 10 + e AS final_claims FROM (SELECT doc_id, word_count, CAST(round_even(10 * (0.35 * greatest(0.0, least(1.0, (n_chars - 100) / 1900.0)) + 0.65 * greatest(0.0, least(1.0, (word_count - 1500) / 10500.0))), 0) AS INTEGER) AS e
        FROM (SELECT doc_id, n_chars, CAST(len({_split("text")}) AS INTEGER) AS word_count FROM documents))""",
    "claim_gate": """SELECT doc_id, CASE WHEN ex THEN NULL ELSE t END AS estimated_tokens, CASE WHEN ex THEN 'existing' WHEN t < 500 THEN 'auto' WHEN ap THEN 'approved' ELSE 'review' END AS gate
        FROM (SELECT doc_id, CASE WHEN length(s) = 0 THEN 0 ELSE greatest(1, CAST(round_even(length(s) / 4, 0) AS INTEGER)) END AS t, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS ex, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS ap
              FROM (SELECT doc_id, regexp_replace(text, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') AS s FROM documents))""",
    "registry_state": f"""SELECT user_id AS paper_id, coalesce(max_by(CASE WHEN e = 'started' THEN 'processing' ELSE 'completed' END, (ts, event_id)) FILTER (WHERE s = 'processing'), 'pending') AS status_proc,
        coalesce(max_by(CASE WHEN s = 'rag' THEN 'indexed' ELSE 'error' END, (ts, event_id)) FILTER (WHERE s IN ('rag', 'rag_error')), 'pending') AS status_rag, max(ts) AS last_event
        FROM (SELECT *, {_CASE(0)} AS e, {_CASE(1)} AS s FROM events) GROUP BY 1""",
    "stage_status": _STATUS + " SELECT * FROM status",
    "pending_papers": _STATUS + " SELECT base_name FROM status WHERE NOT completed AND NOT heuristics",
    "stage_funnel": _STATUS
    + """, n AS (SELECT 1 AS pos, 'metadata' AS stage, count(*) FILTER (WHERE metadata) AS n FROM status UNION ALL SELECT 2, 'pdf', count(*) FILTER (WHERE pdf) FROM status
        UNION ALL SELECT 3, 'final', count(*) FILTER (WHERE final) FROM status UNION ALL SELECT 4, 'claims', count(*) FILTER (WHERE claims) FROM status)
        SELECT stage, n, 100.0 * n / lag(n) OVER (ORDER BY pos) AS rate_from_previous, 100.0 * n / first_value(n) OVER (ORDER BY pos) AS rate_from_first FROM n""",
    "event_envelope": """SELECT 'papers:' || event_type AS channel, CAST(user_id AS VARCHAR) AS id, '{"id":"' || CASE WHEN event_id % 3 = 0 THEN 'own' ELSE CAST(user_id AS VARCHAR) END || '","kind":"' || event_type || '","timestamp":"' || CAST(floor(epoch(ts)) AS BIGINT) || '"}' AS body FROM events""",
    "doi_normalise": """WITH n AS (SELECT page_id, url AS raw, lower(trim(url)) AS doi FROM pages), s AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(doi, '[^a-z0-9._-]+', '-', 'g'), '-+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM n)
        SELECT page_id, raw, doi, slug, 'doi-' || slug AS base_name, 'doi' AS format FROM s""",
    "keyword_seeds": f"{_META} SELECT doi, title, CAST(citation_count AS INTEGER) AS citation_count, array_to_string(m, '; ') AS matched_keywords FROM (SELECT *, {_joined([(k, _hit('norm', k)) for k in KEYWORDS])} AS m FROM (SELECT *, {_norm('title')} AS norm FROM meta)) WHERE len(m) > 0 AND citation_count >= 200 AND doi NOT IN (SELECT doi FROM done)",
    "gap_seeds": f"""{_META}, open AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1)
        SELECT doi, title, CAST(citation_count AS INTEGER) AS citation_count, array_to_string(m, '; ') AS matched_topics, CASE WHEN o THEN 'unclassified' ELSE 'papers' END AS source_bucket,
               CAST(100000 * len(m) + CASE WHEN o THEN 25000 ELSE 0 END + citation_count AS INTEGER) AS score
        FROM (SELECT *, {_joined([(n, ' OR '.join(_hit('norm', t) for t in ts)) for n, ts in GAP_TOPICS])} AS m, paper_id IN (SELECT doc_id FROM open) AS o FROM (SELECT *, {_norm('title')} AS norm FROM meta)) WHERE len(m) > 0 AND citation_count >= 200 AND doi NOT IN (SELECT doi FROM done)""",
    "title_match_exact": f"WITH {_SHORT}, c AS (SELECT CAST(a.paper_id AS VARCHAR) AS item, 'doi-' || b.paper_id AS base_name, b.citation_count AS citations FROM short a JOIN short b ON {_key('a.title')} = {_key('b.title')} WHERE a.year > 2015 AND b.year <= 1980) {_preferred('c')}",
    "title_pairs": f"WITH {_PAIRS} SELECT * FROM pairs",
    "title_match_partial": f"""WITH {_PAIRS}, r AS (SELECT *, max(score) OVER (PARTITION BY item) AS top, nth_value(score, 2) OVER (PARTITION BY item ORDER BY score DESC, base_name ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second FROM pairs),
        tied AS (SELECT * FROM r WHERE score = top AND top - second < 8), won AS ({_preferred("tied")})
        SELECT item, base_name, score FROM r WHERE score = top AND (second IS NULL OR top - second >= 8) UNION ALL SELECT w.item, w.base_name, t.score FROM won w JOIN tied t ON t.item = w.item AND t.base_name = w.base_name""",
    "candidate_terms": f"""WITH {_TITLED}, {_terms("titled")}, own AS (SELECT paper_id, title, term, count(*) AS times FROM gram WHERE n > 1 AND NOT len(list_filter(string_split(term, ' '), lambda w: regexp_full_match(w, '[0-9]{{4}}'))) > 0
        AND NOT regexp_full_match(split_part(term, ' ', 1), '[0-9]+') AND NOT regexp_full_match(split_part(term, ' ', -1), '[0-9]+') AND len(list_filter(string_split(term, ' '), lambda w: w NOT IN ('global', 'worldwide', 'national', 'international', 'european', 'american'))) > 0 GROUP BY ALL)
        SELECT term, CAST(len(string_split(term, ' ')) AS INTEGER) AS n_tokens, count(*) AS doc_freq, CAST(sum(times) AS BIGINT) AS total_freq, array_to_string(list(title ORDER BY paper_id, title)[1:3], ' | ') AS example_titles FROM own GROUP BY 1 HAVING count(*) >= 2""",
    "candidate_scores": f"""WITH {_TITLED}, {_terms("titled")}, own AS (SELECT paper_id, title, term, ln(1 + citation_count) AS w, count(*) AS times FROM gram WHERE n > 1 AND NOT len(list_filter(string_split(term, ' '), lambda w: regexp_full_match(w, '[0-9]{{4}}'))) > 0
        AND NOT regexp_full_match(split_part(term, ' ', 1), '[0-9]+') AND NOT regexp_full_match(split_part(term, ' ', -1), '[0-9]+') GROUP BY ALL)
        SELECT term, round(round(sum(w), 4), 1) AS citation_weight, round(round(3 * count(*) + sum(times) + 0.75 * sum(w), 4), 1) AS combined_score FROM own GROUP BY 1 HAVING count(*) >= 2""",
    "heading_signals": f"""WITH {_LINES}, h AS (SELECT doc_id, ord, line AS title, {_split("replace(line, ':', '')")} AS ws FROM counted), u AS (SELECT *, {_SQUEEZED} AS sq, {_UPPER} AS up, list_filter(ws, lambda v: lower(v) NOT IN ('and', 'or', 'of', 'the', 'in', 'on', 'for', 'to', 'with', 'by')) AS own FROM h),
        c AS (SELECT *, len(list_filter(own, lambda v: regexp_matches(v, '^\\p{{Lu}}'))) AS caps FROM u)
        SELECT doc_id, ord AS line_no, CASE WHEN up THEN 'uppercase' ELSE 'titlecase' END AS signal FROM c WHERE up OR (sq <> '' AND length(sq) <= 80 AND NOT regexp_matches(sq, '[.,;?!]$') AND len(ws) BETWEEN 1 AND 8 AND caps >= greatest(1, len(own) - 1))""",
    "draft_topics": _rules(),
    "resolve_cascade": _cascade() + " SELECT * FROM resolved",
    "match_audit": _cascade() + """ SELECT 'total' AS bucket, count(*) AS n FROM resolved UNION ALL SELECT 'already_doi', count(*) FROM resolved WHERE strategy = 'named' UNION ALL SELECT 'legacy', count(*) FROM resolved WHERE strategy = 'legacy'
        UNION ALL SELECT 'matched', count(*) FROM resolved WHERE strategy NOT IN ('named', 'legacy') UNION ALL SELECT 'unmatched', count(*) FROM resolved WHERE strategy IS NULL""",
    "rename_plan": _cascade() + " SELECT file AS source, base_name || '.pdf' AS target, CASE WHEN base_name IS NULL THEN 'unmatched' WHEN file = max(file) OVER (PARTITION BY base_name) THEN 'copied' ELSE 'overwritten' END AS status FROM resolved",
    "claim_validation": _claims(),
    "bibtex_entries": _BIB,
    "heading_levels": f"WITH {_LINES}, {_LEVELS} SELECT doc_id, ord, level FROM levels",
    "section_text": f"WITH {_LINES}, {_TEXT} SELECT doc_id, section_ord, title, text FROM sections",
    "section_tree": f"WITH RECURSIVE {_LINES}, {_LEVELS}, {_TEXT}, {_TREE} SELECT doc_id, ord, level, parent_ord, section_id FROM parents",
    "rule_filtered_sections": f"{_SECTIONS}, {_pruned(_DROPS, 'text')} SELECT doc_id, section_id, title FROM tree JOIN live USING (doc_id, ord)",
    "llm_filtered_sections": f"{_SECTIONS} SELECT doc_id, section_id, CASE WHEN ord % 3 = 1 THEN 'uncertain' ELSE 'keep' END AS decision FROM tree t WHERE NOT EXISTS (SELECT 1 FROM up u WHERE u.doc_id = t.doc_id AND u.ord = t.ord AND u.anc % 3 = 0)",
    "final_sections": f"{_SECTIONS}, {_pruned('false', _CLEAN)} SELECT doc_id, section_id, md5(final_text) AS text_md5 FROM flagged JOIN live USING (doc_id, ord)",
    "table_render": "SELECT l_orderkey AS table_id, l_linenumber AS row_no, max_by(l_returnflag, (l_partkey, l_returnflag)) || ' |  | ' || max_by(CASE WHEN l_partkey % 2 = 0 THEN 'even' ELSE CAST(l_partkey AS VARCHAR) END, l_partkey) AS row_text FROM lineitem GROUP BY 1, 2",
    "claims_prompt_sections": f"""WITH {_LINES}, p AS (SELECT doc_id, ord, CASE WHEN ord % 2 = 0 THEN 'Part ' || ord ELSE 'Untitled Section' END AS name, trim(line, ' ') AS t FROM lines WHERE trim(line, ' ') <> '')
        SELECT doc_id, md5(string_agg('## ' || name || chr(10) || t, chr(10) || chr(10) ORDER BY ord)) AS sections_md5, string_agg(name, ', ' ORDER BY ord) AS available_sections FROM p GROUP BY 1""",
    "source_items": f"""WITH {_LINES}, h AS (SELECT doc_id, ord, line AS title, w, {_split("replace(line, ':', '')")} AS ws FROM counted), u AS (SELECT *, {_SQUEEZED} AS sq, {_UPPER} AS up, list_filter(ws, lambda v: lower(v) NOT IN ('and', 'or', 'of', 'the', 'in', 'on', 'for', 'to', 'with', 'by')) AS own FROM h),
        c AS (SELECT *, w BETWEEN 1 AND 3 AS head, w > 200 AS fur, len(list_filter(own, lambda v: regexp_matches(v, '^\\p{{Lu}}'))) AS caps FROM u)
        SELECT doc_id, ord, head AS is_heading, CASE WHEN head THEN CAST(length(title) % 4 AS INTEGER) END AS raw, fur AS furniture, md5(CASE WHEN head OR fur THEN title ELSE sq END) AS text_md5,
               CASE WHEN head OR fur THEN NULL WHEN up THEN 'uppercase' WHEN sq <> '' AND length(sq) <= 80 AND NOT regexp_matches(sq, '[.,;?!]$') AND len(ws) BETWEEN 1 AND 8 AND caps >= greatest(1, len(own) - 1) THEN 'titlecase' END AS signal FROM c""",
    "source_blocks": """WITH o AS (SELECT l_orderkey AS k, string_agg('- part ' || l_partkey, chr(10) ORDER BY l_linenumber, l_partkey, l_returnflag) AS a, string_agg('part ' || l_partkey, chr(10) ORDER BY l_linenumber, l_partkey, l_returnflag) AS b,
        string_agg('{"text":' || l_linenumber || '} | ' || l_returnflag, chr(10) ORDER BY l_linenumber, l_partkey, l_returnflag) AS c, string_agg(' | ' || l_partkey, chr(10) ORDER BY l_linenumber, l_partkey, l_returnflag) AS d FROM lineitem GROUP BY 1)
        SELECT k AS doc_id, 0 AS ord, '#/groups/0' AS ref, a AS text FROM o UNION ALL SELECT k, 1, '#/groups/1', b FROM o UNION ALL SELECT k, 2, '#/tables/0', 'Table: Order ' || k || chr(10) || c || chr(10) || 'as shipped' FROM o
        UNION ALL SELECT k, 3, '#/tables/1', 'Table: Grid' || chr(10) || d FROM o UNION ALL SELECT k, 4, '#/pictures/0', '' FROM o""",
    "ranked_terms": f"WITH {_TITLED}, {_terms('titled')} SELECT * FROM stats ORDER BY doc_freq DESC, total_freq DESC, term LIMIT 50",
    "known_ids": "SELECT 's' || doc_id AS id FROM labels WHERE quality IN (0, 1) UNION SELECT 'p' || doc_id FROM labels WHERE quality IN (0, 1) AND doc_id % 2 = 0",
    "first_kept": "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)",
    "registry_upsert": """SELECT coalesce(o.doc_id, n.doc_id) AS paper_id, coalesce(CASE WHEN n.quality = 1 THEN '10.2/' || n.doc_id END, CASE WHEN o.doc_id % 2 = 0 THEN '10.1/' || o.doc_id END) AS doi, CASE WHEN n.doc_id IS NULL THEN 'old/' ELSE 'new/' END AS prefix,
        CASE WHEN o.doc_id IS NULL THEN 'pending' ELSE 'completed' END AS status_proc, 'pending' AS status_rag, CASE WHEN n.doc_id IS NULL THEN 1 ELSE 2 END AS last_event FROM (SELECT * FROM documents WHERE doc_id % 3 > 0) o FULL JOIN labels n ON n.doc_id = o.doc_id""",
    "registry_records": "SELECT '10.5555/d' || o_custkey AS doi, max(o_orderkey) AS line_no, max_by(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY 1",
    "name_parts": f"""WITH {_TITLED}, n AS (SELECT paper_id, CASE WHEN paper_id % 3 = 0 THEN 'Ann - 20' || lpad(CAST(paper_id % 100 AS VARCHAR), 2, '0') || ' - Title ' || paper_id || '__from-raw-pdf-2024-01-02' WHEN paper_id % 3 = 1 THEN 'see doi:10.5555/A.' || paper_id || '., 1' || lpad(CAST(paper_id % 1000 AS VARCHAR), 3, '0')
            ELSE [' None ', 'nan', '', 'x_y & z', 'NULL'][paper_id % 5 + 1] END AS name FROM titled)
        SELECT paper_id, CASE WHEN paper_id % 3 = 0 THEN 'Title ' || paper_id ELSE trim(name, ' ') END AS hint, CASE WHEN paper_id % 3 = 1 THEN '10.5555/a.' || paper_id END AS doi, CASE WHEN paper_id % 3 < 2 THEN name WHEN paper_id % 5 = 3 THEN 'x_y & z' END AS value,
               regexp_extract(name, '\\b((?:19|20)[0-9]{{2}})\\b', 1) AS year, {_LATEX("name")} AS latex, paper_id || '__doi-' || CASE WHEN slug = '' THEN 'unknown-doi' ELSE slug END AS legacy
        FROM (SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(trim(name, ' ')), '[^a-z0-9._-]+', '-', 'g'), '-+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM n)""",
    "cut_abstracts": f"SELECT doc_id, md5(CASE WHEN len(w) > 300 THEN array_to_string(w[1:300], ' ') || '...' ELSE text END) AS abstract_md5 FROM (SELECT doc_id, text, {_split('text')} AS w FROM documents)",
}
SQL["registry_stream"] = SQL["registry_state"]
