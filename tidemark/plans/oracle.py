"""DuckDB restatement of every registered query (the correctness oracle).

Written independently of the Spark code path: plain SQL over the driver's
tables, windows (``row_number``) where Spark uses pre-aggregating ``min_by``,
and a character-level run-length pass where Spark uses a back-reference regex.
Column names equal the Spark queries' names.
"""

from __future__ import annotations

# Fixed values of the rules, spelled out here and not taken from the engine, so that a
# wrong pattern or list there shows as a difference.
class T:
    """Text rules."""

    WS = (r"\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}-\x{2029}\x{202F}\x{205F}\x{3000}")
    MAX_LINE_CHARS, GARBAGE_RUN, REPEAT_MIN, REPEAT_KEEP = 1000, 100, 11, 3
    CHUNK_TOKENS, CHUNK_OVERLAP, PREVIEW_CHARS, REDIRECT_TEXT = 512, 64, 150, "Redirecting"
    HTML_DROP_BLOCKS = [r"(?is)<script[^>]*>.*?</script>", r"(?is)<style[^>]*>.*?</style>", r"(?s)<!--.*?-->"]
    HTML_BREAK_TAGS = r"(?i)</?(p|div|h[1-6]|li|ul|ol|br|tr|table|article|section|nav|header|footer|title|main|aside)(\s[^>]*)?/?>"
    HTML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


class D:
    """Document rules."""

    HTML_EXCLUDE_FILE_KEYWORDS = [
        "impressum", "datenschutz", "kontakt", "robots", "imprint", "data-protection", "contact", "copyright", "login", "search", "suche",
    ]
    EXCLUDE_DOMAINS: list[str] = []
    HTML_FILE_PATTERN, DEFAULT_SOURCE, PDF_TITLE_PREFIX, EXAMPLES_PER_STATUS = r"\.(html|htm|html\.gz)$", "webarchive", "# PDF Document: ", 20


class Q:
    """Parameters of the registered queries."""

    EVAL_K, SELF_SEARCH_K, DENY_PATTERN, STORED_LANG = 100, 10, r"spam|pills", "en"
    SCENARIOS = [
        ("Retrieval Only", False, False), ("Query Exp. + Retrieval", True, False),
        ("Retrieval + Reranker", False, True), ("Query Exp. + Retrieval + Reranker", True, True),
    ]


#: Default suffixes of the media types that the recipes use.
SUFFIXES = [("text/html", ".html"), ("application/pdf", ".pdf")]
RFC = r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?$"
TERM_SPLIT = r"[^\p{L}\p{N}]+"
WS = T.WS
NL = "chr(10)"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(xs) -> str:
    return "[" + ", ".join(_lit(x) for x in xs) + "]"


# ---------------------------------------------------------------- expression builders
def base_site(u: str, p: str) -> tuple[list[str], str]:
    s = [
        f"CASE WHEN strpos({u}, '//') = 0 THEN {u} ELSE substr({u}, strpos({u}, '//') + 2) END AS {p}1",
        f"CASE WHEN starts_with({p}1, 'http://') THEN substr({p}1, 8) ELSE {p}1 END AS {p}2",
        f"regexp_replace(replace(replace({p}2, 'dns:', ''), 'mailto:', ''), '^www[0-9]*\\.', '') AS {p}3",
        f"split_part(split_part({p}3, ':', 1), '/', 1) AS {p}4",
        f"nullif(CASE WHEN ends_with({p}4, '.') THEN substr({p}4, 1, length({p}4) - 1) ELSE {p}4 END, '') AS {p}5",
    ]
    return s, f"{p}5"


def base_url(u: str) -> str:
    return f"CASE WHEN strpos({u}, '//') = 0 THEN {u} ELSE regexp_extract({u}, '^(.*?//[^/]*)', 1) END"


def normalize_url(u: str, p: str) -> tuple[list[str], str]:
    s = [
        f"trim({u}) AS {p}0",
        f"regexp_extract({p}0, {_lit(RFC)}, 1) || regexp_extract({p}0, {_lit(RFC)}, 3) || "
        f"regexp_replace(regexp_extract({p}0, {_lit(RFC)}, 5), ';[^/]*$', '') AS {p}1",
        f"lower({p}1) AS {p}2",
        f"CASE WHEN ends_with({p}2, '/') THEN substr({p}2, 1, length({p}2) - 1) ELSE {p}2 END AS {p}3",
        f"CASE WHEN ends_with({p}3, '/index.html') THEN substr({p}3, 1, length({p}3) - 11) "
        f"WHEN ends_with({p}3, '/index.htm') THEN substr({p}3, 1, length({p}3) - 10) ELSE {p}3 END AS {p}4",
        f"CASE WHEN ends_with({p}4, '.html') THEN substr({p}4, 1, length({p}4) - 5) "
        f"WHEN ends_with({p}4, '.htm') THEN substr({p}4, 1, length({p}4) - 4) "
        f"WHEN ends_with({p}4, '.pdf') THEN substr({p}4, 1, length({p}4) - 4) "
        f"WHEN ends_with({p}4, '.md') THEN substr({p}4, 1, length({p}4) - 3) ELSE {p}4 END AS {p}5",
        f"CASE WHEN {u} IS NULL OR length({p}0) = 0 THEN NULL ELSE nullif({p}5, '') END AS {p}6",
    ]
    return s, f"{p}6"


def url_match(a: str, b: str) -> str:
    return f"({a} IS NOT NULL AND {b} IS NOT NULL AND ({a} = {b} OR strpos({a}, {b}) > 0 OR strpos({b}, {a}) > 0))"


def html_text(h: str) -> str:
    t = h
    for pat in T.HTML_DROP_BLOCKS:
        t = f"regexp_replace({t}, {_lit(pat)}, '', 'g')"
    t = f"regexp_replace({t}, {_lit(T.HTML_BREAK_TAGS)}, {NL}, 'g')"
    t = f"regexp_replace({t}, '<[^>]*>', '', 'g')"
    for ent, ch in T.HTML_ENTITIES:
        t = f"replace({t}, {_lit(ent)}, {_lit(ch)})"
    t = f"regexp_replace({t}, '[ \\t\\r]+', ' ', 'g')"
    t = f"regexp_replace({t}, ' ?' || {NL} || '[ ' || {NL} || ']*', {NL}, 'g')"
    return f"regexp_replace({t}, '^[ ' || {NL} || ']+|[ ' || {NL} || ']+$', '', 'g')"


def html_title(h: str) -> str:
    return f"trim(regexp_extract({h}, '(?is)<title[^>]*>(.*?)</title>', 1))"


def py_strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def heading_title(t: str, fallback: str) -> str:
    heads = f"list_filter(list_transform(string_split({t}, {NL})[1:5], lambda l: {py_strip('l')}), lambda l: starts_with(l, '# '))"
    return f"coalesce(replace({heads}[1], '# ', ''), {fallback})"


def drop_long_lines(t: str) -> str:
    return f"array_to_string(list_filter(string_split({t}, {NL}), lambda l: length(l) <= {T.MAX_LINE_CHARS}), {NL})"


def count_long_lines(t: str) -> str:
    return f"len(list_filter(string_split({t}, {NL}), lambda l: length(l) > {T.MAX_LINE_CHARS}))"


def tokens(t: str) -> str:
    return f"list_filter(regexp_split_to_array({t}, '[{WS}]+'), lambda x: x <> '')"


def terms(t: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({t}), {_lit(TERM_SPLIT)}), lambda x: x <> '')"


def hashed_vector(t: str, dim: int) -> str:
    buckets = f"list_transform({terms(t)}, lambda w: ('0x' || substr(md5(w), 1, 8))::BIGINT % {dim})"
    return f"list_transform(range({dim}), lambda i: len(list_filter({buckets}, lambda b: b = i))::DOUBLE)"


def cosine(a: str, b: str) -> str:
    den = f"(list_dot_product({a}, {a}) * list_dot_product({b}, {b}))"
    return f"CASE WHEN {den} > 0 THEN list_dot_product({a}, {b}) / sqrt({den}) ELSE 0.0 END"


def capture_ts(a: str) -> str:
    return f"try_strptime(nullif(regexp_extract({a}, '-(\\d{{14}})\\d*-', 1), ''), '%Y%m%d%H%M%S')"


def normalized_name(p: str, q: str) -> tuple[list[str], str]:
    s = [
        f"regexp_extract({p}, '^(.*/)?[^/]*$', 1) AS {q}d",
        f"regexp_extract({p}, '([^/]*)$', 1) AS {q}n",
        f"(regexp_matches({q}n, '^.+\\.[^.]*$') AND NOT regexp_matches({q}n, '^\\.[^.]*$')) AS {q}h",
        f"CASE WHEN {q}h THEN regexp_extract({q}n, '^(.*)\\.[^.]*$', 1) ELSE {q}n END AS {q}s",
        f"CASE WHEN {q}h THEN regexp_extract({q}n, '(\\.[^.]*)$', 1) ELSE '' END AS {q}x",
        f"{q}d || regexp_replace({q}s, '\\(\\d+\\)', '', 'g') || {q}x AS {q}norm",
    ]
    return s, f"{q}norm"


# ---------------------------------------------------------------- shared CTEs
def _suffix_values() -> str:
    rows = ", ".join(f"({_lit(t)}, {_lit(e)})" for t, e in SUFFIXES)
    return f"(VALUES {rows}) AS st(st_media_type, st_suffix)"


def _stamp(job: str, crawl: str) -> str:
    lp = lambda x: f"lpad(CAST({x} AS VARCHAR), 2, '0')"
    return (f"CASE WHEN {job} = 3 AND {crawl} = 2 THEN '2024061' WHEN {job} = 2 AND {crawl} = 1 THEN '20241315120000' "
            f"WHEN {job} = 0 AND {crawl} = 2 THEN '20240911120000' ELSE '2024' || {lp(f'1 + ({crawl} * 5 + {job} * 3) % 12')} "
            f"|| {lp(f'1 + ({job} * 7 + {crawl} * 3) % 28')} || {lp(f'({job} * 5 + {crawl} * 7) % 24')} || '0000' END")


RECORDS = f"""
rr AS (SELECT p.page_id, p.url, p.html, c.crawl, p.page_id % 4 AS job, p.page_id + c.crawl AS k
       FROM pages p, (VALUES (0), (1), (2)) AS c(crawl)),
rec AS (SELECT page_id,
          'ARCHIVEIT-1-JOB' || CAST(job AS VARCHAR) || '-' || {_stamp('job', 'crawl')} || '000-00000-h.warc.gz' AS archive,
          page_id * 3 + crawl AS seq, url AS target_uri,
          CASE WHEN page_id % 7 = 0 THEN '404' WHEN page_id % 7 = 1 THEN '301' ELSE '200' END AS http_status,
          CASE WHEN page_id % 13 = 5 THEN 'application/pdf' WHEN page_id % 13 = 9 THEN 'application/x-unknown' ELSE 'text/html' END AS media_type,
          CASE WHEN k % 5 = 0 THEN 'gzip' END AS content_encoding,
          CASE WHEN page_id % 17 = 3 THEN '<html><body><p>Redirecting</p></body></html>'
               WHEN page_id % 17 = 4 THEN '<html><body> </body></html>' ELSE html END || repeat('<!-- v -->', CAST(k % 3 AS INTEGER)) AS body
        FROM rr)"""

PATHS = f"""
paths0 AS (SELECT rec.*,
    url_decode(replace(target_uri, '+', '%2B')) AS _dec,
    lower(regexp_extract(_dec, '^(([^:/?#]+):)?(//(?:[^/?#@]*@)?([^/?#:]*))', 4)) AS _h0,
    CASE WHEN strpos(_h0, 'www.') = 0 THEN _h0 ELSE substr(_h0, 1, strpos(_h0, 'www.') - 1) || substr(_h0, strpos(_h0, 'www.') + 4) END AS domain,
    regexp_extract(_dec, {_lit(RFC)}, 5) AS _path,
    CASE WHEN strpos(_path, '/') = 0 THEN 0 ELSE length(_path) - strpos(reverse(_path), '/') + 1 END AS _ls,
    substr(_path, _ls + 1) AS _f0, substr(_path, 1, _ls) AS _d0,
    strpos(_f0, '.') = 0 AS _nodot,
    CASE WHEN _nodot THEN (CASE WHEN ends_with(_d0 || _f0, '/') THEN _d0 || _f0 ELSE _d0 || _f0 || '/' END) ELSE _d0 END AS _d1,
    CASE WHEN _nodot THEN 'index.html' ELSE _f0 END AS _f1,
    replace(_d1, '.', '-') AS _d2,
    regexp_replace(regexp_extract(_f1, '^(.*)\\.[^.]*$', 1), '\\.', '-', 'g') AS _stem,
    regexp_extract(_f1, '\\.([^.]*)$', 1) AS _ext
  FROM rec),
paths AS (SELECT p.*, st.st_suffix IS NOT NULL AS suffix_known,
    CASE WHEN st.st_suffix IS NOT NULL THEN _stem || st.st_suffix ELSE _stem || '.' || _ext END AS _f2,
    regexp_replace(_d2, '^/', '') || CASE WHEN content_encoding = 'gzip' THEN _f2 || '.gz' ELSE _f2 END AS rel0
  FROM paths0 p LEFT JOIN {_suffix_values()} ON p.media_type = st.st_media_type),
caps AS (SELECT archive, seq, domain,
    row_number() OVER (PARTITION BY archive, domain, rel0 ORDER BY seq) - 1 AS _n,
    length(rel0) - strpos(reverse(rel0), '.') + 1 AS _dot,
    CASE WHEN _n = 0 THEN rel0 WHEN strpos(rel0, '.') > 0
         THEN substr(rel0, 1, _dot - 1) || '(' || CAST(_n AS VARCHAR) || ')' || substr(rel0, _dot)
         ELSE rel0 || '(' || CAST(_n AS VARCHAR) || ')' END AS rel_path,
    {capture_ts('archive')} AS capture_ts, media_type, content_encoding,
    CAST(strlen(body) AS BIGINT) AS size, http_status, body
  FROM paths)"""

_bs, _bsf = base_site("URL", "_s")
SITES = f"""
sheet AS (SELECT page_id AS row, CASE WHEN page_id % 2 = 0 THEN url END AS URL FROM pages),
sheet2 AS (SELECT row, URL, {', '.join(_bs)}, {base_url('URL')} AS base_url FROM sheet WHERE URL IS NOT NULL AND URL <> ''),
sites AS (SELECT DISTINCT {_bsf} AS domain FROM sheet2 WHERE {_bsf} IS NOT NULL),
dmap AS (SELECT {_bsf} AS domain, arg_min(base_url, row) AS base_url FROM sheet2 WHERE {_bsf} IS NOT NULL GROUP BY 1)"""

_nn, _nnf = normalized_name("rel_path", "_m")
LATEST = f"""
allowed AS (SELECT * FROM caps WHERE domain IN (SELECT domain FROM sites)),
allowed_n AS (SELECT allowed.*, {', '.join(_nn)} FROM allowed),
dedup AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY archive, domain, {_nnf}
            ORDER BY size DESC, length(rel_path), rel_path) AS _rn FROM allowed_n) WHERE _rn = 1),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY domain, rel_path
            ORDER BY capture_ts DESC NULLS LAST, archive) AS _rn2 FROM dedup) WHERE _rn2 = 1)"""

_kw = _list(D.HTML_EXCLUDE_FILE_KEYWORDS)


def _deny_clause() -> str:
    if not D.EXCLUDE_DOMAINS:
        return ""
    return "AND domain NOT IN (" + ", ".join(_lit(d) for d in D.EXCLUDE_DOMAINS) + ")"

HTMLDOCS = f"""
conv0 AS (SELECT domain, rel_path, capture_ts, archive, {html_text('body')} AS text
  FROM latest
  WHERE regexp_matches(rel_path, {_lit(D.HTML_FILE_PATTERN)})
    AND NOT list_bool_or(list_transform({_kw}, lambda kw: strpos(lower(regexp_extract(rel_path, '([^/]*)$', 1)), kw) > 0))
    {_deny_clause()}),
conv AS (SELECT *, CASE WHEN text IS NULL THEN 'failed' WHEN text IN ('', {_lit(T.REDIRECT_TEXT)}) THEN 'skipped' ELSE 'converted' END AS status FROM conv0),
hd0 AS (SELECT c.domain, c.rel_path, c.capture_ts, c.text, m.base_url,
    CASE WHEN ends_with(c.rel_path, '.html.gz') THEN substr(c.rel_path, 1, length(c.rel_path) - 8) || '.md'
         WHEN ends_with(c.rel_path, '.pdf.gz') THEN substr(c.rel_path, 1, length(c.rel_path) - 7) || '.md'
         ELSE regexp_replace(c.rel_path, '([^/])\\.[^./]*$', '\\1') || '.md' END AS md,
    regexp_replace(md, '\\.md$', '') || '.html' AS page_path,
    CASE WHEN ends_with(m.base_url, '/') THEN m.base_url ELSE m.base_url || '/' END AS base,
    base || page_path AS url,
    CASE WHEN ends_with(page_path, '/index.html') THEN
           (CASE WHEN length(page_path) > 11 THEN base || substr(page_path, 1, length(page_path) - 11) ELSE regexp_replace(base, '/+$', '') END)
         WHEN page_path = 'index.html' THEN regexp_replace(base, '/+$', '') ELSE url END AS url_preview,
    regexp_extract(md, '([^/]*)$', 1) AS file_name
  FROM conv c LEFT JOIN dmap m ON c.domain = m.domain WHERE c.status = 'converted'),
hd1 AS (SELECT domain || '/' || md AS file_path, file_name, domain,
    {heading_title('text', "regexp_replace(file_name, '\\.md$', '')")} AS title,
    {_lit(D.DEFAULT_SOURCE)} AS source, url, url_preview, capture_ts AS retrieval_date, 'html' AS kind, text, rel_path
  FROM hd0),
hdocs AS (SELECT * EXCLUDE (_rn3) FROM (SELECT *, row_number() OVER (PARTITION BY file_path
            ORDER BY retrieval_date DESC NULLS LAST, rel_path) AS _rn3 FROM hd1) WHERE _rn3 = 1)"""


def clean_ctes(src: str, out: str, key: str) -> str:
    """F10 + P17 + F11 on ``src(key, text, ...)`` -> ``out`` (same columns, cleaned text)."""
    return f"""
{out}_a AS (SELECT * REPLACE (regexp_replace({drop_long_lines('text')}, '[^{WS}]{{{T.GARBAGE_RUN},}}', '', 'g') AS text) FROM {src}),
{out}_c AS (SELECT {key}, unnest(regexp_extract_all(text, '(?s).')) AS ch, unnest(range(1, len(regexp_extract_all(text, '(?s).')) + 1)) AS i FROM {out}_a),
{out}_g AS (SELECT *, i - row_number() OVER (PARTITION BY {key}, ch ORDER BY i) AS grp FROM {out}_c),
{out}_r AS (SELECT *, count(*) OVER (PARTITION BY {key}, ch, grp) AS run_len,
                 row_number() OVER (PARTITION BY {key}, ch, grp ORDER BY i) AS in_run FROM {out}_g),
{out}_t AS (SELECT {key}, string_agg(ch, '' ORDER BY i) AS text FROM {out}_r
            WHERE ch = {NL} OR run_len < {T.REPEAT_MIN} OR in_run <= {T.REPEAT_KEEP} GROUP BY {key}),
{out} AS (SELECT a.* REPLACE (coalesce(t.text, '') AS text) FROM {out}_a a LEFT JOIN {out}_t t ON a.{key} = t.{key}
          WHERE NOT regexp_matches(coalesce(t.text, ''), '^[{WS}]*$'))"""


def chunk_ctes(src: str, out: str, key: str, keep: str = "") -> str:
    stride = T.CHUNK_TOKENS - T.CHUNK_OVERLAP
    keep_sql = (keep + ", ") if keep else ""
    return f"""
{out}_k AS (SELECT {keep_sql}{key}, {tokens('text')} AS toks, len(toks) AS n,
            CASE WHEN n <= 0 THEN []::INTEGER[] ELSE range(0, greatest(n - {T.CHUNK_OVERLAP} - 1, 0) + 1, {stride}) END AS starts,
            list_transform(starts, lambda s: array_to_string(toks[s + 1 : s + {T.CHUNK_TOKENS}], ' ')) AS chunks FROM {src}),
{out} AS (SELECT {keep_sql}{key}, unnest(chunks) AS text, unnest(range(len(chunks))) AS pos FROM {out}_k)"""


CORPUS = """
corpus AS (SELECT source || '/' || CAST(doc_id AS VARCHAR) || '.md' AS file_path,
                  CAST(doc_id AS VARCHAR) || '.md' AS file_name, source AS domain, doc_id, lang, text FROM documents)"""

_rn1, _rn1f = normalize_url("url", "_u")
QUESTIONS = f"""
npages AS (SELECT count(*) AS n FROM pages),
qsheet AS (SELECT b.item_id AS row, b.text AS question,
    p1.url AS rel_1,
    CASE WHEN b.item_id % 10 = 9 THEN '  ' ELSE
      regexp_replace(regexp_replace(regexp_replace(p2.url, '[?#].*$', ''), '/+$', ''), '^(https?://)(www\\.)?', '\\1www.') || '/index.html' END AS rel_2
  FROM benchmark b, npages
  LEFT JOIN pages p1 ON p1.page_id = ((b.item_id * 7) % npages.n + npages.n) % npages.n
  LEFT JOIN pages p2 ON p2.page_id = ((b.item_id * 13 + 3) % npages.n + npages.n) % npages.n),
questions AS (SELECT row AS qid, trim(question) AS question FROM qsheet WHERE question IS NOT NULL AND trim(question) <> ''),
qlong AS (SELECT * FROM (
    SELECT row AS qid, 1 AS pos, trim(rel_1) AS url FROM qsheet WHERE question IS NOT NULL AND trim(question) <> ''
    UNION ALL SELECT row AS qid, 2 AS pos, trim(rel_2) AS url FROM qsheet WHERE question IS NOT NULL AND trim(question) <> '')
  WHERE url IS NOT NULL AND url <> ''),
qhost AS (SELECT *, lower(regexp_extract(url, {_lit(RFC)}, 4)) AS host FROM qlong),
rel_main AS (SELECT qid, pos, url FROM qhost
  WHERE host IN (SELECT domain FROM sites) OR (starts_with(host, 'www.') AND substr(host, 5) IN (SELECT domain FROM sites))),
qmain AS (SELECT * FROM questions WHERE qid IN (SELECT qid FROM rel_main)),
exps AS (SELECT b.item_id AS qid,
    CASE WHEN b.item_id % 3 = 0 THEN concat_ws(' ', b.text, regexp_extract(p.html, '(?is)<title[^>]*>(.*?)</title>', 1)) ELSE '' END AS expanded
  FROM benchmark b, npages LEFT JOIN pages p ON p.page_id = ((b.item_id * 7) % npages.n + npages.n) % npages.n
  WHERE b.item_id % 3 <> 2),
xq AS (SELECT q.qid, q.question, coalesce(nullif(trim(e.expanded), ''), q.question) AS search_text
  FROM qmain q LEFT JOIN exps e ON q.qid = e.qid)"""

_scen_rows = ", ".join(f"({_lit(n)}, {str(e).upper()}, {str(r).upper()})" for n, e, r in Q.SCENARIOS)
HITS = f"""
{clean_ctes('hdocs', 'hclean', 'file_path')},
{chunk_ctes('hclean', 'hch', 'file_path', keep='url, url_preview')},
corpus_vec AS (SELECT file_path || '#' || CAST(pos AS VARCHAR) AS chunk_id, url, url_preview, text,
                      {hashed_vector('text', 128)} AS emb FROM hch),
variants AS (SELECT qid, question, FALSE AS expanded, question AS search_text FROM xq
             UNION ALL SELECT qid, question, TRUE AS expanded, search_text FROM xq),
qv AS (SELECT *, {hashed_vector('search_text', 128)} AS qemb FROM variants),
scored AS (SELECT v.qid, v.question, v.expanded, c.chunk_id, c.url, c.url_preview, c.text,
                  {cosine('v.qemb', 'c.emb')} AS score FROM qv v, corpus_vec c),
ranked AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid, expanded ORDER BY score DESC, chunk_id) AS rank
           FROM scored) WHERE rank <= {Q.EVAL_K}),
scen AS (SELECT * FROM (VALUES {_scen_rows}) AS s(scenario, use_expansion, use_rerank)),
sj AS (SELECT s.scenario, s.use_rerank, r.* FROM ranked r JOIN scen s ON r.expanded = s.use_expansion),
rr_scored AS (SELECT *, CASE WHEN coalesce(text, '') = '' THEN '-inf'::DOUBLE ELSE
                 len(list_intersect(list_distinct({terms('question')}), list_distinct({terms('text')})))::DOUBLE END AS rerank_score
              FROM sj WHERE use_rerank),
rrk AS (SELECT * FROM (SELECT * EXCLUDE (rank), rank AS retrieval_rank,
           row_number() OVER (PARTITION BY scenario, qid ORDER BY rerank_score DESC, rank) AS rank FROM rr_scored) WHERE rank <= {Q.EVAL_K}),
hits AS (SELECT scenario, qid, rank, rank AS retrieval_rank, round(score, 6) AS score, NULL::DOUBLE AS rerank_score, chunk_id, url, url_preview
         FROM sj WHERE NOT use_rerank
         UNION ALL SELECT scenario, qid, rank, retrieval_rank, round(score, 6) AS score, rerank_score, chunk_id, url, url_preview FROM rrk)"""

_hn, _hnf = normalize_url("url", "_hu")
_hp, _hpf = normalize_url("url_preview", "_hp")
_rn, _rnf = normalize_url("url", "_ru")
EVAL = f"""
hn AS (SELECT scenario, qid, rank, {', '.join(_hn)}, {', '.join(_hp)} FROM hits),
rn AS (SELECT qid, pos, url AS relevant_url, {', '.join(_rn)} FROM rel_main),
ranks AS (SELECT h.scenario, h.qid, r.pos, r.relevant_url, min(h.rank) AS match_rank FROM hn h JOIN rn r
          ON h.qid = r.qid AND ({url_match(_hnf, _rnf)} OR {url_match(_hpf, _rnf)})
          GROUP BY 1, 2, 3, 4),
per AS (SELECT s.scenario, r.qid, r.pos, r.url, k.match_rank FROM rel_main r CROSS JOIN scen s
        LEFT JOIN ranks k ON k.scenario = s.scenario AND k.qid = r.qid AND k.pos = r.pos
        WHERE r.qid IN (SELECT qid FROM qmain)),
cnt AS (SELECT scenario, qid, count(*) AS retrieved_count FROM hits GROUP BY 1, 2),
ev AS (SELECT p.scenario, p.qid, CAST(coalesce(any_value(c.retrieved_count), 0) AS BIGINT) AS retrieved_count,
         CAST(count(*) AS INTEGER) AS n_relevant,
         coalesce(string_agg(CASE WHEN match_rank IS NOT NULL THEN url END, '|' ORDER BY pos), '') AS found_docs,
         coalesce(string_agg(CASE WHEN match_rank IS NULL THEN url END, '|' ORDER BY pos), '') AS missing_docs,
         coalesce(string_agg(CAST(match_rank AS VARCHAR), '|' ORDER BY pos), '') AS all_ranks,
         count(match_rank) > 0 AS success,
         CAST(arg_min(match_rank, pos) FILTER (WHERE match_rank IS NOT NULL) AS BIGINT) AS rank_of_first_match,
         min(match_rank) AS best_rank,
         count(match_rank) AS n_found
       FROM per p LEFT JOIN cnt c ON c.scenario = p.scenario AND c.qid = p.qid GROUP BY 1, 2)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts)


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["site_list"] = _with(SITES) + " SELECT domain FROM sites"
    q["domain_map"] = _with(SITES) + " SELECT domain, base_url FROM dmap"
    q["lookup_export"] = _with(SITES) + " SELECT domain, to_json(struct_pack(domain := domain, base_url := base_url))::VARCHAR AS json FROM dmap"
    bs, bsf = base_site("url", "_b")
    q["base_site"] = (f"SELECT page_id, url, base_site, base_url FROM (SELECT page_id, url, {', '.join(bs)}, "
                      f"{bsf} AS base_site, {base_url('url')} AS base_url FROM pages)")
    q["base_url"] = f"SELECT page_id, {base_url('url')} AS base_url FROM pages"
    q["suffix_repair"] = _with(RECORDS, PATHS) + " SELECT archive, seq, rel0 AS rel_path, suffix_known FROM paths"
    q["numbered_paths"] = _with(RECORDS, PATHS) + " SELECT archive, seq, domain, rel_path FROM caps"
    na, naf = normalize_url("url", "_na")
    q["url_matches"] = _with(SITES, QUESTIONS, f"qn AS (SELECT qid, pos, {', '.join(na)}, {naf} AS nu FROM qlong)") + (
        f" SELECT a.qid, a.pos AS pos_a, b.pos AS pos_b, {url_match('a.nu', 'b.nu')} AS matches FROM qn a JOIN qn b ON a.qid = b.qid")
    nu, nuf = normalize_url("url", "_n")
    q["normalized_urls"] = f"SELECT page_id, norm_url FROM (SELECT page_id, {', '.join(nu)}, {nuf} AS norm_url FROM pages)"
    q["archive_path"] = _with(RECORDS, PATHS) + " SELECT archive, seq, domain, rel0 AS rel_path, suffix_known FROM paths"
    q["captures"] = _with(RECORDS, PATHS) + " SELECT archive, seq, domain, rel_path, capture_ts, size, content_encoding, http_status FROM caps"
    q["capture_key"] = _with(RECORDS, PATHS) + " SELECT DISTINCT archive, capture_ts FROM caps"
    nn, nnf = normalized_name("rel_path", "_q")
    q["normalized_name"] = _with(RECORDS, PATHS) + f" SELECT archive, seq, rel_path, norm_name FROM (SELECT archive, seq, rel_path, {', '.join(nn)}, {nnf} AS norm_name FROM caps)"
    q["fingerprint"] = _with(RECORDS, PATHS) + (
        " SELECT archive, seq, CASE WHEN size < 24576 THEN md5(body) ELSE md5(encode(body)[1:8192] || "
        "encode(body)[CAST(floor(size / 2) AS BIGINT) + 1 : CAST(floor(size / 2) AS BIGINT) + 8192] || "
        "encode(body)[size - 8191 : size]) END AS fingerprint FROM caps")
    q["dedup_captures"] = _with(RECORDS, PATHS, SITES, LATEST) + " SELECT archive, seq, domain, rel_path, size, capture_ts FROM dedup"
    q["latest_captures"] = _with(RECORDS, PATHS, SITES, LATEST) + " SELECT domain, rel_path, archive, seq, capture_ts, size FROM latest"
    q["allowed_pages"] = _with(RECORDS, PATHS, SITES, LATEST) + " SELECT archive, seq, domain, rel_path FROM allowed"
    dbs, dbsf = base_site("url", "_d")
    q["denied_pages"] = _with(RECORDS, PATHS, f"deny AS (SELECT DISTINCT {dbsf} AS domain FROM (SELECT {', '.join(dbs)} FROM pages "
                              f"WHERE regexp_matches(url, {_lit(Q.DENY_PATTERN)})))") + (
        " SELECT archive, seq, domain, rel_path FROM caps WHERE domain IS NULL OR domain NOT IN (SELECT domain FROM deny WHERE domain IS NOT NULL)")
    q["domain_summary"] = _with(RECORDS, PATHS, SITES, LATEST) + " SELECT domain, count(*) AS files FROM latest GROUP BY ROLLUP (domain)"
    q["dup_counts"] = _with(RECORDS, PATHS, SITES, LATEST) + (
        f" SELECT archive, domain, CAST(sum(n - 1) AS BIGINT) AS duplicates_removed FROM "
        f"(SELECT archive, domain, {_nnf}, count(*) AS n FROM allowed_n GROUP BY 1, 2, 3) GROUP BY 1, 2")
    q["keyword_excluded"] = _with(RECORDS, PATHS) + (
        f" SELECT archive, seq, rel_path, list_bool_or(list_transform({_kw}, lambda kw: strpos(lower(regexp_extract(rel_path, '([^/]*)$', 1)), kw) > 0)) AS excluded FROM caps")
    q["page_titles"] = f"SELECT page_id, {html_title('html')} AS title FROM pages"
    q["page_text"] = f"SELECT page_id, {html_text('html')} AS text FROM pages"
    base_html = _with(RECORDS, PATHS, SITES, LATEST, HTMLDOCS)
    q["html_documents"] = base_html + " SELECT file_path, file_name, domain, title, source, url, url_preview, retrieval_date, kind, text FROM hdocs"
    q["page_urls"] = base_html + " SELECT file_path, url, url_preview FROM hdocs"
    q["retrieval_dates"] = base_html + " SELECT file_path, retrieval_date FROM hdocs"
    q["conversion_summary"] = base_html + (
        " SELECT domain, count(*) FILTER (WHERE status = 'converted') AS converted, count(*) FILTER (WHERE status = 'skipped') AS skipped,"
        " count(*) FILTER (WHERE status = 'failed') AS failed FROM conv GROUP BY ROLLUP (domain)")
    pdf = f"""
pp AS (SELECT conv_id AS file, 'doc' || CAST(conv_id AS VARCHAR) || '.pdf' AS file_name, turn AS page_no, CASE WHEN conv_id % 9 = 2 THEN ' ' || {NL} ELSE text END AS text FROM conversations),
pf AS (SELECT DISTINCT file, file_name FROM pp),
pa0 AS (SELECT file, count(*) AS n,
         string_agg(CASE WHEN NOT regexp_matches(coalesce(text, ''), '^[{WS}]*$') THEN '## Page ' || CAST(page_no + 1 AS VARCHAR) || {NL} || {NL} || text END, {NL} ORDER BY page_no) AS body
       FROM pp WHERE file % 11 <> 7 GROUP BY 1),
pa AS (SELECT file, file_name, coalesce(n, 0) AS n_pages, body FROM pf LEFT JOIN pa0 USING (file)),
pc AS (SELECT *, {py_strip(f"replace(replace(coalesce(body, ''), '¬' || {NL}, ''), '\\', '')")} AS cleaned FROM pa),
pdocs AS (SELECT file, file_name, n_pages,
    CASE WHEN n_pages = 0 THEN 'skipped' WHEN cleaned = '' THEN 'skipped' ELSE 'converted' END AS status,
    CASE WHEN n_pages = 0 THEN 'Empty Page Count' WHEN cleaned = '' THEN 'No Text Extracted' END AS reason,
    CASE WHEN cleaned <> '' THEN {_lit(D.PDF_TITLE_PREFIX)} || file_name || {NL} || {NL} || cleaned END AS text FROM pc)"""
    q["pdf_documents"] = _with(pdf) + " SELECT file, file_name, n_pages, status, reason, text FROM pdocs"
    q["pdf_summary"] = _with(pdf) + (
        f" SELECT c.status, c.files, l.examples FROM (SELECT status, count(*) AS files FROM pdocs GROUP BY 1) c LEFT JOIN"
        f" (SELECT status, string_agg(file || '  [' || coalesce(reason, '') || ']', {NL} ORDER BY file) AS examples FROM"
        f" (SELECT *, row_number() OVER (PARTITION BY status ORDER BY file) AS rn FROM pdocs WHERE status <> 'converted')"
        f" WHERE rn <= {D.EXAMPLES_PER_STATUS} GROUP BY 1) l ON c.status = l.status")
    q["documents_union"] = _with(RECORDS, PATHS, SITES, LATEST, HTMLDOCS, pdf) + (
        " SELECT file_path, kind, title, text FROM hdocs UNION ALL"
        " SELECT 'pdf/' || regexp_replace(file_name, '\\.pdf(\\.gz)?$', '.md') AS file_path, 'pdf' AS kind,"
        " regexp_replace(regexp_replace(file_name, '\\.pdf(\\.gz)?$', '.md'), '\\.md$', '') AS title, text FROM pdocs WHERE status = 'converted'")
    q["text_preview"] = f"SELECT doc_id, substr(text, 1, {T.PREVIEW_CHARS}) || '...' AS preview FROM documents"
    q["long_lines_dropped"] = (f"SELECT doc_id, {count_long_lines('text')} AS dropped_lines, length({drop_long_lines('text')}) AS chars_kept FROM documents")
    q["garbage_cleaned"] = _with("gsrc AS (SELECT doc_id, text FROM documents)", clean_ctes("gsrc", "gc", "doc_id").replace(
        f"WHERE NOT regexp_matches(coalesce(t.text, ''), '^[{WS}]*$')", "")) + " SELECT doc_id, text FROM gc"
    q["doc_titles"] = _with(CORPUS) + f" SELECT file_path, {heading_title('text', "regexp_replace(file_name, '\\.md$', '')")} AS title FROM corpus"
    corpus_chunks = _with(CORPUS, clean_ctes("corpus", "cclean", "file_path"), chunk_ctes("cclean", "cch", "file_path"))
    q["chunk_tokens"] = corpus_chunks + (
        f" SELECT file_path || '#' || CAST(pos AS VARCHAR) AS chunk_id, file_path, CAST(pos AS INTEGER) AS pos, len({tokens('text')}) AS n_tokens, text FROM cch")
    q["chunk_embeddings"] = corpus_chunks + (
        f" SELECT chunk_id, array_to_string(list_transform(v, lambda x: CAST(CAST(x AS INTEGER) AS VARCHAR)), ',') AS vec,"
        f" len(list_filter(v, lambda x: x > 0)) AS nnz FROM (SELECT file_path || '#' || CAST(pos AS VARCHAR) AS chunk_id, {hashed_vector('text', 128)} AS v FROM cch)")
    q["knn_exact"] = (
        f"SELECT qid, rank, round(score, 6) AS score, vec_id FROM (SELECT a.vec_id AS qid, b.vec_id, "
        f"{cosine('a.embedding::DOUBLE[]', 'b.embedding::DOUBLE[]')} AS score, "
        f"row_number() OVER (PARTITION BY a.vec_id ORDER BY score DESC, b.vec_id) AS rank FROM embeddings a, embeddings b) "
        f"WHERE rank <= {Q.SELF_SEARCH_K}")
    base_q = _with(SITES, QUESTIONS)
    q["questions_long"] = base_q + " SELECT qid, pos, url FROM qlong"
    q["main_domain_docs"] = base_q + " SELECT qid, pos, url FROM rel_main"
    q["expanded_queries"] = base_q + " SELECT qid, search_text FROM xq"
    base_hits = _with(RECORDS, PATHS, SITES, LATEST, HTMLDOCS, QUESTIONS, HITS)
    q["batch_search"] = base_hits + " SELECT scenario, qid, rank, retrieval_rank, score, chunk_id, url FROM hits"
    q["reranked"] = base_hits + (f" SELECT qid, rank, retrieval_rank, rerank_score, chunk_id FROM hits WHERE scenario = {_lit(Q.SCENARIOS[2][0])}")
    base_eval = _with(RECORDS, PATHS, SITES, LATEST, HTMLDOCS, QUESTIONS, HITS, EVAL)
    q["relevance_ranks"] = base_eval + " SELECT scenario, qid, pos, relevant_url, match_rank FROM ranks"
    q["eval_questions"] = base_eval + (
        " SELECT scenario, qid, retrieved_count, n_relevant, found_docs, missing_docs, all_ranks, success,"
        " CAST(rank_of_first_match AS DOUBLE) AS rank_of_first_match, CAST(best_rank AS DOUBLE) AS best_rank FROM ev")
    q["scenario_metrics"] = base_eval + (
        " SELECT scenario, count(*) FILTER (WHERE success) AS successful, count(*) - count(*) FILTER (WHERE success) AS failed,"
        " (count(*) FILTER (WHERE success))::DOUBLE / count(*) AS accuracy, sum(n_found)::DOUBLE / sum(n_relevant) AS recall,"
        " avg(rank_of_first_match) AS avg_rank_first_match FROM ev GROUP BY 1")
    ks = ", ".join(f"({k})" for k in [1, 3, 5, 10, 25, 50, 100])
    acc = f" acc AS (SELECT scenario, k, (count(*) FILTER (WHERE best_rank <= k))::DOUBLE / count(*) AS accuracy FROM ev, (VALUES {ks}) AS kk(k) GROUP BY 1, 2)"
    q["accuracy_at_k"] = base_eval + "," + acc + " SELECT scenario, k, accuracy FROM acc"
    cols = ", ".join(f"any_value(printf('%.1f%%', round(accuracy * 100, 1))) FILTER (WHERE k = {k}) AS k_{k}" for k in [1, 3, 5, 10, 25, 50, 100])
    q["accuracy_report"] = base_eval + "," + acc + f" SELECT scenario, {cols} FROM acc GROUP BY scenario"
    q["scenario_compare"] = base_eval + "," + acc + (
        f", rep AS (SELECT scenario, {cols} FROM acc GROUP BY scenario),"
        " met AS (SELECT scenario, count(*) FILTER (WHERE success) AS successful, count(*) - count(*) FILTER (WHERE success) AS failed,"
        " (count(*) FILTER (WHERE success))::DOUBLE / count(*) AS accuracy, sum(n_found)::DOUBLE / sum(n_relevant) AS recall,"
        " avg(rank_of_first_match) AS avg_rank_first_match FROM ev GROUP BY 1)"
        " SELECT met.*, " + ", ".join(f"rep.k_{k}" for k in [1, 3, 5, 10, 25, 50, 100]) + " FROM met JOIN rep USING (scenario)")
    recs = RECORDS + f""",
recs AS (SELECT archive, seq * 2 AS "offset", 'request' AS warc_type, target_uri, NULL AS http_status, NULL AS media_type, NULL AS reason,
           'GET' AS command, regexp_extract(target_uri, '^[^:]*://[^/?#]*([^#]*)', 1) AS path,
           'application/http; msgtype=request' AS wct, FALSE AS is_resp, NULL AS ctype, content_encoding, NULL::BLOB AS body FROM rec
         UNION ALL
         SELECT archive, seq * 2 + 1, 'response', target_uri, http_status, lower(trim(split_part(ctype, ';', 1))),
           CASE http_status WHEN '404' THEN 'Not Found' WHEN '301' THEN 'Moved Permanently' ELSE 'OK' END, NULL, NULL,
           'application/http; msgtype=response', TRUE, ctype, content_encoding, encode(body) FROM
           (SELECT *, CASE WHEN media_type <> 'text/html' THEN media_type WHEN page_id % 3 = 0 THEN 'Text/HTML; charset=UTF-8' ELSE 'text/html; charset=utf-8' END AS ctype FROM rec))"""
    q["record_census"] = _with(recs) + (
        " SELECT counter, value, count(*) AS n FROM ("
        " SELECT 'records' AS counter, NULL AS value FROM recs"
        " UNION ALL SELECT 'types', warc_type FROM recs"
        " UNION ALL SELECT 'warc-content', lower(trim(split_part(wct, ';', 1))) FROM recs"
        " UNION ALL SELECT 'http-content', media_type FROM recs"
        " UNION ALL SELECT 'unknown-media', media_type FROM recs WHERE media_type NOT IN ('text/html', 'application/pdf')"
        " UNION ALL SELECT 'status', http_status FROM recs) GROUP BY 1, 2")
    q["header_filter"] = _with(recs) + (
        " SELECT archive, \"offset\", target_uri FROM recs WHERE warc_type = 'response' AND strpos(lower(wct), 'application/http') > 0"
        " AND ctype IS NOT NULL AND strpos(lower(ctype), 'text/html') > 0 AND http_status IS NOT NULL AND http_status <> ''"
        " AND strpos(http_status, '404') = 0")
    q["media_types"] = _with(recs) + (
        " SELECT archive, \"offset\", lower(trim(split_part(ctype, ';', 1))) AS media_type,"
        " nullif(trim(split_part(trim(lower(split_part(ctype, ';', 2))), '=', 2)), '') AS charset FROM recs WHERE is_resp")
    q["pdf_records"] = _with(recs) + " SELECT archive, \"offset\", target_uri FROM recs WHERE is_resp AND strpos(lower(ctype), 'pdf') > 0"
    q["header_filter_keys"] = _with(recs) + (
        " SELECT f.filter AS filter, count(*) FILTER (WHERE f.kept) AS n FROM (SELECT unnest(["
        " {'filter': 'http:status:not found', 'kept': reason = 'Not Found'}, {'filter': 'http:error:404', 'kept': http_status = '404'},"
        " {'filter': '!http:error:404', 'kept': http_status <> '404'}, {'filter': 'http:version:1.1', 'kept': true},"
        " {'filter': 'http:command:get', 'kept': command = 'GET'}, {'filter': 'http:path:/en/', 'kept': strpos(lower(path), '/en/') > 0},"
        " {'filter': 'http:content_type:pdf', 'kept': media_type = 'application/pdf'},"
        " {'filter': 'http:charset:utf-8', 'kept': strpos(lower(ctype), 'charset=utf-8') > 0},"
        " {'filter': 'warc-type:request', 'kept': warc_type = 'request'}, {'filter': '!http:status:ok', 'kept': reason <> 'OK'}]) AS f"
        " FROM recs) GROUP BY 1")
    q["pdf_captures"] = _with(RECORDS, PATHS) + (
        " SELECT archive, seq, rel_path FROM caps WHERE regexp_matches(rel_path, '\\.(pdf|pdf\\.gz)$') AND NOT regexp_matches("
        "lower(regexp_extract(rel_path, '([^/]*)$', 1)), 'impressum|datenschutz|kontakt|robots|imprint|data-protection|contact|copyright')")
    read = (" archive, warc_type, target_uri, http_status")
    q["records"] = _with(recs) + (
        f" SELECT{read}, reason AS http_reason, command AS http_command, media_type, coalesce(octet_length(body), 0)::BIGINT AS body_bytes, NULL::VARCHAR AS error FROM recs")
    q["ingest_stream"] = _with(recs) + " SELECT archive, warc_type, target_uri FROM recs"
    q["ingest_summary"] = _with(recs) + " SELECT true AS ok, count(DISTINCT archive) AS archives FROM recs UNION ALL SELECT false, 1 WHERE EXISTS (SELECT 1 FROM recs)"
    q["record_errors"] = _with(recs) + " SELECT 'DAMAGED-00000.warc.gz' AS archive, true AS told, true AS read_before WHERE EXISTS (SELECT 1 FROM recs)"
    q["records_filtered"] = q["header_filter"].replace("SELECT archive, \"offset\", target_uri FROM recs", f"SELECT{read} FROM recs")
    html_caps = PATHS[PATHS.index("caps AS ("):].replace("caps AS (", "hcaps AS (", 1).replace("FROM paths)", "FROM paths WHERE media_type = 'text/html')")
    q["archive_captures"] = _with(RECORDS, PATHS, html_caps) + " SELECT archive, domain, rel_path, capture_ts, size, content_encoding FROM hcaps"
    q["capture_sink"] = _with(RECORDS, PATHS, SITES, LATEST) + " SELECT domain, rel_path, archive, size FROM latest"
    q["lookup_import"] = q["domain_map"]
    q["timestamp_map"] = _with(RECORDS, PATHS, SITES, LATEST) + (
        " SELECT domain || '/' || rel_path AS page, strftime(capture_ts, '%Y-%m-%dT%H:%M:%S') AS retrieved FROM latest")
    q["folder_key"] = _with(RECORDS, PATHS) + (
        f" SELECT DISTINCT archive || '_' || domain AS folder, capture_ts, domain FROM caps")
    q["dropped_lines_total"] = f"SELECT CAST(sum({count_long_lines('text')}) AS BIGINT) AS dropped_lines, count(*) AS documents FROM documents"
    q["page_url_variants"] = _with(RECORDS, PATHS, SITES, LATEST, f"""
hp AS (SELECT l.domain, l.rel_path, m.base_url,
    regexp_replace(CASE WHEN ends_with(l.rel_path, '.html.gz') THEN substr(l.rel_path, 1, length(l.rel_path) - 8) || '.md'
         ELSE regexp_replace(l.rel_path, '([^/])\\.[^./]*$', '\\1') || '.md' END, '\\.md$', '') || '.html' AS page,
    CASE WHEN ends_with(m.base_url, '/') THEN m.base_url ELSE m.base_url || '/' END || 'snapshots/' || page AS url
  FROM latest l LEFT JOIN dmap m ON l.domain = m.domain WHERE regexp_matches(l.rel_path, '\\.(html|htm|html\\.gz)$'))""") + (
        " SELECT domain, rel_path, 'base path' AS variant, url, CASE WHEN ends_with(url, '/index.html') THEN substr(url, 1, length(url) - 11) ELSE url END AS url_preview FROM hp"
        " UNION ALL SELECT domain, rel_path, 'root file', base_url, base_url FROM hp")
    q["markdown_tree"] = base_html + " SELECT file_path, domain, length(text) AS chars FROM hdocs"
    q["eval_export"] = q["scenario_metrics"].replace(", avg(rank_of_first_match) AS avg_rank_first_match", "").replace(
        " avg(rank_of_first_match) AS avg_rank_first_match", "").replace(" AS recall, FROM", " AS recall FROM")
    streamed = _with(CORPUS, clean_ctes("corpus", "cclean", "file_path"), chunk_ctes("cclean", "cch", "file_path", keep="domain"))
    q["index_stream"] = streamed + " SELECT file_path || '#' || CAST(pos AS VARCHAR) AS chunk_id, file_path, CAST(pos AS INTEGER) AS pos, domain FROM cch"
    q["chunk_sentences"] = _with(CORPUS, clean_ctes("corpus", "cclean", "file_path")).replace("WITH", "WITH RECURSIVE", 1) + f""",
lines AS (SELECT file_path, unnest(string_split(regexp_replace(text, '([.!?])[{WS}]+', '\\1' || {NL}, 'g'), {NL})) AS text,
                 unnest(range(len(string_split(regexp_replace(text, '([.!?])[{WS}]+', '\\1' || {NL}, 'g'), {NL})))) AS line FROM cclean),
sents AS (SELECT file_path, line, {tokens('text')} AS toks FROM lines),
cut AS (SELECT file_path, line, unnest(CASE WHEN len(toks) <= 512 THEN [0] ELSE range(0, len(toks) - 64, 448) END) AS win, toks FROM sents WHERE len(toks) > 0),
pc AS MATERIALIZED (SELECT file_path, row_number() OVER f - 1 AS i, toks[win + 1 : win + 512] AS t, len(t) AS n,
              coalesce(sum(len(toks[win + 1 : win + 512])) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at
       FROM cut WINDOW f AS (PARTITION BY file_path ORDER BY line, win)),
ends AS MATERIALIZED (SELECT a.file_path, a.i AS s, max(b.i) + 1 AS e FROM pc a JOIN pc b ON a.file_path = b.file_path AND b.i >= a.i AND b.at + b.n - a.at <= 512 GROUP BY ALL),
nexts AS MATERIALIZED (SELECT x.file_path, x.s, min(coalesce(t.i, x.e)) AS nxt FROM ends x JOIN pc o ON o.file_path = x.file_path AND o.i = x.e
          LEFT JOIN pc t ON t.file_path = x.file_path AND t.i <= x.e AND o.at - t.at <= 64 AND o.at + o.n - t.at <= 512 GROUP BY ALL),
reached AS (SELECT DISTINCT file_path, 0::BIGINT AS s, 0 AS pos FROM pc
            UNION ALL SELECT r.file_path, n.nxt, r.pos + 1 FROM reached r JOIN nexts n ON n.file_path = r.file_path AND n.s = r.s)
SELECT r.file_path || '#' || r.pos AS chunk_id, r.file_path, r.pos::INTEGER AS pos, sum(p.n)::INTEGER AS n_tokens,
       string_agg(array_to_string(p.t, ' '), ' ' ORDER BY p.i) AS text
FROM reached r JOIN ends x ON x.file_path = r.file_path AND x.s = r.s JOIN pc p ON p.file_path = r.file_path AND p.i >= x.s AND p.i < x.e
GROUP BY r.file_path, r.pos"""
    md = "CASE WHEN ends_with(rel_path, '.html.gz') THEN substr(rel_path, 1, length(rel_path) - 8) || '.md' WHEN ends_with(rel_path, '.pdf.gz') THEN substr(rel_path, 1, length(rel_path) - 7) || '.md' ELSE regexp_replace(rel_path, '([^/])\\.[^./]*$', '\\1') || '.md' END"
    q["imported_times"] = _with(RECORDS, PATHS, SITES, LATEST, f"""
lk AS (SELECT domain || '/' || {md} AS file_path, rel_path, archive, domain, capture_ts, ('0x' || md5(domain || '/' || rel_path)[1:6])::BIGINT AS n FROM latest),
tm AS (SELECT file_path, capture_ts - INTERVAL 1 HOUR AS t FROM lk WHERE n % 3 <> 0 UNION SELECT file_path, capture_ts + INTERVAL 365 DAY FROM lk WHERE n % 3 <> 0),
fd AS (SELECT *, CASE WHEN n % 5 = 0 THEN 'crawl_' || domain ELSE archive || '_' || domain END AS folder, CASE WHEN n % 5 <> 0 THEN capture_ts END AS stamp FROM lk),
got AS (SELECT f.rel_path, f.file_path, f.folder, f.stamp, coalesce(max(t) FILTER (WHERE t <= f.stamp), max(t)) AS mapped
        FROM fd f LEFT JOIN tm ON tm.file_path = f.file_path AND t IS NOT NULL GROUP BY ALL)""") + (
        " SELECT file_path, rel_path, folder, strftime(coalesce(mapped, stamp), '%Y-%m-%dT%H:%M:%S') AS retrieval_date,"
        " CASE WHEN mapped IS NOT NULL THEN 'map' WHEN stamp IS NOT NULL THEN 'folder' ELSE 'none' END AS time_source FROM got")
    q["expanded_by_model"] = (
        "SELECT item_id AS qid, CASE WHEN length(trim(text)) % 7 = 0 OR length(trim(text)) % 5 = 0 THEN text ELSE trim(text) || ' ' || lower(trim(text)) END AS search_text,"
        " CASE WHEN length(trim(text)) % 7 = 0 THEN 'failed' WHEN length(trim(text)) % 5 = 0 THEN 'empty' ELSE 'ok' END AS status,"
        " CASE WHEN length(trim(text)) % 7 = 0 OR length(trim(text)) % 5 = 0 THEN 2 ELSE 1 END::BIGINT AS sent FROM benchmark")
    asked = _with(RECORDS, PATHS, SITES, LATEST, HTMLDOCS, QUESTIONS, HITS, "ah AS (SELECT qid, question, chunk_id, text, rank AS retrieval_rank FROM ranked WHERE NOT expanded)")
    q["reranked_bm25"] = asked + f""",
ct AS (SELECT chunk_id, {terms('text')} AS t FROM corpus_vec),
stat AS (SELECT count(*) AS n, avg(len(t)) AS mean FROM ct),
df AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT chunk_id, unnest(t) AS term FROM ct) GROUP BY 1),
qt AS (SELECT DISTINCT qid, chunk_id, unnest({terms('question')}) AS term FROM ah),
tf AS (SELECT qt.qid, qt.chunk_id, qt.term, len(list_filter(ct.t, lambda x: x = qt.term)) AS tf, len(ct.t) AS len FROM qt JOIN ct USING (chunk_id)),
sc AS (SELECT qid, chunk_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * (tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean)))) AS s
       FROM tf JOIN df USING (term), stat WHERE tf > 0 GROUP BY 1, 2)
SELECT qid, chunk_id, round(coalesce(s, 0), 9) AS rerank_score, retrieval_rank FROM ah LEFT JOIN sc USING (qid, chunk_id)"""
    q["reranked_by_scorer"] = asked + (
        ", sb AS (SELECT *, CASE WHEN contains(lower(text), lower(split_part(trim(question), ' ', 1))) THEN 1.0 ELSE 0.0 END - length(text) / 1e6 AS s FROM ah)"
        " SELECT qid, chunk_id, round(s::DOUBLE, 6) AS rerank_score, row_number() OVER (PARTITION BY qid ORDER BY s DESC, retrieval_rank) AS rank, retrieval_rank FROM sb")
    latin = "regexp_replace(html, '[^\\x{00}-\\x{FF}]', '?', 'g')"
    q["decoded_pages"] = (
        "SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'UTF-8' WHEN 1 THEN 'UTF-8' WHEN 2 THEN 'UTF-16LE' WHEN 3 THEN 'ISO-8859-1' WHEN 4 THEN 'ISO-8859-1'"
        f" ELSE CASE WHEN regexp_matches({latin}, '[\\x{{80}}-\\x{{FF}}]') THEN 'ISO-8859-1' ELSE 'UTF-8' END END AS charset,"
        f" md5(CASE WHEN page_id % 6 <= 2 THEN html WHEN page_id % 6 = 4 THEN '<meta charset=\"latin1\">' || {latin} ELSE {latin} END) AS text_md5 FROM pages")
    both = _with(RECORDS, PATHS, SITES, LATEST, HTMLDOCS, CORPUS, clean_ctes("hdocs", "kclean", "file_path"), chunk_ctes("kclean", "kch", "file_path"),
                 clean_ctes("corpus", "cclean", "file_path"), chunk_ctes("cclean", "cch", "file_path"))
    q["indexed_keys"] = both + (
        " SELECT file_path AS key, string_agg(DISTINCT kind, ',' ORDER BY kind) AS kinds FROM"
        " (SELECT file_path, 'page' AS kind FROM kch UNION ALL SELECT file_path, 'document' FROM cch) GROUP BY 1")
    q["adaptive_embed"] = corpus_chunks + " SELECT file_path || '#' || CAST(pos AS VARCHAR) AS chunk_id, file_path, 64::BIGINT AS dim FROM cch"
    q["payload_digests"] = _with(recs) + " SELECT archive, \"offset\", 'sha1:' || sha1(body) AS payload_digest FROM recs WHERE is_resp"
    q["document_export"] = base_html + (
        " SELECT row_number() OVER (ORDER BY file_path) - 1 AS doc_id, coalesce(file_path, '') AS file_path, coalesce(title, '') AS title,"
        " coalesce(url, '') AS url, coalesce(url_preview, '') AS url_preview,"
        " coalesce(strftime(retrieval_date, '%Y-%m-%dT%H:%M:%S'), '') AS retrieval_date FROM hdocs")
    store = _with(CORPUS, "stored_src AS (SELECT * FROM corpus WHERE lang = " + _lit(Q.STORED_LANG) + ")",
                  clean_ctes("stored_src", "sclean", "file_path"), chunk_ctes("sclean", "sch", "file_path"),
                  "done AS (SELECT DISTINCT file_path FROM sch)",
                  "todo AS (SELECT * FROM corpus WHERE file_path NOT IN (SELECT file_path FROM done))",
                  clean_ctes("todo", "tclean", "file_path"), chunk_ctes("tclean", "tch", "file_path"))
    q["not_indexed"] = store + " SELECT file_path FROM todo"
    q["index_summary"] = store + (
        " SELECT CAST(coalesce((SELECT count(*) FROM tch), 0) AS BIGINT) AS chunks,"
        " (SELECT count(DISTINCT file_path) FROM tch) AS files_indexed,"
        " (SELECT count(*) FROM todo WHERE file_path NOT IN (SELECT file_path FROM tch)) AS files_skipped,"
        " (SELECT count(*) FROM corpus WHERE file_path IN (SELECT file_path FROM done)) AS files_already_indexed")
    q["index_build"] = store + (
        " SELECT 1 AS run, (SELECT count(*) FROM sch) AS chunks, (SELECT count(*) FROM done) AS files_indexed,"
        " (SELECT count(*) FROM stored_src) - (SELECT count(*) FROM done) AS files_skipped, 0::BIGINT AS files_already_indexed"
        " UNION ALL SELECT 2, (SELECT count(*) FROM tch), (SELECT count(DISTINCT file_path) FROM tch),"
        " (SELECT count(*) FROM todo WHERE file_path NOT IN (SELECT file_path FROM tch)), (SELECT count(*) FROM done)")
    return q


ORACLE_SQL = _sql()
