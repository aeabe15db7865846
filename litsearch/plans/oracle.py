"""The catalogue's queries in ANSI SQL over the test tables."""

from litsearch.fixed_values import (
    BM25_B, BM25_K1, KEY_IS_TOPIC_PHRASES, NEXT_WORD_IS_TOPIC_PHRASES, WHITE_SPACE,
)
from litsearch.plans import catalogue as Q

SPLIT = r"[^\p{L}\p{N}\p{M}]+"


def _values(name: str, rows: list[tuple]) -> str:
    def text(v):
        if v is None:
            return "CAST(NULL AS VARCHAR)"
        return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(map(text, r)) + ")" for r in rows)
    return (f"{name} AS (SELECT * FROM (VALUES {body}) "
            "AS t(query_id, clause_id, field, kind, value, occur))")


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), '{SPLIT}'), lambda x: x <> '')"


def _all(text: str, pattern: str) -> str:
    return f"regexp_extract_all({text}, '{pattern}', 1)"


_WHITE = " || ".join(f"chr({ord(c)})" for c in WHITE_SPACE)

FLAT = f"""flat AS (
  SELECT page_id, url,
         trim(replace(replace(replace(html, chr(10), ''), chr(13), ''), chr(9), ' '), {_WHITE}) AS html
  FROM pages)"""

NAV = _all("regexp_extract(html, '<nav>.*?<ul[^>]*>(.*?)</ul>', 1)", "<li[^>]*><a[^>]*>(.*?)</a>")

PAPERS = rf"""papers0 AS (
  SELECT page_id AS doc_id, url AS link, regexp_extract(html, '<h1>(.*?)</h1>', 1) AS title,
         '' AS author, array_to_string({_all('html', '<p>(.*?)</p>')}, ' ') AS content,
         regexp_extract(url, '^[a-z]+://([^/]*)', 1) AS publisher,
         regexp_extract(url, '^[a-z]+://[^/]*/[^0-9]*([0-9]+)', 1) AS year, '' AS pages,
         {NAV} AS ieee_keys
  FROM flat),
papers1 AS (
  SELECT *, list_filter(string_split(title, ' '), lambda x: x <> '') AS author_keys FROM papers0),
papers AS (
  SELECT *, (SELECT coalesce(list(k ORDER BY place), []) FROM (
     SELECT k, min(i) AS place FROM (
       SELECT unnest(list_concat(ieee_keys, author_keys)) AS k,
              unnest(range(len(list_concat(ieee_keys, author_keys)))) AS i)
     GROUP BY k)) AS merged_keys
  FROM papers1)"""

PAPER_BASE = (FLAT, PAPERS)

LINKS = rf"""links AS (
  SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
         'https://example.com' || unnest({_all('html', 'href="(/[^"]*)"')}) AS url
  FROM flat)"""

WIKI = r"""wiki AS (
  SELECT doc_id AS id, title, CASE WHEN doc_id % 3 = 0
           THEN regexp_extract(text, '^\s*\S+\s+(\S+)', 1) END AS redirect_title,
         text || CASE WHEN doc_id % 5 = 0 THEN ' ' || title || ' is a field of study.'
                      WHEN doc_id % 5 = 1 THEN ' ' || title || ' is a branch of science.' ELSE '' END
              || CASE WHEN doc_id % 11 = 0 THEN ''
                      ELSE ' [[Category:' || source || '|' || lang || ']] [[Category:' || lang || ']]' END AS text
  FROM (SELECT *, regexp_extract(text, '(\S+)', 1) AS title FROM documents))"""

CATEGORIES = r"""list_transform(regexp_extract_all(text, '\[\[Category:([^]]*)', 1),
                                lambda c: string_split(c, '|')[1])"""

MATCHED = r"""keys AS (
  SELECT DISTINCT lower(k) AS key FROM (SELECT unnest(ieee_keys) AS k FROM papers) WHERE k <> ''),
matched AS (
  SELECT w.id, CASE WHEN a.key IS NOT NULL THEN a.key ELSE b.key END AS key,
         a.key IS NOT NULL AS title_match, w.text
  FROM wiki w LEFT JOIN keys a ON lower(w.title) = a.key
              LEFT JOIN keys b ON lower(w.redirect_title) = b.key
  WHERE a.key IS NOT NULL OR b.key IS NOT NULL)"""


def _says(phrases: list[str], lead: str, after: str = "") -> str:
    return " OR ".join(f"contains(flat_text, {lead}'{p}{after}')" for p in phrases)


TOPICS = f"""categorised AS (
  SELECT *, CASE WHEN len(c) = 0 THEN ['Not found'] ELSE c END AS categories,
         regexp_replace(lower(text), '\\s', ' ', 'g') AS flat_text
  FROM (SELECT *, {CATEGORIES} AS c FROM matched)),
ruled AS (
  SELECT id, key, title_match,
         CASE WHEN {_says(KEY_IS_TOPIC_PHRASES, "key || ' ' || ")} THEN [key]
              WHEN ({_says(NEXT_WORD_IS_TOPIC_PHRASES, "", " ")}) AND len(categories) > 1
                THEN list_concat([categories[2], categories[1]], categories[3:])
              ELSE categories END AS topics
  FROM categorised),
dictionary AS (
  SELECT key, topics FROM (
    SELECT key, topics, row_number() OVER (PARTITION BY key ORDER BY NOT title_match, id) AS n
    FROM ruled) WHERE n = 1)"""

DICTIONARY = (*PAPER_BASE, WIKI, MATCHED, TOPICS)

ENRICHED = """paper_keys AS (
  SELECT doc_id, unnest(ieee_keys) AS key, unnest(range(len(ieee_keys))) AS pos FROM papers),
attached AS (
  SELECT p.doc_id, p.key, p.pos, d.topics[1] AS first_topic,
         coalesce(d.topics[1], 'Not found') AS topic
  FROM paper_keys p LEFT JOIN dictionary d ON lower(p.key) = d.key),
enriched AS (
  SELECT p.*, coalesce(c.combined_topics, []) AS combined_topics
  FROM papers p LEFT JOIN (
    SELECT doc_id, list(topic ORDER BY topic) AS combined_topics
    FROM (SELECT DISTINCT doc_id, topic FROM attached) GROUP BY doc_id) c USING (doc_id))"""

ENRICHED_BASE = (*DICTIONARY, ENRICHED)


def _tokens(source: str, text_fields: list[str], list_fields: list[str]) -> str:
    """``words(doc_id, field, term, pos)`` of the given columns."""
    parts = [f"SELECT doc_id, '{f}' AS field, {_words(f)} AS ws FROM {source}" for f in text_fields]
    parts += [f"SELECT doc_id, '{f}' AS field, "
              f"flatten(list_transform({f}, lambda v: {_words('v')})) AS ws FROM {source}"
              for f in list_fields]
    return ("words AS (SELECT doc_id, field, unnest(ws) AS term, unnest(range(len(ws))) AS pos "
            f"FROM ({' UNION ALL '.join(parts)}))")


POSTINGS = """postings AS (
  SELECT field, term, doc_id, count(*) AS tf, list(pos ORDER BY pos) AS positions
  FROM words GROUP BY field, term, doc_id),
lengths AS (SELECT field, doc_id, count(*) AS doc_len FROM words GROUP BY field, doc_id),
stats AS (SELECT field, count(*) AS n_docs, sum(doc_len) / count(*) AS avg_len
          FROM lengths GROUP BY field),
terms AS (SELECT field, term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf
          FROM postings GROUP BY field, term)"""

TEXT_WORDS = (_tokens("documents", ["text"], []), POSTINGS)

_TEXT = ["link", "title", "author", "content", "publisher", "year", "pages"]
_LISTS = ["ieee_keys", "author_keys", "merged_keys", "combined_topics"]
PAPER_WORDS = (*ENRICHED_BASE, _tokens("enriched", _TEXT, _LISTS), POSTINGS)

KEY_POSTINGS = """key_postings AS (
  SELECT field, lower(k) AS term, doc_id, count(*) AS tf FROM (
    SELECT doc_id, 'ieee_keys' AS field, unnest(ieee_keys) AS k FROM papers
    UNION ALL SELECT doc_id, 'author_keys', unnest(author_keys) FROM papers
    UNION ALL SELECT doc_id, 'merged_keys', unnest(merged_keys) FROM papers)
  WHERE k <> '' GROUP BY ALL),
key_terms AS (SELECT field, term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf
              FROM key_postings GROUP BY field, term)"""

KEY_BASE = (*PAPER_BASE, KEY_POSTINGS)

SCORE = (f"w.idf * {{tf}} * ({BM25_K1} + 1) / ({{tf}} + {BM25_K1} * "
         f"(1 - {BM25_B} + {BM25_B} * l.doc_len / w.avg_len))")


def _hits(default_field: str) -> str:
    """``hits(query_id, clause_id, occur, doc_id, score)`` of word and phrase clauses."""
    return f"""clause_words AS (
  SELECT query_id, clause_id, kind, coalesce(field, '{default_field}') AS field,
         unnest(ws) AS term, unnest(range(len(ws))) AS word_no, len(ws) AS n_words
  FROM (SELECT *, {_words('value')} AS ws FROM clauses WHERE kind IN ('term', 'any_word', 'phrase'))),
weighted AS (
  SELECT c.*, s.avg_len, ln(1 + (s.n_docs - t.df + 0.5) / (t.df + 0.5)) AS idf
  FROM clause_words c JOIN terms t USING (field, term) JOIN stats s USING (field)),
word_hits AS (
  SELECT w.query_id, w.clause_id, p.doc_id, {SCORE.format(tf='p.tf')} AS score
  FROM weighted w JOIN postings p USING (field, term) JOIN lengths l USING (field, doc_id)
  WHERE w.kind <> 'phrase'),
starts AS (
  SELECT query_id, clause_id, doc_id, start FROM (
    SELECT w.query_id, w.clause_id, w.n_words, w.word_no, x.doc_id, x.pos - w.word_no AS start
    FROM clause_words w JOIN words x USING (field, term) WHERE w.kind = 'phrase')
  GROUP BY query_id, clause_id, doc_id, start, n_words HAVING count(DISTINCT word_no) = n_words),
phrases AS (
  SELECT query_id, clause_id, field, sum(idf) AS idf, min(avg_len) AS avg_len
  FROM weighted WHERE kind = 'phrase' GROUP BY ALL),
phrase_hits AS (
  SELECT w.query_id, w.clause_id, f.doc_id, {SCORE.format(tf='f.tf')} AS score
  FROM (SELECT query_id, clause_id, doc_id, count(*) AS tf FROM starts GROUP BY ALL) f
  JOIN phrases w USING (query_id, clause_id) JOIN lengths l USING (field, doc_id)),
hits AS (
  SELECT h.*, c.occur FROM (SELECT * FROM word_hits UNION ALL SELECT * FROM phrase_hits) h
  JOIN clauses c USING (query_id, clause_id)),
matches AS (
  SELECT query_id, doc_id, score FROM (
    SELECT query_id, doc_id, sum(score) FILTER (occur <> 'must_not') AS score,
           count(DISTINCT clause_id) FILTER (occur = 'must') AS must,
           count(*) FILTER (occur = 'must_not') AS banned
    FROM hits GROUP BY query_id, doc_id)
  JOIN (SELECT query_id, count(*) FILTER (occur = 'must') AS n_must FROM clauses GROUP BY query_id)
    USING (query_id)
  WHERE must = n_must AND banned = 0 AND score IS NOT NULL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, doc_id) AS rank FROM matches)"""


def _topic_docs(fields: list[str] | None) -> str:
    """``topic_docs(query_id, topic, doc_id, occurrences)`` and ``counts``."""
    lists = fields or _LISTS
    keys = " UNION ALL ".join(
        f"SELECT doc_id, '{f}' AS field, unnest({f}) AS k FROM enriched" for f in lists)
    named = ("" if fields else
             "AND k.field IN (SELECT c.field FROM clauses c WHERE c.query_id = a.query_id)")
    return f"""doc_topics AS (
  SELECT doc_id, field, regexp_replace(lower(k), ' $', '') AS topic FROM ({keys}) WHERE k <> ''),
asked AS (SELECT DISTINCT query_id, lower(trim(value)) AS topic FROM clauses),
topic_docs AS (
  SELECT a.query_id, a.topic, k.doc_id, count(*) AS occurrences, min(r.rank) AS rank
  FROM asked a JOIN doc_topics k ON k.topic = a.topic {named}
  JOIN ranked r ON r.query_id = a.query_id AND r.doc_id = k.doc_id
  GROUP BY a.query_id, a.topic, k.doc_id)"""


def _counts(measure: str) -> str:
    return f"""counts AS (
  SELECT query_id, topic, n_docs,
         row_number() OVER (PARTITION BY query_id ORDER BY n_docs DESC, topic) AS place
  FROM (SELECT query_id, topic, CAST({measure} AS BIGINT) AS n_docs FROM topic_docs GROUP BY query_id, topic))"""


def _papers_search(rows: list[tuple]) -> tuple:
    return (*PAPER_WORDS, _values("clauses", rows), _hits("combined_topics"))


def _documents_search(rows: list[tuple], default_field: str = "text") -> tuple:
    return (*TEXT_WORDS, _values("clauses", rows), _hits(default_field))


LIST_TEXT = "array_to_string({0}, ';')"


def _pairs() -> str:
    body = ", ".join(f"('{q}', '{t}')" for q, t in Q.PAIR_TEXTS)
    return f"""texts AS (SELECT * FROM (VALUES {body}) AS t(query_id, query_text)),
split AS (
  SELECT query_id, unnest(range(len(ps))) AS clause_id, string_split(unnest(ps), ':') AS parts
  FROM (SELECT query_id, string_split(query_text, ',') AS ps FROM texts)),
pairs AS (
  SELECT query_id, clause_id,
         CASE WHEN len(parts) = 2 THEN lower(trim(parts[1])) END AS field,
         CASE WHEN len(parts) = 2 THEN lower(trim(parts[2])) END AS value,
         CASE WHEN len(parts) <> 2 THEN 'Wrong query format' END AS reason
  FROM split)"""


def _key_terms() -> str:
    return ("asked AS (SELECT query_id, clause_id, field, lower(value) AS term FROM clauses)")


def _key_search(rows: list[tuple]) -> tuple:
    return (*KEY_BASE, _values("clauses", rows), _key_terms())


_KEY_AND = """SELECT query_id, doc_id FROM (
  SELECT a.query_id, p.doc_id, count(DISTINCT a.clause_id) AS n
  FROM asked a JOIN key_postings p USING (field, term) GROUP BY ALL)
JOIN (SELECT query_id, count(*) AS needed FROM asked GROUP BY query_id) USING (query_id)
WHERE n = needed"""

_NO_QUOTES = "replace({0}, '\"', '')"

PAPER_FIELDS = f"""{_NO_QUOTES.format('link')} AS link,
       title || CASE WHEN doc_id % 5 = 0 THEN chr(8232) || 'and more' || chr(133) || '.' ELSE '' END AS title,
       {_NO_QUOTES.format('publisher')} AS author,
       CASE WHEN doc_id % 7 = 0 THEN '' ELSE {_NO_QUOTES.format('content')}
            || CASE WHEN doc_id % 7 = 1 THEN '...' ELSE '' END END AS content,
       publisher, year, CAST(doc_id AS VARCHAR) AS pages"""

_EXPANDED = """expanded AS (
  SELECT c.query_id, c.clause_id, t.field, t.term FROM clauses c JOIN terms t USING (field)
  WHERE (c.kind = 'prefix' AND starts_with(t.term, c.value))
     OR (c.kind = 'wildcard' AND t.term LIKE replace(replace(c.value, '*', '%'), '?', '_'))
     OR (c.kind = 'fuzzy' AND levenshtein(t.term, c.value) <= 2)
     OR (c.kind = 'range' AND t.term BETWEEN string_split(c.value, ' to ')[1]
                                         AND string_split(c.value, ' to ')[2]))"""


def oracle_queries() -> dict[str, str]:
    frontier = (FLAT, LINKS, """fresh AS (
  SELECT url, min(page_id) AS page_id FROM links
  WHERE url NOT IN (SELECT url FROM links WHERE lang = 'de') GROUP BY url)""")
    extracted = "SELECT " + PAPER_FIELDS + ", " + ", ".join(
        f"{LIST_TEXT.format(c)} AS {c}" for c in ("ieee_keys", "author_keys"))
    text_words = _with(*TEXT_WORDS)
    sql = {
        "q01_page_flatten": _with(FLAT) + "SELECT page_id, html AS value FROM flat",
        "q02_row_cap": """SELECT page_id, url, 'first 20' AS cap FROM (
  SELECT page_id, url FROM pages ORDER BY page_id LIMIT 20)
UNION ALL SELECT page_id, url, 'all' FROM pages
UNION ALL SELECT page_id, url, 'peek' FROM (SELECT page_id, url FROM pages ORDER BY page_id LIMIT 1)""",
        "q03_count": "SELECT count(*) AS n_documents FROM pages",
        "q04_extract_fields": _with(FLAT) + """SELECT page_id,
  regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
  regexp_extract(html, '<title>(.*?)</title>', 1) AS page_title,
  regexp_extract(html, '<h1>(.*?)</h1>', 1) AS heading,
  regexp_extract(html, 'track\\(([0-9]+)\\)', 1) AS tracker FROM flat""",
        "q04_paper_fields": _with(*PAPER_BASE) + f"SELECT doc_id AS page_id, {PAPER_FIELDS} FROM papers",
        "q05_extract_lists": _with(FLAT) + f"""SELECT page_id, {LIST_TEXT.format(NAV)} AS keys,
  len({NAV}) AS n_keys FROM flat""",
        "q05_paper_lists": _with(*PAPER_BASE) + f"""SELECT doc_id AS page_id,
  {LIST_TEXT.format('ieee_keys')} AS ieee_keys, {LIST_TEXT.format('author_keys')} AS author_keys FROM papers""",
        "q06_list_codec": _with(*PAPER_BASE) + """SELECT doc_id,
  array_to_string(list_transform(ieee_keys, lambda k: k || ';'), '') AS encoded,
  len(list_filter(ieee_keys, lambda k: k <> '')) AS n_keys,
  array_to_string(list_filter(ieee_keys, lambda k: k <> ''), '|') AS decoded FROM papers""",
        "q07_quality": """SELECT count(*) FILTER (doc_id % 7 = 0) AS n_no_content,
  count(*) FILTER (doc_id % 7 = 1 OR (doc_id % 7 > 1 AND ends_with(text, '...'))) AS n_shortened
FROM documents""",
        "q07_with_content": """SELECT doc_id,
  length(text) + CASE WHEN doc_id % 7 = 1 THEN 3 ELSE 0 END AS n_chars
FROM documents WHERE doc_id % 7 = 1 OR (doc_id % 7 <> 0 AND text <> '')""",
        "q08_doc_key": """SELECT page_id, array_to_string(string_split(url, '/')[-2:], '_') AS doc_key
FROM pages""",
        "q09_outlinks": _with(FLAT, LINKS) + "SELECT page_id, url FROM links",
        "q10_visited": _with(FLAT, LINKS) + "SELECT DISTINCT url FROM links",
        "q11_frontier": _with(*frontier) + "SELECT url, page_id FROM fresh",
        "q11_frontier_counts": _with(*frontier) +
            "SELECT page_id, count(*) AS n_added FROM fresh GROUP BY page_id",
        "q12_merge_keys": _with(*PAPER_BASE) +
            f"SELECT doc_id, {LIST_TEXT.format('merged_keys')} AS merged_keys FROM papers",
        "q13_distinct_keys": _with(*PAPER_BASE) + """SELECT DISTINCT lower(k) AS key
FROM (SELECT unnest(merged_keys) AS k FROM papers) WHERE k <> ''""",
        "q14_match": _with(*PAPER_BASE, WIKI, MATCHED) + """SELECT id, key,
  CAST(title_match AS INTEGER) AS title_match, length(text) AS n_chars FROM matched""",
        "q14_match_many_keys": _with(*DICTIONARY) + f"""SELECT id, key,
  CAST(title_match AS INTEGER) AS title_match, length(text) AS n_chars, {LIST_TEXT.format('topics')} AS topics
FROM ruled JOIN matched USING (id, key, title_match)""",
        "q15_categories": _with(WIKI) + f"""SELECT id,
  CASE WHEN len(c) = 0 THEN 'Not found' ELSE array_to_string(c, ';') END AS categories
FROM (SELECT id, {CATEGORIES} AS c FROM wiki)""",
        "q16_topic_rule": _with(*DICTIONARY) +
            f"SELECT id, key, {LIST_TEXT.format('topics')} AS topics FROM ruled",
        "q17_dictionary": _with(*DICTIONARY) +
            f"SELECT key, len(topics) AS n_topics, {LIST_TEXT.format('topics')} AS topics FROM dictionary",
        "q18_attach": _with(*ENRICHED_BASE) + "SELECT doc_id, key, topic FROM attached",
        "q19_combine": _with(*ENRICHED_BASE) + f"""SELECT doc_id, link,
  {LIST_TEXT.format('combined_topics')} AS combined_topics FROM enriched""",
        "q19_distinct_documents": _with(*PAPER_BASE) + """SELECT doc_id, place, link
FROM (SELECT *, row_number() OVER (PARTITION BY place ORDER BY doc_id) AS n
      FROM (SELECT *, publisher || '/' || year AS place FROM papers)) WHERE n = 1""",
        "q20_ordered": _with(*ENRICHED_BASE) + """SELECT doc_id,
  coalesce(string_agg(first_topic, ';' ORDER BY pos), '') AS topics
FROM papers LEFT JOIN attached USING (doc_id) GROUP BY doc_id""",
        "q21_export": _with(*DICTIONARY) +
            f"SELECT key, {LIST_TEXT.format('topics')} AS topics FROM dictionary",
        "q22_presets": _with(
            *ENRICHED_BASE, "noted AS (SELECT *, concat_ws(' ', publisher, year) AS remark FROM enriched)",
            _tokens("noted", [*_TEXT, "remark"], _LISTS), POSTINGS) + """, sizes AS (
  SELECT field, count(*) AS n_postings, CAST(sum(tf) AS BIGINT) AS n_words FROM postings GROUP BY field)
SELECT 'general' AS preset, * FROM sizes
UNION ALL SELECT 'topics', * FROM sizes WHERE field IN ('combined_topics', 'merged_keys')
UNION ALL SELECT 'keys', * FROM sizes WHERE field IN ('ieee_keys', 'author_keys', 'merged_keys')
UNION ALL SELECT preset, 'stored remark', count(remark), CAST(sum(length(remark)) AS BIGINT)
FROM noted, (VALUES ('general'), ('topics'), ('keys')) p(preset) GROUP BY preset""",
        "q23_token_postings": text_words + f"""SELECT field, term, doc_id, tf,
  {LIST_TEXT.format('positions')} AS positions FROM postings""",
        "q24_key_postings": _with(*KEY_BASE) + "SELECT field, term, doc_id, tf FROM key_postings",
        "q25_dictionary": _with(*TEXT_WORDS, *KEY_BASE) + """SELECT field, term, df, cf FROM terms
UNION ALL SELECT field, term, df, cf FROM key_terms""",
        "q26_field_stats": _with(
            *PAPER_BASE, "both_words AS (SELECT * FROM (" + _with(_tokens("papers", [], _LISTS[:3])) +
            "SELECT * FROM words) UNION ALL (" + _with(_tokens("documents", ["text"], [])) +
            "SELECT * FROM words))") + """SELECT field, count(*) AS n_docs,
  round(sum(n) / count(*), 6) AS avg_len
FROM (SELECT field, doc_id, count(*) AS n FROM both_words GROUP BY field, doc_id) GROUP BY field""",
        "q26_doc_lengths": text_words + "SELECT field, doc_id, doc_len FROM lengths",
        "q27_key": _with(*_key_search(Q.KEY_QUERIES)) + """SELECT query_id, clause_id, doc_id, tf
FROM asked JOIN key_postings USING (field, term)""",
        "q28_status": _with(*_key_search(Q.KEY_QUERIES)) + """SELECT query_id, clause_id, field, term,
  coalesce(df, 0) AS df,
  CASE WHEN df IS NULL THEN 'Term does not exist in index' ELSE 'found' END AS status
FROM asked LEFT JOIN key_terms USING (field, term)""",
        "q29_and2": _with(*_key_search([c for c in Q.KEY_QUERIES if c[0] in Q.TWO_KEYS])) + _KEY_AND,
        "q30_andn": _with(*_key_search(Q.KEY_QUERIES)) + _KEY_AND,
        "q31_selectivity": _with(*_key_search(Q.KEY_QUERIES)) + """SELECT query_id, clause_id, field,
  term, coalesce(cf, 0) AS cf,
  CAST(row_number() OVER (PARTITION BY query_id ORDER BY coalesce(cf, 0), clause_id) AS INTEGER) AS place
FROM asked LEFT JOIN key_terms USING (field, term)""",
        "q34_boolean": _with(*_documents_search(Q.BOOLEAN_QUERIES)) +
            "SELECT query_id, doc_id, round(score, 6) AS score FROM matches",
        "q35_phrase": _with(*_documents_search(Q.PHRASE_QUERIES)) +
            "SELECT query_id, clause_id, doc_id, round(score, 6) AS score FROM phrase_hits",
        "q36_bm25": _with(*_documents_search(Q.RANKED_QUERIES)) + """SELECT query_id, doc_id,
  round(score, 6) AS score, CAST(rank AS INTEGER) AS rank, lang, source
FROM ranked JOIN documents USING (doc_id) WHERE rank <= 50""",
        "q36_papers": _with(*_papers_search(Q.COMPARED_CLAUSES)) + f"""SELECT query_id, doc_id,
  round(score, 6) AS score, rank, title, link, author,
  {LIST_TEXT.format('merged_keys')} AS merged_keys, {LIST_TEXT.format('combined_topics')} AS combined_topics
FROM ranked JOIN enriched USING (doc_id)""",
        "q37_any_word": _with(*_papers_search(Q.COMPARED_TOPICS)) + """SELECT query_id, doc_id,
  round(score, 6) AS score, rank FROM ranked""",
        "q38_expand": _with(*TEXT_WORDS, _values("clauses", Q.PATTERN_QUERIES), _EXPANDED) +
            "SELECT query_id, clause_id, field, term FROM expanded",
        "q38_expanded_hits": _with(*TEXT_WORDS, _values("clauses", Q.PATTERN_QUERIES), _EXPANDED) +
            """SELECT query_id, doc_id, CAST(count(DISTINCT clause_id) AS DOUBLE) AS score
FROM expanded JOIN postings USING (field, term) GROUP BY query_id, doc_id""",
        "q39_topic_counts": _with(*_papers_search(Q.COMPARED_TOPICS), _topic_docs(None),
                                  _counts("count(*)")) +
            "SELECT query_id, topic, n_docs, place FROM counts",
        "q40_occurrences": _with(*_papers_search(Q.COMPARED_TOPICS), _topic_docs(["ieee_keys"]),
                                 _counts("sum(occurrences)")) +
            "SELECT query_id, topic, n_docs, place FROM counts",
        "q41_clause_counts": _with(*_papers_search(Q.COMPARED_CLAUSES)) + """SELECT query_id, clause_id,
  count(DISTINCT doc_id) AS n_docs
FROM hits JOIN ranked USING (query_id, doc_id) GROUP BY query_id, clause_id""",
        "q41_by_clause": _with(*_papers_search(Q.COMPARED_CLAUSES)) + """SELECT DISTINCT query_id, clause_id,
  doc_id, rank FROM hits JOIN ranked USING (query_id, doc_id)""",
        "q36_all": _with(*_documents_search(Q.RANKED_QUERIES)) + """SELECT query_id, doc_id,
  round(score, 6) AS score, rank, lang, source FROM ranked JOIN documents USING (doc_id)""",
        "q42_by_topic": _with(*_papers_search(Q.COMPARED_TOPICS), _topic_docs(None),
                              _counts("count(*)")) + """SELECT query_id, place, topic, doc_id, rank, title, link
FROM (SELECT query_id, doc_id, topic, place, rank,
             row_number() OVER (PARTITION BY query_id, doc_id ORDER BY place) AS n
      FROM topic_docs JOIN counts USING (query_id, topic))
JOIN enriched USING (doc_id) WHERE n = 1""",
        "q42_by_topic_repeated": _with(*_papers_search(Q.COMPARED_TOPICS), _topic_docs(None),
                                       _counts("count(*)")) +
            "SELECT query_id, place, topic, doc_id, rank FROM topic_docs JOIN counts USING (query_id, topic)",
        "q43_tsv_roundtrip": _with(*ENRICHED_BASE) + "SELECT " + ", ".join(_TEXT) + ", " + ", ".join(
            f"{LIST_TEXT.format(c)} AS {c}" for c in _LISTS) + " FROM enriched",
        "q44_xml_roundtrip": _with(WIKI) + """SELECT id, title,
  coalesce(redirect_title, '') AS redirect_title, trim(text) AS text FROM wiki""",
        "q45_index_roundtrip": _with(*PAPER_BASE, _tokens("papers", _TEXT, _LISTS[:3]), POSTINGS) +
            "SELECT field, term, df, cf FROM terms",
        "q45_postings": _with(*PAPER_BASE, _tokens("papers", _TEXT, _LISTS[:3]), POSTINGS) +
            f"""SELECT field, term, doc_id, tf, doc_len, {LIST_TEXT.format('positions')} AS positions
FROM postings JOIN lengths USING (field, doc_id)""",
        "q45_keys": _with(*KEY_BASE) + "SELECT field, term, doc_id, tf FROM key_postings",
        "q45_stats": _with(*PAPER_BASE, _tokens("papers", _TEXT, _LISTS[:3]), POSTINGS) +
            "SELECT field, n_docs, round(avg_len, 6) AS avg_len FROM stats",
        "q45_docs": _with(*PAPER_BASE) + f"""SELECT doc_id, title, link, publisher,
  {LIST_TEXT.format('merged_keys')} AS merged_keys FROM papers""",
        "q46_page_lines": _with(FLAT) + "SELECT html AS value FROM flat",
        "q46_page_files": _with(FLAT) + "SELECT html AS value FROM flat",
    }
    sql["q32_pairs"] = _with(*KEY_BASE, _pairs()) + """SELECT query_id,
  CAST(clause_id AS INTEGER) AS clause_id, field, value, reason, n_docs
FROM (SELECT p.*, (SELECT count(*) FROM key_postings k WHERE k.field = p.field AND k.term = p.value) AS n_docs
      FROM pairs p)"""
    in_documents = _with(*_documents_search(Q.TERM_QUERIES)) + "SELECT * FROM word_hits"
    in_papers = _with(*_papers_search(Q.PAPER_TERMS)) + "SELECT * FROM word_hits"
    sql["q33_term"] = f"""SELECT query_id, clause_id, doc_id, round(score, 6) AS score
FROM (SELECT * FROM ({in_documents}) UNION ALL SELECT * FROM ({in_papers}))"""
    sql["s01_incremental"] = _with(*PAPER_BASE) + extracted + " FROM papers"
    sql["s02_frontier_stream"] = _with(FLAT, LINKS) + """SELECT url,
  coalesce(min(page_id) FILTER (page_id % 2 = 0), min(page_id)) AS page_id
FROM links GROUP BY url"""
    sql["s03_seeded_frontier"] = sql["q11_frontier"]
    return sql
