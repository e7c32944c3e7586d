"""The registered queries as plain SQL over the same tables."""

from __future__ import annotations

from html.entities import name2codepoint

from shelfsense.functions import html as h
from shelfsense.functions.text import NON_SPACE_RUN, PUNCTUATION_RUN, SPACE, VECTOR_WORD, WORD_RUN
from shelfsense.functions.wordlists import LEMMA_KEEP, LEMMA_MIN_LENGTH, LEMMA_RULES, STOP_WORDS
from shelfsense.plans.queries import EVAL_QUERIES, LABELS, SEARCH_QUERIES


def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


STOPS = ", ".join(_lit(word) for word in STOP_WORDS)


def _tokens(text: str) -> str:
    clean = f"regexp_replace(lower(coalesce({text}, '')), {_lit(PUNCTUATION_RUN)}, '', 'g')"
    return f"regexp_extract_all({clean}, {_lit(WORD_RUN)})"


def _vector(text: str) -> str:
    return f"regexp_extract_all(lower(coalesce({text}, '')), {_lit(VECTOR_WORD)})"


def _relevance(text: str) -> str:
    return f"list_filter(regexp_extract_all(lower({text}), {_lit(WORD_RUN)}), lambda x: length(x) > 2)"


def _lemma(token: str) -> str:
    keep = " OR ".join(f"ends_with({token}, {_lit(suffix)})" for suffix in LEMMA_KEEP)
    rules = " ".join(
        f"WHEN ends_with({token}, {_lit(suffix)}) AND length({token}) >= {LEMMA_MIN_LENGTH + len(suffix) - len(replacement)} "
        f"THEN left({token}, length({token}) - {len(suffix)}) || {_lit(replacement)}"
        for suffix, replacement in LEMMA_RULES
    )
    return f"CASE WHEN {keep} THEN {token} {rules} ELSE {token} END"


def _content(text: str, lemmatize: bool) -> str:
    kept = f"list_filter({_tokens(text)}, lambda x: length(x) > 2 AND x NOT IN ({STOPS}))"
    return f"list_transform({kept}, lambda x: {_lemma('x')})" if lemmatize else kept


# Written out apart from the library's table.
KNOWN_LEMMAS = f"""used AS (SELECT DISTINCT unnest({_content('text', False)}) AS token FROM documents),
endings(ending, instead, rank) AS (VALUES ('s', '', 0), ('ses', 's', 1), ('ves', 'f', 2), ('xes', 'x', 3), ('zes', 'z', 4),
  ('ches', 'ch', 5), ('shes', 'sh', 6), ('men', 'man', 7), ('ies', 'y', 8)),
stems AS (SELECT token, left(token, length(token) - length(ending)) || instead AS stem, rank
  FROM used, endings WHERE ends_with(token, ending)),
lemmas AS (SELECT token, arg_min(stem, rank) AS lemma FROM stems
  WHERE length(stem) >= 3 AND stem IN (SELECT token FROM used) GROUP BY token)"""


def _query_rows(lines: str) -> str:
    queries = [line.strip() for line in lines.splitlines() if line.strip()]
    values = ", ".join(f"({i}, {_lit(query)})" for i, query in enumerate(queries))
    return f"queries(query_id, query) AS (VALUES {values})"


BENCHMARK_QUERIES = "queries AS (SELECT item_id AS query_id, text AS query FROM benchmark)"

REVIEWS = """reviews AS (
  SELECT l_partkey AS product_id, o_custkey AS customer_id,
         concat_ws(' ', p_name, p_brand, p_type) AS product_title,
         CAST(ceil(l_quantity / 10) AS DOUBLE) AS star_rating, p_type AS product_category,
         l_orderkey AS ord1, l_linenumber AS ord2,
         (l_orderkey * 7 + l_linenumber) % (SELECT count(*) FROM documents) AS text_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey)"""

TITLES = "titles AS (SELECT product_id, arg_min(product_title, (ord1, ord2)) AS product_title FROM reviews GROUP BY product_id)"

# Search tokens of the product documents: shared texts are counted once, then spread over the reviews.
INDEX_OF_REVIEWS = f"""{TITLES},
uses AS (SELECT product_id, text_id, count(*) AS uses FROM reviews GROUP BY ALL),
text_terms AS (
  SELECT doc_id AS text_id, term, count(*) AS n
  FROM (SELECT doc_id, unnest({_tokens('text')}) AS term FROM documents) GROUP BY ALL),
postings AS (
  SELECT term, product_id, CAST(sum(n) AS BIGINT) AS tf FROM (
    SELECT term, product_id, n * uses AS n FROM text_terms JOIN uses USING (text_id)
    UNION ALL
    SELECT unnest({_tokens('product_title')}) AS term, product_id, 1 AS n FROM titles) GROUP BY ALL),
doc_stats AS (
  SELECT product_id, CAST(sum(n) AS BIGINT) AS doc_len FROM (
    SELECT product_id, len({_tokens('text')}) * uses AS n FROM documents JOIN uses ON doc_id = text_id
    UNION ALL
    SELECT product_id, len({_tokens('product_title')}) AS n FROM titles) GROUP BY ALL),
corpus AS (SELECT count(*) AS n_docs, avg(doc_len) AS avg_doc_len FROM doc_stats)"""
PRODUCT_INDEX = f"{REVIEWS}, {INDEX_OF_REVIEWS}"

DOCUMENT_INDEX = f"""postings AS (
  SELECT term, doc_id, count(*) AS tf
  FROM (SELECT doc_id, unnest({_tokens('text')}) AS term FROM documents) GROUP BY ALL),
doc_stats AS (SELECT doc_id, len({_tokens('text')}) AS doc_len FROM documents),
corpus AS (SELECT count(*) AS n_docs, avg(doc_len) AS avg_doc_len FROM doc_stats)"""


def _bm25(doc: str, top_k: int) -> str:
    """CTE `hits`; only query terms of the postings are used."""
    return f"""terms AS (
  SELECT query_id, term, count(*) AS qtf
  FROM (SELECT query_id, unnest({_tokens('query')}) AS term FROM queries) GROUP BY ALL),
wanted AS (SELECT * FROM postings WHERE term IN (SELECT term FROM terms)),
freq AS (SELECT term, count(*) AS df FROM wanted GROUP BY term),
scores AS (
  SELECT query_id, {doc}, sum(qtf * ln((n_docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE) + 1)
           * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * doc_len / avg_doc_len))) AS bm25
  FROM wanted JOIN freq USING (term) JOIN terms USING (term) JOIN doc_stats USING ({doc}), corpus GROUP BY ALL),
hits AS (
  SELECT query_id, {doc}, bm25,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(bm25, 10) DESC, {doc}) AS INTEGER) AS rank
  FROM scores QUALIFY rank <= {top_k})"""


GRAPH = f"""{REVIEWS},
members AS (SELECT DISTINCT customer_id, product_id FROM reviews),
edges AS MATERIALIZED (
  SELECT DISTINCT a.product_id AS src, b.product_id AS dst
  FROM members a JOIN members b ON a.customer_id = b.customer_id AND a.product_id <> b.product_id),
degrees AS MATERIALIZED (SELECT src AS id, count(*) AS degree FROM edges GROUP BY src),
size AS (SELECT count(*) AS n FROM degrees)"""

PAGERANK = f"""{GRAPH},
steps(it, id, rank, change) AS (
  SELECT 0, id, 1.0::DOUBLE / n, 1e9::DOUBLE FROM degrees, size
  UNION ALL
  SELECT it + 1, id, updated, sum(abs(updated - rank)) OVER () FROM (
    SELECT p.it, p.id, p.rank,
           (1 - 0.85::DOUBLE) / n + 0.85::DOUBLE * coalesce(total, 0) AS updated
    FROM steps p LEFT JOIN (
      SELECT dst, sum(q.rank / degree) AS total
      FROM steps q JOIN degrees ON degrees.id = q.id JOIN edges ON src = q.id GROUP BY dst) x ON x.dst = p.id, size
    WHERE p.change >= n * 1e-6::DOUBLE AND p.it < 100)),
ranks AS (SELECT id, rank FROM steps WHERE it = (SELECT max(it) FROM steps))"""

# Orders as customers, and one more customer for all products of a category.
HOT_PAGERANK = PAGERANK.replace(
    "members AS (SELECT DISTINCT customer_id, product_id FROM reviews)",
    "members AS (SELECT ord1 AS customer_id, product_id FROM reviews UNION SELECT -1, product_id FROM reviews WHERE product_category = 'ECONOMY')",
)

HITS_ROUNDS = 14
HITS = f"""{GRAPH},
steps(it, id, hub, authority) AS (
  SELECT 0, id, 1.0::DOUBLE / n, 1.0::DOUBLE / n FROM degrees, size
  UNION ALL
  SELECT it, id, hub / sum(hub) OVER (), authority / sum(authority) OVER () FROM (
    SELECT a.it, edges.dst AS id, sum(a.authority) AS hub, any_value(b.authority) AS authority
    FROM (SELECT s.it + 1 AS it, e.dst AS id, sum(s.hub) AS authority
          FROM steps s JOIN edges e ON e.src = s.id WHERE s.it < {HITS_ROUNDS} GROUP BY ALL) a
    JOIN edges ON edges.src = a.id
    JOIN (SELECT e.dst AS id, sum(s.hub) AS authority
          FROM steps s JOIN edges e ON e.src = s.id WHERE s.it < {HITS_ROUNDS} GROUP BY ALL) b ON b.id = edges.dst
    GROUP BY a.it, edges.dst))"""


def _fused(top_k: int | None, digits: int) -> str:
    """CTE `fused` from `hits` and `ranks`."""
    limit = f"QUALIFY rank <= {top_k}" if top_k else ""
    return f"""scored AS (
  SELECT h.query_id, h.product_id, h.bm25, coalesce(r.rank, 0) AS pagerank,
         0.7::DOUBLE * h.bm25 / max(h.bm25) OVER (PARTITION BY query_id)
         + (1 - 0.7::DOUBLE) * coalesce(r.rank, 0) / (SELECT max(rank) FROM ranks) AS combined
  FROM hits h LEFT JOIN ranks r ON r.id = h.product_id),
fused AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id
           ORDER BY round(combined, {digits}) DESC, round(bm25, 10) DESC, product_id) AS INTEGER) AS rank
  FROM scored {limit})"""


RELEVANT = f"""relevant AS (
  SELECT DISTINCT query_id, product_id FROM queries, (SELECT DISTINCT product_id, product_title FROM reviews)
  WHERE len(list_filter({_relevance('query')}, lambda x: NOT contains(lower(product_title), x))) = 0)"""

RANKINGS = f"""{_query_rows(EVAL_QUERIES)}, {PAGERANK},
{INDEX_OF_REVIEWS}, {_bm25('product_id', 15)}, {_fused(None, 10)}, {RELEVANT},
runs AS (
  SELECT {_lit(LABELS[0])} AS run, query_id, rank, product_id AS doc_id FROM hits
  UNION ALL SELECT {_lit(LABELS[1])}, query_id, rank, product_id FROM fused),
judged AS (
  SELECT runs.*, CAST(r.product_id IS NOT NULL AS INTEGER) AS rel,
         sum(CAST(r.product_id IS NOT NULL AS INTEGER)) OVER (PARTITION BY run, runs.query_id ORDER BY rank) AS hits
  FROM runs LEFT JOIN relevant r ON r.query_id = runs.query_id AND r.product_id = runs.doc_id),
n_relevant AS (SELECT query_id, count(*) AS n FROM relevant GROUP BY query_id),
pairs AS (SELECT run, query_id FROM queries, (VALUES ({_lit(LABELS[0])}), ({_lit(LABELS[1])})) AS labels(run)),
ideal AS (
  SELECT k, query_id, (SELECT sum(1 / log2(i + 1.0::DOUBLE)) FROM range(1, 16) t(i) WHERE i <= least(n, k)) AS idcg
  FROM n_relevant, (VALUES (5), (10)) AS ks(k)),
counts AS (
  SELECT k, run, query_id, count(*) AS retrieved, sum(rel) AS hits,
         coalesce(sum(rel) FILTER (rank <= k), 0) AS hits_at_k,
         coalesce(1.0::DOUBLE / min(rank) FILTER (rel = 1), 0) AS rr,
         coalesce(sum(hits::DOUBLE / rank) FILTER (rel = 1), 0) AS ap_sum,
         coalesce(sum(hits::DOUBLE / rank) FILTER (rel = 1 AND rank <= k), 0) AS ap_sum_at_k,
         coalesce(sum(1 / log2(rank + 1.0::DOUBLE)) FILTER (rel = 1 AND rank <= k), 0) AS dcg
  FROM judged, (VALUES (5), (10)) AS ks(k) GROUP BY ALL),
base AS (
  SELECT ks.k, run, query_id, coalesce(hits / retrieved::DOUBLE, 0) AS p, coalesce(hits / n::DOUBLE, 0) AS r,
         coalesce(hits_at_k, 0) / ks.k::DOUBLE AS p_at_k, coalesce(hits_at_k / n::DOUBLE, 0) AS r_at_k,
         coalesce(rr, 0) AS rr, coalesce(ap_sum / n, 0) AS ap, coalesce(ap_sum_at_k / least(n, ks.k), 0) AS ap_at_k,
         coalesce(dcg / idcg, 0) AS ndcg
  FROM pairs CROSS JOIN (VALUES (5), (10)) AS ks(k)
  LEFT JOIN counts USING (k, run, query_id) LEFT JOIN n_relevant USING (query_id) LEFT JOIN ideal USING (k, query_id)),
metrics AS (
  SELECT run, query_id, round(p, 4) AS precision, round(r, 4) AS recall,
         round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 4) AS f1,
         round(p_at_k, 4) AS p_at_k, round(r_at_k, 4) AS r_at_k,
         round(CASE WHEN p_at_k + r_at_k > 0 THEN 2 * p_at_k * r_at_k / (p_at_k + r_at_k) ELSE 0 END, 4) AS f1_at_k,
         round(rr, 4) AS mrr, round(ap, 4) AS map, round(ndcg, 4) AS ndcg_at_k
  FROM base WHERE k = 5)"""

MEANS = ", ".join(
    f"round(avg({name}), 6) AS {name}"
    for name in ("precision", "recall", "f1", "p_at_k", "r_at_k", "f1_at_k", "mrr", "map", "ndcg_at_k")
)


def _tfidf(max_features: int, n_docs: str) -> str:
    """CTE `vectors` from `term_rows` (id, term, n)."""
    return f"""vocab AS (
  SELECT term FROM (SELECT term, sum(n) AS total FROM term_rows GROUP BY term ORDER BY total DESC, term LIMIT {max_features})),
cells AS MATERIALIZED (SELECT id, term, sum(n) AS tf FROM term_rows WHERE term IN (SELECT term FROM vocab) GROUP BY ALL),
freq AS (SELECT term, count(*) AS df FROM cells GROUP BY term),
raw AS (
  SELECT id, term, tf * (ln((1 + {n_docs}) / (1.0::DOUBLE + df)) + 1) AS w FROM cells JOIN freq USING (term)),
vectors AS MATERIALIZED (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM raw)"""


def _vector_rows(source: str, id_col: str, text: str) -> str:
    return f"""term_rows AS MATERIALIZED (
  SELECT id, term, 1 AS n FROM (SELECT {id_col} AS id, unnest({_vector(text)}) AS term FROM {source})
  WHERE term NOT IN ({STOPS}))"""


TARGETS = """busy_products AS (
  SELECT product_category, arg_max(product_id, (n, product_id)) AS product_id
  FROM (SELECT product_category, product_id, count(*) AS n FROM reviews GROUP BY ALL) GROUP BY ALL)"""

SIMILAR_PAIRS = f"""{TARGETS},
targets AS (SELECT DISTINCT product_id AS target FROM busy_products),
target_vectors AS MATERIALIZED (SELECT * FROM vectors WHERE id IN (SELECT target FROM targets)),
close_pairs AS (
  SELECT a.id AS target, b.id AS product_id, sum(a.weight * b.weight) AS score
  FROM target_vectors a JOIN vectors b ON a.term = b.term AND a.id <> b.id GROUP BY ALL),
candidates AS (
  SELECT target, product_id, coalesce(score, 0) AS score FROM targets
  JOIN titles ON product_id <> target LEFT JOIN close_pairs USING (target, product_id))"""

MOST_SIMILAR = """SELECT target, product_id, product_title, round(score, 4) AS score,
       CAST(row_number() OVER (PARTITION BY target ORDER BY round(score, 10) DESC, product_id) AS INTEGER) AS rank
FROM candidates JOIN titles USING (product_id) QUALIFY rank <= 5"""

PROCESSED = f"processed AS (SELECT doc_id, array_to_string({_content('text', True)}, ' ') AS text FROM documents)"


def _ngrams(source: str, n: int, top_k: int) -> str:
    parts = " || ' ' || ".join(f"w[i + {j}]" if j else "w[i]" for j in range(n))
    return f"""SELECT ngram, count(*) AS frequency FROM (
  SELECT unnest(list_transform(range(1, greatest(len(w) - {n - 2}, 1)), lambda i: {parts})) AS ngram
  FROM (SELECT list_filter({_vector('text')}, lambda x: x NOT IN ({STOPS})) AS w FROM {source}))
GROUP BY ngram ORDER BY frequency DESC, ngram LIMIT {top_k}"""


# Pages


def _strip(text: str) -> str:
    return f"regexp_replace({text}, {_lit(h.OUTER_SPACE)}, '', 'g')"


def _canonical(url: str) -> str:
    bare = f"regexp_replace({_strip(url)}, {_lit(h.QUERY_OR_FRAGMENT)}, '')"
    head = f"regexp_extract({bare}, {_lit(h.SCHEME_AND_AUTHORITY)})"
    scheme = f"regexp_extract({bare}, {_lit(h.SCHEME)})"
    path = f"regexp_replace(substring({bare}, length({head}) + 1), '/+$', '')"
    authority = f"substring({head}, length({scheme}) + 1)"
    return f"(lower({scheme}) || {authority} || CASE WHEN {path} = '' THEN '/' ELSE {path} END)"


# Patterns written out for RE2, apart from those of the library.
SCRIPTS = (
    r"(?is)<script\b.*?</script\s*>", r"(?is)<style\b.*?</style\s*>", r"(?is)<template\b.*?</template\s*>", r"(?s)<!--.*?-->",
)
QUOTED = r"""(?:[^>="']|=\s*"[^"]*"|=\s*'[^']*'|[="'])*?>"""
ANY_TAG = "(?s)<[/!?A-Za-z]" + QUOTED
TITLE_TEXT = r"(?is)<title\b[^>]*>(.*?)</title"
LINK = r"""(?is)<a\s(?:[^>="']|=\s*"[^"]*"|=\s*'[^']*')*?\bhref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""

# Only these named references occur in the pages; the library resolves all of them and numeric ones.
ENTITIES = ("copy", "middot", "quot", "lt", "gt", "nbsp", "eacute", "hellip", "mdash", "amp")


def _unescape(text: str) -> str:
    for name in ENTITIES:
        text = f"replace({text}, '&{name};', {_lit(chr(name2codepoint[name]))})"
    return text


def _visible(html: str) -> str:
    text = html
    for pattern in (*SCRIPTS, ANY_TAG):
        text = f"regexp_replace({text}, {_lit(pattern)}, chr(1), 'g')"
    return _strip(f"regexp_replace({_unescape(text)}, '[{SPACE}]*' || chr(1) || '[{SPACE}' || chr(1) || ']*', ' ', 'g')")


def _bare(html: str) -> str:
    for pattern in SCRIPTS:
        html = f"regexp_replace({html}, {_lit(pattern)}, chr(1), 'g')"
    return html


def _title(html: str, url: str) -> str:
    for pattern in SCRIPTS:
        html = f"regexp_replace({html}, {_lit(pattern)}, chr(1), 'g')"
    title = _unescape(f"regexp_extract({html}, {_lit(TITLE_TEXT)}, 1)")
    return f"coalesce(nullif({title}, ''), {url})"


STORED = f"""stored AS (
  SELECT page_id, canonical AS url, html, {_visible('html')} AS content FROM (
    SELECT page_id, {_canonical('url')} AS canonical, html FROM pages)
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1)"""

# All links of the stored pages are of the form /path, without dot segments.
LINKS = f"""links AS (
  SELECT url, CAST(link_position - 1 AS INTEGER) AS link_position, regexp_extract(url, {_lit(h.SCHEME_AND_AUTHORITY)}) AS site,
         {_unescape("trim(href, chr(34) || chr(39))")} AS href
  FROM (SELECT url, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) AS link_position
        FROM (SELECT url, regexp_extract_all({_bare("html")}, {_lit(LINK)}, 1) AS hrefs FROM stored)))"""
RESOLVED = f"resolved AS (SELECT url, link_position, {_canonical('site || href')} AS link FROM links)"

# Seeds are all pages: the first level takes each text once, the second level finds no stored page.
CRAWL = f"""{STORED}, {LINKS}, {RESOLVED},
accepted AS (
  SELECT page_id, url, html, content, 0 AS depth FROM stored
  QUALIFY row_number() OVER (PARTITION BY md5(content) ORDER BY page_id) = 1)"""


# What a reader sees of the markup that the hostile pages have at their end.
HOSTILE_TEXT = " it's \ufffd caf\u00e9 bar \u20ac&bogus; link"


def _with(ctes: str, query: str) -> str:
    return f"WITH RECURSIVE {ctes}\n{query}"


def _all() -> dict[str, str]:
    search_rows, eval_rows = _query_rows(SEARCH_QUERIES), _query_rows(EVAL_QUERIES)
    rounded_hits = "SELECT query_id, {doc}, round(bm25, 6) AS bm25, rank FROM hits"
    page_rank = "SELECT id, round(rank, 8) AS rank FROM ranks"
    labelled = "FROM documents LEFT JOIN labels USING (doc_id)"
    words = f"words AS (SELECT unnest({_content('text', False)}) AS token FROM documents)"
    sides = """stats AS (
  SELECT product_category, product_id, product_title, avg(star_rating) AS mean, count(*)::DOUBLE AS n
  FROM reviews GROUP BY ALL),
a AS (SELECT product_category, product_id, product_title, round(mean, 4) AS s FROM stats
  QUALIFY row_number() OVER (PARTITION BY product_category ORDER BY round(mean, 4) DESC, product_id) <= 10),
b AS (SELECT product_category, product_id, product_title, round(n, 4) AS s FROM stats
  QUALIFY row_number() OVER (PARTITION BY product_category ORDER BY round(n, 4) DESC, product_id) <= 10),
an AS (SELECT *, (s - min(s) OVER c) / (max(s) OVER c - min(s) OVER c + 1e-6::DOUBLE) AS norm FROM a WINDOW c AS (PARTITION BY product_category)),
bn AS (SELECT *, (s - min(s) OVER c) / (max(s) OVER c - min(s) OVER c + 1e-6::DOUBLE) AS norm FROM b WINDOW c AS (PARTITION BY product_category)),
merged AS (
  SELECT product_category AS request, product_id, product_title,
         0.5::DOUBLE * coalesce(an.norm, 0) + 0.5::DOUBLE * coalesce(bn.norm, 0) AS score
  FROM an FULL JOIN bn USING (product_category, product_id, product_title))"""
    return {
        "reviews_profile": _with(REVIEWS, """SELECT product_category, count(*) AS reviews,
  count(DISTINCT product_id) AS products, count(DISTINCT customer_id) AS customers, sum(star_rating) AS stars,
  CAST(sum(length(text)) AS BIGINT) AS chars FROM reviews JOIN documents ON doc_id = text_id GROUP BY ALL"""),
        "csv_round_trip": """SELECT CAST(doc_id AS VARCHAR) AS product_id, source AS customer_id,
  lang || ', ' || source AS product_title, md5(text) AS body_hash, CAST(n_chars % 5 + 1 AS DOUBLE) AS star_rating,
  lang AS product_category FROM documents""",
        "first_rows_per_source": """SELECT * FROM (
  (SELECT 'documents' AS source, doc_id AS id, md5(text) AS text_hash FROM documents ORDER BY doc_id LIMIT 100)
  UNION ALL
  (SELECT 'benchmark', item_id, md5(text) FROM benchmark ORDER BY item_id LIMIT 100))""",
        "last_half_per_source": """SELECT * FROM (
  SELECT 'documents' AS source, doc_id AS id, md5(text) AS text_hash FROM documents
  UNION ALL SELECT 'benchmark', item_id, md5(text) FROM benchmark)
QUALIFY row_number() OVER (PARTITION BY source ORDER BY id DESC) <= (SELECT count(*) // 2 FROM documents)""",
        "drop_nulls": f"SELECT doc_id, lang, quality, toxic {labelled} WHERE quality IS NOT NULL AND toxic IS NOT NULL AND lang IS NOT NULL",
        "fill_nulls": f"""SELECT lang, CAST(sum(coalesce(quality, 0)) AS BIGINT) AS quality,
  CAST(sum(coalesce(toxic, 0)) AS BIGINT) AS toxic, count(*) AS documents {labelled} GROUP BY lang""",
        "unlabelled_documents": "SELECT doc_id, lang FROM documents ANTI JOIN labels USING (doc_id)",
        "category_counts": _with(REVIEWS, "SELECT product_category, count(*) AS documents FROM reviews GROUP BY ALL ORDER BY documents DESC, product_category"),
        "first_per_key": _with(REVIEWS, """SELECT product_id, customer_id, ord1, ord2 FROM reviews
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY ord1, ord2, customer_id) = 1"""),
        "product_documents": _with(REVIEWS, """SELECT product_id, arg_min(product_title, (ord1, ord2)) AS product_title,
  round(avg(star_rating), 6) AS star_rating, arg_min(product_category, (ord1, ord2)) AS product_category FROM reviews GROUP BY product_id"""),
        "tokenize": f"""SELECT doc_id, len({_tokens('text')}) AS tokens, md5(array_to_string({_tokens('text')}, ' ')) AS token_hash,
  len({_vector('text')}) AS vector_tokens, len({_relevance('text')}) AS relevance_tokens FROM documents""",
        "preprocess": f"""SELECT doc_id, md5(array_to_string({_content('text', False)}, ' ')) AS plain_hash,
  md5(array_to_string({_content('text', True)}, ' ')) AS lemma_hash FROM documents""",
        "known_lemmas": _with(KNOWN_LEMMAS, "SELECT token, lemma FROM lemmas"),
        "preprocess_known": _with(KNOWN_LEMMAS, f"""SELECT doc_id, md5(coalesce(cleaned, '')) AS text_hash FROM documents LEFT JOIN (
  SELECT doc_id, string_agg(coalesce(lemma, token), ' ' ORDER BY i) AS cleaned FROM (
    SELECT doc_id, unnest(words) AS token, generate_subscripts(words, 1) AS i
    FROM (SELECT doc_id, {_content('text', False)} AS words FROM documents)) LEFT JOIN lemmas USING (token)
  GROUP BY doc_id) USING (doc_id)"""),
        "doc_profile": f"SELECT doc_id, len(regexp_extract_all(text, {_lit(NON_SPACE_RUN)})) AS word_count, length(text) AS char_count FROM documents",
        "profile_means": f"""SELECT round(avg(len(regexp_extract_all(text, {_lit(NON_SPACE_RUN)}))), 6) AS mean_words,
  round(avg(length(text)), 6) AS mean_chars, count(DISTINCT lang) AS categories FROM documents""",
        "top_bigrams": _with(PROCESSED, _ngrams("processed", 2, 15)),
        "top_trigrams_raw": _ngrams("documents", 3, 25),
        "tfidf_features": _with(
            f"{PROCESSED}, {_vector_rows('processed', 'doc_id', 'text')}, {_tfidf(20, '(SELECT count(*) FROM documents)')}",
            "SELECT term AS feature, round(sum(weight) / (SELECT count(*) FROM documents), 6) AS mean_tfidf FROM vectors GROUP BY term",
        ),
        "term_weights": _with(f"""words AS (SELECT unnest({_content('text', True)}) AS term FROM documents),
top AS (SELECT term, count(*) AS term_count FROM words GROUP BY term ORDER BY term_count DESC, term LIMIT 200)""",
            "SELECT term, term_count, round(term_count / max(term_count) OVER ()::DOUBLE, 6) AS weight FROM top"),
        "preprocess_compare": _with(words, f"""SELECT 'without_lemmas' AS strategy,
  round(count(*) / (SELECT count(*) FROM documents)::DOUBLE, 6) AS mean_tokens, count(DISTINCT token) AS unique_terms FROM words
  UNION ALL SELECT 'with_lemmas', round(count(*) / (SELECT count(*) FROM documents)::DOUBLE, 6),
  count(DISTINCT {_lemma('token')}) FROM words"""),
        "feature_compare": _with(
            f"{PROCESSED}, {_vector_rows('processed', 'doc_id', 'text')}, {_tfidf(1000, '(SELECT count(*) FROM documents)')}",
            """SELECT feature_strategy, count(DISTINCT term) AS feature_count, count(*) AS nonzero_values
  FROM cells, (VALUES ('Bag-of-Words'), ('TF-IDF')) AS s(feature_strategy) GROUP BY feature_strategy""",
        ),
        "postings": _with(DOCUMENT_INDEX, "SELECT term, doc_id, tf FROM postings"),
        "doc_stats": _with(PRODUCT_INDEX, "SELECT product_id, doc_len FROM doc_stats"),
        "term_stats": _with(PRODUCT_INDEX, "SELECT term, count(*) AS doc_freq, CAST(sum(tf) AS BIGINT) AS term_count FROM postings GROUP BY term"),
        "bm25_search": _with(f"{search_rows}, {PRODUCT_INDEX}, {_bm25('product_id', 20)}", rounded_hits.format(doc="product_id")),
        "bm25_batch": _with(f"{BENCHMARK_QUERIES}, {PRODUCT_INDEX}, {_bm25('product_id', 10)}", rounded_hits.format(doc="product_id")),
        "review_level_bm25": _with(f"{BENCHMARK_QUERIES}, {DOCUMENT_INDEX}, {_bm25('doc_id', 10)}", rounded_hits.format(doc="doc_id")),
        "index_stats": _with(f"{GRAPH}, {INDEX_OF_REVIEWS}", """SELECT
  (SELECT count(*) FROM reviews) AS records, n_docs AS products, (SELECT count(DISTINCT term) FROM postings) AS terms,
  round(avg_doc_len, 6) AS avg_doc_len, (SELECT count(*) FROM edges) AS edges FROM corpus"""),
        "co_review_neighbours": _with(GRAPH, """SELECT src, count(*) AS neighbours, min(dst) AS smallest, max(dst) AS largest,
  CAST(sum(dst) AS BIGINT) AS id_sum, CAST(sum(dst * dst) AS BIGINT) AS id_square_sum FROM edges GROUP BY src"""),
        "graph_stats": _with(GRAPH, "SELECT count(*) AS nodes, CAST(sum(degree) AS BIGINT) AS edges FROM degrees"),
        "pagerank": _with(PAGERANK, page_rank),
        "pagerank_hot_customers": _with(HOT_PAGERANK, page_rank),
        "hits": _with(HITS, f"SELECT id, round(hub, 7) AS hub, round(authority, 7) AS authority FROM steps WHERE it = {HITS_ROUNDS}"),
        "fused_search": _with(
            f"{search_rows}, {PAGERANK}, {INDEX_OF_REVIEWS}, {_bm25('product_id', 20)}, {_fused(10, 4)},"
            " docs AS (SELECT product_id, avg(star_rating) AS star_rating, arg_min(product_category, (ord1, ord2)) AS product_category FROM reviews GROUP BY ALL)",
            """SELECT query_id, product_id, product_title, round(star_rating, 2) AS star_rating, product_category,
  round(combined, 4) AS combined, round(bm25, 4) AS bm25, round(pagerank, 6) AS pagerank, rank
FROM fused JOIN titles USING (product_id) JOIN docs USING (product_id)""",
        ),
        "pseudo_relevance": _with(f"{eval_rows}, {REVIEWS}, {RELEVANT}", "SELECT query_id, product_id FROM relevant"),
        "eval_per_query": _with(RANKINGS, "SELECT * FROM metrics"),
        "eval_mean": _with(RANKINGS, f"SELECT run, {MEANS} FROM metrics GROUP BY run"),
        "eval_compare": _with(
            f"{RANKINGS}, means AS (SELECT run, {MEANS} FROM metrics GROUP BY run)",
            "SELECT run, metric, score FROM means UNPIVOT (score FOR metric IN (precision, recall, f1, p_at_k, r_at_k, f1_at_k, mrr, map, ndcg_at_k))",
        ),
        "eval_set_metrics": _with(RANKINGS, """SELECT run, query_id, round(p_at_k, 6) AS precision_at_k, round(r_at_k, 6) AS recall_at_k,
  round(rr, 6) AS reciprocal_rank, round(ap_at_k, 6) AS average_precision, round(ndcg, 6) AS ndcg_at_k,
  round(CASE WHEN p_at_k + r_at_k > 0 THEN 2 * p_at_k * r_at_k / (p_at_k + r_at_k) ELSE 0 END, 6) AS f1_at_k
FROM base WHERE k = 10"""),
        "content_recs": _with(
            f"""{REVIEWS}, {TITLES},
firsts AS (
  SELECT product_id, product_title || ' ' || text AS text
  FROM (SELECT * FROM reviews QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY ord1, ord2, customer_id) = 1)
  JOIN documents ON doc_id = text_id),
{_vector_rows('firsts', 'product_id', 'text')}, {_tfidf(3000, '(SELECT count(*) FROM firsts)')},
{SIMILAR_PAIRS}""",
            MOST_SIMILAR,
        ),
        "content_recs_all_reviews": _with(
            f"""{REVIEWS}, {TITLES},
{_vector_rows('documents', 'doc_id', 'text').replace('term_rows', 'text_rows')},
text_counts AS (SELECT id AS text_id, term, count(*) AS n FROM text_rows GROUP BY ALL),
uses AS (SELECT product_id, text_id, count(*) AS uses FROM reviews GROUP BY ALL),
term_rows AS MATERIALIZED (SELECT product_id AS id, term, n * uses AS n FROM text_counts JOIN uses USING (text_id)),
{_tfidf(5000, '(SELECT count(*) FROM titles)')},
{SIMILAR_PAIRS}""",
            MOST_SIMILAR,
        ),
        "user_item_mean": _with(REVIEWS, "SELECT customer_id, product_id, round(avg(star_rating), 6) AS rating FROM reviews GROUP BY ALL"),
        "user_means": _with(REVIEWS, """SELECT customer_id, round(sum(rating) / (SELECT count(DISTINCT product_id) FROM reviews), 6) AS mean
FROM (SELECT customer_id, product_id, avg(star_rating) AS rating FROM reviews GROUP BY ALL) GROUP BY customer_id"""),
        "hybrid_blend": _with(f"{REVIEWS}, {sides}", """SELECT request, product_id, product_title, round(score, 6) AS hybrid_score,
  CAST(row_number() OVER (PARTITION BY request ORDER BY round(score, 10) DESC, product_id) AS INTEGER) AS rank
FROM merged QUALIFY rank <= 5"""),
        "canonical_url": f"""SELECT page_id, {_canonical('url')} AS canonical,
  regexp_extract({_canonical('url')}, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1) AS host FROM pages""",
        "page_text": f"""SELECT page_id, md5({_visible('html')}) AS content_hash, length({_visible('html')}) AS content_length,
  {_title('html', 'url')} AS title FROM pages""",
        "page_links": _with(f"{STORED}, {LINKS}, {RESOLVED}", "SELECT url, link_position, link FROM resolved"),
        "page_hostile": f"""SELECT page_id, md5({_visible('html')} || {_lit(HOSTILE_TEXT)}) AS content_hash, {_title('html', 'url')} AS title,
  len(regexp_extract_all({_bare('html')}, {_lit(LINK)}, 1)) + 1 AS n_links, '/q?x=1' AS last_link FROM pages""",
        "page_dedup": f"SELECT min(page_id) AS page_id, count(*) AS copies FROM pages GROUP BY md5({_visible('html')})",
        "crawl_pages": _with(CRAWL, f"""SELECT url, {_title('html', 'url')} AS title, CAST(depth AS INTEGER) AS depth,
  regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1) AS domain, length(content) AS content_length FROM accepted"""),
        "crawl_errors": _with(CRAWL, """SELECT DISTINCT link AS url, 'not in snapshot' AS error
FROM resolved JOIN accepted USING (url) WHERE link LIKE 'http%' AND link NOT IN (SELECT url FROM stored)"""),
        "page_append": _with(f"{REVIEWS}, {CRAWL}", """SELECT 'review' AS kind, count(*) AS rows, count(DISTINCT product_id) AS products,
  count(star_rating) AS rated, CAST(sum(length(text)) AS BIGINT) AS chars FROM reviews JOIN documents ON doc_id = text_id
UNION ALL
SELECT 'page', count(*), count(DISTINCT url), 0, CAST(sum(length(content)) AS BIGINT) FROM accepted"""),
    }


ORACLE_SQL: dict[str, str] = _all()
