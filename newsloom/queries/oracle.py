"""The same results in DuckDB SQL. Only the lists of block elements and stopwords are shared with the Spark code."""

from __future__ import annotations

from newsloom.functions.html import BLOCKS
from newsloom.functions.text import STOPWORDS

SPACE = r"[\t\n\x0b\f\r\x1c-\x20\x{85}\p{Z}]"
NAMES = "|".join(BLOCKS)
RUN = "DATE '2024-01-15'"


def sub(text: str, pattern: str, new: str = "") -> str:
    return f"regexp_replace({text}, '{pattern}', '{new}', 'g')"


def trim(text: str) -> str:
    return sub(text, f"^{SPACE}+|{SPACE}+$")


def clean(html: str) -> str:
    blocks = "|".join(rf"<{t}(?:[\s/][^>]*)?>.*?(?:</{t}\s*>|\z)" for t in ("script", "style", "iframe"))
    return sub(html, rf"(?is)<!--.*?(?:-->|\z)|{blocks}")


def unescape(text: str) -> str:
    for name, letter in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        text = f"replace({text}, '&{name};', '{letter}')"
    return text


def unescape_html5(text: str) -> str:
    """As ``unescape``; the old names also count without their ``;``."""
    for name, letter in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        text = sub(text, f"&{name};?", letter)
    return text


def plain(html: str) -> str:
    return unescape(sub(html, "</?[A-Za-z!][^>]*>"))


def region(html: str) -> str:
    return rf"regexp_extract({html}, '(?is)<article(?:\s[^>]*)?>(.*?)(?:</article|\z)', 1)"


def paragraphs(html: str) -> str:
    return (rf"list_transform(string_split_regex({html}, '(?i)<p(?:\s[^>]*)?>')[2:], "
            rf"lambda p: regexp_extract(p, '(?is)^(.*?)(?:</?(?:{NAMES})\b|\z)', 1))")


def joined(parts: str) -> str:
    return f"coalesce(array_to_string({parts}, ''), '')"


def text_all(html: str) -> str:
    return trim(plain(joined(paragraphs(html))))


def text_first(html: str) -> str:
    return unescape(joined(
        f"list_transform({paragraphs(html)}, lambda q: regexp_extract(q, '(?:^|>)([^<]+)', 1))"))


def block_texts(html: str) -> str:
    pieces = rf"string_split_regex({html}, '(?i)</?(?:{NAMES})(?:\s[^>]*)?/?>')"
    return f"list_filter(list_transform({pieces}, lambda b: {trim(plain('b'))}), lambda t: t <> '')"


def title(html: str) -> str:
    def heading(tag: str) -> str:
        return f"nullif({trim(plain(rf'''regexp_extract({html}, '(?is)<{tag}(?:[[:space:]][^>]*)?>(.*?)(?:</{tag}|$)', 1)'''))}, '')"
    return f"coalesce({heading('h1')}, {heading('title')})"


def host(url: str) -> str:
    return f"lower(regexp_extract({url}, '^[a-z]+://([^/?#:]*)', 1))"


def canonical(url: str) -> str:
    return f"regexp_replace(split_part(split_part({url}, '#', 1), '?', 1), '^http://', 'https://')"


def source(url: str) -> str:
    h = host(url)
    return (f"CASE WHEN {h} = 'spam-farm.example.org' OR {h} LIKE '%.spam-farm.example.org' THEN 'farm' "
            f"WHEN {h} = 'cheap-pills.example.com' OR {h} LIKE '%.cheap-pills.example.com' THEN 'pills' "
            f"WHEN {h} LIKE '%example.com' THEN 'com' WHEN {h} LIKE '%example.net' THEN 'net' "
            f"WHEN {h} LIKE '%example.org' THEN 'org' END")


def segment(url: str) -> str:
    return f"nullif(regexp_extract({url}, '([^/]*)/$', 1), '')"


def lead(text: str) -> str:
    return f"array_to_string(string_split({text}, '.')[1:4], '')"


PAGES = f"SELECT page_id, url, {clean('html')} AS html FROM pages"
REGION = f"SELECT page_id, url, html, {region('html')} AS body FROM ({PAGES})"
# Pieces between anchors, cut with plain string functions: all links of the pages are written alike.
LINKS = rf"""
  SELECT page_id, page_url, CAST(i - 1 AS INTEGER) AS pos, {unescape("split_part(piece, '\"', 1)")} AS href,
    {trim(plain("split_part(substr(piece, strpos(piece, '>') + 1), '</a>', 1)"))} AS anchor
  FROM (SELECT page_id, page_url, unnest(pieces[2:]) AS piece, generate_subscripts(pieces[2:], 1) AS i FROM (
    SELECT page_id, url AS page_url, string_split(html, '<a href="') AS pieces FROM ({PAGES})))"""
ORIGIN = "regexp_extract(page_url, '^([a-z]+://[^/?#]*)', 1)"
NAV = f"SELECT *, {canonical(f'{ORIGIN} || href')} AS url FROM ({LINKS})"
CHAIN = f"""
  SELECT a.page_id, {canonical('a.url')} AS page_url, {canonical('b.url')} AS url
  FROM pages a JOIN pages b ON b.page_id = a.page_id + 1"""
DIRECT = sub("p", r"(?is)<b>.*?(?:</b>|\z)|<br>")
FIELDS = """
  SELECT page_id, url, '/img/' || page_id || '.png' AS image FROM pages"""
LAYOUTS = ["%Y-%-m-%-d", "%B %-d, %Y", "%-d %b %Y", "%B %-d %Y", "%-d %B, %Y"]
EVENT_CHANGES = """
  SELECT user_id, event_id AS seq, CASE WHEN event_type = 'error' THEN 'REMOVE' ELSE 'MODIFY' END AS event_name,
         event_type, value FROM events"""
STATE = f"""
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) AS rn
    FROM ({EVENT_CHANGES})) WHERE rn = 1 AND event_name <> 'REMOVE'"""
# Digits after the leading zeros: the last seven tell the numbers apart.
SEQ = "repeat('9', 37) || lpad(CAST(n AS VARCHAR), 7, '0')"
CHANGES = """
  SELECT 'MODIFY' AS event_name, event_id * 2 AS n, event_id, user_id, event_type, ts, props FROM events
  UNION ALL
  SELECT 'REMOVE', event_id * 2 + 1, event_id, user_id, NULL, NULL, NULL FROM events WHERE event_type = 'error'"""
DECODED = f"""
  SELECT event_name, {SEQ} AS seq, 'user ' || user_id AS key,
    CASE WHEN event_name = 'MODIFY' THEN 'user ' || user_id END AS title,
    CASE WHEN event_name = 'MODIFY' THEN 'https://example.com/' || event_id END AS url,
    CAST(NULL AS VARCHAR) AS source, CAST(ts AS DATE) AS date, CAST(NULL AS VARCHAR) AS blurp, props AS text,
    CAST(NULL AS VARCHAR) AS imgurl, event_type AS category,
    CASE WHEN event_name = 'MODIFY' THEN event_type || ', ' || user_id END AS tags
  FROM ({CHANGES})"""
TOKENS = r"""
  SELECT doc_id, unnest(list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')) AS term
  FROM documents"""
STOP = ", ".join(f"'{w}'" for w in sorted(set(STOPWORDS)))
COUNTS = f"SELECT doc_id, term, count(*) AS n FROM ({TOKENS}) GROUP BY doc_id, term"
KEYWORDS = f"""
  SELECT doc_id, rn AS rank, term, n, n / total AS score FROM (
    SELECT c.doc_id, term, n, total, row_number() OVER (PARTITION BY c.doc_id ORDER BY n DESC, term) AS rn
    FROM ({COUNTS}) c JOIN (SELECT doc_id, count(*) AS total FROM ({TOKENS}) GROUP BY doc_id) t ON c.doc_id = t.doc_id
    WHERE term NOT IN ({STOP})) WHERE rn <= 10"""
TOP = f"SELECT term, count(*) AS n FROM ({KEYWORDS}) GROUP BY term"


def bm25(queries: str, k: int) -> str:
    return rf"""
  WITH tok AS MATERIALIZED ({TOKENS}),
  tf AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY doc_id, term),
  len AS (SELECT d.doc_id, count(term) AS dl FROM documents d LEFT JOIN tok ON tok.doc_id = d.doc_id GROUP BY d.doc_id),
  size AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(dl) AS mean FROM len),
  q AS ({queries}),
  df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
  total AS (SELECT q.query_id, tf.doc_id, round(sum(
      ln(1 + (size.n - df.df + 0.5) / (df.df + 0.5)) * tf.tf * 2.2 / (tf.tf + 1.2 * (0.25 + 0.75 * len.dl / size.mean))), 6) AS score
    FROM q JOIN tf ON tf.term = q.term JOIN df ON df.term = q.term JOIN len ON len.doc_id = tf.doc_id CROSS JOIN size
    GROUP BY q.query_id, tf.doc_id),
  best AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM total)
  SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM best WHERE rank <= {k}"""


ARTICLES = rf"""
  SELECT page_id, url, source, title, text, ad, first_p FROM (
    SELECT page_id, split_part(url, '#', 1) AS url, {source('url')} AS source, {title('html')} AS title,
      CASE {source('url')}
        WHEN 'net' THEN {text_first('body')}
        WHEN 'farm' THEN {unescape(joined(f"list_transform({paragraphs('body')}, lambda p: {DIRECT})"))}
        WHEN 'org' THEN array_to_string({block_texts('body')}, chr(10) || chr(10))
        ELSE {text_all('body')} END AS text,
      nullif({trim(plain(r"regexp_extract(html, '(?is)<div class=.ad.>([^<]*)', 1)"))}, '') AS ad,
      {unescape(rf"regexp_extract({paragraphs('body')}[1], '(?:^|>)([^<]+)', 1)")} AS first_p
    FROM ({REGION}))"""

# Sites in alphabetical order, dealt by ``page_id % 14``; a page's own link comes before the others.
SITE_NAMES = "aljazeera apnews cio govinsider govtech guardian infoworld khaleej nytimes opengov shanghai techcrunch techwire yonhap".split()
SITE_HOSTS = ("www.aljazeera.com apnews.com www.cio.com www.govinsider.asia www.govtech.com www.theguardian.com www.infoworld.com "
              "www.khaleejtimes.com www.nytimes.com www.opengovasia.com www.shine.cn techcrunch.com www.techwireasia.com en.yna.co.kr").split()


def by_site(values: dict[int, str], other: str = "NULL") -> str:
    return "CASE kind " + " ".join(f"WHEN {k} THEN {v}" for k, v in values.items()) + f" ELSE {other} END"


SITE_ORIGIN = by_site({k: f"'https://{h}'" for k, h in enumerate(SITE_HOSTS)})
SITE_FOLDER = by_site({5: "'/technology'", 6: "'/article'"}, "''")
SITE_TITLE = unescape(r"regexp_extract(html, '<title>([^<]*)', 1)") + " || ' ' || page_id"
SITE_LINKS = f"""
  SELECT page_id AS i, page_id % 14 AS kind, 0 AS pos, '/story/' || page_id AS href, {trim(SITE_TITLE)} AS anchor FROM pages
  UNION ALL SELECT page_id, page_id % 14, pos + 1, href, anchor FROM ({LINKS})"""
SITE_CARDS = f"""
  SELECT i * 2 AS page_id, kind, {by_site({k: f"'{n}'" for k, n in enumerate(SITE_NAMES)})} AS source,
    CAST(CASE WHEN kind IN (4, 10) THEN pos * 2 ELSE pos END AS INTEGER) AS pos, {SITE_ORIGIN} || {SITE_FOLDER} || href AS url,
    CASE WHEN kind NOT IN (5, 6) THEN anchor END AS title,
    {by_site({1: "'first ' || anchor", 2: "CASE WHEN pos > 2 THEN 'About ' || anchor END", 0: "'About ' || anchor", 3: "'About ' || anchor",
              8: "'About ' || anchor"})} AS blurp,
    {by_site({1: "'2024-01-05T10:00:00Z'", 11: "'2024-01-06T07:00:00'", 12: "'By Ann | 8 January, 2024'"})} AS date_text,
    CASE kind WHEN 10 THEN '/img' || href || '.jpg' END AS imgurl,
    {by_site({0: "'technology'", 1: "'technology'", 2: "'analytics'", 3: "'www.govinsider.asia'", 4: "'security'", 6: "'analytics'", 8: "'technology'",
              10: "'technology'", 11: "'techcrunch.com'"})} AS category
  FROM ({SITE_LINKS}) WHERE NOT (kind = 2 AND pos = 2)"""
SITE_ARTICLES = rf"""
  SELECT page_id AS i, page_id % 14 AS kind, html, {trim(SITE_TITLE)} AS t,
    {unescape(rf"regexp_extract({paragraphs('body')}[1], '(?:^|>)([^<]+)', 1)")} AS first_p,
    CASE WHEN page_id % 14 IN (0, 5, 8) THEN array_to_string({block_texts('body')}, chr(10) || chr(10))
      WHEN page_id % 14 IN (2, 3, 9, 12) THEN {text_first('body')}
      WHEN page_id % 14 = 6 THEN {sub(trim(plain('body')), r'\[.*\]')}
      WHEN page_id % 14 = 11 THEN {unescape(joined(f"list_transform({paragraphs('body')}, lambda p: {DIRECT})"))}
      ELSE {text_all('body')} END AS text
  FROM ({REGION})"""

ORACLE = {
    "a01_read_pages": "SELECT page_id, url, length(html) AS n_chars FROM pages",
    "a02_with_source": f"""
      SELECT page_id, url, source, CASE source WHEN 'net' THEN 'first' WHEN 'org' THEN 'main' WHEN 'farm' THEN 'direct'
        ELSE 'all' END AS text_mode FROM (SELECT page_id, url, {source('url')} AS source FROM pages)""",
    "a03_select_source": "SELECT doc_id, source, lang, n_chars FROM documents WHERE source = 'src3'",
    "a04_read_changes": f"""
      SELECT event_name, {SEQ} AS seq, 'user ' || user_id AS title,
        CASE WHEN event_name = 'REMOVE' THEN -1 ELSE 7 END::BIGINT AS n_fields FROM ({CHANGES})""",
    "a04_sort_changes": f"""
      WITH c AS (SELECT n, event_id, event_id % 7 AS k, event_name, {SEQ} AS seq, '00' || {SEQ} AS padded FROM ({CHANGES})),
      s AS (SELECT *, CASE WHEN n % 6 < 2 THEN padded ELSE seq END AS written FROM c)
      SELECT 'sound' AS kind, seq, CAST(NULL AS VARCHAR) AS text FROM s WHERE k IN (1, 4, 5, 6)
      UNION ALL SELECT 'record', NULL, '5' FROM s WHERE k = 1 AND event_name = 'MODIFY'
      UNION ALL SELECT 'sequence', NULL, regexp_replace(written, '^0*9', 'x') FROM s WHERE k = 2
      UNION ALL SELECT 'batch', NULL, CASE WHEN k = 0 THEN event_id::VARCHAR ELSE '' END FROM s WHERE k IN (0, 3) AND event_name = 'MODIFY'""",
    "a05_decode_attributes": DECODED,
    "b01_extract_links": f"""
      SELECT page_id, page_url, CAST(pos + 6 AS INTEGER) AS pos, href, anchor FROM ({LINKS})
      UNION ALL SELECT page_id, url, pos, replace(href, '#', CAST(page_id AS VARCHAR)), anchor FROM pages, (VALUES
        (0, '/open#', 'one'), (1, '/b', 'two'), (2, '/unq#?a=b', 'three'), (3, '/it''s', 'four'), (4, '/x?a>"b', 'five'), (5, '/it''s', 'seven')
      ) AS v(pos, href, anchor)""",
    "b01_extract_cards": f"""
      SELECT * EXCLUDE (kind, rn) FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id, pos) AS rn FROM ({SITE_CARDS}))
      WHERE rn = 1 OR kind IN (0, 1, 8, 12)""",
    "b02_slice_cards": f"""
      SELECT page_id, page_url, pos, href, CASE WHEN pos >= 3 THEN anchor END AS anchor FROM ({LINKS}) WHERE pos <> 2""",
    "b03_resolve_url": rf"""
      WITH l AS (SELECT *, split_part(split_part(page_url, '#', 1), '?', 1) AS page,
          regexp_extract(page_url, '^([a-z]+):', 1) AS scheme FROM ({LINKS}))
      SELECT page_url, href, {ORIGIN} || href AS url FROM l
      UNION ALL SELECT page_url, substr(href, 2), CASE WHEN length(href) > 1 THEN regexp_extract(page, '^(.*/)', 1) || substr(href, 2) END FROM l
      UNION ALL SELECT page_url, '//cdn.example.org' || href, scheme || '://cdn.example.org' || href FROM l
      UNION ALL SELECT page_url, 'https://example.net' || href, 'https://example.net' || href FROM l
      UNION ALL SELECT page_url, '?start=' || pos, page || '?start=' || pos FROM l""",
    "b04_canonical_url": f"SELECT page_id, {canonical('url')} AS url FROM pages",
    "b05_url_category": f"""
      SELECT page_id, {segment('url')} AS plain, {segment(canonical('url'))} AS canonical,
        {segment(f"rtrim({canonical('url')}, '/') || '/'")} AS slashed FROM pages""",
    "b06_filter_links": f"""
      SELECT * FROM ({LINKS}) WHERE regexp_matches(href, '[aeiou]{{2}}') AND href LIKE '/%'
        AND href NOT LIKE '%th%' AND href NOT LIKE '%é%'""",
    "b07_allowed_hosts": f"""
      SELECT page_id, page_url, url, {source('page_url')} AS source FROM ({CHAIN}) WHERE {source('page_url')} = {source('url')}""",
    "b08_dedupe_links": f"""
      SELECT url, page_id, pos, anchor FROM (
        SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id, pos) AS rn FROM ({NAV})) WHERE rn = 1""",
    "b08_dedupe_links_each_visit": f"""
      SELECT url, page_id, pos, again FROM (
        SELECT *, anchor LIKE '%th%' AS again, row_number() OVER (
          PARTITION BY url, anchor LIKE '%th%' ORDER BY page_id, pos) AS rn FROM ({NAV})) WHERE again OR rn = 1""",
    "b08_dedupe_links_stream": "SELECT DISTINCT 'https://example.com/' || user_id AS url FROM events",
    "b09_expand_frontier": f"""
      SELECT DISTINCT url, 1 AS hop FROM ({NAV}) WHERE url NOT IN (SELECT {canonical('url')} FROM pages)""",
    "b09_expand_frontier_hops": f"""
      WITH edges AS MATERIALIZED (SELECT {canonical('page_url')} AS page_url, url FROM ({NAV}) UNION ALL SELECT page_url, url FROM ({CHAIN})),
      h0 AS MATERIALIZED (SELECT DISTINCT {canonical('url')} AS url FROM pages WHERE {canonical('url')} LIKE '%/'),
      h1 AS MATERIALIZED (SELECT DISTINCT e.url FROM h0 JOIN edges e ON e.page_url = h0.url WHERE e.url NOT IN (FROM h0)),
      h2 AS MATERIALIZED (SELECT DISTINCT e.url FROM h1 JOIN edges e ON e.page_url = h1.url
        WHERE e.url NOT IN (FROM h0 UNION ALL FROM h1)),
      h3 AS (SELECT DISTINCT e.url FROM h2 JOIN edges e ON e.page_url = h2.url
        WHERE e.url NOT IN (FROM h0 UNION ALL FROM h1 UNION ALL FROM h2))
      SELECT url, 1 AS hop FROM h1 UNION ALL SELECT url, 2 FROM h2 UNION ALL SELECT url, 3 FROM h3""",
    "b09_unseen_links": f"""
      WITH own AS MATERIALIZED (SELECT {canonical('url')} AS url FROM pages),
      one AS MATERIALIZED (SELECT DISTINCT url FROM ({NAV}) WHERE url IS NOT NULL AND url NOT IN (SELECT url FROM own WHERE url IS NOT NULL))
      SELECT url, 'links' AS run FROM one UNION ALL
      SELECT DISTINCT url, 'chain' FROM (SELECT url FROM ({CHAIN}) UNION ALL SELECT url FROM ({NAV})) WHERE url IS NOT NULL
        AND url NOT IN (SELECT url FROM own WHERE url IS NOT NULL) AND url NOT IN (SELECT url FROM one)""",
    "b10_attach_card": """
      SELECT p.page_id, p.url, 'card ' || (c.page_id - 1) AS card_title FROM pages p
      JOIN pages c ON split_part(p.url, '#', 1) = split_part(c.url, '#', 1) WHERE c.page_id > 0""",
    "b10_attach_card_stream": """
      WITH p AS (SELECT page_id, url, TIMESTAMP '2024-01-01' + to_hours(page_id) AS moment FROM pages),
      a AS (SELECT page_id, url, unnest([moment, moment + INTERVAL 4 HOUR, moment + INTERVAL 40 HOUR]) AS moment FROM p),
      c AS (SELECT 'card ' || page_id AS title, split_part(url, '#', 1) AS key, moment + INTERVAL 2 HOUR AS seen FROM p WHERE page_id % 3 < 2)
      SELECT a.page_id, a.url, strftime(a.moment, '%Y-%m-%d %H:%M') AS "at", c.title AS card_title FROM a
      LEFT JOIN c ON split_part(a.url, '#', 1) = c.key AND a.moment BETWEEN c.seen AND c.seen + INTERVAL 1 DAY""",
    "c01_strip_markup": f"SELECT page_id, html FROM ({PAGES})",
    "c02_body_text_all": f"SELECT page_id, {text_all('body')} AS text FROM ({REGION})",
    "c02_body_text_direct": f"""
      SELECT page_id, {unescape(joined(f"list_transform({paragraphs('body')}, lambda p: {DIRECT})"))} AS text FROM ({REGION})""",
    "c03_body_text_first": f"SELECT page_id, {text_first('body')} AS text FROM ({REGION})",
    "c04_main_text": f"SELECT page_id, array_to_string({block_texts('body')}, chr(10) || chr(10)) AS text FROM ({REGION})",
    "c04_dense_text": rf"""
      WITH piece AS (
        SELECT page_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM (
          SELECT page_id, string_split_regex(html, '(?i)</?(?:{NAMES})(?:\s[^>]*)?/?>') AS parts FROM ({PAGES}))),
      block AS (
        SELECT page_id, i, {trim(plain('part'))} AS text,
          len(list_filter(string_split_regex({trim(plain('part'))}, '\s+'), lambda w: w <> '')) AS words,
          len(list_filter(string_split_regex({trim(plain(r"array_to_string(regexp_extract_all(part, '(?is)<a\s[^>]*>(.*?)</a', 1), ' ')"))}, '\s+'), lambda w: w <> '')) AS linked
        FROM piece),
      near AS (
        SELECT *, linked / words AS share, coalesce(lag(linked / words) OVER w, 0) AS share_before,
          coalesce(lag(words) OVER w, 0) AS words_before, coalesce(lead(words) OVER w, 0) AS words_after
        FROM block WHERE text <> '' WINDOW w AS (PARTITION BY page_id ORDER BY i)),
      kept AS (
        SELECT page_id, string_agg(text, chr(10) || chr(10) ORDER BY i) AS text FROM near
        WHERE share <= 1.0::DOUBLE / 3 AND CASE WHEN share_before <= 5.0::DOUBLE / 9
          THEN words > 16 OR words_after > 15 OR words_before > 4 ELSE words > 40 OR words_after > 17 END
        GROUP BY page_id)
      SELECT p.page_id, coalesce(kept.text, '') AS text FROM pages p LEFT JOIN kept ON kept.page_id = p.page_id""",
    "c04_scored_text": rf"""
      WITH token AS (
        SELECT page_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM (
          SELECT page_id, regexp_extract_all(html, '<[^>]*>|[^<\x09-\x0D\x20]+') AS parts FROM ({PAGES}))),
      total AS (SELECT *, sum(CASE WHEN part LIKE '<%' THEN -13 ELSE 4 END) OVER (PARTITION BY page_id ORDER BY i) AS upto FROM token),
      ahead AS (SELECT *, coalesce(lag(upto) OVER (PARTITION BY page_id ORDER BY i), 0) AS before FROM total),
      low AS (SELECT *, min(before) OVER (PARTITION BY page_id ORDER BY i) AS least FROM ahead),
      ends AS (
        SELECT page_id, i AS last, least, row_number() OVER (PARTITION BY page_id ORDER BY upto - least DESC, i) AS rank
        FROM low QUALIFY rank = 1 AND upto > least),
      starts AS (SELECT page_id, last, max(i) AS first FROM ahead JOIN ends USING (page_id) WHERE i <= last AND before = least GROUP BY ALL),
      run AS (
        SELECT page_id, string_agg(part, ' ' ORDER BY i) AS text FROM token JOIN starts USING (page_id)
        WHERE i BETWEEN first AND last AND part NOT LIKE '<%' GROUP BY page_id)
      SELECT page_id, coalesce({unescape('text')}, '') AS text FROM pages LEFT JOIN run USING (page_id)""",
    "c05_page_title": f"SELECT page_id, {title('html')} AS title FROM ({PAGES})",
    "c06_meta_content": f"""
      SELECT page_id, image, {host('url')} AS section, url AS link_image, CAST(NULL AS VARCHAR) AS keywords FROM ({FIELDS})""",
    "c07_lead_image": """
      SELECT page_id, CASE WHEN url LIKE 'https%' THEN regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/lazy/' || page_id || '.jpg'
        ELSE 'http://cdn.example.org/' || page_id || '.jpg' END AS imgurl FROM pages""",
    "c08_strip_brackets": r"""
      SELECT doc_id, regexp_replace(substr(text, 1, 20) || ' [note] ' || substr(text, 21) || ' [x]' || chr(10) || text,
        '\[.*\]', '', 'g') AS text FROM documents""",
    "c09_clean_space": f"""
      SELECT doc_id, {trim('t')} AS both, {sub('t', f'^{SPACE}+')} AS left_only FROM (
        SELECT doc_id, chr(10) || ' ' || chr(9) || chr(160) || ' ' || text || chr(8195) || chr(12288) || ' ' || chr(13) || chr(10) AS t
        FROM documents)""",
    "c10_unescape_entities": f"SELECT page_id, 'AB&#99999999;&#x110000;' || {unescape('html')} AS html FROM pages",
    "c10_unescape_html5": f"SELECT page_id, {unescape_html5('html')} AS html FROM pages",
    "d01_parse_date": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders",
    "d02_clean_date_text": f"""
      SELECT o_orderkey, CASE o_orderkey % 5 {' '.join(
          f"WHEN {i} THEN strftime(o_orderdate, '{x}')" for i, x in enumerate(LAYOUTS))} END AS text,
        CAST(o_orderdate AS DATE) AS day FROM orders""",
    "d03_default_date": f"""
      SELECT o_orderkey, day, strftime(day, '%d/%m/%Y') AS printed FROM (
        SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE)
          WHEN o_orderkey % 3 = 0 THEN {RUN} WHEN o_orderkey % 3 = 1 THEN DATE '2024-01-01' END AS day FROM orders)""",
    "d04_blurp": f"""
      SELECT page_id, coalesce(CASE WHEN url LIKE '%?%' THEN ad END, nullif(CASE WHEN url LIKE 'https%'
        THEN {lead(text_all('body'))} ELSE first_p END, '')) AS blurp
      FROM (SELECT *, regexp_extract(html, '(?is)<div class="ad">(.*?)</div>', 1) AS ad,
        {unescape(rf"regexp_extract({paragraphs('body')}[1], '(?:^|>)([^<]+)', 1)")} AS first_p FROM ({REGION}))""",
    "d05_lead_sentences": f"""
      SELECT doc_id, {lead('text')} AS lead, CASE WHEN length(text) > 50 THEN {lead('text')} END AS lead_if_long FROM documents""",
    "d06_category": f"""
      SELECT page_id, source, CASE source WHEN 'farm' THEN 'spam' WHEN 'net' THEN regexp_extract(html, '<html lang="([a-z]+)"', 1)
        WHEN 'com' THEN coalesce({segment(canonical('url'))}, 'leading') WHEN 'org' THEN {segment(canonical('url'))} END AS category
      FROM (SELECT *, {source('url')} AS source FROM ({PAGES}))""",
    "d07_normalise_tags": """
      SELECT p_partkey, CASE WHEN p_partkey % 3 < 2 THEN replace(lower(p_name), ' ', ', ') || ', ' || lower(p_type) END AS tags FROM part""",
    "d08_filter_titles": f"""
      SELECT page_id, title FROM (SELECT page_id, {title('html')} AS title FROM ({PAGES}))
      WHERE title IS NULL OR (title NOT LIKE '%review%' AND lower(title) NOT LIKE '%best%')""",
    "d08_filter_titles_documents": """
      SELECT doc_id, text AS title FROM documents WHERE text NOT LIKE '%review%' AND lower(text) NOT LIKE '%best%'""",
    "d09_conform_union": f"""
      SELECT {title('html')} AS title, url, 'pages' AS source, CAST(NULL AS DATE) AS date, CAST(NULL AS VARCHAR) AS blurp,
        CAST(NULL AS VARCHAR) AS text, CAST(NULL AS VARCHAR) AS imgurl, CAST(NULL AS VARCHAR) AS category,
        CAST(NULL AS VARCHAR) AS tags FROM ({PAGES})
      UNION ALL SELECT 'document ' || doc_id, NULL, source, {RUN}, NULL, text, NULL, lang, NULL FROM documents""",
    "d10_build_articles_cards": f"""
      WITH a AS (
        SELECT i, kind, text, t, first_p, CASE kind WHEN 5 THEN {title('html')} WHEN 6 THEN 'Headline ' || i ELSE t END AS title
        FROM ({SITE_ARTICLES})
      ), r AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY i DESC) AS rn FROM a
        WHERE title IS NOT NULL AND (kind <> 5 OR (title NOT LIKE '%review%' AND lower(title) NOT LIKE '%best%')))
      SELECT i * 2 + 1 AS page_id, title, {SITE_ORIGIN} || {SITE_FOLDER} || '/story/' || i AS url,
        {by_site({k: f"'{n}'" for k, n in enumerate(SITE_NAMES)})} AS source,
        {by_site({k: f"'{d:02}/01/2024'" for k, d in enumerate((2, 5, 3, 4, 9, 2, 3, 10, 2, 4, 7, 6, 8, 11))})} AS date,
        nullif({by_site({0: "'About ' || t", 1: "'first ' || t", 2: "'Described ' || i", 3: "'About ' || t", 4: "'About ' || i", 5: "'Stand'", 6: "'Described ' || i",
                  7: "'Sum ' || i", 8: "'About ' || t", 9: lead('text'), 10: "'About ' || i", 11: "'A firm ' || i", 12: lead('text'), 13: 'first_p'})}, '') AS blurp,
        text, {SITE_ORIGIN} || CASE kind WHEN 10 THEN '/img/story/' || i || '.jpg' ELSE '/p/' || i || '.png' END AS imgurl,
        {by_site({2: "'analytics'", 3: "'Security'", 4: "'security'", 5: "'Tech'", 6: "'analytics'", 8: "'business'", 9: "'Big Data'", 11: "NULL", 12: "'cloud ' || i"},
                 "'technology'")} AS category,
        {by_site({2: "'data, cloud ' || i", 5: "'AI, Law ' || i || ', Tech'", 6: "'Data, Cloud ' || i", 11: "'seed, ai ' || i", 12: "'cloud ' || i"})} AS tags
      FROM r WHERE rn = 1""",
    "d10_build_articles": f"""
      SELECT title, url, source, date, category, blurp, text FROM (
        SELECT title, url, source, text,
          CASE WHEN source IN ('com', 'pills') THEN {RUN} WHEN source IN ('net', 'org') THEN DATE '2024-01-01' END AS date,
          CASE source WHEN 'farm' THEN 'spam' WHEN 'pills' THEN NULL WHEN 'org' THEN {segment("rtrim(url, '/') || '/'")}
            ELSE {segment('url')} END AS category,
          nullif(CASE source WHEN 'farm' THEN first_p WHEN 'org' THEN ad WHEN 'net' THEN CASE WHEN length(text) > 50 THEN {lead('text')} END
            ELSE {lead('text')} END, '') AS blurp,
          row_number() OVER (PARTITION BY title ORDER BY page_id DESC) AS rn
        FROM ({ARTICLES}) WHERE title IS NOT NULL
          AND (source <> 'net' OR (title NOT LIKE '%review%' AND lower(title) NOT LIKE '%best%'))) WHERE rn = 1""",
    "e01_upsert_latest": f"""
      SELECT page_id, url, title FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY page_id DESC) AS rn
        FROM (SELECT page_id, url, {title('html')} AS title FROM ({PAGES})) WHERE title IS NOT NULL) WHERE rn = 1""",
    "e02_apply_changes": STATE,
    "e03_apply_changes_stream": STATE,
    "e03_apply_changes_state": STATE,
    "e04_to_search_doc": f"""
      SELECT strftime(date, '%d/%m/%Y') AS date, url, text, blurp, imgurl, title, tags, category FROM (
        SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq DESC) AS rn FROM ({DECODED}))
      WHERE rn = 1 AND event_name <> 'REMOVE'""",
    "e05_change_counts": f"SELECT event_name, count(*) AS n FROM ({EVENT_CHANGES}) GROUP BY event_name",
    "e05_change_counts_stream": f"SELECT event_name, count(*) AS n FROM ({EVENT_CHANGES}) GROUP BY event_name",
    "e06_write_jsonl": "SELECT * FROM documents",
    "e07_write_feed": "SELECT doc_id, text, lang, n_chars, source, '2024-01-15T00-00-00' AS run_ts FROM documents",
    "e07_write_feed_chunks": """
      SELECT source, doc_id, (rn - 1) // 100 * 100 AS "offset", rn AS "row" FROM (
        SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents)""",
    "e08_encode_temporal": """
      SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value, props,
        strftime(ts, '%Y-%m-%d') AS day FROM events""",
    "f01_keywords": f"SELECT doc_id, CAST(rank AS INTEGER) AS rank, term, CAST(n AS INTEGER) AS n, score FROM ({KEYWORDS})",
    "f02_summary": rf"""
      WITH found AS (
        SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '[^.!?]+[.!?]*'), lambda s: {trim('s')}),
          lambda s: regexp_matches(s, '[\p{{L}}\p{{N}}]')) AS ss FROM documents),
      s AS (SELECT doc_id, unnest(ss) AS sentence, generate_subscripts(ss, 1) AS i FROM found),
      w AS MATERIALIZED (SELECT doc_id, i, unnest(list_filter(string_split_regex(lower(sentence), '[^\p{{L}}\p{{N}}]+'), lambda t: t <> '')) AS term FROM s),
      c AS (SELECT doc_id, term, count(*) AS n FROM w GROUP BY doc_id, term),
      m AS (SELECT w.doc_id, w.i, sum(c.n) / count(*) AS mean FROM w JOIN c ON c.doc_id = w.doc_id AND c.term = w.term GROUP BY w.doc_id, w.i),
      r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY mean DESC, i) AS rank FROM m),
      t AS (SELECT r.doc_id, string_agg(s.sentence, ' ' ORDER BY s.i) AS summary FROM r JOIN s ON s.doc_id = r.doc_id AND s.i = r.i
        WHERE rank <= 3 GROUP BY r.doc_id)
      SELECT d.doc_id, coalesce(t.summary, '') AS summary FROM documents d LEFT JOIN t ON t.doc_id = d.doc_id""",
    "f03_trending": f"""
      SELECT CAST(rn AS INTEGER) AS rank, term, n FROM (
        SELECT *, row_number() OVER (ORDER BY n DESC, term) AS rn FROM ({TOP})) WHERE rn <= 20""",
    "f03_trending_daily": f"""
      WITH c AS (SELECT DATE '2024-01-01' + CAST(doc_id % 28 AS INTEGER) AS day, term, count(DISTINCT doc_id) AS n
        FROM ({KEYWORDS}) GROUP BY 1, 2),
      g AS (SELECT c.day, c.term, c.n, c.n - coalesce(b.n, 0) AS growth, row_number() OVER (PARTITION BY c.day ORDER BY c.n DESC, c.term) AS rn
        FROM c LEFT JOIN c b ON b.term = c.term AND b.day = c.day - 1)
      SELECT day, CAST(rn AS INTEGER) AS rank, term, n, growth FROM g WHERE rn <= 5""",
    "f03_trending_hourly": """
      WITH c AS (SELECT CAST(floor(epoch(ts) / 3600) AS BIGINT) AS hour, event_type AS term, count(*) AS n FROM events GROUP BY 1, 2),
      g AS (SELECT c.hour, c.term, c.n, c.n - coalesce(b.n, 0) AS growth, row_number() OVER (PARTITION BY c.hour ORDER BY c.n DESC, c.term) AS rn
        FROM c LEFT JOIN c b ON b.term = c.term AND b.hour = c.hour - 1)
      SELECT hour, CAST(rn AS INTEGER) AS rank, term, n, growth FROM g WHERE rn <= 3""",
    "f03_trending_stream": """
      SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type AS term, count(*) AS n FROM events GROUP BY 1, 2""",
    "f03_trending_periods": f"""
      WITH w AS MATERIALIZED (SELECT doc_id, term, TIMESTAMP '2024-01-01' + to_hours(doc_id % 60) AS moment FROM ({KEYWORDS}) WHERE rank <= 3),
      s AS (SELECT doc_id, term, moment FROM w UNION ALL SELECT doc_id, term, moment + to_hours(doc_id % 7 * 5) FROM w),
      p AS (SELECT doc_id, term, moment - to_hours(h) AS start FROM s, (SELECT unnest(range(24)) AS h))
      SELECT strftime(start, '%Y-%m-%d %H:%M') AS start, term, count(DISTINCT doc_id) AS n FROM p GROUP BY ALL""",
    "f04_search": bm25(
        r"SELECT DISTINCT item_id AS query_id, unnest(list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')) AS term FROM benchmark", 10),
    "f04_search_index": bm25(
        r"SELECT DISTINCT item_id AS query_id, unnest(list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')) AS term FROM benchmark", 10),
    "f04_search_blocks": bm25(
        r"SELECT DISTINCT item_id AS query_id, unnest(list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')) AS term FROM benchmark", 10),
    "f05_recommend": f"""
      WITH q0 AS (SELECT term, row_number() OVER (ORDER BY n DESC, term) AS rn FROM ({TOP})),
      hits AS ({bm25("SELECT CAST(rn AS INTEGER) AS query_id, term FROM q0 WHERE rn <= 10", 5)})
      SELECT query_id AS term_rank, q0.term, rank, doc_id, score FROM hits JOIN q0 ON q0.rn = hits.query_id""",
}


def dates_as_text(name: str, column: str, layout: str = "%Y-%m-%d") -> None:
    ORACLE[name] = f"SELECT * REPLACE (strftime({column}, '{layout}') AS {column}) FROM ({ORACLE[name]})"


for _name, _column in (
    ("a05_decode_attributes", "date"), ("d01_parse_date", "day"), ("d02_clean_date_text", "day"),
    ("d03_default_date", "day"), ("d09_conform_union", "date"), ("d10_build_articles", "date"),
    ("f03_trending_daily", "day"),
):
    dates_as_text(_name, _column)
dates_as_text("f03_trending_stream", "window_start", "%Y-%m-%d %H:%M:%S")
