"""The catalog's queries as DuckDB SQL over the given tables, written independently of Spark's plans."""

from __future__ import annotations

from crawlframe.functions.domains import public_suffixes

# Named parts. A query lists the ones it needs; parts may use parts listed before them.
PARTS: dict[str, str] = {}

PARTS["n_pages"] = "SELECT count(*) AS n FROM pages"

PARTS["fx_sites"] = r"""
SELECT CAST(hn + 1 AS BIGINT) AS id, domain,
  CASE hn % 6
    WHEN 0 THEN ''
    WHEN 1 THEN concat('User-agent: *', chr(10), 'Disallow: /en/', chr(10))
    WHEN 2 THEN concat('User-agent: *', chr(10), 'Allow: /en/7', chr(10), 'Disallow: /en/', chr(10), 'Crawl-delay: 2', chr(10))
    WHEN 3 THEN concat('User-agent: *', chr(10), 'Disallow:', chr(10), 'Request-rate: 2/20', chr(10), 'Crawl-delay: 9', chr(10))
    WHEN 4 THEN concat('User-agent: foo', chr(10), 'Disallow: /', chr(10), chr(10), '# the others', chr(10), 'user-agent: bar', chr(10),
      'User-agent: *', chr(10), 'Disallow: /%64e/ # c', chr(10), 'Crawl-delay: 1.5', chr(10), 'Sitemap: ', domain, '/sitemap.xml', chr(10))
    ELSE '<html>404</html>' END AS robots_content,
  CASE WHEN hn % 3 = 1 THEN concat('<urlset><url><loc>', domain, '/sm/1</loc></url><url><loc>https', substr(domain, 5), '/sm/2#x</loc></url></urlset>') ELSE '' END AS sitemap_content
FROM (SELECT domain, row_number() OVER (ORDER BY md5(domain)) - 1 AS hn
      FROM (SELECT DISTINCT concat('http://', lower(regexp_extract(url, '^https?://([^/?#]+)', 1))) AS domain FROM pages) h) t"""

PARTS["fx_stored_sites"] = "SELECT * FROM fx_sites WHERE domain LIKE '%.com'"

PARTS["fx_fetches"] = r"""
SELECT p.page_id AS seq, p.url, concat('http://', lower(regexp_extract(p.url, '^https?://([^/?#]+)', 1))) AS domain,
  q.url AS parent_url,
  CASE WHEN p.page_id % 5 = 4 THEN d.html ELSE p.html END AS html,
  CASE p.page_id % 10 WHEN 0 THEN 'text/html; charset=utf-8' WHEN 1 THEN 'application/xhtml+xml' WHEN 2 THEN 'application/pdf'
    WHEN 3 THEN 'image/svg+xml' WHEN 4 THEN 'text/html' WHEN 5 THEN 'text/plain' WHEN 6 THEN NULL WHEN 7 THEN 'application/msword'
    WHEN 8 THEN 'text/xml' ELSE 'text/html' END AS content_type,
  CASE p.page_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 404 ELSE 200 END AS status,
  1704067200 + 60 * p.page_id AS accessed_s
FROM pages p LEFT JOIN pages d ON d.page_id = p.page_id - 1
LEFT JOIN pages q ON p.page_id >= 3 AND q.page_id = (p.page_id * 7 + 3) % (SELECT n FROM n_pages)"""

PARTS["fx_edges"] = """
SELECT page_id AS src, 0 AS pos, (page_id * 7 + 3) % (SELECT n FROM n_pages) AS dst FROM pages
UNION ALL
SELECT page_id, 1, (page_id * 3 + 1) % (SELECT n FROM n_pages) FROM pages"""

PARTS["fx_link_table"] = "SELECT DISTINCT src AS from_page, dst AS to_page FROM fx_edges"

PARTS["fx_links"] = r"""
SELECT e.src * 2 + e.pos AS seq, a.url AS parent_url, b.url AS url,
  concat('http://', lower(regexp_extract(b.url, '^https?://([^/?#]+)', 1))) AS host
FROM fx_edges e JOIN pages a ON a.page_id = e.src JOIN pages b ON b.page_id = e.dst"""

PARTS["fx_seen"] = "SELECT url FROM pages WHERE url LIKE 'https:%'"

PARTS["fx_stored"] = "SELECT page_id AS id, url FROM pages WHERE NOT contains(url, '?') AND NOT contains(url, '#')"

PARTS["fx_host_lists"] = r"""
SELECT domain, domain LIKE '%.com' OR domain LIKE '%.net' AS include, contains(domain, '://blog.') AS exclude FROM fx_sites"""

PARTS["fx_redirects"] = """
SELECT s.domain, s.robots_content,
  CASE WHEN s.robots_content = '' AND NOT ((s.id - 1) % 48 = 0 AND s.id > 1) THEN 301 ELSE 200 END AS status, t.domain AS location
FROM fx_sites s LEFT JOIN fx_sites t ON (s.id - 1) % 6 = 0
  AND t.id - 1 = CASE (s.id - 1) % 24 WHEN 6 THEN s.id WHEN 12 THEN s.id - 1 ELSE s.id + 5 END"""

PARTS["fx_images"] = """
SELECT page_id, k AS pos,
  CASE k WHEN 0 THEN concat('http://img.example.com/i/', CAST(page_id AS VARCHAR), '.png') WHEN 1 THEN 'data:image/gif;base64,R0lGODlh'
    WHEN 2 THEN 'http://www.cms.com/x.jpg' ELSE '' END AS src,
  CASE k WHEN 0 THEN 'image/png' WHEN 1 THEN 'data:image/gif;base64,R0lGODlh' WHEN 2 THEN 'image/jpeg' ELSE NULL END AS content_type
FROM pages, (VALUES (0), (1), (2), (3)) ks(k) WHERE page_id % 4 >= k"""

PARTS["fx_page_data"] = """
SELECT doc_id AS id, doc_id % (SELECT n FROM n_pages) AS page_id,
  CASE doc_id % 5 WHEN 0 THEN 'PDF' WHEN 1 THEN 'DOC' WHEN 2 THEN 'DOCX' WHEN 3 THEN 'PPT' ELSE 'PPTX' END AS data_type_code,
  text AS content FROM documents"""

PARTS["fx_requests"] = """
SELECT event_id AS seq, user_id AS host, epoch_us(ts) AS arrival_us, (user_id % 5) * 14400000000 AS limit_us FROM events"""

PARTS["fx_slots"] = """
SELECT *, n * limit_us + max(arrival_us - n * limit_us) OVER (
    PARTITION BY host ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS slot_us
FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY arrival_us, seq) AS n FROM fx_requests) t"""

PARTS["fx_moment"] = """
SELECT m AS middle, m + 6 * 3600000000 AS now_us
FROM (SELECT min(arrival_us) + (max(arrival_us) - min(arrival_us)) // 2 AS m FROM fx_requests) t"""

PARTS["fx_clocks"] = """
SELECT host, min(seq) AS host_seq, max(slot_us) FILTER (slot_us <= (SELECT middle FROM fx_moment)) AS last_fetch_us,
  max(limit_us) AS limit_us FROM fx_slots GROUP BY host"""

PARTS["fx_queue"] = """
SELECT host, seq, arrival_us FROM fx_slots
WHERE slot_us > (SELECT middle FROM fx_moment) AND arrival_us <= (SELECT now_us FROM fx_moment)"""

PARTS["fx_ready"] = """
SELECT c.host, c.host_seq, c.last_fetch_us, c.limit_us, q.queued
FROM fx_clocks c JOIN (SELECT host, count(*) AS queued FROM fx_queue GROUP BY host) q USING (host)
WHERE c.last_fetch_us IS NULL OR (SELECT now_us FROM fx_moment) - c.last_fetch_us >= c.limit_us"""

PARTS["fx_hrefs"] = r"""
SELECT page_id, url, k AS pos, CASE k
    WHEN 0 THEN '/p/q' || page_id WHEN 1 THEN 'q' || page_id || '.html' WHEN 2 THEN '//B.example.com/x' || page_id
    WHEN 3 THEN 'mailto:a' || page_id || '@b.example.com' WHEN 4 THEN 'http://c.example.org/x?b=' || page_id || '&a=1#t'
    WHEN 5 THEN '' WHEN 6 THEN NULL WHEN 7 THEN 'tel:' || page_id WHEN 8 THEN 'https://D.example.net'
    WHEN 9 THEN '/für/' || page_id WHEN 10 THEN 'http://e.example.com/x?to=sms:' || page_id
    WHEN 11 THEN '/f%c3%bc%2f%41 ' || page_id WHEN 12 THEN upper(url) ELSE url || '&z=a b&é=' || page_id END AS href
FROM pages, (SELECT CAST(range AS INTEGER) AS k FROM range(14)) ks"""

PARTS["fx_html"] = r"""
SELECT page_id, url, html || CASE page_id % 3
    WHEN 0 THEN '<a href="/x">1</a><A class="b" HREF="/y?a=1&amp;b=' || page_id || '">2</A><img src="/i/' || page_id || '.png"><img alt="z" src="data:image/gif;base64,R0">'
    WHEN 1 THEN '<!-- <a href="/no"><img src="/no.png"> --><script>var s = "<a href=/no2>";</script><a name="t">anchor</a><a href="">e</a><img>'
    ELSE '<img class=x src=''/i/q.gif''><IMG SRC=http://cms.com/y alt=y><a id=k href=/bare>b</a>' END AS html
FROM pages"""

# Canonical URLs of the pages: scheme folded, no fragment, a path, sorted pairs. Page URLs have
# lower-case hosts and safe characters only.
PARTS["canon"] = r"""
SELECT url AS raw, 'http://' || regexp_extract(url, '^https?://([^/?#]*)', 1)
    || CASE WHEN regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) END
    || CASE WHEN contains(url, '?') THEN '?' || list_aggregate(list_sort(string_split(regexp_extract(url, '\?([^#]*)', 1), '&')), 'string_agg', '&') ELSE '' END AS canonical
FROM (SELECT DISTINCT url FROM pages) t"""

PARTS["c_links"] = """
SELECT l.seq, p.canonical AS parent_url, u.canonical AS url, l.host
FROM fx_links l JOIN canon p ON p.raw = l.parent_url JOIN canon u ON u.raw = l.url"""

PARTS["c_stored"] = "SELECT min(id) AS id, canonical AS url FROM fx_stored JOIN canon ON raw = url GROUP BY canonical"

PARTS["c_seen"] = "SELECT DISTINCT canonical AS url FROM fx_seen JOIN canon ON raw = url"

# Fetches with their type by an explicit list of the headers that occur.
PARTS["typed"] = r"""
SELECT *, CASE
    WHEN content_type IS NULL THEN CASE
      WHEN url LIKE '%pdf' THEN '.pdf' WHEN url LIKE '%ppt' THEN '.ppt' WHEN url LIKE '%pptx' THEN '.pptx'
      WHEN url LIKE '%doc' THEN '.doc' WHEN url LIKE '%docx' THEN '.docx' ELSE '.html' END
    WHEN content_type LIKE 'text/html%' THEN '.html' WHEN content_type = 'application/xhtml+xml' THEN '.xhtml'
    WHEN content_type = 'application/pdf' THEN '.pdf' WHEN content_type = 'image/svg+xml' THEN '.svg'
    WHEN content_type = 'application/msword' THEN '.doc' WHEN content_type = 'text/xml' THEN '.xml' END AS extension
FROM fx_fetches"""

PARTS["routed"] = """
SELECT *, CASE WHEN extension IN ('.html', '.xhtml', '.xml') THEN 'HTML' ELSE upper(substr(extension, 2)) END AS data_type_code,
  CASE WHEN extension IN ('.doc', '.docx', '.ppt', '.pptx', '.pdf') THEN 'document'
    WHEN extension IN ('.html', '.xhtml', '.xml') THEN 'website' ELSE 'skip' END AS route
FROM typed"""

PARTS["visits"] = """
SELECT * FROM (
  SELECT r.seq, u.canonical AS url, p.canonical AS parent_url, r.route, r.data_type_code, coalesce(r.status, 204) AS http_status_code,
    r.accessed_s, r.html, row_number() OVER (PARTITION BY u.canonical ORDER BY r.seq) AS visit
  FROM routed r JOIN canon u ON u.raw = r.url LEFT JOIN canon p ON p.raw = r.parent_url WHERE r.route <> 'skip') t
WHERE visit = 1"""

PARTS["page_rows"] = r"""
SELECT *, regexp_extract(url, '^http://[^/?#]*') AS domain,
  CASE WHEN route = 'document' THEN 'BINARY' WHEN copy = 1 THEN 'HTML' ELSE 'DUPLICATE' END AS page_type_code
FROM (SELECT *, row_number() OVER (PARTITION BY route, CASE WHEN route = 'website' THEN html END ORDER BY accessed_s, seq) AS copy FROM visits) t"""

PARTS["page_sites"] = """
SELECT domain, id FROM fx_stored_sites
UNION ALL
SELECT domain, (SELECT max(id) FROM fx_stored_sites) + row_number() OVER (ORDER BY md5(domain))
FROM (SELECT DISTINCT domain FROM page_rows WHERE domain NOT IN (SELECT domain FROM fx_stored_sites)) t"""

PARTS["page_ids"] = """
SELECT *, row_number() OVER (ORDER BY md5(url)) AS id FROM page_rows"""

PARTS["rb_lines"] = r"""
SELECT domain, unnest(string_split(robots_content, chr(10))) AS line,
  CAST(generate_subscripts(string_split(robots_content, chr(10)), 1) AS INTEGER) AS pos FROM fx_sites"""

PARTS["rb_tokens"] = """
SELECT domain, pos, CASE WHEN line = '' THEN 'empty' ELSE lower(trim(split_part(split_part(line, '#', 1), ':', 1))) END AS k,
  url_decode(trim(substr(split_part(line, '#', 1), strpos(split_part(line, '#', 1), ':') + 1))) AS v
FROM rb_lines WHERE line = '' OR contains(split_part(line, '#', 1), ':')"""

PARTS["rb_marked"] = """
SELECT *, lag(k) OVER (PARTITION BY domain ORDER BY pos) AS before FROM rb_tokens
WHERE k IN ('empty', 'user-agent', 'allow', 'disallow', 'crawl-delay', 'request-rate')"""

PARTS["rb_grouped"] = """
SELECT *, sum(CASE WHEN k = 'empty' OR (k = 'user-agent' AND coalesce(before, '') <> 'user-agent') THEN 1 ELSE 0 END)
  OVER (PARTITION BY domain ORDER BY pos) AS g FROM rb_marked"""

PARTS["rb_groups"] = """
SELECT domain, g, bool_or(k = 'user-agent' AND v = '*') AS star FROM rb_grouped
GROUP BY domain, g HAVING bool_or(k = 'user-agent') AND bool_or(k NOT IN ('empty', 'user-agent'))"""

PARTS["rb_star"] = """
SELECT r.* FROM rb_grouped r JOIN (SELECT domain, min(g) AS g FROM rb_groups WHERE star GROUP BY domain) s USING (domain, g)"""

PARTS["rb_rules"] = """
SELECT domain, CAST(row_number() OVER (PARTITION BY domain ORDER BY pos) - 1 AS INTEGER) AS rule_seq, k = 'allow' OR v = '' AS allow, v AS path
FROM rb_star WHERE k IN ('allow', 'disallow')"""

PARTS["rb_limits"] = r"""
SELECT s.domain, l.requests, l.seconds, l.crawl_delay,
  coalesce(CAST(l.seconds AS DOUBLE) / nullif(l.requests, 0), CAST(l.crawl_delay AS DOUBLE), 5.0) AS limit_s
FROM fx_sites s LEFT JOIN (
  SELECT domain, CAST(max(split_part(v, '/', 1)) FILTER (k = 'request-rate' AND regexp_full_match(v, '[0-9]+/[0-9]+')) AS BIGINT) AS requests,
    CAST(max(split_part(v, '/', 2)) FILTER (k = 'request-rate' AND regexp_full_match(v, '[0-9]+/[0-9]+')) AS BIGINT) AS seconds,
    CAST(max(v) FILTER (k = 'crawl-delay' AND regexp_full_match(v, '[0-9]+')) AS BIGINT) AS crawl_delay
  FROM rb_star GROUP BY domain) l USING (domain)"""

PARTS["page_domains"] = r"""
SELECT page_id, url, concat('http://', lower(regexp_extract(url, '^https?://([^/?#]+)', 1))) AS domain FROM pages"""

PARTS["matched"] = r"""
SELECT p.page_id, p.url, p.domain, coalesce(first(r.allow ORDER BY r.rule_seq) FILTER (r.rule_seq IS NOT NULL), true) AS allowed
FROM page_domains p LEFT JOIN rb_rules r
  ON r.domain = p.domain AND starts_with(regexp_extract(p.url, '^https?://[^/?#]*(.*)', 1), r.path)
GROUP BY ALL"""

# Links of the pages: quoted or bare values; comments and scripts are taken out first.
PARTS["h_clean"] = r"""
SELECT page_id, url, regexp_replace(html, '(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'g') AS html FROM fx_html"""

PARTS["h_links"] = r"""
SELECT page_id, url, CAST(pos - 1 AS INTEGER) AS pos, replace(trim(v, '"'), '&amp;', '&') AS href
FROM (SELECT page_id, url, unnest(vs) AS v, generate_subscripts(vs, 1) AS pos
      FROM (SELECT page_id, url, regexp_extract_all(html, '(?i)<a [^>]*?href=("[^"]*"|[^ >]+)', 1) AS vs FROM h_clean) a) b"""

PARTS["h_images"] = r"""
SELECT page_id, CAST(pos - 1 AS INTEGER) AS pos, trim(v, '"''') AS src
FROM (SELECT page_id, unnest(vs) AS v, generate_subscripts(vs, 1) AS pos
      FROM (SELECT page_id, regexp_extract_all(html, '(?i)<img [^>]*?src=("[^"]*"|''[^'']*''|[^ >]+)', 1) AS vs FROM h_clean) a) b"""

# Links of all kinds resolved on their page's host, kind by kind as they are built.
PARTS["resolved"] = r"""
SELECT h.page_id, h.pos, d.domain || CASE h.pos
    WHEN 0 THEN href WHEN 1 THEN '/' || href WHEN 3 THEN '/' || href WHEN 7 THEN '/' || href
    WHEN 9 THEN '/f%C3%BCr/' || h.page_id WHEN 11 THEN '/f%C3%BC%2FA%20' || h.page_id END AS on_host,
  CASE h.pos WHEN 2 THEN 'http://b.example.com/x' || h.page_id WHEN 4 THEN 'http://c.example.org/x?a=1&b=' || h.page_id
    WHEN 8 THEN 'http://d.example.net/' WHEN 10 THEN 'http://e.example.com/x?to=sms%3A' || h.page_id END AS fixed,
  h.href, h.url, d.domain, regexp_extract(h.href, '^[^?#]*') AS base,
  string_split(regexp_extract(h.href, '\?([^#]*)', 1), '&') AS pairs
FROM fx_hrefs h JOIN page_domains d USING (page_id) WHERE h.href IS NOT NULL AND h.href <> ''"""

PARTS["shaped"] = r"""
SELECT *, d2.domain || CASE WHEN path = '' THEN '/' ELSE path END
    || CASE WHEN contains(href, '?') THEN '?' || list_aggregate(list_transform(list_sort(list_filter(pairs, lambda x: x <> '')), lambda x:
      replace(replace(CASE WHEN contains(x, '=') THEN x ELSE x || '=' END, ' ', '+'), 'é', '%C3%A9')), 'string_agg', '&') ELSE '' END AS own
FROM (SELECT *, regexp_extract(base, '(?i)^https?://[^/]*(.*)', 1) || CASE WHEN pos = 13 AND NOT contains(url, '?') AND NOT contains(url, '#')
        THEN '&z=a%20b&%C3%A9=' || page_id ELSE '' END AS path_in FROM resolved) r,
  LATERAL (SELECT r.domain AS domain, CASE WHEN pos = 13 AND NOT contains(url, '?') AND NOT contains(url, '#')
    THEN regexp_extract(url, '^https?://[^/]*(.*)', 1) || '&z=a%20b&%C3%A9=' || page_id ELSE regexp_extract(base, '(?i)^https?://[^/]*(.*)', 1) END AS path) d2"""

PARTS["labels_of"] = r"""
SELECT page_id, host, CASE WHEN host LIKE '%.example.net' THEN 'example.net' ELSE regexp_extract(host, '[^.]*$') END AS suffix
FROM (SELECT page_id, lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) AS host FROM pages) t"""

PARTS["reg"] = r"""
SELECT page_id, host, suffix, regexp_extract(rest, '[^.]*$') AS domain,
  CASE WHEN contains(rest, '.') THEN regexp_replace(rest, '\.[^.]*$', '') ELSE '' END AS subdomain
FROM (SELECT *, substr(host, 1, length(host) - length(suffix) - 1) AS rest FROM labels_of) t"""

PARTS["rules"] = "SELECT unnest([" + ", ".join("'" + rule + "'" for rule in public_suffixes()) + "]) AS rule"

PARTS["listed"] = r"""
WITH p AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS own, ['co.uk', 'foo.ck', 'www.ck', 'city.kawasaki.jp', 'x.kawasaki.jp', 'io', 'unlisted', 'com.au', 'ck'][page_id % 9 + 1] AS s FROM pages),
h AS (SELECT page_id, unnest([lower(own), 'a.b' || page_id || '.' || s, 'w' || page_id || '.' || s, s]) AS host FROM p),
l AS (SELECT *, string_split(host, '.') AS w FROM (SELECT DISTINCT host FROM h) d),
t AS (SELECT host, len(w) AS n, k, array_to_string(w[k:], '.') AS tail, array_to_string(w[k + 1:], '.') AS rest FROM (SELECT *, unnest(range(1, len(w) + 1)) AS k FROM l) x),
m AS (SELECT host, any_value(n) AS n, min(k + 1) FILTER ('!' || tail IN (FROM rules)) AS e,
    min(k) FILTER (tail IN (FROM rules) OR (k < n AND '*.' || rest IN (FROM rules) AND '!' || tail NOT IN (FROM rules))) AS a FROM t GROUP BY host),
s AS (SELECT l.host, l.w, coalesce(e, a, n + 1) AS st FROM m JOIN l USING (host))
SELECT page_id, host, CASE WHEN st > 2 THEN array_to_string(w[:st - 2], '.') ELSE '' END AS subdomain, CASE WHEN st > 1 THEN coalesce(w[st - 1], '') ELSE '' END AS domain, array_to_string(w[st:], '.') AS suffix
FROM h JOIN s USING (host)"""

PARTS["new_links"] = r"""
SELECT url, seq, pos, parent_url, regexp_extract(url, '^http://[^/?#]*') AS host FROM (
  SELECT u.url, u.seq, u.pos, u.parent_url, row_number() OVER (PARTITION BY u.url ORDER BY u.seq, u.pos) AS k FROM (
    SELECT l.page_id AS seq, l.pos, c.canonical AS parent_url,
      regexp_extract(c.canonical, '^http://[^/?#]*') || array_to_string(list_transform(string_split(l.href, ''), lambda x:
        CASE WHEN regexp_full_match(x, '[A-Za-z0-9_.~:/?\[\]@!$&''()*+,;=|-]') THEN x ELSE url_encode(x) END), '') AS url
    FROM h_links l JOIN canon c ON c.raw = l.url WHERE l.href <> '' AND NOT regexp_matches(l.href, 'mailto:|callto:|sms:|tel:')) u) t
WHERE k = 1"""

PARTS["fresh_links"] = r"""
SELECT * FROM new_links WHERE host NOT IN (SELECT domain FROM fx_host_lists WHERE exclude)
  AND url NOT IN (SELECT url FROM c_stored) AND url NOT IN (SELECT url FROM c_seen)"""

_RB = ["fx_sites", "rb_lines", "rb_tokens", "rb_marked", "rb_grouped", "rb_groups", "rb_star", "rb_rules"]
_ROWS = ["n_pages", "fx_fetches", "canon", "typed", "routed", "visits", "page_rows"]
_LINKS = ["n_pages", "fx_edges", "fx_links"]
_CLINKS = [*_LINKS, "canon", "c_links"]
_SLOTS = ["fx_requests", "fx_slots"]
_MOMENT = [*_SLOTS, "fx_moment", "fx_clocks", "fx_queue", "fx_ready"]

ORACLES: dict[str, str] = {}


def oracle(name: str, parts: list[str], body: str) -> None:
    with_text = ",\n".join(f"{p} AS ({PARTS[p].strip()})" for p in dict.fromkeys(parts))
    ORACLES[name] = (f"WITH {with_text}\n" if parts else "") + body.strip()


def recursive_oracle(name: str, parts: list[str], body: str) -> None:
    oracle(name, parts, body)
    ORACLES[name] = ORACLES[name].replace("WITH ", "WITH RECURSIVE ", 1)


oracle("scan_pages", [], "SELECT page_id, url FROM pages")
oracle("scan_sites", ["fx_sites"], "SELECT * FROM fx_sites")
_SEEDS = r"""
SELECT CAST(NULL AS VARCHAR) AS parent_url, domain AS url FROM fx_sites
UNION ALL
SELECT NULL, 'http://' || regexp_replace(regexp_replace(loc, '^https?://', ''), '#.*', '')
FROM (SELECT unnest(regexp_extract_all(sitemap_content, '<loc>([^<>]+)</loc>', 1)) AS loc FROM fx_sites) t"""
oracle("seed_table", ["fx_sites"], _SEEDS)
oracle("seeds_union_sitemaps", ["fx_sites"], f"SELECT url FROM ({_SEEDS}) s")
oracle("code_tables", [*_ROWS, "fx_page_data"], """
SELECT c.code_table, c.code, coalesce(u.n_rows, 0) AS n_rows
FROM (VALUES ('data_type', 'PDF'), ('data_type', 'DOC'), ('data_type', 'DOCX'), ('data_type', 'PPT'), ('data_type', 'PPTX'),
  ('page_type', 'HTML'), ('page_type', 'BINARY'), ('page_type', 'DUPLICATE'), ('page_type', 'FRONTIER')) c(code_table, code)
LEFT JOIN (SELECT 'page_type' AS code_table, page_type_code AS code, count(*) AS n_rows FROM page_rows GROUP BY 2
  UNION ALL SELECT 'data_type', data_type_code, count(*) FROM fx_page_data GROUP BY 2) u USING (code_table, code)""")
oracle("write_pages", [*_ROWS, "fx_sites", "fx_stored_sites", "page_sites", "page_ids"], """
SELECT p.id, s.id AS site_id, page_type_code, url, CASE WHEN page_type_code = 'HTML' THEN CAST(strlen(html) AS BIGINT) END AS html_bytes,
  http_status_code, accessed_s, CASE WHEN page_type_code = 'HTML' THEN CAST(128 AS BIGINT) END AS hash_chars
FROM page_ids p JOIN page_sites s USING (domain)""")
oracle("store_batches", [*_ROWS, "page_ids"], """
SELECT p.url, p.domain, p.page_type_code, CASE WHEN p.page_type_code = 'HTML' THEN CAST(strlen(p.html) AS BIGINT) END AS html_bytes,
  p.http_status_code, p.accessed_s, f.url AS parent,
  CASE WHEN p.page_type_code = 'BINARY' THEN CAST(strlen(p.html) AS BIGINT) END AS data_bytes
FROM page_ids p LEFT JOIN page_ids f ON f.url = p.parent_url AND f.seq < p.seq""")
oracle("write_page_data", ["n_pages", "fx_page_data"], """
SELECT id, page_id, data_type_code, CAST(strlen(content) AS BIGINT) AS n_bytes, md5(content) AS data_md5 FROM fx_page_data""")
oracle("write_images", ["fx_images"], """
SELECT row_number() OVER (ORDER BY md5(k)) AS id, page_id, filename, content_type, n_bytes FROM (
  SELECT page_id || ':' || pos AS k, page_id, CASE WHEN pos = 1 THEN '' ELSE regexp_extract(src, '[^/]*$') END AS filename,
    CASE pos WHEN 0 THEN '.png' ELSE '.gif' END AS content_type, CASE WHEN pos = 1 THEN CAST(strlen(src) AS BIGINT) END AS n_bytes
  FROM fx_images WHERE pos IN (0, 1)) t""")
_FIRST_LINKS = """
SELECT f.{id} AS from_page, t.{id} AS to_page FROM {rows} t JOIN {rows} f ON f.url = t.parent_url WHERE f.seq < t.seq"""
oracle("write_links", [*_ROWS, "page_ids"], _FIRST_LINKS.format(id="id", rows="page_ids"))
oracle("first_parent_links", _ROWS, _FIRST_LINKS.format(id="seq", rows="page_rows"))
oracle("frontier_save_load", _CLINKS, """
SELECT host, url, parent_url, seq, CAST(row_number() OVER (PARTITION BY host ORDER BY seq) AS BIGINT) AS position
FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq) AS k FROM c_links) t WHERE k = 1""")
oracle("bootstrap_source", ["fx_sites", *_LINKS], f"""
SELECT parent_url, url, 'frontier' AS start FROM fx_links UNION ALL SELECT parent_url, url, 'seeds' FROM ({_SEEDS}) s""")

oracle("filter_include_hosts", ["fx_sites", "fx_host_lists", *_LINKS], """
SELECT seq, url, host FROM fx_links WHERE host IN (SELECT domain FROM fx_host_lists WHERE include)""")
oracle("filter_exclude_hosts", ["fx_sites", "fx_host_lists", *_LINKS], """
SELECT seq, url, host FROM fx_links WHERE host NOT IN (SELECT domain FROM fx_host_lists WHERE exclude)""")
oracle("filter_registered_domain", ["labels_of", "reg"], """
SELECT p.page_id, p.url FROM pages p JOIN reg USING (page_id)
WHERE (domain, suffix) IN (('example', 'com'), ('ththen', 'net'), ('example', 'org'))""")
oracle("filter_nonweb_links", ["fx_hrefs"], r"""
SELECT page_id, pos, href FROM fx_hrefs WHERE NOT regexp_matches(href, 'mailto:|callto:|sms:|tel:')""")
oracle("filter_empty_refs", ["fx_hrefs", "fx_images"], """
SELECT * FROM (SELECT page_id, pos, href AS ref, 'href' AS kind FROM fx_hrefs UNION ALL SELECT page_id, pos, src, 'src' FROM fx_images) t
WHERE ref <> ''""")
_TYPED = ["n_pages", "fx_fetches", "typed", "routed"]
oracle("route_fetches", _TYPED, "SELECT seq, url, extension, data_type_code, route FROM routed")
oracle("filter_image_types", ["fx_images"], """
SELECT page_id, pos, src, CASE pos WHEN 0 THEN '.png' WHEN 1 THEN '.gif' ELSE '.jpeg' END AS extension FROM fx_images WHERE pos < 3""")
oracle("filter_image_sources", ["fx_images"], """
SELECT page_id, pos, src FROM fx_images WHERE src LIKE 'data:%' OR NOT regexp_matches(src, '^https?://([^/]*\\.)?cms\\.[a-z]+(/|$)')""".replace("\\\\", "\\"))
_MATCHED = [*_RB, "page_domains", "matched"]
oracle("robots_allowed", _MATCHED, "SELECT page_id, url, domain FROM matched WHERE allowed")
oracle("robots_match", _MATCHED, "SELECT * FROM matched")
oracle("ready_hosts", _MOMENT, "SELECT host, last_fetch_us, limit_us, queued FROM fx_ready")
oracle("filter_duplicates", _ROWS, "SELECT seq, url, page_type_code FROM page_rows WHERE page_type_code = 'DUPLICATE'")
oracle("sites_with_sitemap", ["fx_sites"], "SELECT id, domain, sitemap_content FROM fx_sites WHERE sitemap_content <> ''")
oracle("default_status", ["n_pages", "fx_fetches"], "SELECT seq, coalesce(status, 204) AS status FROM fx_fetches")

oracle("dedup_by_url", _CLINKS, """
SELECT seq, parent_url, url, host FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq) AS k FROM c_links) t WHERE k = 1""")
_BY_CONTENT = """
SELECT seq, url, CASE WHEN k = 1 THEN 'HTML' ELSE 'DUPLICATE' END AS page_type_code,
  CASE WHEN k = 1 THEN CAST(strlen(html) AS BIGINT) END AS html_bytes, CASE WHEN k = 1 THEN md5(html) END AS html_md5,
  CASE WHEN k = 1 THEN CAST(128 AS BIGINT) END AS hash_chars
FROM (SELECT *, row_number() OVER (PARTITION BY html ORDER BY accessed_s, seq) AS k FROM fx_fetches) t"""
oracle("dedup_by_content", ["n_pages", "fx_fetches"], _BY_CONTENT)
oracle("dedup_documents_by_content", [], """
SELECT doc_id, CASE WHEN k = 1 THEN 'HTML' ELSE 'DUPLICATE' END AS page_type_code, CASE WHEN k = 1 THEN md5(text) END AS text_md5
FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents) t""")
oracle("content_duplicate_groups", [], """
SELECT min(doc_id) AS first, count(*) AS n_rows, CAST(strlen(text) AS BIGINT) AS n_bytes FROM documents GROUP BY text HAVING count(*) > 1""")

oracle("links_not_stored", [*_CLINKS, "fx_stored", "c_stored"], "SELECT seq, url FROM c_links WHERE url NOT IN (SELECT url FROM c_stored)")
oracle("links_not_seen", [*_CLINKS, "fx_seen", "c_seen"], "SELECT seq, url FROM c_links WHERE url NOT IN (SELECT url FROM c_seen)")
oracle("attach_site", ["n_pages", "fx_fetches", "fx_sites", "fx_stored_sites"], """
SELECT f.seq, f.url, f.domain, s.id AS site_id FROM fx_fetches f JOIN (
  SELECT domain, id FROM fx_stored_sites UNION ALL
  SELECT domain, (SELECT max(id) FROM fx_stored_sites) + row_number() OVER (ORDER BY md5(domain))
  FROM (SELECT DISTINCT domain FROM fx_fetches WHERE domain NOT IN (SELECT domain FROM fx_stored_sites)) t) s USING (domain)""")
oracle("new_links_only", ["n_pages", "fx_edges"], """
SELECT src AS from_page, dst AS to_page FROM fx_edges e WHERE pos = 1
  AND NOT EXISTS (SELECT 1 FROM fx_edges s WHERE s.pos = 0 AND s.src = e.src AND s.dst = e.dst)""")
oracle("missing_seed_sites", ["fx_sites", "fx_stored_sites", "fx_host_lists"], """
SELECT domain FROM fx_host_lists WHERE domain NOT IN (SELECT domain FROM fx_stored_sites)""")
oracle("full_links", [*_CLINKS, "fx_stored", "c_stored"], """
SELECT DISTINCT f.id AS from_page, t.id AS to_page FROM c_links l JOIN c_stored f ON f.url = l.parent_url JOIN c_stored t ON t.url = l.url""")
oracle("fk_violations", [*_ROWS, "fx_stored", "fx_images", "fx_edges", "fx_link_table", "fx_page_data", "fx_sites", "fx_stored_sites"], """
SELECT constraint_name, key, count(*) AS n_rows FROM (
  SELECT 'fk_image_page_data' AS constraint_name, CAST(page_id AS VARCHAR) AS key FROM fx_images WHERE page_id NOT IN (SELECT id FROM fx_stored)
  UNION ALL SELECT 'fk_link_page', CAST(from_page AS VARCHAR) FROM fx_link_table WHERE from_page NOT IN (SELECT id FROM fx_stored)
  UNION ALL SELECT 'fk_link_page_1', CAST(to_page AS VARCHAR) FROM fx_link_table WHERE to_page NOT IN (SELECT id FROM fx_stored)
  UNION ALL SELECT 'fk_page_site', CAST(s.id AS VARCHAR) FROM page_rows r JOIN fx_sites s USING (domain) WHERE s.id NOT IN (SELECT id FROM fx_stored_sites)
  UNION ALL SELECT 'fk_page_page_type', page_type_code FROM page_rows WHERE page_type_code NOT IN ('HTML', 'BINARY', 'DUPLICATE', 'FRONTIER')
  UNION ALL SELECT 'fk_page_data_page', CAST(page_id AS VARCHAR) FROM fx_page_data WHERE page_id NOT IN (SELECT id FROM fx_stored)
  UNION ALL SELECT 'fk_page_data_data_type', data_type_code FROM fx_page_data WHERE data_type_code NOT IN ('PDF', 'DOC', 'DOCX', 'PPT', 'PPTX')
) v GROUP BY 1, 2""")
recursive_oracle("resolve_host_redirects", ["fx_sites", "fx_redirects"], """
, walk(domain, place, tries, visited) AS (
  SELECT domain, domain, 1, [domain] FROM fx_redirects
  UNION ALL
  SELECT w.domain, r.location, w.tries + 1, list_append(w.visited, r.location)
  FROM walk w JOIN fx_redirects r ON r.domain = w.place
  WHERE w.tries < 3 AND r.robots_content = '' AND r.status BETWEEN 300 AND 399 AND r.location IS NOT NULL AND NOT list_contains(w.visited, r.location))
SELECT w.domain, w.place AS final_domain, w.tries, r.robots_content
FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY tries DESC) AS k FROM walk) w JOIN fx_redirects r ON r.domain = w.place WHERE k = 1""")

oracle("count_sites", ["fx_sites"], "SELECT count(*) AS n_sites FROM fx_sites")
oracle("count_pages", [], "SELECT count(*) AS n_pages FROM pages")
oracle("count_duplicates", _ROWS, "SELECT count(*) AS n_duplicates FROM page_rows WHERE page_type_code = 'DUPLICATE'")
oracle("pages_by_type", _ROWS, "SELECT page_type_code, count(*) AS n_rows FROM page_rows GROUP BY 1")
oracle("page_type_share", _ROWS, """
SELECT page_type_code, count(*) AS n_rows, round_even(CAST(100 AS DOUBLE) * count(*) / sum(count(*)) OVER (), 1) AS share FROM page_rows GROUP BY 1""")
oracle("pages_per_site", ["page_domains"], "SELECT domain, count(*) AS n_pages FROM page_domains GROUP BY 1")
_AVG = "SELECT round_even(CAST(count(*) AS DOUBLE) / count(DISTINCT {key}), 1) AS {name} FROM {rows}"
oracle("avg_pages_per_site", ["page_domains"], _AVG.format(key="domain", name="avg_pages", rows="page_domains"))
oracle("count_images", ["fx_images"], "SELECT count(*) AS n_images FROM fx_images")
oracle("images_per_page", ["fx_images"], "SELECT page_id, count(*) AS n_images FROM fx_images GROUP BY 1")
oracle("avg_images_per_page", ["fx_images"], _AVG.format(key="page_id", name="avg_images", rows="fx_images"))
oracle("documents_by_type", ["n_pages", "fx_page_data"], """
SELECT data_type_code, count(*) AS n_rows, round_even(CAST(100 AS DOUBLE) * count(*) / sum(count(*)) OVER (), 1) AS share FROM fx_page_data GROUP BY 1""")
oracle("documents_per_page", ["n_pages", "fx_page_data"], "SELECT page_id, count(*) AS n_documents FROM fx_page_data GROUP BY 1")
oracle("avg_documents_per_page", ["n_pages", "fx_page_data"], _AVG.format(key="page_id", name="avg_documents", rows="fx_page_data"))
oracle("crawl_summary", [*_ROWS, "fx_sites", "fx_stored_sites", "page_sites", "fx_images", "fx_page_data"], """
SELECT 'sites' AS metric, CAST(count(*) AS DOUBLE) AS value FROM page_sites
UNION ALL SELECT 'pages', count(*) FROM page_rows
UNION ALL SELECT 'duplicates', count(*) FROM page_rows WHERE page_type_code = 'DUPLICATE'
UNION ALL SELECT 'avg_pages_per_site', round_even(CAST(count(*) AS DOUBLE) / count(DISTINCT domain), 1) FROM page_rows
UNION ALL SELECT 'images', count(*) FROM fx_images
UNION ALL SELECT 'avg_images_per_page', round_even(CAST(count(*) AS DOUBLE) / count(DISTINCT page_id), 1) FROM fx_images
UNION ALL SELECT 'documents', count(*) FROM fx_page_data
UNION ALL SELECT 'avg_documents_per_page', round_even(CAST(count(*) AS DOUBLE) / count(DISTINCT page_id), 1) FROM fx_page_data""")
oracle("unique_violations", [*_LINKS, "fx_sites", "canon", "fx_page_data", "fx_images"], """
SELECT 'pk_frontier_url' AS constraint_name, url AS key, count(*) AS n_rows FROM fx_links GROUP BY url HAVING count(*) > 1
UNION ALL SELECT 'unq_domain_idx', domain, count(*) FROM fx_sites GROUP BY domain HAVING count(*) > 1
UNION ALL SELECT 'pk_site_id', CAST(id AS VARCHAR), count(*) FROM fx_sites GROUP BY id HAVING count(*) > 1
UNION ALL SELECT 'unq_url_idx', canonical, count(*) FROM pages JOIN canon ON raw = url GROUP BY canonical HAVING count(*) > 1
UNION ALL SELECT 'pk_page_id', CAST(page_id AS VARCHAR), count(*) FROM pages GROUP BY page_id HAVING count(*) > 1
UNION ALL SELECT 'pk_page_data_id', CAST(id AS VARCHAR), count(*) FROM fx_page_data GROUP BY id HAVING count(*) > 1
UNION ALL SELECT 'pk_image_id', CAST(pos AS VARCHAR), count(*) FROM fx_images GROUP BY pos HAVING count(*) > 1
UNION ALL SELECT 'pk_link', concat(src, ',', dst), count(*) FROM fx_edges GROUP BY src, dst HAVING count(*) > 1""")
oracle("frontier_queue_lengths", _LINKS, "SELECT host, count(*) AS queued FROM fx_links GROUP BY host")
oracle("concat_sitemaps", ["fx_sites"], """
SELECT domain, '<urlset>' || substr(domain, 8) || '</urlset>' || sitemap_content || '<url>' || id || '</url>' AS sitemap_content FROM fx_sites""")
_TABLE = ["n_pages", "fx_edges", "fx_link_table"]
for _name in ("graph_nodes", "ordered_nodes"):
    oracle(_name, _TABLE, "SELECT DISTINCT from_page FROM fx_link_table ORDER BY 1")

oracle("frontier_positions", _LINKS, """
SELECT host, seq, url, CAST(row_number() OVER (PARTITION BY host ORDER BY seq) AS BIGINT) AS position FROM fx_links""")
oracle("frontier_heads", _LINKS, """
SELECT host, seq, parent_url, url FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY seq) AS k FROM fx_links) t WHERE k = 1""")
oracle("first_parent", _CLINKS, """
SELECT url, parent_url, seq FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY seq) AS k FROM c_links) t WHERE k = 1""")
oracle("first_visit", _CLINKS, "SELECT seq, url, row_number() OVER (PARTITION BY url ORDER BY seq) = 1 AS is_first FROM c_links")
oracle("politeness_slots", _SLOTS, "SELECT host, seq, slot_us FROM fx_slots")
oracle("stream_politeness", _SLOTS, "SELECT host, seq, slot_us FROM fx_slots")
oracle("politeness_slots_first_waits", _SLOTS, """
SELECT host, seq, greatest(slot_us, n * limit_us + min(arrival_us) OVER (PARTITION BY host)) AS slot_us FROM fx_slots""")
oracle("politeness_slots_few_hosts", ["fx_requests"], """
SELECT host, seq, n * limit_us + max(arrival_us - n * limit_us) OVER (PARTITION BY host ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS slot_us
FROM (SELECT seq, host % 3 AS host, arrival_us, host % 3 * 60000000 AS limit_us, row_number() OVER (PARTITION BY host % 3 ORDER BY arrival_us, seq) AS n FROM fx_requests) t""")
oracle("assign_ids", ["page_domains"], """
SELECT row_number() OVER (ORDER BY md5(domain)) AS id, domain FROM (SELECT DISTINCT domain FROM page_domains) t""")
oracle("fetch_batch", _MOMENT, """
SELECT r.host, min(q.seq) AS seq, r.host_seq FROM fx_ready r JOIN fx_queue q USING (host) GROUP BY r.host, r.host_seq ORDER BY r.host_seq LIMIT 8""")

oracle("lookup_first", ["page_domains"], """
SELECT page_id, url, domain FROM page_domains WHERE domain = (SELECT domain FROM page_domains WHERE page_id = 0) ORDER BY page_id LIMIT 1""")
oracle("distinct_frontier", _CLINKS, "SELECT DISTINCT host, parent_url, url FROM c_links")

oracle("canonicalize_url", ["canon", "page_domains", "fx_hrefs", "resolved", "shaped"], r"""
SELECT page_id, -1 AS pos, canonical FROM pages JOIN canon ON raw = url
UNION ALL
SELECT page_id, pos, CASE WHEN pos IN (12, 13) THEN own WHEN fixed IS NOT NULL THEN fixed
  WHEN pos IN (1, 3, 7) THEN 'http://' || href ELSE 'http://' || substr(on_host, length(domain) + 1) END FROM shaped""")
oracle("resolve_link", ["page_domains", "fx_hrefs", "resolved", "shaped"], r"""
SELECT page_id, pos, CASE WHEN pos IN (12, 13) THEN own ELSE coalesce(fixed, on_host) END AS resolved FROM shaped""")
oracle("url_domain", ["page_domains"], "SELECT * FROM page_domains")
oracle("url_parts", [], r"""
SELECT page_id, regexp_extract(url, '^[a-z]+') AS scheme, regexp_extract(url, '//([^/?#]*)', 1) AS netloc,
  regexp_extract(url, '//[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '\?([^#]*)', 1) AS query, regexp_extract(url, '#(.*)', 1) AS fragment
FROM pages""")
oracle("url_basename", [], "SELECT page_id, regexp_extract(url, '[^/]*$') AS basename FROM pages")
oracle("registered_domain", ["labels_of", "reg"], "SELECT page_id, host, subdomain, domain, suffix FROM reg")
oracle("store_batch_images", ["canon"], """
SELECT url, filename, content_type, md5(data) AS data_md5, accessed_s, CAST(NULL AS BIGINT) AS n_rows FROM (
  SELECT v.canonical AS url, unnest(CASE v.page_id % 3
    WHEN 0 THEN [struct_pack(filename := v.page_id || '.png', content_type := '.png', data := 'image ' || v.page_id, accessed_s := 1800000000 + v.page_id, ok := v.page_id % 2 = 0),
      struct_pack(filename := '', content_type := '.gif', data := 'data:image/gif;base64,R0', accessed_s := 1704067200 + 60 * v.page_id, ok := true)]
    WHEN 2 THEN [struct_pack(filename := 'q.gif', content_type := '.gif', data := regexp_extract(v.canonical, '^http://[^/?#]*'), accessed_s := CAST(1900000000 AS BIGINT), ok := NOT regexp_matches(v.canonical, '^http://[^/?#]*net([/?#]|$)'))]
    ELSE [] END, recursive := true)
  FROM (SELECT p.page_id, c.canonical, row_number() OVER (PARTITION BY c.canonical ORDER BY p.page_id) AS k FROM pages p JOIN canon c ON c.raw = p.url) v WHERE k = 1) t
WHERE ok""")
oracle("canonicalize_url_hosts", [], """
SELECT page_id, 'https://' || host || '/p' || page_id || '#x' AS url, 'http://' || encoded || '/p' || page_id AS canonical
FROM pages JOIN (VALUES (0, 'münchen.de', 'xn--mnchen-3ya.de'), (1, 'BÜCHER.example:8080', 'xn--bcher-kva.example:8080'), (2, '日本語.jp', 'xn--wgv71a119e.jp'),
  (3, 'правда.рф', 'xn--80aafi6cg.xn--p1ai'), (4, 'faß.de', 'fass.de'), (5, 'čaj.gov.si', 'xn--aj-dma.gov.si'), (6, '例え。テスト', 'xn--r8jz45g.xn--zckzah')) v(k, host, encoded)
  ON page_id % 7 = k""")
oracle("content_hash_groups", [], """
SELECT min(doc_id) AS first, count(*) AS n_rows, CAST(128 AS BIGINT) AS hash_chars FROM documents WHERE text IS NOT NULL GROUP BY text""")
oracle("registered_domain_listed", ["rules", "listed"], "SELECT * FROM listed")
oracle("filter_registered_domain_listed", ["rules", "listed"], """
SELECT page_id, 'https://' || host || '/x' AS url FROM listed
WHERE (domain, suffix) IN (('example', 'com'), ('w8', 'io'), ('b8', 'com.au'), ('www', 'ck'), ('city', 'kawasaki.jp'))""")
oracle("extract_links", ["fx_html", "h_clean", "h_links"], "SELECT page_id, pos, href FROM h_links")
oracle("extract_images", ["fx_html", "h_clean", "h_images"], "SELECT page_id, pos, src FROM h_images")
oracle("mime_extension", ["n_pages", "fx_fetches", "typed"], """
SELECT seq, CASE WHEN content_type IS NOT NULL THEN extension END AS extension FROM typed""")
oracle("url_extension_fallback", [], r"""
SELECT page_id, suffix, CASE WHEN suffix = '' THEN '.html' ELSE '.' || regexp_extract(suffix, '[a-z]+$') END AS extension
FROM pages, (VALUES (''), ('pdf'), ('.ppt'), ('pptx'), ('.doc'), ('x.docx')) s(suffix)""")
oracle("extension_datatype", _TYPED, "SELECT seq, extension, data_type_code FROM routed")
oracle("robots_rules", _RB, "SELECT domain, rule_seq, allow, path FROM rb_rules")
oracle("robots_limits", [*_RB, "rb_limits"], "SELECT * FROM rb_limits")
oracle("robots_sitemaps", ["fx_sites"], """
SELECT domain, 0 AS pos, regexp_extract(robots_content, 'Sitemap: (.*)', 1) AS sitemap FROM fx_sites WHERE contains(robots_content, 'Sitemap: ')""")
oracle("sitemap_locations", ["fx_sites"], """
SELECT domain, k AS pos, domain || '/sm/' || (k + 1) AS url FROM fx_sites, (VALUES (0), (1)) ks(k) WHERE sitemap_content <> ''""")
oracle("robots_normalized", [*_RB], """
SELECT s.domain, coalesce(string_agg(b.block, chr(10) || chr(10) ORDER BY b.star, b.g), '') AS robots
FROM fx_sites s LEFT JOIN (
  SELECT domain, g, star, string_agg(text, chr(10) ORDER BY part, pos) AS block FROM (
    SELECT r.domain, r.g, q.star, r.pos,
      CASE r.k WHEN 'user-agent' THEN 0 WHEN 'crawl-delay' THEN 1 WHEN 'request-rate' THEN 2 ELSE 3 END AS part,
      CASE WHEN r.k = 'user-agent' THEN 'User-agent: ' || v WHEN r.k = 'crawl-delay' THEN 'Crawl-delay: ' || v
        WHEN r.k = 'request-rate' THEN 'Request-rate: ' || v WHEN r.k = 'allow' OR v = '' THEN 'Allow: ' || v ELSE 'Disallow: ' || v END AS text
    FROM rb_grouped r JOIN rb_groups q USING (domain, g)
    WHERE r.k <> 'empty' AND NOT (r.k = 'crawl-delay' AND NOT regexp_full_match(v, '[0-9]+'))) t
  GROUP BY domain, g, star) b USING (domain)
GROUP BY s.domain""")
oracle("content_bytes", [], "SELECT doc_id, CAST(strlen(text) AS BIGINT) AS n_bytes, md5(text) AS data_md5 FROM documents")

_FRESH = ["fx_html", "h_clean", "h_links", "canon", "new_links", "fx_sites", "fx_host_lists", "fx_stored", "c_stored", "fx_seen", "c_seen", "fresh_links"]
for _name in ("expand_frontier", "stream_frontier_expand"):
    oracle(_name, _FRESH, "SELECT host, seq, pos, parent_url, url FROM fresh_links")

oracle("graph_edges", _TABLE, "SELECT from_page, to_page FROM fx_link_table")
oracle("graph_undirected", _TABLE, "SELECT DISTINCT least(from_page, to_page) AS page_a, greatest(from_page, to_page) AS page_b FROM fx_link_table")
oracle("graph_all_nodes", _TABLE, "SELECT from_page AS page FROM fx_link_table UNION SELECT to_page FROM fx_link_table")
recursive_oracle("crawl_bfs", [*_MATCHED, "fx_host_lists", "n_pages", "fx_edges"], """
, open_edges AS (SELECT DISTINCT src, dst FROM fx_edges WHERE dst IN (
    SELECT page_id FROM matched WHERE allowed AND domain NOT IN (SELECT domain FROM fx_host_lists WHERE exclude)))
, reached(page, depth) AS (
  SELECT page_id, 0 FROM pages WHERE url LIKE '%/'
  UNION
  SELECT e.dst, r.depth + 1 FROM reached r JOIN open_edges e ON e.src = r.page WHERE r.depth < 40)
, depths AS (SELECT page, min(depth) AS depth FROM reached GROUP BY page)
SELECT d.page, CASE WHEN d.depth > 0 THEN min(p.page) END AS parent, d.depth
FROM depths d LEFT JOIN (SELECT x.page, x.depth, e.dst FROM depths x JOIN open_edges e ON e.src = x.page) p
  ON p.dst = d.page AND p.depth = d.depth - 1
GROUP BY d.page, d.depth""")

oracle("stream_dedup_urls", _CLINKS, "SELECT DISTINCT url FROM c_links")
oracle("stream_dedup_content", ["n_pages", "fx_fetches"], _BY_CONTENT)
oracle("stream_route_results", _TYPED, "SELECT route, seq, url, data_type_code FROM routed WHERE route <> 'skip'")
