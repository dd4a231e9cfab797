"""The catalogue's queries as plain SQL, for the side-by-side check.

Answers are worked out from the tables without any of the package's code:
pages by regular expressions, rendered pages from the rows they come from.
"""

from __future__ import annotations

_ENTITIES = "replace(replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')"
_SPACES = r"[\s\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{0085}\x{000b}\x1c-\x1f]+"


def _text(expr: str) -> str:
    return _ENTITIES.format(expr)


def _clean(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '{_SPACES}', ' ', 'g'))"


def _tags(name: str) -> str:
    return f"len(regexp_extract_all(html, '<{name}[ >]'))"


# Links of the test pages in order: page_id, pos, href, label.
_LINKS = f"""
  SELECT page_id, unnest(range(len(hrefs)))::INT AS pos, unnest(hrefs) AS href, unnest(labels) AS raw_label
  FROM (SELECT page_id,
               regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs,
               regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS labels FROM pages)"""
_LINK_ROWS = f"""
  SELECT page_id, pos, 'https://site.example.com' || {_text('href')} AS url, {_clean(_text('raw_label'))} AS label
  FROM ({_LINKS})"""

_HOST = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"
_BLOCKED = "(contains(url, '#') OR regexp_matches(lower(url), '/es/1|#top|\\?print'))"
_SITE = f"(contains({_HOST}, 'example') AND NOT {_BLOCKED})"
_CAMPAIGN = f"({_SITE} AND regexp_matches(lower(url), '/en/|/de/'))"
_PRODUCT = f"({_SITE} AND regexp_matches(lower(url), '/fr/|/en/1'))"
_LISTING = f"({_SITE} AND NOT {_PRODUCT} AND regexp_matches(lower(url), '/de/|/es/|\\?page='))"
_SHOP_PARTS = (
    "/myaccount|/my-orders|/communications|/my-notifications|/profile|/login|/logout|/register|/help|/faq"
    "|/contact|/legal|/privacy|/cookies|/terms|/wishlist|/cart|/basket|/checkout|/search|/brands|/invite"
    "|/storelocator|/member|/club"
)

_PATH = "regexp_extract(url, '^https?://[^/]+(/[^#]*)', 1)"

_CENTS = "round(p_retailprice * 100)::BIGINT"


def _money(cents: str, point: str = ".") -> str:
    return f"(({cents}) // 100)::VARCHAR || '{point}' || lpad((({cents}) % 100)::VARCHAR, 2, '0')"


_LINES = """
  SELECT *, CASE source WHEN 'json' THEN 60 WHEN 'meta' THEN 45 WHEN 'local_node' THEN 35
                        WHEN 'local_text' THEN 20 ELSE 0 END AS bonus
  FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               CASE WHEN l_returnflag <> 'R' THEN floor(l_extendedprice * 10) / 100 END AS o,
               floor(l_extendedprice * (1 - l_discount) * 10) / 100 AS c,
               CASE WHEN l_linestatus = 'F' THEN (l_quantity % 12)::INT END AS pct,
               (['json', 'meta', 'local_node', 'local_text', 'page', 'other', 'json'])[l_linenumber] AS source
        FROM lineitem)"""


def _score(o: str, c: str) -> str:
    gap = f"abs(round_even((1 - {c} / {o}) * 100, 0)::INT - pct)"
    return f"""(bonus + CASE WHEN {c} BETWEEN 1 AND 5000 THEN 10 ELSE 0 END
      + CASE WHEN {o} IS NULL THEN 0 WHEN {o} >= {c} THEN 10 ELSE -25 END
      + CASE WHEN {o} IS NULL OR {o} <= {c} THEN 0 WHEN ({o} - {c}) / {o} BETWEEN 0.01 AND 0.95 THEN 15 ELSE -10 END
      + CASE WHEN {o} IS NULL OR pct IS NULL THEN 0 WHEN {gap} = 0 THEN 40 WHEN {gap} <= 2 THEN 25
             WHEN {gap} <= 5 THEN 10 ELSE -30 END)"""


def _price_value(raw: str) -> str:
    """Price text to number, as an independent chain of cases."""
    tight = (
        f"regexp_replace(regexp_replace(trim(regexp_replace(replace({raw}, '€', ''), '\\s+', ' ', 'g')),"
        f" ' ?, ?', ',', 'g'), ' ?\\. ?', '.', 'g')"
    )
    return f"""(SELECT CASE WHEN v > 0 AND v <= 10000 THEN round(v, 2) END FROM (
      SELECT try_cast(CASE WHEN len(n) - len(replace(n, '.', '')) > 1
                 THEN replace(regexp_extract(n, '^(.*)\\.[^.]*$', 1), '.', '') || '.' || regexp_extract(n, '([^.]*)$', 1)
                 ELSE n END AS DOUBLE) AS v
      FROM (SELECT regexp_replace(CASE
                WHEN regexp_full_match(s, '\\d{{1,4}} \\d{{2}}') THEN replace(s, ' ', '.')
                WHEN contains(s, ',') AND contains(s, '.') THEN
                  CASE WHEN regexp_matches(s, ',[^.]*$') THEN replace(replace(s, '.', ''), ',', '.')
                       ELSE replace(s, ',', '') END
                ELSE replace(s, ',', '.') END, '[^0-9.-]', '', 'g') AS n
            FROM (SELECT {tight} AS s))))"""


_PRICE_FORMS = f"""
  SELECT p_partkey, unnest(range(8))::INT AS form, unnest([
    big || ',' || rest || ' €', whole || ' ' || rest, replace(big, '.', ',') || ' . ' || rest,
    '€ ' || whole || ' , ' || rest, '-' || whole, whole || '-' || rest, '9' || whole || '0.00', p_name]) AS raw
  FROM (SELECT *, regexp_replace(whole, '(\\d)(\\d{{3}})$', '\\1.\\2') AS big
        FROM (SELECT p_partkey, p_name, ({_CENTS} // 100)::VARCHAR AS whole,
                     lpad(({_CENTS} % 100)::VARCHAR, 2, '0') AS rest FROM part))"""

# Price of one text hit of the documents: digits, gap, digits.
_DOC_HIT = "round(try_cast(regexp_replace(regexp_replace(h, '\\s*[.,]\\s*', '.'), '\\s', '.') AS DOUBLE), 2)"
_DOC_PRICES = f"""
  SELECT doc_id, list_filter(list_transform(hits, lambda h: {_DOC_HIT}), lambda v: v > 0 AND v <= 10000) AS vals
  FROM (SELECT doc_id, list_concat(
      regexp_extract_all(text, '€\\s*(\\d{{1,4}}\\s*[.,]\\s*\\d{{2}})', 1),
      regexp_extract_all(text, '€\\s*(\\d{{1,4}}\\s\\d{{2}})', 1),
      regexp_extract_all(text, '(\\d{{1,4}}\\s*[.,]\\s*\\d{{2}})\\s*€', 1),
      regexp_extract_all(text, '(\\d{{1,4}}\\s\\d{{2}})\\s*€', 1),
      regexp_extract_all(text, '\\b(\\d{{1,4}}\\s*[.,]\\s*\\d{{2}})\\b', 1),
      regexp_extract_all(text, '\\b(\\d{{1,4}}\\s\\d{{2}})\\b', 1)) AS hits FROM documents)"""

# Product pages: what the page of a part must yield.
_S = "(10 + p_size % 30)"
_NOW = f"({_CENTS} * 7) // 10"
_DETAIL = f"""
  SELECT p_partkey,
    'https://shop.example.com/p/' || p_partkey AS product_url,
    p_name || CASE WHEN p_partkey % 6 = 2 THEN ' - gris' ELSE '' END AS product_name,
    CASE WHEN p_partkey % 2 = 0 THEN 'About ' || p_name ELSE 'Fine ' || p_name || ' made for every day'
      || CASE WHEN p_partkey % 4 = 3 THEN ', whatever the weather may be' ELSE '' END END AS description,
    CASE WHEN p_partkey % 4 IN (0, 2) THEN {_money(_CENTS)} ELSE '' END AS original_price,
    {_money(_NOW)} AS discount_price,
    CASE WHEN p_partkey % 4 IN (0, 2) THEN '-30%' ELSE '' END AS discount_percentage,
    (['rojo | azul', 'verde', 'gris', 'negro', 'blanco', 'lila'])[p_partkey % 6 + 1] AS color,
    CASE WHEN p_partkey % 2 = 0 THEN 'https://img.example.com/' || p_partkey || '.jpg'
         ELSE '/img/' || p_partkey || '.jpg' END AS image_url,
    CASE WHEN p_partkey % 4 = 1 THEN '38:OK, 39:OK, 40:OK, 41:OK, 42:OK, 43:OK'
         WHEN p_partkey % 4 = 0 THEN {_S} || ':OK, ' || ({_S} + 2) || ':OUT, ' || ({_S} + 4) || ':ALMOST'
         WHEN p_partkey % 4 = 2 THEN 'M:OUT, XL:OK' ELSE '38:OK, M:OUT' END AS sizes_status
  FROM part"""

_SHOP = "https://shop.example.com"
_STEPS = """
  SELECT * FROM (VALUES (0, 'Todo', '', 0, 4), (1, 'Moda', '/a', 3, 14), (2, 'Casa', '/b', 10, 29)) t(page, label, tail, low, high)"""
_STUBS = f"""
  SELECT s_suppkey, page, label, tail, i - low AS pos, s_suppkey * 20 + i AS part_key
  FROM supplier, ({_STEPS}), unnest(range(30)) r(i) WHERE i BETWEEN low AND high"""
# The listings of a campaign's plan: its own page, and the two others twice.
_PLANNED = f"""
  SELECT s.* FROM ({_STUBS}) s UNION ALL SELECT s.* FROM ({_STUBS}) s WHERE tail <> ''"""
_RUN_TS = "2024-05-01 12:00:00"


_PRODUCTS = f"""
  SELECT d.p_partkey::VARCHAR AS product_id, d.product_url, s_suppkey::VARCHAR AS campaign_id,
         '{_SHOP}/catalog/' || s_suppkey AS campaign_url, label AS subcategory, d.product_name,
         d.original_price, d.discount_price, d.discount_percentage, d.color, d.sizes_status, d.image_url,
         '{_RUN_TS}' AS extraction_timestamp
  FROM (SELECT s_suppkey, part_key, arg_min(label, (page, pos)) AS label FROM ({_STUBS})
        GROUP BY s_suppkey, part_key) s
  JOIN ({_DETAIL}) d ON d.p_partkey = s.part_key"""


# Queries that call from SQL what another query calls as columns: same rows.
_SAME_ROWS = {
    "sql_resolved": "resolved_urls", "sql_links": "links", "sql_prices": "doc_prices",
    "sql_sizes": "part_sizes", "sql_colors": "part_colors",
}


def all_oracles() -> dict[str, str]:
    found = _own_oracles()
    return found | {name: found[other] for name, other in _SAME_ROWS.items()}


def _own_oracles() -> dict[str, str]:
    return {
        "page_source": "SELECT page_id, url, length(html)::INT AS html_chars FROM pages",
        "stored_keys": "SELECT DISTINCT o_custkey FROM orders",
        "conformed_products": f"""
            SELECT p_partkey::VARCHAR AS product_id, '' AS product_url, '' AS campaign_id, '' AS campaign_url,
                   '' AS subcategory, p_name AS product_name, printf('%.2f', p_retailprice) AS original_price,
                   '' AS discount_price, '' AS discount_percentage,
                   CASE WHEN p_type = 'ECONOMY' THEN '' ELSE p_type END AS color, '' AS sizes_status,
                   '' AS image_url, '{_RUN_TS}' AS extraction_timestamp FROM part""",
        "streamed_links": f"""
            SELECT url, page_id, pos, label FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id, pos) AS rn
            FROM ({_LINK_ROWS})) WHERE rn = 1""",
        "node_counts": f"""
            SELECT page_id, {_tags('a')} AS n_a, {_tags('li')} AS n_li, {_tags('h1')} AS n_h1, {_tags('p')} AS n_p,
                   {_tags('br')} AS n_br, {_tags('script')} AS n_script FROM pages""",
        "node_texts": f"""
            SELECT page_id, string_agg({_clean(_text('raw_label'))}, ' ' ORDER BY pos) AS nav_text
            FROM ({_LINKS}) GROUP BY page_id""",
        "node_attributes": """
            SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang, '' AS dir FROM pages""",
        "selector_counts": """
            SELECT page_id, len(regexp_extract_all(html, '<meta charset='))::INT AS with_charset,
                   len(regexp_extract_all(html, 'class="ad"'))::INT AS class_ad,
                   len(regexp_extract_all(html, 'class="[^"]*a[^"]*"'))::INT AS class_part,
                   len(regexp_extract_all(html, '<a href="[^"]*th[^"]*"'))::INT AS href_th,
                   len(regexp_extract_all(html, '<html lang="en"'))::INT AS english FROM pages""",
        "nav_links": """
            SELECT page_id, len(regexp_extract_all(html, '<a href='))::INT AS nav_links,
                   len(regexp_extract_all(regexp_extract(html, '(?s)<article>.*</article>'), '<li'))::INT AS article_items
            FROM pages""",
        "nav_link_nodes": """
            SELECT page_id, len(regexp_extract_all(html, '<a href='))::INT AS nav_links,
                   len(regexp_extract_all(regexp_extract(html, '(?s)<article>.*</article>'), '<li'))::INT AS article_items
            FROM pages""",
        "ranked_matches": """
            SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY sel_rank, k) - 1)::INT AS pos,
                   sel_rank, tag
            FROM (SELECT page_id, 0 AS sel_rank, 'div' AS tag, unnest(range(len(regexp_extract_all(html, '<div class="ad"')))) AS k FROM pages
                  UNION ALL SELECT page_id, 1, 'h1', unnest(range(len(regexp_extract_all(html, '<h1')))) FROM pages
                  UNION ALL SELECT page_id, 2, 'a', unnest(range(len(regexp_extract_all(html, '<a href')))) FROM pages
                  UNION ALL SELECT page_id, 3, 'div', unnest(range(len(regexp_extract_all(html, '<div>')))) FROM pages
                  UNION ALL SELECT page_id, 4, 'footer', unnest(range(len(regexp_extract_all(html, '<footer')))) FROM pages)""",
        "card_anchors": f"""
            SELECT page_id, unnest(range(len(h)))::INT AS pos, {_text('unnest(h)')} AS href
            FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS h FROM pages)""",
        "links": f"SELECT * FROM ({_LINK_ROWS})",
        "resolved_urls": f"""
            SELECT page_id, unnest(range(10))::INT AS form, unnest([
              regexp_replace(url, '#$', ''), 'https://site.example.com' || p, 'https://cdn.example.com' || p,
              'https://site.example.com' || p, 'https://site.example.com?id=' || page_id,
              'https://site.example.com#top', '', 'https://site.example.com/a' || p, 'mailto:x@example.com',
              'https://site.example.com/x' || p]) AS url
            FROM (SELECT page_id, url, {_PATH} AS p FROM pages)""",
        "url_kinds": f"""
            SELECT page_id, contains({_HOST}, 'example.com') AS on_site, {_CAMPAIGN} AS campaign,
                   {_LISTING} AS listing, {_PRODUCT} AS product,
                   array_to_string(list_filter([CASE WHEN {_CAMPAIGN} THEN 'campaign' END,
                     CASE WHEN {_LISTING} THEN 'listing' END, CASE WHEN {_PRODUCT} THEN 'product' END],
                     lambda k: k IS NOT NULL), ',') AS kinds FROM pages""",
        "blocked_urls": f"""
            SELECT page_id, contains(url, '#') OR regexp_matches(lower(url), '{_SHOP_PARTS}') AS blocked,
                   true AS blocked_help FROM pages""",
        "url_ids": r"""
            SELECT page_id,
              coalesce(nullif(regexp_extract(url, '/(\d+)/?$', 1), ''),
                       regexp_extract(regexp_extract(url, '^https?://[^/?#]*/([^?#]*)', 1), '([^/]*)$', 1)) AS id,
              coalesce(nullif(regexp_extract(seg, '-(\d+)$', 1), ''), seg) AS segment_id
            FROM (SELECT *, 'item-' || regexp_extract(url, '/(en|de|fr|es)/([^/?#]+)', 2) AS seg FROM pages)""",
        "url_forms": f"""
            SELECT page_id, page_id % 2 = 0 AS http, rtrim(url, '/') AS same_as, {_HOST} AS host FROM pages""",
        "sql_urls": f"""
            SELECT page_id, {_CAMPAIGN} AS campaign, {_LISTING} AS listing, {_PRODUCT} AS product,
                   coalesce(nullif(regexp_extract(url, '/(\\d+)/?$', 1), ''),
                       regexp_extract(regexp_extract(url, '^https?://[^/?#]*/([^?#]*)', 1), '([^/]*)$', 1)) AS id,
                   {_HOST} AS host FROM pages""",
        "sql_texts": """
            SELECT p_partkey, p_name AS clean, len(string_split(p_name, ' '))::INT AS words,
                   CASE WHEN p_partkey % 130 BETWEEN 1 AND 95 THEN '-' || (p_partkey % 130) || '%'
                     WHEN p_partkey % 130 > 99 THEN '-15%' ELSE '' END AS label,
                   CASE WHEN p_size BETWEEN 0 AND 9999 THEN p_size + 0.5::DOUBLE END AS price FROM part""",
        "clean_documents": f"SELECT doc_id, {_clean('text')} AS clean FROM documents",
        "word_counts": """
            SELECT p_partkey, len(string_split(p_name, ' '))::INT AS words,
                   len(string_split(p_name || ' ' || p_type || ' ' || p_brand, ' ')) <= 3 AS few FROM part""",
        "end_dates": """
            SELECT p_partkey, CASE WHEN p_partkey % 6 > 3 THEN 'hasta ' || p_name
              ELSE (['acaba en', 'termina en', 'finaliza en', 'hasta'])[p_partkey % 6 + 1]
                   || ' el ' || p_size END AS end_date FROM part""",
        "discount_texts": """
            SELECT p_partkey, CASE WHEN p_partkey % 130 BETWEEN 1 AND 95 THEN '-' || (p_partkey % 130) || '%'
              WHEN p_partkey % 130 > 99 THEN '-15%' ELSE '' END AS label FROM part""",
        "float_texts": """
            SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN p_size::DOUBLE END AS number FROM part""",
        "discount_labels": """
            SELECT l_orderkey, l_linenumber, l_partkey, printf('%.2f', l_extendedprice) AS original_price,
                   CASE WHEN pct BETWEEN 1 AND 95 THEN '-' || pct || '%' ELSE '' END AS discount_percentage
            FROM (SELECT *, round_even((1 - l_extendedprice * (1 - l_discount) / l_extendedprice) * 100, 0)::INT AS pct
                  FROM lineitem)""",
        "normalized_prices": f"SELECT p_partkey, form, {_price_value('raw')} AS price FROM ({_PRICE_FORMS})",
        "doc_prices": f"""
            SELECT doc_id, len(vals)::INT AS n_prices,
                   coalesce(array_to_string(list_transform(vals, lambda v: printf('%.2f', v)), ' '), '') AS prices,
                   CASE WHEN len(vals) >= 2 THEN list_max(vals) END AS original, list_min(vals) AS current
            FROM (SELECT doc_id, list_filter(vals, lambda v, i: list_position(vals, v) = i) AS vals FROM ({_DOC_PRICES}))""",
        "price_scores": f"""
            SELECT l_orderkey, l_linenumber, l_partkey, bonus, {_score('o', 'c')}::INT AS score FROM ({_LINES})""",
        "best_pairs": f"""
            SELECT l_orderkey, o AS original, c AS current, score FROM (
              SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY score DESC, l_linenumber, l_partkey, l_suppkey) AS rn
              FROM (SELECT *, {_score('o', 'c')}::INT AS score
                    FROM (SELECT * REPLACE (CASE WHEN o IS NOT NULL THEN greatest(o, c) END AS o, least(o, c) AS c)
                          FROM ({_LINES}) WHERE c > 0 AND c <= 10000))) WHERE rn = 1""",
        "part_sizes": """
            SELECT p_partkey, array_to_string(list_filter(
                CASE WHEN p_partkey % 3 = 0 THEN ['XL', 'M', n] ELSE [n, '40'] END,
                lambda v, i: v IS NOT NULL AND list_position(CASE WHEN p_partkey % 3 = 0 THEN ['XL', 'M', n] ELSE [n, '40'] END, v) = i), ' ') AS sizes
            FROM (SELECT p_partkey, CASE WHEN p_size BETWEEN 10 AND 52 THEN p_size::VARCHAR END AS n FROM part)""",
        "stock_states": """
            SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 AND p_partkey % 2 = 1 THEN 'OUT'
              ELSE (['OK', 'OUT', 'LAST', 'ALMOST', 'OK', 'OUT', 'ALMOST'])[p_partkey % 7 + 1] END AS status FROM part""",
        "part_colors": """
            SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN '' ELSE string_split(p_name, ' ')[-1] END AS color,
                   false AS bad_brand, true AS bad_size FROM part""",
        "color_phrases": "SELECT p_partkey, p_name AS color, '' AS none FROM part",
        "size_status": """
            SELECT p_brand, p_size, (['OK', 'ALMOST', 'LAST', 'OUT'])[max(p_partkey % 4) + 1] AS status
            FROM part GROUP BY p_brand, p_size""",
        "size_texts": """
            SELECT p_partkey, p_size || ':LAST, ' || (p_size + 60) || ':OUT, M:OK, XL:OK' AS sizes FROM part""",
        "shortest_names": """
            SELECT p_brand, p_name FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY length(p_name), p_name) AS rn
            FROM part) WHERE rn = 1""",
        "json_walk": """
            SELECT event_id, 0 AS obj, 0 AS pos, 'id' AS key, event_id::VARCHAR AS value FROM events
            UNION ALL SELECT event_id, 1, 0, 'k', json_extract_string(props, '$.k') FROM events""",
        "first_link_per_url": f"""
            SELECT url, page_id, pos, label FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id, pos) AS rn
            FROM ({_LINK_ROWS})) WHERE rn = 1""",
        "first_link_labels": f"""
            SELECT url, arg_min(label, (page_id, pos)) AS label FROM ({_LINK_ROWS}) GROUP BY url""",
        "link_counts": f"""
            SELECT host, count(DISTINCT (page_id, link)) AS total_products_count, count(DISTINCT link) AS unique_products_count
            FROM (SELECT l.page_id, l.url AS link, {_HOST.replace('url', 'p.url')} AS host
                  FROM ({_LINK_ROWS}) l JOIN pages p USING (page_id)) GROUP BY host""",
        "page_labels": f"""
            SELECT page_id, string_agg(label, ', ' ORDER BY pos) FILTER (label <> '') AS labels
            FROM ({_LINK_ROWS}) GROUP BY page_id""",
        "listing_plans": f"""
            WITH links AS ({_LINK_ROWS}),
            own AS (SELECT p.page_id, CASE WHEN p.page_id % 2 = 0 THEN 'https://site.example.com/p' || p.page_id
                      ELSE coalesce((SELECT l.url || '/' FROM links l WHERE l.page_id = p.page_id AND l.pos = 1),
                                    'https://site.example.com') END AS url FROM pages p),
            kept AS (SELECT * FROM links WHERE pos < 4),
            main AS (SELECT o.page_id, -1 AS pos, o.url, 'principal' AS label FROM own o
                     WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.page_id = o.page_id AND rtrim(k.url, '/') = rtrim(o.url, '/')))
            SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1)::INT AS pos, url, label
            FROM (SELECT * FROM kept UNION ALL SELECT * FROM main)""",
        "unseen_orders": """
            SELECT o_orderkey, o_custkey FROM orders o ANTI JOIN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') d
            USING (o_custkey)""",
        "order_frontier": """
            SELECT o_orderkey, o_orderpriority FROM (SELECT * FROM orders WHERE o_orderstatus <> 'F'
              ORDER BY o_orderdate, o_orderkey LIMIT 50) WHERE NOT starts_with(o_orderpriority, '5')""",
        "every_order": "SELECT o_orderkey FROM orders",
        "orders_with_customers": """
            SELECT o_orderkey, o_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey""",
        "limit_per_parent": """
            SELECT o_custkey, o_orderkey, rn::INT AS position FROM (SELECT *, row_number() OVER
              (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn <= 3""",
        "event_positions": """
            SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS position
            FROM events""",
        "run_counters": """
            SELECT count(*) AS found, count(*) FILTER (o_orderstatus = 'F') AS skipped,
                   count(*) FILTER (o_orderstatus <> 'F') AS "new" FROM orders""",
        "appended_orders": """
            SELECT o_orderkey, 0 AS src FROM orders WHERE o_orderstatus = 'O'
            UNION ALL SELECT o_orderkey, 1 FROM orders WHERE o_totalprice > 200000""",
        "page_names": f"""
            SELECT page_id, {_clean(_text("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"))} AS name FROM pages""",
        "shop_details": f"SELECT * EXCLUDE (p_partkey) FROM ({_DETAIL})",
        "shop_campaigns": f"""
            SELECT s_suppkey * 4 AS page_id, 0 AS pos, 'Marca ' || s_suppkey AS name,
                   '{_SHOP}/catalog/' || s_suppkey AS url, 'acaba en ' || (s_suppkey % 9 + 1) || ' días' AS end_date FROM supplier
            UNION ALL SELECT s_suppkey * 4, 1, 'Campanya #' || s_suppkey, '{_SHOP}/catalog/' || s_suppkey || '/solo', ''
            FROM supplier""",
        "shop_subpages": f"""
            SELECT '{_SHOP}/catalog/' || s_suppkey AS campaign_url, pos, '{_SHOP}/catalog/' || s_suppkey || tail AS url, label
            FROM supplier, (VALUES (0, '', 'Todo'), (1, '/a', 'Moda'), (2, '/b', 'Casa'), (3, '/a', 'Moda'), (4, '/b', 'Casa'))
            t(pos, tail, label)""",
        "shop_listings": f"""
            SELECT '{_SHOP}/catalog/' || s_suppkey || tail AS url, pos::INT AS pos, '{_SHOP}/p/' || part_key AS product_url,
                   'Item ' || part_key AS product_name FROM ({_STUBS})""",
        "crawl_campaigns": f"""
            SELECT s_suppkey::VARCHAR AS campaign_id, '{_SHOP}/catalog/' || s_suppkey AS campaign_url,
                   69::BIGINT AS total_products_count, 30::BIGINT AS unique_products_count,
                   'Marca ' || s_suppkey AS brand_name, 'Todo, Moda, Casa, Moda, Casa' AS subcategories,
                   'acaba en ' || (s_suppkey % 9 + 1) || ' días' AS end_date_text, '{_RUN_TS}' AS extraction_timestamp
            FROM supplier""",
        "crawl_counts_resumed": f"""
            SELECT s_suppkey::VARCHAR AS campaign_id, '{_SHOP}/catalog/' || s_suppkey AS campaign_url,
                   count(*) AS total_products_count, count(DISTINCT part_key) AS unique_products_count,
                   'Marca ' || s_suppkey AS brand_name, 'Todo, Moda, Casa, Moda, Casa' AS subcategories,
                   'acaba en ' || (s_suppkey % 9 + 1) || ' días' AS end_date_text, '{_RUN_TS}' AS extraction_timestamp
            FROM ({_PLANNED}) WHERE NOT (tail = '/b' AND s_suppkey % 10 = 0) GROUP BY s_suppkey""",
        "crawl_counters": f"""
            WITH n AS (
              SELECT count(*) AS n, count(*) FILTER (s_suppkey % 2 = 0) AS later, count(*) FILTER (s_suppkey % 10 = 0) AS never FROM supplier
            )
            SELECT run, counter, value::BIGINT AS value FROM n, unnest([
              {{'run': 1, 'counter': 'found', 'value': 2 * n}}, {{'run': 1, 'counter': 'skipped', 'value': 0}},
              {{'run': 1, 'counter': 'new', 'value': 2 * n}}, {{'run': 1, 'counter': 'campaigns', 'value': n}},
              {{'run': 1, 'counter': 'corrected', 'value': 0}}, {{'run': 1, 'counter': 'open_listings', 'value': 2 * later}},
              {{'run': 2, 'counter': 'found', 'value': 2 * n}}, {{'run': 2, 'counter': 'skipped', 'value': n}},
              {{'run': 2, 'counter': 'new', 'value': n}}, {{'run': 2, 'counter': 'campaigns', 'value': 0}},
              {{'run': 2, 'counter': 'corrected', 'value': later - never}}, {{'run': 2, 'counter': 'open_listings', 'value': 2 * never}}
            ]) AS t(u), LATERAL (SELECT u.run AS run, u.counter AS counter, u.value AS value)""",
        "crawl_visited": f"SELECT '{_SHOP}/catalog/' || s_suppkey AS campaign_url FROM supplier",
        "pages_by_url": f"""
            SELECT p_partkey AS page_id, product_url AS url, product_name AS name FROM ({_DETAIL})
            WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 45)""",
        "crawl_products": _PRODUCTS,
        "crawl_resume": _PRODUCTS,
        "crawl_pending": f"""
            SELECT '{_SHOP}/catalog/' || s_suppkey AS campaign_url, min(page)::INT AS page_pos,
                   arg_min(pos, page)::INT AS pos, '{_SHOP}/p/' || part_key AS product_url,
                   'Item ' || part_key AS product_name, arg_min(label, page) AS subcategory
            FROM ({_STUBS}) WHERE NOT (page = 2 AND s_suppkey % 2 = 0)
              AND (part_key % 3 = 0 OR part_key NOT IN (SELECT p_partkey FROM part))
            GROUP BY s_suppkey, part_key""",
    }
