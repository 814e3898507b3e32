"""Expected results as SQL over the supplied tables.

Nothing here reads markup or JSON of the sample shop: the expected products follow from ``part`` by the
arithmetic that defines the shop's irregularities.
"""

from __future__ import annotations

from ..operators.classify import QUESTION
from ..operators.classify import SNIPPET_CHARS as CLASSIFY_CHARS
from ..operators.detail import REQUEST
from ..samples.catalog import BASE, IMAGES


def _decoded(text: str) -> str:
    """The only references in the supplied titles; both also count without their semicolon."""
    return f"""regexp_replace(regexp_replace({text}, '&quot;?', '"', 'g'), '&amp;?', '&', 'g')"""


_CTES = f"""
p AS (
  SELECT p_partkey AS k, p_name AS nm, p_brand AS br, lower(p_type) AS t, p_retailprice AS pr,
         p_partkey // 300 AS g, p_partkey // 6000 AS d, p_partkey // 30000 AS c,
         '{BASE}/catalog/' || lower(p_type) || '-' || (p_partkey // 30000) AS slug,
         (p_partkey % 7) NOT IN (5, 6) AS has_offer, '{IMAGES}/' || p_partkey AS img
  FROM part),
t0 AS (
  SELECT *,
    CASE WHEN k % 27 = 3 THEN 'Z' WHEN k % 36 = 4 THEN NULL WHEN k % 45 = 5 THEN '&amp;'
         WHEN k % 9 = 1 THEN nm || ' &amp; Co &copy2 ' || k
         WHEN k % 9 = 2 THEN nm || chr(160) || chr(12288) || ' ' || k ELSE nm || ' ' || k END AS raw_name,
    CASE WHEN k % 27 = 3 THEN 'Z' WHEN k % 36 = 4 THEN NULL WHEN k % 45 = 5 THEN '&'
         WHEN k % 9 = 1 THEN nm || ' & Co ' || chr(169) || '2 ' || k ELSE nm || ' ' || k END AS name,
    CASE k % 5 WHEN 1 THEN ' ab-' || k || ' ' WHEN 2 THEN k::VARCHAR WHEN 3 THEN '' WHEN 4 THEN 'SKU' || k END AS raw_sku,
    CASE k % 5 WHEN 1 THEN 'AB-' || k WHEN 2 THEN k::VARCHAR WHEN 3 THEN '' WHEN 4 THEN 'SKU' || k END AS sku,
    CASE WHEN k % 6 IN (0, 1) THEN br WHEN k % 6 = 5 THEN ' ' || br || ' &amp; Sons ' END AS raw_brand,
    CASE WHEN k % 6 IN (0, 1) THEN br WHEN k % 6 = 5 THEN br || ' & Sons' END AS brand,
    CASE WHEN NOT has_offer THEN NULL WHEN k % 8 = 3 AND k % 3 = 0 THEN 1000.5::DOUBLE WHEN k % 8 IN (3, 7) THEN NULL
         WHEN k % 8 = 4 THEN -5::DOUBLE WHEN k % 8 = 5 THEN 50000::DOUBLE WHEN k % 8 = 6 THEN 50000.01::DOUBLE
         ELSE pr END AS raw_price,
    CASE WHEN has_offer AND k % 3 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
    CASE WHEN has_offer THEN CASE k % 10 WHEN 0 THEN 'InStock' WHEN 1 THEN 'OutOfStock' WHEN 2 THEN 'PreOrder'
      WHEN 3 THEN 'BackOrder' WHEN 4 THEN ' in stock ' WHEN 7 THEN '' WHEN 8 THEN 'Currently Out of Stock'
      WHEN 9 THEN 'LimitedAvailability ' END END AS raw_avail,
    CASE WHEN has_offer THEN CASE k % 10 WHEN 0 THEN 'In Stock' WHEN 1 THEN 'Out of Stock' WHEN 2 THEN 'Pre-Order'
      WHEN 3 THEN 'BackOrder' WHEN 4 THEN 'In Stock' WHEN 7 THEN '' WHEN 8 THEN 'Out of Stock'
      WHEN 9 THEN 'LimitedAvailability ' END END AS avail,
    CASE (k // 2) % 5 WHEN 0 THEN img || '.jpg' WHEN 1 THEN img || '.jpg|' || img || '.jpg|' || img || '-b.jpg'
      WHEN 3 THEN img || '.jpg' WHEN 4 THEN img || '-o.jpg|' || img || '.jpg' ELSE '' END AS raw_images,
    CASE (k // 2) % 5 WHEN 0 THEN img || '.jpg' WHEN 1 THEN img || '.jpg|' || img || '-b.jpg'
      WHEN 3 THEN img || '.jpg' WHEN 4 THEN img || '-o.jpg|' || img || '.jpg' ELSE '' END AS images,
    CASE (k // 3) % 6 WHEN 0 THEN 4.5::DOUBLE WHEN 1 THEN 4.2::DOUBLE WHEN 2 THEN 3.9::DOUBLE END AS rating,
    CASE (k // 3) % 6 WHEN 0 THEN 12::BIGINT WHEN 1 THEN 0::BIGINT END AS review_count,
    CASE WHEN k % 16 = 0 THEN 'Desc &lt;' || k || '&gt; for' || chr(10) || '  ' || k END AS raw_desc,
    CASE WHEN k % 16 = 0 THEN 'Desc <' || k || '> for ' || k END AS descr,
    CASE WHEN k % 13 = 0 THEN NULL WHEN k % 17 = 0 THEN '{BASE}/product/' || (k - 1) ELSE '{BASE}/product/' || k END AS address
  FROM p),
truth AS (
  SELECT *, CASE WHEN raw_price < 0 OR raw_price > 50000 THEN NULL ELSE raw_price END AS price FROM t0),
placed AS (
  SELECT *, 0 AS kind, g AS idx, CASE WHEN g % 3 = 2 THEN k % 2 ELSE 0 END AS s, slug || '/rack-' || g AS page_url,
         CASE WHEN g % 7 = 3 THEN 503 ELSE 200 END AS status FROM truth
  UNION ALL BY NAME
  SELECT *, 1 AS kind, d AS idx, 0 AS s, slug || '/deals-' || d AS page_url, 200 AS status FROM truth WHERE k % 20 = 0
  UNION ALL BY NAME
  SELECT *, 2 AS kind, 0 AS idx, 0 AS s, slug AS page_url, 200 AS status FROM truth WHERE t = 'promo' AND k % 25 = 0),
cats AS (
  SELECT DISTINCT t, c, slug, t || '-' || c AS cname, slug || CASE WHEN t = 'large' THEN '/' ELSE '' END AS url,
    (c * 6 + list_position(['economy', 'large', 'medium', 'promo', 'small', 'standard'], t) - 1)::BIGINT AS seed_ord
  FROM p),
nav AS (SELECT DISTINCT t, c, kind, idx, page_url FROM placed WHERE kind < 2),
subs AS (
  SELECT seed_ord, cname, t, kind, idx, page_url AS url,
    CASE WHEN kind = 1 THEN 'Deals ' || idx WHEN t = 'standard' OR idx % 4 = 3 THEN 'Rack ' || idx ELSE 'Rack&' || idx END AS name,
    CASE WHEN t = 'standard' THEN 'jsonld' ELSE 'html' END AS found_by
  FROM cats JOIN nav USING (t, c) WHERE t NOT IN ('promo', 'medium')
  UNION ALL
  SELECT seed_ord, cname, t, 3, 0, slug || '/rack-0?sort=asc', 'Sorted', 'html' FROM cats
  WHERE t NOT IN ('promo', 'medium', 'standard')),
front AS (
  SELECT seed_ord, kind, idx, url, cname || ' > ' || name AS category_path, false AS is_category FROM subs
  UNION ALL
  SELECT seed_ord, 2, 0, url, cname, true FROM cats WHERE t IN ('promo', 'medium')),
reach AS (
  SELECT placed.*, front.category_path, front.seed_ord FROM placed JOIN front ON front.url = placed.page_url
  WHERE placed.status = 200),
raw AS (SELECT * FROM reach WHERE raw_name IS NOT NULL),
tagged AS (
  SELECT *, CASE WHEN length(raw_name) < 2 THEN 'short_name' WHEN address IS NULL THEN 'no_url' END AS drop_reason,
         md5(address || '|' || coalesce(sku, '')) AS fp FROM raw),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY fp ORDER BY seed_ord, kind, idx, s, k) AS rn FROM tagged
  WHERE drop_reason IS NULL),
prod AS (SELECT * FROM ranked WHERE rn = 1),
named_pages AS (SELECT DISTINCT page_url FROM raw),
wanted AS (
  SELECT address AS url, category_path, seed_ord, kind, idx, s, k FROM reach
  WHERE address IS NOT NULL AND page_url IN (SELECT page_url FROM named_pages)
  UNION ALL
  SELECT DISTINCT '{BASE}/info/' || g, category_path, seed_ord, kind, idx, 0, 0 FROM reach
  WHERE kind = 0 AND page_url IN (SELECT page_url FROM named_pages)),
dfront AS (
  SELECT url, category_path FROM (
    SELECT *, row_number() OVER (PARTITION BY url ORDER BY seed_ord, kind, idx, s, k) AS rn FROM wanted) WHERE rn = 1),
visits AS (
  SELECT '{BASE}/product/' || k AS url FROM p WHERE k % 3 = 0),
det AS (
  SELECT k, nm, '{BASE}/product/' || k AS url,
    CASE k % 4 WHEN 0 THEN 'jsonld' WHEN 3 THEN 'none' ELSE 'html' END AS via,
    CASE k % 4 WHEN 0 THEN 'Detail ' || nm WHEN 1 THEN 'Og & ' || nm || ' ' || k WHEN 2 THEN nm || chr(10) || ' ' || k END AS name,
    CASE k % 4 WHEN 0 THEN 'd' || k WHEN 1 THEN 'ZX' || k END AS sku,
    CASE k % 4 WHEN 0 THEN k::DOUBLE WHEN 1 THEN ('1' || k || '.5')::DOUBLE END AS price,
    CASE WHEN k % 4 = 0 THEN 'InStock' END AS avail,
    CASE WHEN k % 8 = 0 THEN 'About ' || k WHEN k % 4 = 1 THEN 'Meta ' || k END AS descr,
    CASE WHEN k % 4 = 1 THEN '{IMAGES}/og/' || k || '.png?a=1&b=2' ELSE '' END AS images
  FROM p WHERE k % 11 <> 5),
drec AS (SELECT det.*, dfront.category_path FROM dfront JOIN det USING (url) WHERE det.name IS NOT NULL),
first_addr AS (
  SELECT address, fp, descr FROM (
    SELECT *, row_number() OVER (PARTITION BY address ORDER BY seed_ord, kind, idx, s, k) AS pos FROM prod) WHERE pos = 1),
patch AS (
  SELECT f.fp, r.descr FROM drec r JOIN first_addr f ON f.address = r.url
  WHERE r.descr IS NOT NULL AND f.descr IS NULL),
added AS (SELECT * FROM drec WHERE url NOT IN (SELECT address FROM first_addr)),
shop AS (
  SELECT url, CASE WHEN t = 'medium' THEN 404 ELSE 200 END AS status, 'category' AS page_type,
         CASE WHEN t IN ('standard', 'promo') THEN 'listing' ELSE 'unknown' END AS by_html FROM cats
  UNION ALL
  SELECT DISTINCT page_url, status, 'listing', 'listing' FROM placed WHERE kind < 2
  UNION ALL
  SELECT '{BASE}/product/' || k, CASE WHEN k % 11 = 5 THEN 404 ELSE 200 END, 'product',
         CASE WHEN k % 4 = 0 THEN 'product' ELSE 'unknown' END FROM p),
racks AS (
  SELECT page_url, g, count(*) FILTER (s = 0) AS ones, count(*) FILTER (s = 1) AS twos FROM placed WHERE kind = 0 GROUP BY ALL),
blocks AS (
  SELECT page_url, 1 AS script_pos, 0 AS block_pos, 'WebSite' AS block_type, 0 AS elements FROM racks
  UNION ALL SELECT page_url, CASE WHEN g % 2 = 1 THEN 1 ELSE 2 END, g % 2, 'ItemList', ones + 1 FROM racks
  UNION ALL SELECT page_url, CASE WHEN g % 2 = 1 THEN 2 ELSE 3 END, 0, 'ItemList', twos FROM racks WHERE g % 3 = 2
  UNION ALL SELECT page_url, 1, 0, 'ItemList', count(*) FROM placed WHERE kind = 1 GROUP BY page_url
  UNION ALL SELECT url, 0, 0, 'ItemList', (SELECT count(*) FROM nav n WHERE n.t = cats.t AND n.c = cats.c) FROM cats WHERE t = 'standard'
  UNION ALL SELECT url, 0, 1, 'ItemList', 1 FROM cats WHERE t = 'standard'
  UNION ALL SELECT url, 0, 0, 'ItemList', (SELECT count(*) FROM placed q WHERE q.page_url = cats.url AND q.kind = 2) FROM cats WHERE t = 'promo'
  UNION ALL SELECT '{BASE}/product/' || k, 0, 0, 'Organization', 0 FROM p WHERE k % 4 = 0
  UNION ALL SELECT '{BASE}/product/' || k, 1, 0, 'Product', 0 FROM p WHERE k % 4 = 0),
web AS (
  SELECT page_id, url, html, coalesce(nullif(trim(split_part(
    {_decoded("regexp_extract(html, '<title>(.*?)</title>', 1)")}, '|', 1)), ''), NULL) AS title
  FROM pages)
"""

_PROD = """fp AS fingerprint, name AS product_name, brand, sku, category_path, address AS product_url, price, currency,
  avail AS availability, {descr} AS description, images, rating, review_count,
  NULL::VARCHAR AS unit_pack_size, '{{}}' AS specifications, '' AS alternatives"""
_DET = """{key}name AS product_name, NULL::VARCHAR AS brand, sku, {path} AS category_path, url AS product_url, price,
  'USD' AS currency, avail AS availability, descr AS description, images, NULL::DOUBLE AS rating,
  NULL::BIGINT AS review_count, NULL::VARCHAR AS unit_pack_size, '{{}}' AS specifications, '' AS alternatives"""
_KEY = "md5(url || '|' || coalesce(sku, '')) AS fingerprint, "
_PRODUCTS = f"SELECT {_PROD.format(descr='descr')} FROM prod"
_ADDED = f"SELECT {_DET.format(key=_KEY, path='category_path')} FROM added"
_IMAGE_JSON = "CASE WHEN images = '' THEN '[]' ELSE '[\"' || replace(images, '|', '\",\"') || '\"]' END"
_STAMP = "2024-05-01T00:00:00.000000"
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _prompt(template: str, url: str, body: str) -> str:
    head, middle, tail = template.split("%s")
    return f"{_q(head)} || {url} || {_q(middle)} || {body} || {_q(tail)}"


def _json_field(name: str, value: str, quoted: bool = True) -> str:
    shown = f"'\"' || {value} || '\"'" if quoted else f"({value})::VARCHAR"
    return f"'\"{name}\":' || coalesce({shown}, 'null')"


_JSON_ROW = " || ',' || ".join(
    [
        _json_field("id", "id", False), _json_field("fingerprint", "fp"), _json_field("product_name", "name"),
        _json_field("brand", "brand"), _json_field("sku", "sku"), _json_field("category_path", "category_path"),
        _json_field("product_url", "address"), _json_field("price", "price", False), _json_field("currency", "currency"),
        _json_field("unit_pack_size", "NULL"), _json_field("availability", "avail"), _json_field("description", "descr"),
        "'\"specifications\":{}'", f"'\"image_urls\":' || {_IMAGE_JSON}", "'\"alternative_products\":[]'",
        _json_field("rating", "rating", False), _json_field("review_count", "review_count", False),
        _json_field("scraped_at", f"'{_STAMP}'"),
    ]
)
_NUMBERED = "(SELECT *, row_number() OVER (ORDER BY seed_ord, kind, idx, s, k) AS id FROM prod)"
_STATS = """(SELECT count(*) AS total, (SELECT count(*) FROM prod) AS valid,
  count(*) FILTER (drop_reason IS NULL) - (SELECT count(*) FROM prod) AS duplicates,
  count(*) FILTER (drop_reason IS NOT NULL) AS dropped FROM tagged)"""


def _coverage(field: str, filled: str) -> str:
    return (
        f"SELECT '{field}' AS field, count(*) FILTER ({filled}) AS filled, count(*) AS total, "
        f"coalesce(round(count(*) FILTER ({filled}) * 100.0::DOUBLE / nullif(count(*), 0), 2), 0.0)::DOUBLE AS pct FROM prod"
    )


_BODIES = {
    "page_snapshot": f"""SELECT url, status::BIGINT AS status, NULL::VARCHAR AS body_md5 FROM shop
        WHERE url IN (SELECT url FROM cats) OR url IN (SELECT address FROM truth WHERE address IS NOT NULL)
        UNION ALL SELECT url, 200, md5(min(html)) FROM pages GROUP BY url HAVING count(DISTINCT html) = 1""",
    "page_status_split": """SELECT url, status::BIGINT AS status, CASE WHEN status = 200 THEN 'read' ELSE 'skipped' END AS outcome
        FROM shop""",
    "seed_frontier": "SELECT seed_ord, url, cname AS category_name FROM cats WHERE seed_ord < 4",
    "insert_new_products": """SELECT fp AS fingerprint, name AS product_name,
        CASE WHEN fp IN (SELECT fp FROM ranked WHERE kind = 1) THEN 'stored' ELSE category_path END AS category_path
        FROM prod""",
    "unvisited_frontier": "SELECT url, category_path FROM dfront WHERE url NOT IN (SELECT url FROM visits)",
    "product_count": "SELECT count(*) AS products FROM prod",
    "products_ordered": f"SELECT id, fp AS fingerprint, name AS product_name FROM {_NUMBERED}",
    "export_json_rows": f"SELECT id, '{{' || {_JSON_ROW} || '}}' AS json FROM {_NUMBERED}",
    "export_csv_rows": f"""SELECT fp AS fingerprint, name AS product_name, coalesce(brand, '') AS brand, coalesce(sku, '') AS sku,
        category_path, address AS product_url, coalesce(price::VARCHAR, '') AS price, currency, '' AS unit_pack_size,
        coalesce(avail, '') AS availability, coalesce(descr, '') AS description, '{{}}' AS specifications,
        {_IMAGE_JSON} AS image_urls, '[]' AS alternative_products, coalesce(rating::VARCHAR, '') AS rating,
        coalesce(review_count::VARCHAR, '') AS review_count, '{_STAMP}' AS scraped_at FROM prod""",
    "incremental_rerun": """SELECT * FROM (
        WITH listed AS (SELECT fp, address, category_path FROM prod WHERE seed_ord < 2),
        reached AS (SELECT DISTINCT url FROM wanted WHERE seed_ord < 2),
        detailed AS (SELECT url, category_path, md5(url || '|' || coalesce(sku, '')) AS fp FROM drec),
        found AS (SELECT * FROM detailed WHERE url IN (SELECT url FROM reached) AND url NOT IN (SELECT address FROM listed)),
        later AS (SELECT fp, address, category_path FROM prod WHERE seed_ord >= 2 AND fp NOT IN (SELECT fp FROM found)),
        last AS (
          SELECT * FROM detailed WHERE url NOT IN (SELECT url FROM reached) AND url NOT IN (SELECT address FROM listed)
            AND url NOT IN (SELECT address FROM later))
        SELECT fp AS fingerprint, category_path, 0::BIGINT AS batch FROM listed
        UNION ALL SELECT fp, category_path, 0 FROM found
        UNION ALL SELECT fp, category_path, 1 FROM later
        UNION ALL SELECT fp, category_path, 1 FROM last)""",
    "page_links": f"""SELECT page_url, pos, href, text, '{BASE}' || rtrim(href, '/') AS link_url FROM (
        SELECT page_url, generate_subscripts(anchors, 1) - 1 AS pos, unnest(anchors) AS a,
          regexp_extract(a, 'href="([^"]*)"', 1) AS href,
          trim(regexp_replace(a, '<[^>]*>', '', 'g')) AS text
        FROM (SELECT url AS page_url, regexp_extract_all(regexp_replace(html, '<script>.*?</script>|<!--.*?-->', '', 'gs'),
          '(?s)<a .*?</a>') AS anchors FROM pages))""",
    "subcategories": "SELECT seed_ord, url, name, cname AS parent, 1::BIGINT AS depth FROM subs WHERE found_by = 'html'",
    "subcategories_jsonld": "SELECT seed_ord, url, name, cname AS parent, 1::BIGINT AS depth FROM subs WHERE found_by = 'jsonld'",
    "subcategories_all": "SELECT seed_ord, url, name, cname AS parent, 1::BIGINT AS depth, found_by FROM subs",
    "listing_frontier": "SELECT url, category_path, seed_ord, is_category FROM front",
    "product_frontier": "SELECT url, category_path FROM dfront",
    "pagination_urls": f"""SELECT page_url, url FROM (SELECT DISTINCT page_url FROM placed WHERE kind < 2), LATERAL (
        SELECT unnest([page_url || '?p=2', page_url || '?sp=9', page_url || '?dir=asc&p=3',
          'https://cdn.example.com/next?up=1', regexp_replace(page_url, '[^/]*$', '') || 'rack-x?p=4#top']) AS url)""",
    "classify_url": """SELECT url, page_type FROM shop UNION ALL SELECT url, 'unknown' FROM pages""",
    "classify_html": """SELECT url, by_html AS page_type FROM shop UNION ALL SELECT url, 'unknown' FROM pages""",
    "classify_page": """SELECT url, page_type, 'url' AS classified_by FROM shop
        UNION ALL SELECT url, 'unknown', 'none' FROM pages""",
    "classify_with_responses": """SELECT url, page_type, 'url' AS classified_by FROM shop
        UNION ALL SELECT url, CASE page_id % 5 WHEN 0 THEN 'category' WHEN 2 THEN 'product' ELSE 'unknown' END,
          CASE WHEN page_id % 5 IN (0, 2, 3) THEN 'model' ELSE 'none' END FROM pages""",
    "classify_requests": f"SELECT url, {_prompt(QUESTION, 'url', f'substring(html, 1, {CLASSIFY_CHARS})')} AS prompt FROM pages",
    "classify_audit": """SELECT url, page_type, 'url' AS classified_by, page_type = 'product' AS unexpected_type FROM shop
        WHERE status = 200 AND (page_type = 'product' OR url IN (SELECT url FROM front))""",
    "jsonld_blocks": "SELECT page_url, script_pos::BIGINT AS script_pos, block_pos::BIGINT AS block_pos, block_type FROM blocks WHERE block_type <> 'WebSite' OR block_pos = 0",
    "jsonld_itemlists": """SELECT page_url, script_pos::BIGINT AS script_pos, block_pos::BIGINT AS block_pos, elements::BIGINT AS elements
        FROM blocks WHERE block_type = 'ItemList'""",
    "listing_elements": f"""SELECT page_url, (row_number() OVER (PARTITION BY page_url, s ORDER BY k) - 1)::BIGINT AS elem_pos,
          address AS elem_url, 'Product' AS item_type FROM placed WHERE kind < 2
        UNION ALL SELECT page_url, ones::BIGINT, '{BASE}/info/' || g, 'Service' FROM racks""",
    "listing_products_raw": """SELECT page_url, raw_name AS product_name, raw_brand AS brand, raw_sku AS sku,
        coalesce(address, '') AS product_url, currency, raw_desc AS description FROM placed
        WHERE status = 200 AND raw_name IS NOT NULL""",
    "extract_listing": """SELECT page_url, raw_name AS product_name, raw_brand AS brand, raw_sku AS sku,
        coalesce(address, '') AS product_url, raw_price AS price, currency, raw_avail AS availability,
        raw_desc AS description, raw_images AS images, rating, review_count, NULL::VARCHAR AS unit_pack_size,
        '{}' AS specifications, '' AS alternatives FROM placed
        WHERE status = 200 AND raw_name IS NOT NULL""",
    "price_parse": """SELECT k, CASE k % 9 WHEN 0 THEN pr WHEN 1 THEN ('100' || k || '.5')::DOUBLE WHEN 4 THEN ('-0.' || k || 'e2')::DOUBLE
        WHEN 5 THEN k::DOUBLE WHEN 7 THEN 'Infinity'::DOUBLE END AS price FROM p""",
    "availability_norm": """SELECT raw_name AS product_name, coalesce(address, '') AS product_url, raw_avail AS raw_availability,
        avail AS availability FROM raw""",
    "image_clean": "SELECT raw_name AS product_name, coalesce(address, '') AS product_url, raw_images, images FROM raw",
    "rating_parse": "SELECT raw_name AS product_name, coalesce(address, '') AS product_url, rating, review_count FROM raw",
    "price_sanity": """SELECT raw_name AS product_name, coalesce(address, '') AS product_url, raw_price AS price, price AS sane
        FROM raw""",
    "fingerprint": """SELECT coalesce(address, '') AS product_url, sku,
        md5(coalesce(address, '') || '|' || coalesce(sku, '')) AS fingerprint FROM raw""",
    "detail_jsonld": f"SELECT {_DET.format(key='', path=_q(''))} FROM det WHERE via = 'jsonld'",
    "detail_html": f"""SELECT {_DET.format(key='', path=_q(''))} FROM (
        SELECT * REPLACE (CASE k % 4 WHEN 0 THEN 'Wrong' ELSE name END AS name, CASE WHEN k % 4 = 1 THEN sku END AS sku,
          CASE WHEN k % 4 = 1 THEN price END AS price, NULL AS avail, CASE WHEN k % 4 = 1 THEN descr END AS descr)
        FROM det WHERE via <> 'none')""",
    "detail_title": """SELECT url, CASE k % 4 WHEN 0 THEN 'Wrong' ELSE name END AS product_name FROM det
        UNION ALL SELECT url, title FROM web""",
    "detail_price": "SELECT url, CASE WHEN k % 4 = 1 THEN price END AS price FROM det",
    "detail_sku": "SELECT url, CASE WHEN k % 4 = 1 THEN sku END AS sku FROM det",
    "detail_meta": "SELECT url, CASE WHEN k % 4 = 1 THEN descr END AS description, images FROM det",
    "extract_detail": """SELECT url, via AS extracted_by, name AS product_name, sku, price, descr AS description,
          CASE WHEN via <> 'none' THEN 'USD' END AS currency FROM det
        UNION ALL SELECT url, 'html', title, NULL, NULL, NULL, 'USD' FROM web WHERE title IS NOT NULL
        UNION ALL SELECT url, 'none', NULL, NULL, NULL, NULL, NULL FROM web WHERE title IS NULL""",
    "extract_requests": "SELECT url, "
    + _prompt(REQUEST, "url", "'<html><body><p>Script only ' || k || '</p></body></html>'")
    + " AS prompt FROM det WHERE via = 'none'",
    "extract_from_responses": f"""SELECT 'Model ' || nm AS product_name, NULL::VARCHAR AS brand, 'm' || k AS sku, '' AS category_path,
        url AS product_url, (k || '.25')::DOUBLE AS price, 'USD' AS currency, 'InStock' AS availability, 'Seen ' || k AS description,
        '{IMAGES}/m/' || k || '.png' AS images, NULL::DOUBLE AS rating, NULL::BIGINT AS review_count,
        'Box of ' || k AS unit_pack_size, '{{"count":"3","size":"' || k || '"}}' AS specifications, '' AS alternatives
        FROM det WHERE k % 12 IN (3, 7)""",
    "validate_rejects": """SELECT page_url, raw_name AS product_name, coalesce(address, '') AS product_url, drop_reason
        FROM tagged WHERE drop_reason IS NOT NULL""",
    "clean_text": f"""SELECT 'doc ' || doc_id AS id, trim(regexp_replace(text, '{_SPACE}', ' ', 'g')) AS text FROM documents
        UNION ALL SELECT 'page ' || page_id, trim(regexp_replace({_decoded("regexp_extract(html, '<title>(.*?)</title>', 1)")},
          '{_SPACE}', ' ', 'g')) FROM pages""",
    "validate_products": _PRODUCTS,
    "listing_job": _PRODUCTS,
    "dedup_first": "SELECT fp AS fingerprint, raw_name AS product_name, page_url FROM prod",
    "validation_stats": f"SELECT * FROM {_STATS}",
    "validation_summary": f"""SELECT 'Validation: ' || total || ' total, ' || valid || ' valid, ' || duplicates || ' duplicates, '
        || dropped || ' dropped' AS summary FROM {_STATS}""",
    "category_report": """SELECT split_part(category_path, ' > ', 1) AS category, count(*) AS products,
        count(DISTINCT CASE WHEN contains(category_path, ' > ') THEN category_path END) AS subcategories FROM prod GROUP BY 1""",
    "field_coverage": " UNION ALL ".join(
        [
            _coverage("price", "price IS NOT NULL"), _coverage("image_urls", "images <> ''"),
            _coverage("sku", "sku <> ''"), _coverage("rating", "rating IS NOT NULL"), _coverage("description", "descr <> ''"),
        ]
    ),
    "merge_enrich": f"""SELECT {_PROD.format(descr='coalesce(patch.descr, prod.descr)')} FROM prod LEFT JOIN patch USING (fp)""",
    "merge_insert": _ADDED,
    "detail_job": """SELECT * FROM (
        WITH now AS (SELECT * FROM drec WHERE url NOT IN (SELECT url FROM visits))
        SELECT 'patch' AS action, f.fp AS key, NULL::VARCHAR AS product_name, r.descr AS description
        FROM now r JOIN first_addr f ON f.address = r.url WHERE r.descr IS NOT NULL AND f.descr IS NULL
        UNION ALL
        SELECT 'insert', md5(url || '|' || coalesce(sku, '')), name, descr FROM now WHERE url NOT IN (SELECT address FROM first_addr)
        UNION ALL
        SELECT 'mark', url, NULL, NULL FROM dfront JOIN det USING (url) WHERE url NOT IN (SELECT url FROM visits))""",
    "streaming_ingest": f"""SELECT {_PROD.format(descr='coalesce(patch.descr, prod.descr)')} FROM prod LEFT JOIN patch USING (fp)
        UNION ALL {_ADDED}""",
    "quarantine_replay": """SELECT * FROM (
        WITH late AS (
          SELECT placed.*, front.category_path, front.seed_ord, md5(address || '|' || coalesce(sku, '')) AS fp
          FROM placed JOIN front ON front.url = placed.page_url
          WHERE placed.status = 503 AND length(raw_name) >= 2 AND address IS NOT NULL),
        first AS (SELECT *, row_number() OVER (PARTITION BY fp ORDER BY seed_ord, kind, idx, s, k) AS rn FROM late)
        SELECT fp AS fingerprint, category_path, 0::BIGINT AS batch FROM prod
        UNION ALL SELECT fp, category_path, 1 FROM first WHERE rn = 1 AND fp NOT IN (SELECT fp FROM prod))""",
    "run_diff": f"""SELECT * FROM (
        WITH later AS (
          SELECT fp, price AS old, descr AS said, currency = 'EUR' AND rating IS NULL AS gone,
                 CASE review_count WHEN 12 THEN price * 1.6::DOUBLE WHEN 0 THEN price * 1.2::DOUBLE ELSE price END AS young,
                 CASE WHEN sku LIKE 'SKU%' AND descr IS NULL THEN 'now described' ELSE descr END AS says
          FROM prod),
        met AS (
          SELECT *, concat_ws(',', CASE WHEN old IS DISTINCT FROM young THEN 'price' END,
                              CASE WHEN said IS DISTINCT FROM says THEN 'description' END) AS fields FROM later)
        SELECT fp AS fingerprint, CASE WHEN gone THEN 'gone' ELSE 'changed' END AS change, CASE WHEN gone THEN '' ELSE fields END AS fields,
               old AS price_before, CASE WHEN NOT gone THEN young END AS price_after,
               coalesce(NOT gone AND abs(young - old) > abs(old) * 0.5::DOUBLE, false) AS price_jump
        FROM met WHERE gone OR fields <> ''
        UNION ALL
        SELECT md5(url || '|' || coalesce(sku, '')), 'new', '', NULL, price, false FROM added)""",
    "shape_drift": """SELECT * FROM (
        WITH items AS (SELECT * FROM placed WHERE kind < 2),
        moved(field, distance) AS (
          SELECT 'sku', (count(*) FILTER (k % 5 = 2))::DOUBLE / count(*) FROM items
          UNION ALL SELECT unnest(['description', 'about']), (SELECT (count(*) FILTER (k % 16 < 2))::DOUBLE / count(*) FROM items)
          UNION ALL SELECT unnest(['@type', 'name', 'brand', 'offers', 'image', 'aggregateRating']), 0::DOUBLE)
        SELECT field, round(distance, 9) AS distance, distance > 0.1 AS drifted FROM moved)""",
    "coverage_alert": " UNION ALL ".join(
        f"SELECT *, total > 0 AND pct < 90.0 AS alert FROM ({_coverage(field, filled)})"
        for field, filled in [
            ("price", "price IS NOT NULL"), ("image_urls", "images <> ''"), ("sku", "sku <> ''"), ("rating", "rating IS NOT NULL"),
            ("description", "descr <> ''"),
        ]
    ),
    "full_run": f"""SELECT {_PROD.format(descr='coalesce(patch.descr, prod.descr)')} FROM prod LEFT JOIN patch USING (fp)
        UNION ALL {_ADDED}""",
    "full_run_with_answers": f"""SELECT * FROM (
        WITH read AS (
          SELECT *, NULL::VARCHAR AS unit, '{{}}' AS specs FROM drec UNION ALL
          SELECT k, nm, url, 'model', 'Model ' || nm, 'm' || k, (k || '.25')::DOUBLE, 'InStock', 'Seen ' || k,
                 '{IMAGES}/m/' || k || '.png', dfront.category_path, 'Box of ' || k, '{{"count":"3","size":"' || k || '"}}'
          FROM dfront JOIN det USING (url) WHERE k % 12 IN (3, 7)),
        changed AS (
          SELECT f.fp, r.descr, r.specs FROM read r JOIN first_addr f ON f.address = r.url
          WHERE r.descr IS NOT NULL AND f.descr IS NULL),
        fresh AS (SELECT * FROM read WHERE url NOT IN (SELECT address FROM first_addr))
        SELECT {_PROD.format(descr='coalesce(changed.descr, prod.descr)').replace("'{}' AS", "coalesce(changed.specs, '{}') AS")} FROM prod LEFT JOIN changed USING (fp)
        UNION ALL SELECT {_DET.format(key=_KEY, path='category_path').replace("NULL::VARCHAR AS unit_pack_size, '{}' AS", "unit AS unit_pack_size, specs AS")} FROM fresh)""",
    "script_rejects": """SELECT DISTINCT page_url, 0::BIGINT AS script_pos, 'not JSON' AS reason FROM placed WHERE kind < 2""",
}


def oracle_sql() -> dict[str, str]:
    return {name: f"WITH {_CTES}\n{body}" for name, body in _BODIES.items()}
