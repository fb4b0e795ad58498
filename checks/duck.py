"""The mappings of ``inputs.py`` as SQL, put together into one WITH clause per query."""

from __future__ import annotations

_STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S')"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def _view(name: str, sql: str, *needs: str) -> None:
    VIEWS[name] = (needs, sql)


def stamp(column: str) -> str:
    return _STAMP.format(column)


_view(
    "raw_events",
    """
    SELECT CAST(user_id AS VARCHAR) AS domain_userid, ts AS collector_tstamp,
           '/article/' || CAST(100 + n AS VARCHAR) || '/slug-' || CAST(n AS VARCHAR) AS page_urlpath,
           CASE event_type WHEN 'view' THEN 'page_ping' WHEN 'click' THEN 'page_view' ELSE event_type END AS event_name,
           'site-' || CAST(n % 3 AS VARCHAR) AS site, n
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) + user_id % 10 * 100 AS n FROM events)
    """,
)
_view(
    "raw_events_dense",
    """
    SELECT CAST(user_id % 3 AS VARCHAR) AS domain_userid, ts AS collector_tstamp,
           '/article/' || CAST(100 + n AS VARCHAR) || '/slug-' || CAST(n AS VARCHAR) AS page_urlpath,
           CASE event_type WHEN 'signup' THEN 'page_view' ELSE 'page_ping' END AS event_name,
           'site-' || CAST(n % 3 AS VARCHAR) AS site, n
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS n FROM events)
    """,
)
for _suffix in ("", "_dense"):
    _view(
        f"events_norm{_suffix}",
        f"""
        SELECT site, domain_userid AS client_id, t AS activity_time, CAST(t AS DATE) AS session_date,
               page_urlpath AS landing_page_path, event_name, strftime(t, '%Y/%m/%d/%H') AS chunk_name
        FROM (SELECT *, make_timestamp(CAST(round_even(CAST(epoch_us(collector_tstamp) AS DECIMAL(20,0)) / 1000000, 0)
                        AS BIGINT) * 1000000) AS t FROM raw_events{_suffix})
        """,
        f"raw_events{_suffix}",
    )
    _view(
        f"events_agg{_suffix}",
        f"""
        SELECT client_id, min(activity_time) AS activity_time, session_date, landing_page_path, event_name,
               count(*) AS ping_count, site, chunk_name
        FROM events_norm{_suffix}
        WHERE event_name = 'page_ping' AND client_id IS NOT NULL AND landing_page_path IS NOT NULL
              AND session_date IS NOT NULL
        GROUP BY client_id, session_date, landing_page_path, event_name, site, chunk_name
        UNION ALL
        SELECT client_id, activity_time, session_date, landing_page_path, event_name, NULL, site, chunk_name
        FROM events_norm{_suffix} WHERE event_name IS DISTINCT FROM 'page_ping'
        """,
        f"events_norm{_suffix}",
    )
    _view(
        f"event_dwell{_suffix}",
        f"""
        SELECT CAST(sum(e.ping_count) * 10 AS BIGINT) AS duration, e.client_id, a.id AS article_id, a.external_id,
               CAST(a.published_at AS DATE) AS published_at, e.site, e.session_date
        FROM events_agg{_suffix} e JOIN articles a ON a.path = e.landing_page_path AND a.site = e.site
        WHERE e.event_name = 'page_ping'
        GROUP BY e.client_id, a.id, a.external_id, CAST(a.published_at AS DATE), e.site, e.session_date
        """,
        f"events_agg{_suffix}",
        "articles",
    )
_view(
    "articles",
    """
    SELECT doc_id + 1 AS id, 'site-' || CAST(doc_id % 3 AS VARCHAR) AS site,
           CAST(100 + doc_id AS VARCHAR) AS external_id,
           source || ' ' || lang || ' ' || CAST(n_chars AS VARCHAR) AS title,
           '/article/' || CAST(100 + doc_id AS VARCHAR) || '/slug-' || CAST(doc_id AS VARCHAR) AS path,
           CASE WHEN doc_id % 17 <> 0 THEN CAST(DATE '2023-11-01' + CAST(doc_id % 90 AS INT) AS TIMESTAMP) END
               AS published_at,
           TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '2024-01-01 00:00:00' AS updated_at
    FROM documents
    """,
)
_view("labelled", "SELECT doc_id + 1 AS id, quality, toxic FROM labels")
_view(
    "stored_articles",
    "SELECT * FROM articles WHERE id IN (SELECT id FROM labelled)",
    "articles",
    "labelled",
)
_view(
    "paths",
    """
    SELECT a.site, a.path, CASE WHEN l.toxic <> 1 THEN a.external_id END AS external_id,
           CASE WHEN l.toxic = 1 THEN 'no_external_id' END AS exclude_reason, a.created_at, a.updated_at
    FROM articles a JOIN labelled l USING (id)
    """,
    "articles",
    "labelled",
)
_view(
    "order_dwell",
    """
    SELECT CAST(SUM(l_quantity * 10) AS BIGINT) AS duration, CAST(o_custkey AS VARCHAR) AS client_id,
           l_partkey AS article_id, 'p' || CAST(l_partkey AS VARCHAR) AS external_id,
           DATE '1999-01-01' + CAST((l_partkey * 7919) % 1000 AS INT) AS published_at, 'site-0' AS site,
           CAST(l_shipdate AS DATE) AS session_date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    GROUP BY o_custkey, l_partkey, CAST(l_shipdate AS DATE)
    """,
)
_view(
    "order_articles",
    "SELECT DISTINCT article_id AS id, external_id, site, published_at FROM order_dwell",
    "order_dwell",
)
_view(
    "item_vectors",
    """
    SELECT vec_id AS item_id, CAST(embedding AS DOUBLE[]) AS embedding,
           DATE '2023-11-01' + CAST(vec_id % 90 AS INT) AS published_at
    FROM embeddings
    """,
)
_view(
    "models",
    """
    SELECT o_orderkey AS id, CASE WHEN o_orderpriority = '1-URGENT' THEN 'popularity' ELSE 'article' END AS type,
           CASE o_orderstatus WHEN 'F' THEN 'stale' WHEN 'O' THEN 'pending' ELSE 'current' END AS status,
           'site-' || CAST(o_custkey % 20 AS VARCHAR) AS site, o_orderdate AS created_at, o_orderdate AS updated_at
    FROM orders
    """,
)
_view(
    "promoted",
    "SELECT type, site, max(id) AS new_id FROM models WHERE status = 'pending' GROUP BY type, site",
    "models",
)
_view(
    "promoted_models",
    """
    SELECT id, type, site, created_at,
           CASE WHEN id = new_id THEN 'current' WHEN new_id IS NOT NULL AND status = 'current' THEN 'stale'
                ELSE status END AS status,
           CASE WHEN id = new_id OR (new_id IS NOT NULL AND status = 'current') THEN TIMESTAMP '2024-01-30 00:00:00'
                ELSE updated_at END AS updated_at
    FROM (SELECT m.*, p.new_id,
                 row_number() OVER (PARTITION BY m.type, m.site, m.status ORDER BY m.id) AS n
          FROM models m LEFT JOIN promoted p ON m.type = p.type AND m.site = p.site)
    WHERE NOT (status = 'stale' AND new_id IS NOT NULL AND n <= 2)
    """,
    "models",
    "promoted",
)


def with_views(sql: str, *names: str) -> str:
    """``sql`` behind the views it names, with all that those need in front."""
    ordered: list[str] = []

    def place(name: str) -> None:
        for needed in VIEWS[name][0]:
            place(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        place(name)
    parts = ", ".join(f"{name} AS ({VIEWS[name][1].strip()})" for name in ordered)
    return f"WITH {parts} {sql.strip()}" if parts else sql.strip()
