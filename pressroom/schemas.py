"""Column layouts of the stored tables."""

EVENT_HOURS = "site string, chunk_dir string, chunk_name string, lines bigint, bytes bigint, files bigint"

RAW_EVENTS = "collector_tstamp string, domain_userid string, event_name string, page_urlpath string"

EVENTS = (
    "client_id string, activity_time timestamp, session_date date, landing_page_path string, "
    "event_name string, ping_count bigint, site string, chunk_name string"
)

DWELL_TIMES = (
    "duration bigint, client_id string, article_id bigint, external_id string, published_at date, "
    "site string, session_date date"
)

ARTICLES = (
    "id bigint, site string, external_id string, title string, path string, "
    "published_at timestamp, created_at timestamp, updated_at timestamp"
)

PATHS = (
    "site string, path string, external_id string, exclude_reason string, "
    "created_at timestamp, updated_at timestamp"
)

MODELS = "id bigint, type string, status string, site string, created_at timestamp, updated_at timestamp"

RECOMMENDATIONS = (
    "source_entity_id string, recommended_article_id bigint, score decimal(7,6), model_id bigint"
)

RESPONSES = (
    "site string, kind string, path string, external_id string, url string, status int, "
    "body string, fetched_at timestamp"
)

RUN_METRICS = "run_id string, name string, value double, unit string, tags map<string,string>"
