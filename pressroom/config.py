"""Per-site settings and the constants the results depend on."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

# --- fixed values -----------------------------------------------------------------
SECONDS_PER_PING = 10

PAGE_PING = "page_ping"
PAGE_VIEW = "page_view"
RECOMMENDATION_FLOW = "recommendation_flow"

REQUIRED_EVENT_FIELDS = ("collector_tstamp", "domain_userid", "event_name", "page_urlpath")

MIN_ROWS_PER_ARTICLE = 5  # kept when strictly greater
MIN_ROWS_PER_READER = 2  # kept when strictly greater
MIN_READER_SECONDS = 60  # kept when strictly greater
MIN_DURATION, MAX_DURATION = 30, 600  # inclusive

POPULARITY_LIMIT = 50
POPULARITY_HALF_LIFE = 10.0
TRAINING_DAYS = 28
MAX_RECS = 10
MAX_STALE_DELETES = 2

FAILURES = (
    "unknown",
    "fetch_error",
    "no_external_id",
    "malformed_api_response",
    "failed_site_validation",
    "no_publish_date",
    "duplicate_path",
)
EXCLUDING_FAILURES = ("no_external_id", "failed_site_validation")

MODEL_TYPES = ("article", "user", "popularity")
MODEL_STATUSES = ("pending", "current", "stale", "failed")

EXCLUDE_TAG_MESSAGE = "Article has exclude tag"
# ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class TrainingParams:
    """Hyper-parameters of the factor model.

    ``tune_ranges`` maps a parameter to a half-open ``(start, stop, step)`` range.
    """

    half_life: float = 10.0
    rank: int = 64
    iterations: int = 3
    implicit: bool = True
    regularisation: float = 0.1
    alpha: float = 1.0
    seed: int = 42
    tune: bool = False
    tune_ranges: dict = field(default_factory=dict)

    def with_values(self, **values) -> "TrainingParams":
        return replace(self, **values)


@dataclass(frozen=True)
class SiteConfig:
    """One newsroom, and the place to plug in another.

    ``id_rule``, ``metadata_rule`` and ``bulk_rule`` name entries of
    ``operators.extraction.ID_RULES`` / ``METADATA_RULES`` / ``BULK_RULES`` or are such
    entries themselves; ``event_rule`` turns parsed raw events into normalised ones, None
    stands for ``operators.events.normalise_events``. ``validators`` are (SQL predicate over
    ``url``, ``status``, ``body``, message) pairs: the first that holds rejects the article.
    """

    name: str
    domain: str
    hours_of_data: int
    popularity_window: int
    max_article_age: int
    training: TrainingParams
    id_rule: str | tuple
    metadata_rule: str | tuple
    bulk_rule: str | Callable | None = None
    event_rule: Callable | None = None
    validators: tuple[tuple[str, str], ...] = ()
    refresh_deletes_excluded: bool = False
    event_fields: tuple = REQUIRED_EVENT_FIELDS


# --- fixed values: the three newsrooms ----------------------------------------------
INQUIRER = SiteConfig(
    name="philadelphia-inquirer",
    domain="www.inquirer.com",
    hours_of_data=2,
    popularity_window=2,
    max_article_age=2,
    training=TrainingParams(
        half_life=120.0,
        rank=256,
        iterations=2,
        tune_ranges={"iterations": (1, 3, 1), "rank": (30, 180, 50)},
    ),
    id_rule="arc_lookup",
    metadata_rule="arc_json",
    bulk_rule="arc_bulk",
)
TRIBUNE = SiteConfig(
    name="texas-tribune",
    domain="www.texastribune.org",
    hours_of_data=2,
    popularity_window=7,
    max_article_age=10,
    training=TrainingParams(
        half_life=90.0,
        rank=100,
        iterations=3,
        tune_ranges={"iterations": (5, 11, 2), "rank": (160, 360, 100)},
    ),
    id_rule="html_content_id",
    metadata_rule="tribune_json",
    bulk_rule="tribune_bulk",
)
CITY_PAPER = SiteConfig(
    name="washington-city-paper",
    domain="washingtoncitypaper.com",
    hours_of_data=24,
    popularity_window=7,
    max_article_age=10,
    training=TrainingParams(
        half_life=30.0,
        rank=144,
        iterations=3,
        tune_ranges={"iterations": (1, 5, 1), "rank": (40, 300, 20)},
    ),
    id_rule="article_path",
    metadata_rule="article_html",
    refresh_deletes_excluded=True,
)

ARTICLE_PATH_PATTERN = r"^/((v|c)/s/washingtoncitypaper\.com/)?article/([0-9]+)/\S+"

NON_ARTICLE_PREFIXES = (
    "/districts",
    "/employees",
    "/directory",
    "/newsletters",
    "/states",
    "/search",
    "/departments",
    "/about",
    "/series",
    "/all",
    "/program",
    "/events",
    "/library",
    "/people",
    "/donate",
    "/topics",
    "/organizations",
    "/jobs",
    "/support-us",
    "/session",
)
INVALID_PREFIXES = ("/author", "/wires", "/zzz-systest")
IN_HOUSE_PLATFORMS = ("composer", "ellipsis", "airtable")
TEST_SITE = "/zzz-systest"
# ----------------------------------------------------------------------------------

SITES = {site.name: site for site in (INQUIRER, TRIBUNE, CITY_PAPER)}


def get_site(name: str) -> SiteConfig:
    if name not in SITES:
        raise KeyError(f"no site named {name!r}; known sites: {sorted(SITES)}")
    return SITES[name]
