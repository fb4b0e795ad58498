"""Visited paths + landed responses -> articles and path cache."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressroom import config
from pressroom.operators import articles as art
from pressroom.operators import extraction, path_cache, paths
from pressroom.session import settle


@dataclass
class MetadataUpdate:
    articles: DataFrame
    paths: DataFrame
    created: DataFrame
    refreshed: DataFrame
    errors: DataFrame


def update_metadata(
    site: config.SiteConfig,
    to_update: DataFrame,
    articles: DataFrame,
    path_table: DataFrame,
    responses: DataFrame,
    as_of,
    reserve: Callable[[int], int] | None = None,
    part: Callable[[str, DataFrame], DataFrame] | None = None,
) -> MetadataUpdate:
    """Create articles for new paths, refresh the known ones, and remember each path.

    ``to_update`` is the result of ``paths_to_update`` for this site. Results that feed
    several outputs are settled once. ``reserve`` hands out the first of so many article ids; without
    it ids continue after the largest one in ``articles``. ``part`` gives the stored rows of a table (``article`` or ``path``) among which those
    with the given keys are: with it the results hold these and their changes only, and the rest of the tables is looked up but not carried along.
    """
    mine = responses.filter(F.col("site") == site.name)
    to_update = settle(to_update)

    visited = paths.new_paths(to_update).withColumnRenamed("landing_page_path", "path")
    extracted = settle(extraction.extract_ids(site, visited, mine))
    no_id = art.failed_scrapes(extracted)
    duplicates = art.duplicate_paths(extracted, articles)
    scraped = settle(extraction.extract_metadata(site, art.new_articles(extracted, articles), mine))
    first_id = reserve(scraped.count()) if reserve else None
    _, created, undated = art.create_articles(articles, scraped, as_of, first_id)
    created = settle(created)
    again = art.known_ids(articles, paths.refresh_ids(to_update))
    rescraped = settle(extraction.extract_metadata(site, again, mine))
    changed = created.select(*art.KEY).unionByName(rescraped.select(*art.KEY))
    snapshot = (part("article", changed) if part else articles).select(*art.COLUMNS).unionByName(created)
    failed_refresh = art.failed_scrapes(rescraped)
    snapshot, undated_refresh = art.refresh_articles(snapshot, rescraped, as_of)
    if site.refresh_deletes_excluded:
        snapshot = art.delete_excluded_articles(snapshot, failed_refresh, config.EXCLUDE_TAG_MESSAGE)

    errors = settle(
        art.scrape_errors(no_id, duplicates, art.failed_scrapes(scraped), undated, failed_refresh, undated_refresh)
    )
    both_paths = scraped.join(created.select("site", "external_id"), ["site", "external_id"], "left_semi")
    if part:
        path_table = part("path", path_cache.path_entries(both_paths, errors).select("site", "path"))
    cache = path_cache.update_path_cache(path_table, both_paths, errors, as_of)
    refreshed = rescraped.filter(F.col("error_type").isNull() & F.col("published_at").isNotNull())
    return MetadataUpdate(snapshot, cache, created, refreshed, errors)
