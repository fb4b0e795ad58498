"""Dwell times -> recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pressroom import config
from pressroom.operators import factors, interactions, popularity, similarity
from pressroom.session import settle


def default_recs(dwell: DataFrame, site: config.SiteConfig, as_of, max_recs: int | None = None) -> DataFrame:
    return popularity.popularity_recs(dwell, as_of, site.popularity_window, site.name, max_recs=max_recs)


def train_step(
    rows: DataFrame, params: config.TrainingParams, as_of
) -> tuple[DataFrame, DataFrame]:
    """Interactions -> (item embeddings, item dimension with decay)."""
    prepared = settle(interactions.prepare_interactions(settle(rows)))
    embeddings = factors.item_embeddings(factors.train(prepared, params))
    return embeddings, interactions.item_dimension(prepared, as_of, params.half_life)


def article_recs_from(
    rows: DataFrame, params: config.TrainingParams, as_of, max_recs: int = config.MAX_RECS
) -> DataFrame:
    """Top similar recent articles for every article with enough readers."""
    return recs_from_embeddings(*train_step(rows, params, as_of), max_recs)


def recs_from_embeddings(embeddings: DataFrame, dimension: DataFrame, max_recs: int = config.MAX_RECS) -> DataFrame:
    """The same from the vectors of any model: ``embeddings(item_id, embedding)`` and the item dimension with its decay."""
    dimension = settle(dimension)
    items = embeddings.join(dimension.select("item_id", "decay"), "item_id")
    neighbours = similarity.nearest(items, max_recs)
    return similarity.article_recs(neighbours, dimension)


def article_recs(
    dwell: DataFrame,
    articles: DataFrame,
    site: config.SiteConfig,
    as_of,
    days: int = config.TRAINING_DAYS,
    max_recs: int = config.MAX_RECS,
) -> DataFrame:
    rows = interactions.training_interactions(
        dwell, articles, as_of, site.max_article_age, days=days, site=site.name
    )
    return article_recs_from(rows, site.training, as_of, max_recs)
