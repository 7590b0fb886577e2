"""Catalogue to collections to items, and the raster health report."""

from __future__ import annotations

from pyspark.sql import DataFrame

from terraloom.operators import catalog, inventory
from terraloom.sources import documents


def collections(docs: DataFrame, bucket: str, region: str) -> DataFrame:
    """Flatten catalogue documents (``links``) to the collections table."""
    children = catalog.links(docs, "child")
    return catalog.parse_href(children, bucket, region).select(*documents.COLLECTION_COLUMNS)


def enriched(collections_df: DataFrame, docs: DataFrame, keep_links: bool = False) -> DataFrame:
    """Collections with a type and a readable document."""
    return catalog.enrich(collections_df.filter("type != ''"), docs, keep_links=keep_links)


def items(collections_df: DataFrame, docs: DataFrame, item_docs: DataFrame, base: str) -> DataFrame:
    """Items of the collections that have a type and a readable document.

    Collection documents are parsed and joined once, for facts and links alike.
    """
    return catalog.items(enriched(collections_df, docs, keep_links=True), item_docs, base)


def health(headers: DataFrame, size_mb: str = "size_mb") -> DataFrame:
    """Format summary of a set of raster headers."""
    return inventory.report(inventory.assess(headers), size_mb)
