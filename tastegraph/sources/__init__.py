"""Readers and writers: delimited text, loose JSON metadata, parquet tables."""

from tastegraph.sources.delimited import (
    load_personal_ratings,
    read_product_titles,
    read_ratings_csv_header,
    read_ratings_delimited,
    write_metadata_csv,
    write_ratings_delimited,
    write_titles_delimited,
)
from tastegraph.sources.metadata import project_metadata, read_metadata_json
from tastegraph.sources.tables import load_tables, products_from_part, ratings_from_orders

__all__ = [
    "load_personal_ratings", "read_product_titles", "read_ratings_csv_header", "read_ratings_delimited",
    "write_metadata_csv", "write_ratings_delimited", "write_titles_delimited",
    "project_metadata", "read_metadata_json",
    "load_tables", "products_from_part", "ratings_from_orders",
]
