"""Readers and writers."""

from halfstar.sources.delimited import (
    parse_movie_lines,
    parse_rating_lines,
    parse_training_log,
    read_movies,
    read_ratings,
    read_space_text,
    read_training_log,
    write_space_text,
)
from halfstar.sources.ingest import ingest_batches, prepare_ids, recode_ids
from halfstar.sources.saved import load_als, load_result, load_tables, save_als, save_result, save_tables
from halfstar.sources.tables import movies_from_tables, ratings_from_tables

__all__ = [
    "ingest_batches",
    "load_als",
    "load_tables",
    "load_result",
    "movies_from_tables",
    "parse_movie_lines",
    "parse_rating_lines",
    "parse_training_log",
    "prepare_ids",
    "ratings_from_tables",
    "read_movies",
    "read_ratings",
    "read_space_text",
    "read_training_log",
    "recode_ids",
    "save_als",
    "save_tables",
    "save_result",
    "write_space_text",
]
