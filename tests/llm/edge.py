"""Fixtures of this folder: awkward rows, and the small tables."""

from __future__ import annotations

import duckdb

SF = "/root/testdata/sf0.001"

EDGE = [
    (1, "The cat sat on the mat. The dog ran.", "en", "a", 1),
    (2, "the CAT sat on the mat. the dog ran.", "en", "a", 2),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, None, "fr", "b", 3),
    (6, "Ünïcode ÇA va? Ünïcode ÇA va? été déjà vu", "fr", "b", 9),
    (7, "word " * 3000, "en", "c", 15000),
    (8, "word " * 3000 + "end", "en", "c", 15003),
    (9, "\n\n  \t\n", "de", "c", 6),
    (9, "\n\n  \t\n", "de", "c", 6),
    (None, "The cat sat on the mat. The dog ran.", "en", None, 1),
    (10, "a b c d e f g a b c d e f g", "es", "d", 7),
    (11, "line one here\nline one here\n| home | about | contact |\n12345 !!! ###", "en", "d", 7),
    (12, "12345 678", "en", "d", 7),
    (13, "Licensed under the Apache License, Version 2.0. MIT License. GNU General Public License; CC BY", "en", "d", 7),
]


def edge_docs(spark):
    """Awkward rows, with columns whose names clash with those the operators make."""
    rows = [(*r, "x", 5, 7.0, 0, "w") for r in EDGE]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, n long, score double, gid int, word string")


def empty_docs(spark):
    return edge_docs(spark).limit(0)


def table(name: str = "documents", sf: str = SF) -> list[tuple]:
    return duckdb.sql(f"select * from '{sf}/{name}.parquet'").fetchall()


def lower(text: str | None) -> str:
    return (text or "").translate({c: c + 32 for c in range(65, 91)})
