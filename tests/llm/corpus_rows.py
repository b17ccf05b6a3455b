"""Rows that the tests share."""

from __future__ import annotations

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows_of(texts, first=0):
    return [(first + i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
