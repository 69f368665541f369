"""Small documents with every odd case, and plain versions of what operators count."""

from __future__ import annotations

import re

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, size int, row string, key string"
PROSE = "The quick brown fox number {} jumps over the lazy dog near river {} while nobody in town {} looks at it. "


def prose(seed: int, sentences: int = 6) -> str:
    return "".join(PROSE.format(seed * 97 + i, seed * 31 + i * 7, seed + i * 13) for i in range(sentences)).strip()


def corpus() -> list[tuple]:
    texts = [(i, prose(i)) for i in range(12)]
    texts += [(20, prose(1)), (21, prose(1) + "  \n"), (19, "\t" + prose(1))]  # equal but for white space
    texts += [(30, prose(2).replace("quick", "slow", 1)), (31, prose(2).upper())]
    texts += [(40, None), (41, ""), (42, " \n\t"), (43, "123 456"), (44, "é ü ¿? " * 30)]
    texts += [(50, prose(3)), (50, prose(3)), (50, prose(4)), (None, prose(5)), (None, None)]  # repeated and null ids
    texts += [(60, "same words again " * 400), (61, "word " * 9000), (62, "x" * 5000)]
    rows = []
    for n, (doc_id, text) in enumerate(texts):
        source = None if n % 7 == 3 else ("hot" if n % 3 else f"s{n % 4}")
        rows.append((doc_id, text, "en" if n % 2 else None, source, n, "clash", n, "clash", None))
    return rows


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
