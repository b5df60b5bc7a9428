from __future__ import annotations

import random

import pytest

LETTERS = "the of and ing tion über straße año niño être déjà vu data model train loss".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(LETTERS) + rng.choice(["", "s", "x", str(rng.randrange(50))]) for _ in range(n))


def messy_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars) with nulls in any column, empty and very long texts, ties and
    repeated rows."""
    rng = random.Random(7)
    base = sentence(rng, 120)
    words = base.split(" ")
    rows = [
        (1, None, "en", "a", None), (2, "", None, "a", 0), (3, " \t\n\x0b ", "de", None, 5), (None, "no id here", "en", "b", 10),
        (None, None, None, None, None), (4, "one", "en", "b", 3), (5, "ONE", "en", "b", 3), (5, "ONE", "en", "b", 3),
        (6, base, "en", "a", 1), (7, base.upper(), "en", "b", 1), (8, base + " tail", "en", None, 1),
        (9, " ".join(words[:60] + ["changed"] + words[61:]), "fr", "a", 1), (10, " ".join(reversed(words)), "fr", "c", 1),
        (11, sentence(rng, 30_000), "en", "a", 1), (12, "x" * 50_000, "de", "a", 1), (13, "line\nline\n\nline", "de", "c", 1),
        (14, "a b c d e " * 40, "de", "c", 1), (15, "<|endoftext|>x <|endoftext|>", "de", "c", 1),
        (16, "Ünïcödé 😀 \u2003 x\x1cy ſK\u0301", "de", "c", 1), (17, "no id here", "en", "b", 10),
    ]
    rows += [(100 + i, sentence(rng, rng.randrange(5, 80)), rng.choice(["en", "de", None]), rng.choice("abc"), i) for i in range(60)]
    return rows + [(200, base, "en", "hot", 1)] * 5


@pytest.fixture(scope="session")
def rows():
    return messy_rows()


@pytest.fixture(scope="session")
def messy(spark, rows):
    """The rows, with extra columns named like the operators' own."""
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    extra = "row digest place tie ids score kept listed h size token nid signature decoded predicted keep_id".split()
    return docs.selectExpr("*", *[f"'{name}' AS {name}" for name in extra]).repartition(3)


@pytest.fixture(scope="session")
def plain(messy):
    return messy.select("doc_id", "text", "lang", "source", "n_chars")


@pytest.fixture(scope="session")
def nothing(messy):
    return messy.limit(0)
