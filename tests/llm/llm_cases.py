import duckdb
import numpy as np
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, id string, class string, runs string, size string, text_key string"


@pytest.fixture(scope="session")
def small(sf_dir):
    """(doc_id, text, lang, source) of the smallest documents."""
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{sf_dir}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="session")
def odd_rows(small):
    """Texts with everything that may go wrong: nulls, nothing, white space, repeats, ties and a very long text."""
    chance = np.random.default_rng(2)
    texts = [t for _, t, _, _ in small[:40]]
    passage = " ".join(f"word{i}" for i in chance.integers(0, 5000, 120))
    lines = [f"{w}\n{passage}. {w} ends here.\n{w}" for w in ("alpha", "beta", "gamma")]
    near = [" ".join([*passage.split()[:k], "changed", *passage.split()[k + 1 :]]) for k in (3, 50, 118)]
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    strange = ["", " \t\n ", "\n\n\n", "a", "one two", "\U0001d538\U0001d539 x", "Été ßİ", "123 456", "same line\n" * 30, "aaaa" * 400, "ab\x00cd " * 90]
    texts += lines + near + [passage.upper(), long] + strange + [f"common line\n text {i} of its own\n" for i in range(12)]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 3}" if i % 4 else None) for i, t in enumerate(texts)]
    return rows + [(len(rows), None, None, None), (len(rows) + 1, None, "fr", "s1")]


def with_more(rows):
    """The rows with columns whose names clash with those that operators make."""
    return [(*r, len(r[1] or ""), "k", "s", "i", "c", "r", "z", "t") for r in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(with_more(odd_rows), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
