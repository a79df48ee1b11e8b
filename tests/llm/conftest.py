import numpy as np
import pytest

SYLLABLES = "ka lo mi nu ra se ti vo wen zul bre dar fen gos hal jin kel mor pas qui".split()


def invented_text(rng, words: int) -> str:
    made = ("".join(rng.choice(SYLLABLES, rng.integers(1, 4))) for _ in range(words))
    return " ".join(w if rng.random() > 0.1 else w + "." for w in made)


@pytest.fixture
def prose():
    """Invented texts by number of words, the same ones in every run."""
    rng = np.random.default_rng(5)
    return lambda words: invented_text(rng, words)


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) rows, with columns whose names operators use inside."""

    def make(rows, **columns):
        extra = ["score", "ids", "decoded", "_site", "mix_kept", "lines", "node", "digest", "n_tokens"]
        schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in extra)
        values = [
            (i, t, columns.get("lang", "en"), columns.get("source", "s"), *("x" for _ in extra)) for i, t in rows
        ]
        return spark.createDataFrame(values, schema)

    return make


#: Rows that every operator has to take: nulls, empty and blank texts, copies, a very long text.
ODD_ROWS = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "one two three four five six"),
    (6, "one two three four five six"), (6, "one two three four five six"), (None, "no id here"),
    (None, None), (7, "x" * 30_000), (8, "word " * 20_000), (9, "ÄÖ 日本 😀  end\r\n"),
]
