from __future__ import annotations

import random

import pytest

# Names that the operators use for columns of their own.
CLASHING = (
    "part", "shard", "start", "piece", "length", "place", "score", "spans", "fingerprint",
    "component_id", "node", "root", "u", "v", "id", "label", "tie", "ids", "_tagged", "_found",
    "offset", "sequence_id", "n_tokens", "segment", "term", "items", "least", "first", "lang_pred",
)


def messy_texts(seed: int = 5) -> list[tuple[int | None, str | None]]:
    """Documents with null and repeated ids and texts, empty, odd and very long texts."""
    random.seed(seed)
    some = ["alpha", "Beta", "gamma,", "delta", "été", "x1", "日本", "a", "the", "of", "ÉTÉ", "z" * 40]
    made = [" ".join(random.choices(some, k=random.randint(1, 60))) for _ in range(40)]
    long = " ".join(random.choices(some, k=20_000))
    rows = list(enumerate(made, 100))
    rows += [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (6, long), (7, long + " end")]
    rows += [(None, "no id here"), (None, None), (8, made[0]), (9, made[0]), (9, made[0]), (9, made[1])]
    rows += [(10, "a  b \n\n c\r\nd"), (11, "𝔘nicode ́ 　 wide"), (12, "'s don't <|endoftext|> x")]
    rows += [(13, "\x00\x1f control"), (14, made[2] + "."), (15, "!!! ??? ...")]
    return rows


@pytest.fixture(scope="session")
def messy():
    return messy_texts()


@pytest.fixture(scope="session")
def frame(spark):
    """Documents with further columns whose names clash with those of the operators."""

    def make(rows):
        extra = ", ".join(f"{name} string" for name in CLASHING)
        full = [(i, t, None, None, None, *["?"] * len(CLASHING)) for i, t in rows]
        return spark.createDataFrame(
            full, f"doc_id long, text string, lang string, source string, n_chars long, {extra}"
        ).repartition(3)

    return make
