"""Small frames for the tests of the text operators."""

import random

SCHEMA = "doc_id long, text string, lang string, id string, key double, _id int, _row string, n_words string, score string, label string"


def frame(spark, pairs, lang="en"):
    """Documents with further columns whose names operators use inside."""
    rows = [(i, t, lang, "i", 0.5, 7, "r", "n", "s", "l") for i, t in pairs]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(40_000))
COPY = "the same text, twice and more,\nin two lines of one document"

#: Nulls, empty and blank texts, a very long text, copies, repeated ids and repeated rows.
EDGE = [
    (None, "only a text"), (1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, COPY), (5, COPY), (6, COPY), (7, COPY + " "),
    (7, "another text under the same id"), (None, None), (8, "x"), (9, "😀 é ß 日本 word"), (10, COPY),
]


def words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"v{rng.randrange(vocabulary)}" for _ in range(n)]


def variants(seed: int, groups: int = 6, size: int = 9, length: int = 60) -> list[tuple[int, str]]:
    """Texts in groups of copies with a growing number of changed words."""
    rng, out = random.Random(seed), []
    for _ in range(groups):
        base = words(rng, length, 5000)
        for _ in range(size):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                text[rng.randrange(length)] = f"n{rng.randrange(10**6)}"
            out.append(" ".join(text))
    rng.shuffle(out)
    return list(enumerate(out))
