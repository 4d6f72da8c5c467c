"""Documents with every kind of trouble, and texts in two made-up languages."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept boolean, class int, row int, place int, position int, taken int, size int, judged int, key int"
OTHERS = (0.5, False, 1, 2, 3, 4, 5, 6, 7, 8)


def prose(seed, n, stem="ab"):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(stem + "cdeo") for _ in range(rng.randint(2, 6))) for _ in range(n))


LONG = prose(99, 6000)
MESSY = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (4, "One", "en", "b", 3), (5, "one", None, "b", 3),
    (5, "one", None, "b", 3), (None, prose(1, 70), "en", None, None), (6, LONG, "en", "a", len(LONG)), (7, LONG, "en", "c", len(LONG)),
    (8, prose(2, 80), "de", "c", 1), (8, prose(3, 80), "de", "c", 1), (9, "é ü 漢字 \U0001F600 x\x00y", "fr", "a", 9), (10, "..!! ??", "fr", "é", 7),
]


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, *OTHERS) for r in rows], SCHEMA).repartition(3)


def messy(spark):
    return docs_of(spark, MESSY)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
