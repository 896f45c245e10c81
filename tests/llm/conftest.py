import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", "", ",", "."]) for _ in range(n))


def _words():
    rnd = random.Random(4)
    parts = ["an", "er", "tion", "le", "ré", "der", "ß", "ou", "st", "ing", "o", "ka"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4))) for _ in range(800)]


WORDS = _words()


def corpus(seed=1, n=60):
    """Documents with exact and near copies, shared passages, boilerplate, and every odd case."""
    rnd = random.Random(seed)
    texts = [prose(rnd, rnd.randint(60, 200)) for _ in range(n)]
    passage = prose(rnd, 40)
    for i in range(0, n, 5):
        texts[i] += "\n" + passage + "\n" + prose(rnd, 30)
    for i in range(3, n, 6):  # near copies of document 0 and chains of copies of copies
        w = texts[i - 3].split(" ")
        w[rnd.randrange(len(w))] = "changed"
        texts[i] = " ".join(w)
    texts += [texts[7]] * 4 + [texts[8] + " x"]
    for i in range(2, n, 3):
        texts[i] = texts[i] + "\nAll rights reserved to the 17 owners.\n" + prose(rnd, 25)
    texts += [None, "", "   \n\t", "one", "two words", "two  words", "UPPER lower UPPER lower", "a b c d", "A B C D", "a b c",
              "ü" * 60, "ü" * 60, "spam spam " * 40, "x" * 49, "x" * 50, "x" * 51, "é\x0bé\x1cé　é " * 20,
              prose(rnd, 8000), "\0" * 80, "\0" * 90, "a,b,c. " * 30]
    rows = []
    for i, t in enumerate(texts):
        source = None if i % 11 == 0 else f"src{'ABé'[i % 3]}" if i % 2 else "hot"
        rows.append((i * 3 + 2, t, None if i % 7 == 0 else "en", source, None if t is None else len(t)))
    rnd.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def got():
    """Rows of some columns, sorted."""
    return lambda df, *columns: sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
