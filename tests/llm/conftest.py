import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, rank long, node string, `key` string"


def corpus(seed=1, n=120):
    """Prose of a small vocabulary, with copies, near copies, shared passages, and awkward rows."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdeilnorst") for _ in range(rng.randint(2, 8))) for _ in range(900)]
    say = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    passage = say(60)
    texts = [say(rng.randint(1, 160)) for _ in range(n)]
    for i in range(0, n, 10):
        texts[i] += " " + passage + " " + say(5)
    texts += [texts[3]] * 5 + [texts[4].upper()]
    base = say(200).split()
    for _ in range(12):
        edit = list(base)
        edit[rng.randrange(200)] = "changed"
        texts.append(" ".join(edit))
    texts += ["", "   \n\t", "a", "x " * 3000, "é ß 日本語 " + say(20), say(30) + " " + say(10), "9" * 400, "no\x1cbreak\x85here"]
    texts.append(say(20000))
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s1", None]), len(t), 7, 8, "n", "k") for i, t in enumerate(texts)]
    rows.append((len(rows), None, None, None, None, None, None, None, None))
    rows.append((None, say(40), "en", "s1", 1, 1, 1, "", ""))
    rows += [rows[5], rows[5]]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.createDataFrame([], "item_id long, text string")
