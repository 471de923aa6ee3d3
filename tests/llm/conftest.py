import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string"


@pytest.fixture(scope="session")
def corpus():
    """Small mixed corpus: copies, near copies, long, empty and null texts."""
    rng = random.Random(11)
    stock = ["alpha", "beta", "gamma", "delta", "été", "über", "niño", "x1", "the", "of", "and", "Zed"]
    out = []
    for i in range(60):
        words = [rng.choice(stock) + (str(rng.randrange(40)) if rng.random() < 0.6 else "") for _ in range(rng.randrange(1, 90))]
        out.append((i, " ".join(words).replace(" the", "\nthe")))
    base = [f"w{i}" for i in range(60)]
    for i in range(60, 90):  # near copies of one text, each with one or two changed words
        words = list(base)
        for _ in range(rng.randrange(0, 3)):
            words[rng.randrange(60)] = f"z{i}"
        out.append((i, " ".join(words)))
    out += [(90, out[3][1]), (91, out[3][1]), (92, ""), (93, None), (94, " \n\t "), (95, "one"), (96, "one"), (97, "lorem " * 4000)]
    out += [(97, "lorem " * 4000), (None, "no id here but words"), (98, "x" * 5000)]
    return [(a, b, ["en", "de", None][k % 3], f"s{k % 4}" if k % 7 else None, 1, "k") for k, (a, b) in enumerate(out)]


@pytest.fixture(scope="session")
def documents(spark, corpus):
    return spark.createDataFrame(corpus, DOC_SCHEMA).repartition(3)
