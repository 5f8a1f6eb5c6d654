import random

import pytest

VOCABULARY = "the of and to in is that for with on as are this be was by from an at it or not have which all can one two three river stone light paper green house water winter summer garden letter window engine market".split()


def prose(rng: random.Random, words: int) -> str:
    return " ".join(rng.choice(VOCABULARY) + (rng.choice(["", "", ".", ",", "s", "\n", "\t"])) for _ in range(words))


@pytest.fixture(scope="session")
def corpus():
    """Texts with copies, near copies, shared passages, repeats, nulls, blanks and one very long text."""
    rng = random.Random(5)
    base = [prose(rng, rng.choice([3, 7, 40, 90, 200])) for _ in range(60)]
    texts = list(base)
    for t in base[:25]:
        words = t.split(" ")
        for _ in range(rng.randint(1, 4)):
            at = rng.randrange(len(words))
            words[at] = "edited" + str(rng.randrange(9))
        texts.append(" ".join(words))
    passage = prose(rng, 60)
    texts += [f"{prose(rng, 20)} {passage} {prose(rng, 20)}" for _ in range(12)] + base[:8] + [base[0]] * 5
    texts += ["", " \n\t ", "one", "one two", "one two three four five", "ha " * 300, "É É é ß 日本語 🎉 " * 12, prose(rng, 6000), passage + "\n" + passage, "\n\n\n", "a\x00b c d e"]
    rows = [(i, t) for i, t in enumerate(texts)]
    return [*rows, (500, None), (501, None), (None, base[3]), (None, "lonely words here"), (7, texts[7]), (7, texts[8])]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with extra columns whose names the operators use inside."""
    extra = "row string, text_key string, id string, kept boolean, n_words long, set string, _text_key int, source string, lang string"
    rows = [(i, t, "r", "k", "i", True, 1, "s", 1, ["a.org", "b.org", None][j % 3], "en" if j % 2 else None) for j, (i, t) in enumerate(corpus)]
    return spark.createDataFrame(rows, f"doc_id long, text string, {extra}").repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string, row string")


@pytest.fixture(scope="session")
def labelled(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, 60) if i % 3 else " ".join(f"{w}###" for w in prose(rng, 60).split()), "good.org" if i % 3 else "bad.org", "en") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(300)] + [(None, 1, 0), (5, None, None)], "doc_id long, quality int, toxic int")
    return docs, labels
