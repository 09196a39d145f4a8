import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeilnorstu") for _ in range(rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Documents with copies, near copies, shared lines and passages, repeated rows, nulls and empty texts."""
    rng = random.Random(5)
    lines = [words(rng, rng.randint(5, 14)) for _ in range(60)]
    passage = words(rng, 70)
    rows = []
    for i in range(60):
        text = "\n".join(words(rng, rng.randint(4, 20)) for _ in range(rng.randint(1, 9)))
        if i % 4 == 1:
            k = rng.randint(0, 50)
            text += "\n" + "\n".join(lines[k:k + 6]) + "\n\n" + words(rng, 6)
        if i % 5 == 2:
            text = words(rng, 12) + " " + passage + " " + words(rng, 9) + "\n" + text
        rows.append((i, text, rng.choice(["en", "fr", None]), rng.choice(["a", "b", None]), len(text)))
    for i, of in ((60, 3), (61, 3), (62, 17)):
        rows.append((i, rows[of][1], "en", "a", rows[of][4]))
    rows.append((63, rows[5][1] + " more", "en", "b", 0))
    rows += [(64, None, None, None, None), (65, "", "en", "b", 0), (66, " \n\t ", "en", "b", 4), (67, "?!\n?!", "fr", "a", 5),
             (None, rows[7][1], "en", "a", 1), (68, "a\n" * 9, "en", "a", 18), (69, words(rng, 3000), "en", "b", 9)]
    return rows + [rows[4], rows[4], rows[70]]          # repeated rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def vocabulary(spark):
    import public_tokenizers
    from tessera.llm.word_bpe import Vocabulary
    return Vocabulary(spark, public_tokenizers.path("word_bpe_49k.json"))
