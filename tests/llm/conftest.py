import random

import pytest

WORDS = "the of and in to a is it on as with for by at from this that be are was".split()


@pytest.fixture(scope="session")
def texts():
    """Random texts with copies, near copies, shared passages, blanks and odd characters."""
    rnd = random.Random(5)
    made = [" ".join(rnd.choice(WORDS) + rnd.choice(["", "", "x", "yz", "."]) for _ in range(rnd.choice([1, 3, 12, 40, 90])))
            for _ in range(40)]
    passage = " ".join(rnd.choice(WORDS) + str(i) for i in range(14))
    for i in range(12):
        near = made[i].split(" ")
        near[rnd.randrange(len(near))] = "Éß漢"
        made += [made[i], " ".join(near), made[i + 12] + "\n" + passage + " " + made[i][:30]]
    return made + ["", None, " \t\n", "ab " * 400, "x" * 3000, "it's  don't\r\n\r\nA_b #$% <|endoftext|>", passage.upper()]


@pytest.fixture()
def docs(spark, texts):
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), "clash") for i, t in enumerate(texts)]
    rows += [(None, texts[0], None, None, None, None), (3, texts[3], "en", "s0", 1, "again")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `match` string").repartition(3)


@pytest.fixture()
def labels(spark):
    rows = [(i, int(i % 5 > 0), int(i % 11 == 0)) for i in range(70)] + [(None, 1, 0), (2, 0, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
