import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, band string, row int, extra string, _id string"


def _sentence(r, n, words):
    return " ".join(r.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Ids and texts: nulls, blanks, short and very long texts, copies, near copies, shared passages, odd letters."""
    r = random.Random(7)
    words = [f"{a}{b}" for a in ("ba", "do", "ke", "Lu", "mi", "né") for b in ("ran", "tol", "s", "vex", "uß", "p")]
    passage = _sentence(r, 60, words)
    base = _sentence(r, 120, words)
    out = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (6, "two words"), (7, base), (8, base), (9, base.replace(" ", "\n"))]
    near = base.split(" ")
    near[50] = "changed"
    out += [(10, " ".join(near)), (11, _sentence(r, 30, words) + " " + passage + " " + _sentence(r, 30, words)), (12, passage + " " + _sentence(r, 50, words))]
    out += [(13, (_sentence(r, 12, words) + "\n") * 9), (14, _sentence(r, 30_000, words)), (15, "Ünïcode “quotes” é́ 漢字 <|endoftext|> it's 1234 \x1c x\xa0y  z"), (16, "A" * 5000)]
    out += [(i, _sentence(r, r.randint(1, 90), words) + r.choice(["", ".", "\nReleased under the MIT License.\n", "\nCopyright x. All rights reserved\n"])) for i in range(17, 60)]
    out += [(60, base), (60, base), (None, passage)]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i, t, "en", f"src{(i or 0) % 3}" if i != 20 else None, len(t or ""), "h", "b", 1, "x", "y") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
