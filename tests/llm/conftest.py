import hashlib
import random
import re

import pytest

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def rows():
    """Copies, near copies, shared passages and every odd text."""
    rng = random.Random(5)
    texts = [prose(rng, rng.randrange(60, 160), 5000) for _ in range(12)]
    passage = prose(rng, 70, 5000)
    copies = [texts[0], texts[0], texts[1].upper()]
    near = []
    for t in texts[2:6]:
        words = t.split()
        words[len(words) // 2] = "changed"
        near.append(" ".join(words))
    shared = [f"{prose(rng, 40, 5000)} {passage} {prose(rng, 30, 5000)}" for _ in range(5)]
    lines = "\n".join(prose(rng, 6, 5000) for _ in range(9))
    odd = [
        None, "", "   ", "\n\n", "one", "a b c", "ünï çödé", "日本 語 テスト", "\x00 null \x1f",
        lines, "head line\n" + lines + "\ntail line", lines.replace("\n", "\n\n"),
        "x " * 400, "giant" * 3000, passage, "a b c",
    ]
    return [(i, t) for i, t in enumerate(texts + copies + near + shared + odd)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    return spark.createDataFrame(full, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
