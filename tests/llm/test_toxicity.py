import random
import zlib

import pyarrow as pa
import pytest

from liftspark.llm.toxicity import Restorer, decode, disguised, language_model, toxicity
from liftspark.llm.words import Texts
from tests.llm.conftest import SCHEMA, prose

BAD = ["vermalon", "drickspul", "hogfrent", "stullweb"]


def disguise(rng, word):
    kind = rng.randrange(4)
    if kind == 0:
        return "".join({"e": "3", "a": "4", "o": "0", "i": "1", "s": "$"}.get(c, c) for c in word)
    if kind == 1:
        return rng.choice(" .-").join(word)
    if kind == 2:
        at = rng.randrange(len(word))
        return word[:at] + word[at] * 4 + word[at:]
    return word.upper()


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    rows, marks = [], []
    for i in range(600):
        words, toxic = prose(rng, rng.randint(30, 120)).split(), i % 6 == 0
        if toxic:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) if i < 300 else disguise(rng, rng.choice(BAD)))
        rows.append((i, " ".join(words), "en", "a", 1))
        if i < 500:
            marks.append((i, int(toxic)))
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(marks, "doc_id long, toxic int")


def test_held_out_accuracy(corpus):
    rows, docs, marks = corpus
    got = {r.doc_id: r for r in toxicity(docs, marks).collect()}
    assert len(got) == len(rows)
    wrong = 0
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        if r.held_out or i >= 500:
            wrong += r.predicted != int(i % 6 == 0)
    assert wrong <= 4


def test_viterbi(corpus):
    model = language_model(corpus[1])
    for word in BAD:
        assert decode(word, model) == word
        assert decode(word.replace("e", "3").replace("o", "0"), model) == word
        assert decode(" ".join(word), model, True) == word
        assert decode(word.replace("l", "llll"), model) == word or "l" not in word
    assert decode("", model) == "" and decode("2024", model).isdigit() is not None


def test_every_disguise_is_read(corpus):
    """Signs at the ends and in runs, spaced leetspeak, very long words; plain words keep their reading."""
    restore = Restorer(language_model(corpus[1]))

    def read(text):
        words, spaced, _ = disguised(Texts(pa.array(["", text, "a"])))
        return " ".join(restore(w, x) for w, x in zip(words, spaced)).replace("-", " ").replace("_", " ").split()

    for text in (
        "dr!ck$pul", "$tu||web", "$ t u 1 1 w 3 b", "h 0 g f r 3 n +", "5 t u ! ! w e b", "drickspu!", "$tullweb!!", "vermal" + "o" * 60 + "n", "verma" + "l" * 900 + "on",
        "-".join(["nuberdan"] * 8 + ["v3rm4l0n"]), "_".join(["nuberdan"] * 100 + ["h0gfr3nt"] + ["nuberdan"] * 100),
    ):
        assert set(read(text)) & set(BAD), (text, read(text)[-5:])
    assert read("nuberdan!")[0] == "nuberdan" and read("**nuberdan**")[0] == "nuberdan" and read("nuberdan! ")[0] == "nuberdan"
    assert read("1 2 3 4 ! 5") == [] and read("2024 $ 5.00") == []


def test_awkward(awkward, awkward_rows, labels):
    rows = toxicity(awkward, labels).collect()
    assert len(rows) == len(awkward_rows) and set(rows[0].asDict()) == {"doc_id", "held_out", "score", "predicted"}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert all(not r.held_out for r in rows if r.doc_id is None)


def test_empty(nothing, awkward, labels):
    assert toxicity(nothing, labels).count() == 0
    assert {r.score for r in toxicity(awkward, labels.limit(0)).collect()} == {0.0}
