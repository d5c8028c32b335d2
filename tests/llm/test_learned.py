from __future__ import annotations

import pickle
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortum.llm import byte_gru, toxicity
from cohortum.llm.wordcache import Words
from tests.llm.helpers import documents, odd_texts

FOLDER = "/root/testdata/sf0.01"


def test_gradients_are_those_of_the_loss():
    noise = np.random.default_rng(3)
    weights = {k: v.astype(np.float64) for k, v in byte_gru.start_weights(3).items()}
    bytes_, label = noise.integers(0, 256, (5, 4)).astype(np.uint8), np.array([0, 1, 2, 1, 0])

    def loss() -> float:
        return -byte_gru.log_probabilities(bytes_, weights)[:, np.arange(5), label].mean()

    found = byte_gru.gradients(bytes_, label, weights)
    for name in weights:
        flat, slope = weights[name].reshape(-1), found[name].reshape(-1)
        for at in np.argsort(-np.abs(slope))[:3]:
            before = flat[at]
            flat[at] = before + 1e-4
            high = loss()
            flat[at] = before - 1e-4
            low = loss()
            flat[at] = before
            assert slope[at] == pytest.approx((high - low) / 2e-4, rel=2e-2, abs=1e-5)


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")


def test_languages_of_held_out_documents(spark, tables):
    docs, _ = tables
    model = byte_gru.fit(docs)
    found = byte_gru.language_predictions(docs, model)
    both = found.join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL")
    assert both.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97
    assert found.where("score < 0 OR score > 1").count() == 0
    odd = documents(spark, odd_texts())
    names = {r["doc_id"]: r["lang_pred"] for r in byte_gru.language_predictions(odd, model).collect()}
    assert [names[i] for i in (1, 2, 3, 4)] == ["und"] * 4 and names[6] != "und"
    kept = byte_gru.with_language(odd, model, 0.0)
    assert kept.columns == odd.columns and kept.where("doc_id <= 4").count() == 0


def test_windows_are_the_spans_of_their_words(monkeypatch):
    words = [b"abc", "日本語のテキスト".encode() * 9, b"x", b"de" * 12, b"fgh", b"y" * 25]
    expected: dict = {}
    for number, word in enumerate(words):
        for a, b, low, high in byte_gru.spans(word):
            expected.setdefault(b - a, []).append((word[a:b], number, [low <= a + i < high for i in range(b - a)]))
    looked_at = []
    plain = byte_gru.spans
    monkeypatch.setattr(byte_gru, "spans", lambda word: looked_at.append(word) or plain(word))
    found = byte_gru.windows(words)
    assert list(found) == list(expected) and byte_gru.windows([]) == {}
    for length, (bytes_, numbers, own) in found.items():
        assert [(x.tobytes(), n, o) for x, n, o in zip(bytes_, numbers.tolist(), own.T.tolist())] == expected[length]
    assert looked_at == [words[1], words[5]]


def test_a_full_memory_keeps_the_words_that_come_again():
    asked = []
    words = Words(lambda new: asked.append(sorted(new)) or [w.encode() for w in new], most=4)
    words.learn([["a", "b", "c"]])
    known = words.learn([["b", "d"], ["c", "e"]])
    assert asked == [["a", "b", "c"], ["d", "e"]] and known("b") == b"b" and len(words.known) == 4


@pytest.mark.parametrize("step", ["language", "toxicity"])
def test_a_batch_is_read_a_piece_at_a_time(monkeypatch, step):
    texts = ["one", None, "two", "a longer text than a piece", "", "three", "4"]
    asked = []

    class Stub:
        def label(self, some):
            asked.append(some)
            return ["en"] * len(some), [0.5] * len(some)

        def score(self, some):
            asked.append(some)
            return np.full(len(some), 0.5)

    for module, name in ((byte_gru, "labeller"), (toxicity, "scorer")):
        monkeypatch.setattr(module, name, lambda model: Stub())
        monkeypatch.setattr(module, "SMALLER", 8)
    batch = pa.RecordBatch.from_pydict({"doc_id": range(7), "held_out": [False] * 7, "text": texts})
    found = list((byte_gru.predicted if step == "language" else toxicity.scored)(iter([batch, batch[:0]]), b""))
    assert asked == [texts[:3], [texts[3]], texts[4:]]
    assert [x for some in found for x in some["doc_id"].to_pylist()] == list(range(7))


def test_learning_languages_starts_no_workers_for_rows_of_objects(spark, monkeypatch):
    docs = documents(spark, odd_texts())

    def refused(*_):
        raise AssertionError("rows of Python objects")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refused)
    assert pickle.loads(byte_gru.fit(docs))[0] == ["en"]
    assert pickle.loads(byte_gru.fit(docs.limit(0)))[0] == []


def test_nothing_to_learn_languages_from(spark):
    docs = documents(spark, ["some text", None]).withColumn("lang", F.lit(None).cast("string"))
    found = byte_gru.language_predictions(docs, byte_gru.fit(docs)).collect()
    assert [(r["lang_pred"], r["score"]) for r in found] == [("und", 0.0)] * 2
    assert byte_gru.language_predictions(docs.limit(0), byte_gru.fit(docs.limit(0))).collect() == []


def test_toxic_documents_disguised_or_not(spark, tables):
    docs, labels = tables
    trained = toxicity.fit(docs, labels)
    scores = toxicity.toxicity_scores(docs, trained)
    both = scores.join(labels, "doc_id").where("held_out").toPandas()
    clean = both[both.toxic == 0]
    assert (clean.predicted == 0).mean() > 0.98
    assert both[both.toxic == 1].score.mean() > clean.score.mean() + 0.4
    filler = "the and of that with from this " * 12
    texts = [filler, filler + "idiot moron stupid", filler + "1di0t m0r0n stuuupid", filler + "i d i o t s.t.u.p.i.d"]
    planted = toxicity.toxicity_scores(documents(spark, texts + odd_texts()), trained)
    score = {r["doc_id"]: r["score"] for r in planted.collect()}
    assert score[1] < 0.3 < score[2] and score[3] > score[1] and score[4] > score[1]
    assert score[5] == score[6] < 0.3
    kept = toxicity.without_toxic(documents(spark, texts), trained)
    assert 1 in {r["doc_id"] for r in kept.collect()} and len(kept.columns) == 11


def test_restoration(tables):
    model = toxicity.character_model(tables[0])
    for word, meant in {"m0r0n": "moron", "s.t.u.p.i.d": "stupid", "cl0wn": "clown", "l0ser": "loser"}.items():
        assert toxicity.restored_words(word, model) == [meant]
    assert toxicity.restored_words("plain", model) == ["plain"]
    assert toxicity.restored_words("12345", model) == []


def test_restoration_at_the_ends_of_signs_alone_and_of_doubled_letters(tables):
    model = toxicity.character_model(tables[0])
    hidden = {
        "$tupid": "stupid", "!diot": "idiot", "|diot": "idiot", "1diot!": "idiot", "worthle$$": "worthless",
        "a$$!": "ass", "@$$": "ass", "455": "ass", "stuupid": "stupid", "idiiot": "idiot", "(\"$tupid\")": "stupid",
    }
    for word, meant in hidden.items():
        assert any(meant in (x, x + x[-1]) for x in toxicity.restored_words(word, model)), word
    for word in ("great!", "(the", "good", "*all*"):
        assert word.strip("!(*") in toxicity.restored_words(word, model)
    assert toxicity.features(["good", "good", "goods"]).count("good") == 1


@pytest.mark.parametrize("label", [None, 0, 1])
def test_labels_that_teach_nothing(spark, label):
    docs = documents(spark, ["some text", None, ""], [2, 3, None])
    labels = spark.createDataFrame([(2, label), (None, 1)], "doc_id bigint, toxic int")
    scores = [r["score"] for r in toxicity.toxicity_scores(docs, toxicity.fit(docs, labels)).collect()]
    assert len(scores) == 3 and len(set(scores)) == 1 and 0 < scores[0] < 1
    assert toxicity.toxicity_scores(docs.limit(0), toxicity.fit(docs.limit(0), labels)).collect() == []


def every_reading(word: str, model: np.ndarray) -> dict[str, float]:
    """The cost of each path of a word's lattice, by what it restores; the cheapest of equal ones."""
    out: dict[str, float] = {}
    choices = [toxicity.arcs(word, at) for at in range(len(word))]
    for path in product(*choices):
        text = "".join(char for char, _ in path)
        states = [0, 0, *toxicity.symbols(text).tolist(), 0]
        cost = sum(extra for _, extra in path) - sum(float(model[tuple(states[i : i + 3])]) for i in range(len(states) - 2))
        out[text] = min(cost, out.get(text, np.inf))
    return out


@settings(max_examples=120, deadline=None)
@given(st.text("abesotl$1!04ß.", min_size=1, max_size=7), st.integers(0, 3))
def test_the_restored_word_is_the_cheapest_of_all_paths(word, seed):
    model = np.log(np.random.default_rng(seed).dirichlet(np.ones(64), (64, 64))).astype(np.float32)
    costs = every_reading(word, model)
    assert costs[toxicity.restore(word, model)] == pytest.approx(min(costs.values()), abs=1e-4)


@settings(max_examples=200, deadline=None)
@given(st.text("abé", min_size=1, max_size=12).filter(lambda x: not toxicity.TRIPLE.search(x)), st.integers(0, 3))
def test_doubled_letters_one_by_one_are_the_whole_lattice(word, seed):
    model = np.log(np.random.default_rng(seed).dirichlet(np.ones(64), (64, 64))).astype(np.float32)
    assert toxicity.undoubled(word, model) == toxicity.restore(word, model)


def test_a_text_of_very_many_words(spark, tables):
    docs, labels = tables
    text = "the and of that " * 5000
    long = documents(spark, [text, text + "idiot moron stupid " * 200])
    scores = toxicity.toxicity_scores(long, toxicity.fit(docs, labels)).orderBy("doc_id").collect()
    assert scores[0]["score"] < 0.3 < scores[1]["score"]
    assert {r["lang_pred"] for r in byte_gru.language_predictions(long, byte_gru.fit(docs)).collect()} == {"en"}


def test_every_language_is_learned(spark):
    """More languages than have a whole sample each; each writes with three letters of its own."""
    letters = [chr(c) for c in range(0x3B1, 0x3B1 + 24)] + [chr(c) for c in range(0x430, 0x430 + 32)] + list("abcdefghijklmnopqrstuvwxyz")
    rows, languages = [], 80
    for i in range(languages * 12):
        own = letters[i % languages : i % languages + 3]
        text = " ".join("".join(own[(j * k + k) % 3] for k in range(4)) for j in range(60))
        rows.append((i, text, f"l{i % languages:02d}"))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = byte_gru.fit(docs)
    langs, _ = pickle.loads(model)
    assert len(langs) == languages
    predicted = {r["lang_pred"] for r in byte_gru.language_predictions(docs, model).collect()}
    assert predicted <= set(langs) and max(predicted) > "l70"


def test_rows_of_one_identifier_are_one_of_the_sample(spark, tables):
    docs, _ = tables
    few = docs.where("doc_id < 60")
    again = few.unionByName(few.where("doc_id = 2")).unionByName(few.where("doc_id = 2"))
    assert byte_gru.fit(again) == byte_gru.fit(few)


@settings(max_examples=100, deadline=None)
@given(st.text("aé日😀", max_size=60))
def test_windows_of_long_words_stand_for_every_position_once(word):
    raw, seen = word.encode(), []
    for start, end, low, high in byte_gru.spans(raw):
        raw[start:end].decode()  # cut at characters
        assert end - start <= byte_gru.WINDOW + 8 and start <= low and high <= end
        seen += range(low, high)
    assert seen == list(range(len(raw)))


def test_sums_of_words_are_those_of_a_plain_loop():
    weights = byte_gru.start_weights(3, seed=2)
    labeller = byte_gru.Labeller(pickle.dumps((["a", "b", "c"], weights)))
    words = ["a", "wörter", "日本語" * 9, "x" * 70]
    for word, found in zip(words, labeller.sums(words)):
        expected = np.zeros(7)
        for start, end, low, high in byte_gru.spans(word.encode()):
            part = np.frombuffer(word.encode()[start:end], np.uint8)[None]
            logs = byte_gru.log_probabilities(part, weights)[:, 0]
            for at in range(low - start, high - start):
                expected += [*logs[at], *np.exp(logs[at]), 1]
        assert np.frombuffer(found, np.float32) == pytest.approx(expected, rel=1e-4)
