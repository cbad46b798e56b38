from __future__ import annotations

import numpy as np
import pytest
from monthloom.llm import langid
from monthloom.llm.common import crc_remainder, segments
from monthloom.llm.queries import QUERIES
from pyspark.sql import functions as F

WORDS = {
    "en": "the house and the garden are with this that which there were through thought other",
    "de": "das haus und der garten sind mit diesem welches dort wären durch gedanken andere nicht",
    "xx": "zozo kaka tutu lili mama popo zuzu kiki tata lolo momo pipi",
}


def rows():
    out = []
    for k, (lang, words) in enumerate(WORDS.items()):
        words = words.split()
        out += [(100 * k + i, " ".join(words[(i * 7 + j * 3) % len(words)] for j in range(12)), lang) for i in range(40)]
    return out


@pytest.fixture
def model(spark):
    return langid.train(spark.createDataFrame(rows(), "doc_id bigint, text string, lang string"), F.lit(True))


def test_filter_returns_exactly_the_languages_of_an_ngram(model):
    """Against plain sets of n-grams: no language is missed, and false ones stay at the chance the fill implies."""
    letters = langid._letters()
    sets = {}
    for lang in WORDS:
        counts = {}
        for _, text, own in rows():
            if own == lang:
                for value in np.unique(langid.grams([(0, langid.padded([text])[0])], letters)[0]).tolist():
                    counts[value] = counts.get(value, 0) + 1
        sets[lang] = {v for v, n in counts.items() if n >= 40 * langid.MIN_SHARE}
    values = np.array(sorted(set().union(*sets.values())), np.uint64)
    mask = np.full(len(values), ~np.uint64(0))
    for which in range(langid.HASHES):
        mask &= model.slots[0, langid.slots_of(values, which)]
    wrong = 0
    for value, bits in zip(values.tolist(), mask.tolist(), strict=True):
        for b, lang in enumerate(model.languages):
            assert value not in sets[lang] or bits >> b & 1
            wrong += value not in sets[lang] and bits >> b & 1
    assert wrong <= 2


def test_predictions_and_odd_texts(spark, model):
    odd = [(1, "The garden and the house"), (2, "Der Garten und das Haus"), (3, None), (4, ""), (5, "123 !!"), (6, "a"), (7, "zozo kaka"), (8, "ЖЖЖЖЖЖ"), (9, "the garden " * 40_000)]
    frame = spark.createDataFrame([(*r, "de", 1.0, "x") for r in [*odd, odd[0]]], "doc_id bigint, text string, lang string, score double, lang_pred string")
    out = langid.predict(frame, model).collect()
    found = {r["doc_id"]: r["lang_pred"] for r in out}
    assert len(out) == 10
    assert [found[i] for i in range(1, 6)] == ["en", "de", "und", "und", "und"]
    assert found[6] in WORDS and found[8] in WORDS and found[7] == "xx" and found[9] == "en"
    assert all(0 <= r["score"] <= 1 for r in out)
    assert langid.predict(frame.limit(0), model).collect() == []
    left = langid.keep_known(frame, model, 0.1)
    assert left.columns == frame.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 1, 2, 6, 7, 8, 9]


def test_more_languages_than_bits_in_a_word(spark):
    """Each of 200 languages has words of its own."""
    rows = [(8 * k + i, " ".join(f"{chr(0x4E00 + 40 * k + j)}{chr(0x4E00 + 40 * k + j + 1)}abc" for j in range(i, i + 12)), f"l{k:03}") for k in range(200) for i in range(8)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.train(frame, F.col("doc_id") % 8 < 6)
    assert len(model.languages) == 200 and model.slots.shape[0] == 4
    out = langid.predict(frame, model).join(frame.select("doc_id", "lang"), "doc_id").filter("doc_id % 8 >= 6")
    assert out.filter("lang = lang_pred").count() == 400


def test_parts_of_a_long_text_have_the_ngrams_of_the_whole():
    letters = langid._letters()
    text = langid.padded(["".join(chr(97 + i * i % 26) + (" " if i % 7 == 3 else "") for i in range(900)) + "İΣ"])
    whole = langid.grams([(0, text[0])], letters)[0]
    parts = [langid.grams(group, letters)[0] for group in segments([*text, *langid.padded(["ab", ""])], langid.GRAM - 1, 100)]
    short = langid.grams([(0, langid.padded(["ab"])[0])], letters)[0]
    assert sorted(np.concatenate(parts).tolist()) == sorted([*whole.tolist(), *short.tolist()])


def test_without_training_rows(spark):
    frame = spark.createDataFrame([(1, "abc", None)], "doc_id bigint, text string, lang string")
    model = langid.train(frame, F.lit(True))
    assert langid.predict(frame, model).first()["lang_pred"] == "und"


def test_segments_cover_each_ngram_once():
    text = "".join(chr(97 + i % 26) for i in range(1000))
    parts = [p for group in segments(["ab", text, ""], 3, 100) for i, p in group if i == 1]
    assert [p[k : k + 4] for p in parts for k in range(len(p) - 3)] == [text[k : k + 4] for k in range(997)]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    out = QUERIES["op5_langid"](spark, folder).join(truth, "doc_id")
    held = out.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count(F.lit(1))).first()
    assert held[1] > 150 and held[0] > 0.98
    assert out.filter(F.col("held_out") != (crc_remainder("doc_id", 4) == 2)).isEmpty()
