"""Language and toxicity models: held-out accuracy, boundaries and the counterfactual penalty."""

import itertools
import math
import pickle
import re
import tracemalloc
from collections import Counter

import pytest
from fixtures_llm import documents
from pyspark.sql import functions as F

from plumbline.llm import catalog, language_id, toxicity

FOLDER = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = catalog.queries()["op2_language_id"](spark, FOLDER).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(truth) and len(held) > 100
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_without_letters_or_labels(spark):
    train = documents(spark, [(i, "the house is the home" if i % 2 else "das haus ist das heim", "en" if i % 2 else "de", "s") for i in range(40)])
    model = language_id.learn(train)
    assert model.languages == ["de", "en"]
    assert model.predict(None) == ("und", 0.0) and model.predict(" 12 !") == ("und", 0.0)
    assert model.predict("THE House")[0] == "en" and model.predict("dashaus")[0] == "de"
    bare = language_id.learn(documents(spark, [(1, "text", None, None), (2, None, "en", None)]))
    assert bare.predict("text") == ("und", 0.0)


def test_language_does_not_read_held_out_rows(spark):
    rows = documents(spark, [(i, "abc", f"l{i}", "s") for i in range(60)])
    held = {r["lang"] for r in rows.where(language_id.held_out(F.col("doc_id"))).collect()}
    assert held and not held & set(language_id.learn(rows).languages)


def test_toxicity_of_held_out_documents(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = catalog.queries()["op3_toxicity"](spark, FOLDER).collect()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(rows) == len(texts)
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in held) / len(held) > 0.9
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)


def _identity_sample(spark):
    # Toxic examples happen to name one group more often than harmless ones do.
    texts, labels = [], []
    for i in range(400):
        bad = i % 2
        group = "women" if i % 10 < (8 if bad else 2) else "men"
        texts.append((i, f"the {group} next door are {'horrid trash' if bad and i % 3 else 'kind people'} number{i % 7}", "en", "s"))
        labels.append((i, bad))
    return documents(spark, texts), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_swapped_groups_score_alike(spark):
    docs, labels = _identity_sample(spark)
    gap = {}
    for strength in (0.0, 4.0):
        model = toxicity.learn(docs, labels, fairness=strength)
        gap[strength] = abs(model.score("the women next door") - model.score("the men next door"))
        assert model.score("horrid trash") > 0.5 > model.score("kind people")
    assert gap[4.0] < 0.25 * gap[0.0]


@pytest.mark.parametrize("toxic", [0, 1])
def test_one_class_only(spark, toxic):
    docs = documents(spark, [(i, "some text", "en", "s") for i in range(20)])
    labels = spark.createDataFrame([(i, toxic) for i in range(20)], "doc_id bigint, toxic int")
    model = toxicity.learn(docs, labels)
    assert abs(model.score("anything") - toxic) < 0.01 and abs(model.score(None) - toxic) < 0.01


def test_numerals_are_no_letters_and_marks_belong_to_words():
    assert language_id.words_of("½ ² ①② Ⅷ 12 _") == []
    assert language_id.words_of("नमस्ते दुनिया") == ["नमस्ते", "दुनिया"]
    assert language_id.words_of("étude naïve x²y ab1c") == ["étude", "naïve", "x", "y", "ab", "c"]


def test_texts_without_a_letter_are_undetermined(spark):
    docs = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(["½ ²", "①②", "Ⅷ", None, "", "12 !?"])], "doc_id bigint, text string, lang string, source string")
    model = language_id.learn(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert {r["lang_pred"] for r in language_id.identify(docs, model).collect()} == {"und"}


def test_more_languages_than_the_bound_are_an_error(spark):
    rows = documents(spark, [(i, f"w{i} abc", f"l{i % 9}", "s") for i in range(200)])
    with pytest.raises(ValueError, match="languages"):
        language_id.learn(rows, languages=8)
    assert len(language_id.learn(rows, languages=9).languages) == 9


def test_each_language_has_its_own_words(spark):
    # A frequent language must not crowd out the words of a rare one.
    rows = [(i, " ".join(f"aa{chr(98 + j)}{chr(98 + i % 20)}" for j in range(20)), "big", "s") for i in range(400)]
    rows += [(1000 + i, "zuq zuq vox", "rare", "s") for i in range(30)]
    model = language_id.learn(documents(spark, rows), words=2, grams=50)
    assert {"zuq", "vox"} <= set(model.words) and len(model.words) == 4


def test_language_against_direct_counting(spark):
    """Scores by counting in plain Python over all rows of a small set, without bounds."""
    rows = [(i, t, lang, "s") for i, (lang, t) in enumerate([("de", "das haus am see"), ("en", "the house at sea"), ("fr", "la maison au lac"), ("de", "der see"), ("en", "the sea")] * 8)]
    train = documents(spark, rows)
    kept = [(r["lang"], r["text"]) for r in train.where(~language_id.held_out(F.col("doc_id"))).collect()]
    languages = sorted({lang for lang, _ in kept})
    words = {lang: Counter(w for x, t in kept if x == lang for w in t.split()) for lang in languages}
    grams = {(lang, n): Counter() for lang in languages for n in range(1, 6)}
    for lang in languages:
        for w, count in words[lang].items():
            for n in range(1, 6):
                for i in range(len(w) - n + 1):
                    grams[lang, n][w[i : i + n]] += count

    def scores(word):
        if any(word in words[x] for x in languages):
            return [math.log((words[x][word] + 0.5) / (sum(words[x].values()) + 1000)) for x in languages]
        total, i, pieces = [0.0] * len(languages), 0, 0
        while i < len(word):
            n = next((n for n in range(min(5, len(word) - i), 0, -1) if any(word[i : i + n] in grams[x, n] for x in languages)), 0)
            piece = [math.log((grams[x, n][word[i : i + n]] + 0.5) / (sum(grams[x, n].values()) + 1000)) if n else -12.0 for x in languages]
            total, i, pieces = [a + b for a, b in zip(total, piece)], i + max(n, 1), pieces + 1
        return [t / pieces for t in total]

    texts = ["Das Haus", "the seahouse", "lac lac maisonette", "see sea", "zzz qqq", "au 12 at", "hausboot am lac"]
    got = {r["doc_id"]: r for r in language_id.identify(documents(spark, list(enumerate(texts))), language_id.learn(train)).collect()}
    for i, text in enumerate(texts):
        each = [scores(w) for w in re.findall("[a-z]+", text.lower())]
        mean = [round(sum(x) / len(each), 9) * min(len(each), language_id.EVIDENCE) for x in zip(*each)]
        share = 1 / sum(math.exp(m - max(mean)) for m in mean)
        assert abs(got[i]["score"] - share) < 1e-5
        assert mean[languages.index(got[i]["lang_pred"])] >= max(mean) - 1e-5


def test_a_worker_needs_little_memory_for_languages(spark):
    """Bytes in memory for each name of a model as a worker loads it, and for each unknown word it has judged."""
    words = ["".join(w) for w in itertools.product("abcdefghijklmnopqrst", repeat=4)][:40_000]
    texts = [" ".join(words[i::80]) for i in range(80)]
    model = language_id.learn(documents(spark, [(i, t, f"l{i % 4}", "s") for i, t in enumerate(texts)]))
    names = len(model.words) + len(model.grams)
    assert names > 40_000
    sent = pickle.dumps(model)
    del model
    tracemalloc.start()
    try:
        model = pickle.loads(sent)
        loaded = tracemalloc.get_traced_memory()[0]
        for i in range(100):
            model.predict(" ".join(f"{w}{chr(97 + i % 26)}zy" for w in words[400 * i : 400 * (i + 1)]))
        kept = tracemalloc.get_traced_memory()[0] - loaded
    finally:
        tracemalloc.stop()
    assert loaded < 220 * names
    assert kept < 100_000
