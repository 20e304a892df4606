import random

from chronopitch.llm import languages

WORDS = {
    "en": "the crowd never stopped singing while their keeper should have been sent off and nobody at the ground expected that".split(),
    "de": "die zuschauer sangen ohne pause weiter und der torwart hielt alles was danach noch kam niemand hatte das erwartet".split(),
    "pl": "kibice nie przestawali śpiewać a bramkarz obronił wszystko co przyszło później nikt się tego nie spodziewał wczoraj".split(),
}


def sentence(lang, n=9):
    return " ".join(random.choice(WORDS[lang]) for _ in range(n)).capitalize() + "."


def corpus(spark):
    random.seed(6)
    rows = []
    for i in range(240):
        lang = ["en", "de", "pl"][i % 3]
        label = {"en": ["en", "English", " en", "en_GB", "eng"], "de": ["de", "German", "DEU"], "pl": ["pl", "Polish"]}[lang]
        rows.append((i, " ".join(sentence(lang) for _ in range(4)), "de" if i % 24 == 0 else random.choice(label), "x"))
    rows += [
        (900, f"{sentence('en')} {sentence('en')} — „{sentence('de')} {sentence('de')}“ {sentence('en')}", "en", "x"), (901, sentence("pl"), None, "x"), (902, sentence("de"), "??", "x"), (903, sentence("en"), "pl", "x"), (904, None, "en", "x"),
        (905, "", None, "x"), (906, "12' 44' 3-1 ##", None, "x"), (907, "a" * 5000, "en", "x"), (908, sentence("de").upper(), "de", "x"), (909, sentence("pl") + " " + "ha" * 3000 + " &amp; {\"xg\":0.3}", "pol", "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, label string")


def test_labels():
    assert [languages.label_code(x) for x in ("en", " EN", "en-GB", "German", "deu", "Français", "mul", "und", "xx", "", None, "n/a")] == ["en", "en", "en", "de", "de", "fr", None, None, None, None, None, None]


def test_segments_and_wrong_labels(spark):
    docs = corpus(spark)
    known = languages.fit(docs)
    found = languages.language_segments(docs, known)
    rows = {}
    for r in found.collect():
        rows.setdefault(r["doc_id"], []).append((r["seg_no"], r["lang"]))
        assert 0.5 <= r["confidence"] <= 1
    assert all(rows[i] == [(1, ["en", "de", "pl"][i % 3])] for i in range(240))
    assert rows[900] == [(1, "en"), (2, "de"), (3, "en")] and rows[901] == [(1, "pl")] and rows[908] == [(1, "de")] and rows[909] == [(1, "pl")]
    assert not {904, 905, 906, 907} & set(rows)
    wrong = {r["doc_id"] for r in languages.mislabelled(found).collect()}
    assert wrong == {900, 901, 902, 903} | {i for i in range(0, 240, 24) if i % 3 != 1}
    assert languages.language_segments(docs.limit(0), known).count() == 0


def test_the_filter_has_every_language_of_an_ngram():
    import numpy as np

    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    i = np.arange(20_000)
    rates = np.stack([i % 2, (i // 2) % 2, np.ones_like(i)], 1).astype(float)
    known = languages.build_filter(hashes, rates, ["a", "b", "c"])
    mask = np.full(len(hashes), 2**64 - 1, np.uint64)
    for slot in languages.slots(hashes):
        mask &= known.masks[slot]
    bits = np.stack([(mask >> np.uint64(k)) & np.uint64(1) for k in range(3)], 1) == 1
    assert bits[rates > 0].all() and bits[rates == 0].mean() < 0.01


def test_ngrams_of_many_words_are_those_of_each():
    """Against a plain loop: whole words of any length, each n-gram once, counts by slice against the masks."""
    import numpy as np

    random.seed(3)
    words = ["".join(random.choice("abcé") for _ in range(random.randrange(0, 60))) for _ in range(200)] + ["ha" * 3000, "", "a"]
    where, hashes = languages.grams(words)
    for k, w in enumerate(words):
        edged = f"_{w}_"
        plain = {edged[i : i + n] for n in (3, 4) for i in range(len(edged) - n + 1)}
        alone = languages.grams([w])
        assert (where == k).sum() == len(plain) + 1 == len(alone[1])
        assert set(hashes[where == k]) == set(alone[1])
    known = languages.build_filter(hashes[::2], np.ones((len(hashes[::2]), 1)), ["x"])
    counted = known.counts(words)
    assert (known.counts(words[::-1])[::-1] == counted).all() and (counted[:, 0] == counted[:, 1]).all()
    assert all(counted[k, 0] >= (where[::2] == k).sum() for k in range(len(words)))


def test_a_language_that_only_wrong_labels_name_is_left_out(spark):
    random.seed(9)
    rows = [(i, " ".join(sentence(["en", "de", "pl"][i % 3]) for _ in range(4)), "fi" if i % 20 == 0 else ["en", "de", "pl"][i % 3]) for i in range(300)]
    rows += [(1000, sentence("en", 3), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = languages.fit(docs)
    assert known.languages == ["de", "en", "pl"]
    short = [tuple(r) for r in languages.language_segments(docs.where("doc_id = 1000"), known).select("seg_no", "lang").collect()]
    assert short == [(1, "en")]
