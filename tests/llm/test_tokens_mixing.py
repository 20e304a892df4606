import random

import pytest

from chronopitch.llm import mixing, tokens

TEXTS = ["", None, " ", "a", "the cat", "naïve café — 北京 😀", "x" * 3000, "ab" * 2000, "hello\n\n  world\t!!", "don't we'll I'm", "12345 67,890.12", "<|endoftext|> stays text", " ​", "ﬁ Ⅻ ½"]


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(tokens.read_ranks(tokens.vocabulary_file()))


def test_ids_are_the_public_tokenizer_s(encoder):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    theirs = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    theirs.encode_special_tokens = True
    random.seed(4)
    letters = "abcdefghij ABC éßñ 0123 .,!?'\n"
    texts = TEXTS + ["".join(random.choice(letters) for _ in range(random.randrange(1, 400))) for _ in range(300)]
    for text, own in zip(texts, theirs.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        assert encoder.encode(text) == own.ids


def test_ids_decode_to_the_text(encoder):
    back = {i: word for word, i in encoder.ranks.items()}
    for text in TEXTS:
        assert b"".join(back[i] for i in encoder.encode(text)).decode() == (text or "")


def test_encoded_tables(spark):
    docs = spark.createDataFrame([(1, "the cat", "clash", 5), (2, None, "c", 6), (3, "", "c", 7)], "doc_id long, text string, ids string, extra int")
    rows = {r["doc_id"]: r for r in tokens.encoded(docs, count="n").collect()}
    assert rows[1]["ids"] == [1169, 3797] and rows[1]["n"] == 2 and rows[1]["extra"] == 5
    assert rows[2]["ids"] == [] == rows[3]["ids"] and rows[2]["n"] == 0
    assert tokens.encoded(docs.limit(0)).count() == 0


def test_water_filling():
    assert mixing.water_fill({"a": 0.5, "b": 0.5}, {"a": 100.0, "b": 10.0}, 60.0) == {"a": 50.0, "b": 10.0}
    got = mixing.water_fill({"a": 0.6, "b": 0.3, "c": 0.1}, {"a": 20.0, "b": 100.0, "c": 100.0}, 80.0)
    assert got == {"a": 20.0, "b": pytest.approx(45.0), "c": pytest.approx(15.0)}
    assert sum(mixing.water_fill({"a": 0.5, "b": 0.5}, {"a": 5.0, "b": 5.0}, 60.0).values()) == 10.0
    assert mixing.water_fill({"a": 1.0, "b": 0.0}, {"a": 5.0}, 3.0) == {"a": 3.0, "b": 0.0}


def test_mix(spark):
    random.seed(1)
    rows = [(i, "Big-Source " if i % 3 else "small", random.randrange(1, 30)) for i in range(900)] + [(2000, None, 5), (2001, "other", 500), (2002, "small", 0), (2003, "small", None)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("big_source", 0.5, 1, 0.5), ("small", 0.3, 2, 0.5), ("nowhere", 0.2, 3, 0.5)], "source string, target_share double, max_repeats int, budget_ratio double")
    mixed, shares = mixing.mix(sized, targets)
    got = mixed.collect()
    assert len({r["doc_id"] for r in got}) == len(got) and {r["source"] for r in got} == {"big_source", "small"}
    assert all(1 <= r["repeats"] <= (1 if r["source"] == "big_source" else 2) for r in got)
    total = sum(n or 0 for _, s, n in rows if s)
    size = {s: sum(r["repeats"] * r["n_tokens"] for r in got if r["source"] == s) for s in ("big_source", "small")}
    want = mixing.water_fill({"big_source": 0.5, "small": 0.3, "nowhere": 0.2}, {"big_source": float(sum(n for _, s, n in rows if s == "Big-Source ")), "small": 2.0 * sum(n or 0 for _, s, n in rows if s == "small")}, 0.5 * (total + 5))
    assert all(want[s] - 30 <= size[s] <= want[s] for s in size)
    report = {r["source"]: r for r in shares.collect()}
    assert report["nowhere"]["tokens"] == 0 and sum(r["actual_share"] for r in report.values()) == pytest.approx(1.0)
    assert sorted(map(tuple, mixing.mix(sized, targets)[0].collect())) == sorted(map(tuple, got))
    assert mixing.mix(sized.limit(0), targets)[0].count() == 0


def test_shares_come_within_one_small_document(spark):
    """The rest of a source is filled to the document that brings it nearest; many sources without a target only count."""
    rng = random.Random(5)
    rows = [(i, "a", rng.randrange(1, 900)) for i in range(400)] + [(1000 + i, "b", rng.randrange(1, 50)) for i in range(400)] + [(5000 + i, f"other {i}", 2) for i in range(500)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("a", 0.7, 2, 0.25), ("b", 0.3, 1, 0.25)], "source string, target_share double, max_repeats int, budget_ratio double")
    for seed in range(3):
        out, report = mixing.mix(sized, targets, seed)
        total = sum(r[2] for r in rows) * 0.25
        for r in report.collect():
            assert abs(r["tokens"] - r["feasible_share"] * total) <= 12, r
        assert out.groupBy("doc_id").count().where("count > 1").count() == 0
