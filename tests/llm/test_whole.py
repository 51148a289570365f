"""Cases in which an operator once did less than the whole job."""

import random

import brute
import public_tokenizers
import pytest

import corpus_pipeline
from sedimenta.llm import chat, common, near_copies, simhash, token_files


def test_near_duplicates_of_the_pipeline(spark):
    """Copies with some words changed, against the similarity of all pairs."""
    rnd, texts = random.Random(7), []
    for _ in range(40):
        words = [f"w{rnd.randrange(5000)}" for _ in range(rnd.randint(30, 400))]
        texts.append(" ".join(words))
        for changes in (1, 2, 3, 6):
            own = list(words)
            for at in rnd.sample(range(len(own)), changes):
                own[at] = f"x{rnd.randrange(5000)}"
            texts.append(" ".join(own))
    texts += [texts[0].upper(), "", None, "too short", "Too  short"]
    label = brute.shingle_components(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == set(label)


def test_chat_rows_of_two_layouts(spark):
    """Turns and whole conversations in one table."""
    df = spark.createDataFrame(
        [(1, 0, "user", "Hi", None, None, None), (1, 1, "assistant", "Yo", None, None, None), (2, None, None, None, [("user", "a"), ("assistant", "b")], None, None), (3, None, None, None, None, "p", "q"), (4, 0, None, None, [], None, None), (5, 0, "user", "x", None, "extra", "extra")],
        "conv_id long, turn long, role string, text string, messages array<struct<role:string,content:string>>, prompt string, response string",
    )
    got = {r["key"]: [tuple(t) for t in r["turns"]] for r in chat.read_back(chat.chat(df)).collect()}
    assert got == {1: [("user", "Hi"), ("assistant", "Yo")], 2: [("user", "a"), ("assistant", "b")], 3: [("user", "p"), ("assistant", "q")], 4: [("", "")], 5: [("user", "x")]}


def test_chat_rows_that_fit_no_layout(spark):
    """One odd row costs no other conversation."""
    df = spark.createDataFrame(
        [(1, "Hi", "Yo", None), (2, "Hi", None, None), (3, None, None, []), (4, None, None, None), (5, "p", "q", [("user", "a"), ("assistant", "b")]), (6, None, "z", [("user", "c")]), (None, None, None, None)],
        "conv_id long, prompt string, response string, messages array<struct<role:string,content:string>>",
    )
    made = chat.chat(df, misfit="empty")
    got = {r["key"]: ([tuple(t) for t in r["turns"]], r["learnt"]) for r in chat.read_back(made).collect()}
    assert got == {1: ([("user", "Hi"), ("assistant", "Yo")], ["Yo"]), 2: ([("user", "Hi"), ("assistant", "")], [""]), 3: ([], []), 4: ([], []), 5: ([("user", "a"), ("assistant", "b")], ["b"]), 6: ([("user", "c")], []), None: ([], [])}


@pytest.mark.parametrize("radius", [2, None])
def test_an_id_in_two_components(spark, radius):
    """Rows of one id, one a copy of another document and one with a text of its own; ids as text; rows without an id."""
    one_of_each = lambda df: simhash.one_of_each(df, radius, 3 if radius else 5)
    text = lambda k: " ".join(f"w{k}x{j}" for j in range(30))
    rows = [x for k in range(30) for x in ((1000 + k, text(2 * k)), (k, text(2 * k)), (1000 + k, text(2 * k + 1)))]
    kept = one_of_each(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == sorted(x for x in rows if x != (x[0], text(2 * (x[0] - 1000))))
    rows = [("a", text(1), 1), ("b", text(1).upper(), 2), (None, text(1), 3), (None, None, 4), ("c", None, 5), ("d", " ", 6), ("e", text(2), 7), ("e", text(3), 8), ("e", text(3), 8)]
    kept = one_of_each(spark.createDataFrame(rows, "doc_id string, text string, h long").repartition(4)).collect()
    assert sorted(r["h"] for r in kept) == [1, 3, 4, 5, 7, 8]


@pytest.mark.parametrize("most", [300, 10**6])
def test_near_copies_in_large_buckets(spark, most):
    """Chains of edits, in which the first of a bucket doesn't reach all, against all pairs."""
    rnd, texts = random.Random(3), []
    for k in range(3):
        words = [f"c{k}w{j}" for j in range(60)]
        for _ in range(40):
            words[rnd.randrange(60)] = f"x{rnd.randrange(100)}"
            texts.append(" ".join(words))
    label = brute.shingle_components(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert {r["doc_id"] for r in near_copies.one_of_each(docs, most=most).collect()} == set(label)


def test_lookup_of_an_id_in_several_parts(spark):
    word, path = public_tokenizers.path("word_bpe_49k.json"), common.shared_path(spark, "t")
    rows = [(k, f"single {k}") for k in range(100, 130)] + [(7, f"repeat {k}") for k in range(40)] + [(k, "first") for k in range(5)]
    was = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_files.write(spark.createDataFrame(rows, "doc_id long, text string"), path, word, shard_bytes=60)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was)
    assert spark.read.parquet(path).where("first_id <= 7 and last_id >= 7").select("part").distinct().count() > 1
    got = [token_files.lookup(spark, path, 7, k) for k in range(40)]
    assert sorted(got) == sorted([*brute.ids("word_bpe_49k.json", f"repeat {k}"), 1] for k in range(40))
    assert token_files.lookup(spark, path, 7, 40) is None
