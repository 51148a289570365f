"""The opN queries over the smallest tables, each against its plain version."""

import hashlib
import os
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

import brute
from sedimenta.llm import queries, url_filter

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="needs the test tables")


def rows(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


def run(spark, name):
    return [r.asDict() for r in queries.queries()[name](spark, SF).collect()]


def test_token_counts(spark):
    want = {d["doc_id"]: (len((d["text"] or "").encode()), len(brute.ids("byte_bpe_50k.json", d["text"]))) for d in rows("documents")}
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in run(spark, "op1_token_counts")}
    assert got == want
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in run(spark, "op1_token_counts"))


def test_simhash(spark):
    prints = {d["doc_id"]: brute.fingerprint(d["text"]) for d in rows("documents")}
    label = brute.components(prints)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in run(spark, "op2_simhash")}
    assert got == {i: (f"{f:016x}", label[i]) for i, f in prints.items()}


def test_packing(spark):
    got, at = run(spark, "op3_packing"), defaultdict(list)
    docs = {d["doc_id"]: [*brute.ids("byte_bpe_50k.json", d["text"]), 0] for d in rows("documents")}
    seen = defaultdict(int)
    for r in sorted(got, key=lambda r: (r["doc_id"], r["piece"])):
        own = docs[r["doc_id"]]
        assert r["start"] == seen[r["doc_id"]] and r["ids_crc32"] == brute.crc(own[r["start"] : r["start"] + r["length"]])
        assert r["length"] == 2048 or r["piece"] == 0
        seen[r["doc_id"]] += r["length"]
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    assert seen == {i: len(x) for i, x in docs.items()}
    for own in at.values():
        end = 0
        for a, n in sorted(own):
            assert a == end
            end += n
        assert end <= 2048
    assert len(at) <= -(-sum(map(len, docs.values())) // 2048) + 1


def test_quality(spark):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = {r["doc_id"]: r for r in run(spark, "op4_quality")}
    docs = {d["doc_id"]: d["text"] for d in rows("documents")}
    assert {i: tuple(r[x] for x in names) for i, r in got.items()} == {i: brute.base(t) for i, t in docs.items()}
    assert not any(r["kept"] and r["base_failed"] for r in got.values())
    labels = [r for r in rows("labels") if r["doc_id"] in got and not got[r["doc_id"]]["base_failed"]]
    assert sum(got[r["doc_id"]]["kept"] for r in labels if r["quality"] == 1) >= 0.97 * sum(r["quality"] == 1 for r in labels)


def test_chat(spark):
    want, turns = {}, defaultdict(list)
    for r in rows("conversations"):
        turns[r["conv_id"]].append((r["turn"], r["role"] or "", r["text"] or ""))
    turns[-1] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    for i, own in turns.items():
        own.sort()
        learnt = "".join(t for _, r, t in own if r == "assistant")
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want[i] = (len(own), sha("".join(f"{r}\n{t}\n" for _, r, t in own)), len(learnt), sha(learnt))
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in run(spark, "op6_chat")} == want


def test_urls(spark):
    want = {r["page_id"]: brute.url(r["url"], url_filter.STRICT, url_filter.SOFT) for r in rows("pages")}
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in run(spark, "op7_urls")} == want


def test_token_files(spark):
    want, at = {}, 0
    for d in sorted(rows("documents"), key=lambda d: d["doc_id"]):
        own = [*brute.ids("word_bpe_49k.json", d["text"]), 1]
        want[d["doc_id"]] = (at, len(own), brute.crc(own))
        at += len(own)
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in run(spark, "op8_token_files")} == want


def test_decontamination(spark):
    items = [(r["item_id"], r["text"]) for r in rows("benchmark")]
    want = {d["doc_id"]: brute.contamination(d["text"], items) for d in rows("documents")}
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in run(spark, "op9_decontamination")}
    assert got == want and any(x[4] for x in want.values())


def test_lm_scores(spark):
    docs = rows("documents")
    want = dict(zip([d["doc_id"] for d in docs], brute.lm([d["text"] for d in docs]), strict=True))
    got = {r["doc_id"]: r["log_score"] for r in run(spark, "op10_lm_scores")}
    assert got.keys() == want.keys() and all(abs(got[i] - x) < 1e-3 for i, x in want.items())


def test_pipeline(spark):
    """Each stage's plain version, on what the one before it kept: near copies are five-word shingle sets of similarity 0.8 or more. The forest's verdicts
    come from the operator, one document at a time."""
    from sedimenta.llm import quality

    docs = {d["doc_id"]: d["text"] for d in rows("documents")}
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit_on_labels(frame, spark.read.parquet(f"{SF}/labels.parquet"))
    import numpy as np

    kept = {i: t for i, t in docs.items() if not brute.base(t)[5] and model.scores(np.array([quality.statistics(t)[1]]))[0] <= model.threshold}
    names = sorted(kept)
    label = {i: names[k] for i, k in zip(names, brute.shingle_components([kept[i] for i in names]), strict=True)}
    items = [(r["item_id"], r["text"]) for r in rows("benchmark")]
    left = {i: t for i, t in kept.items() if label[i] == i and not brute.contamination(t, items)[4]}
    got = run(spark, "pipeline")
    want = {i: [*brute.ids("byte_bpe_50k.json", t), 0] for i, t in left.items()}
    assert {r["doc_id"] for r in got} == set(want)
    assert all(r["ids_crc32"] == brute.crc(want[r["doc_id"]][r["start"] : r["start"] + r["length"]]) for r in got)
    assert all(brute.crc(np.frombuffer(r["ids"], "<u4")) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in got)
    assert sum(r["length"] for r in got) == sum(map(len, want.values()))
