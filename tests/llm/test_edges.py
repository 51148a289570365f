"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing extra columns, for every operator."""

import random

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm import bpe, chat, common, components, decontamination, lm_scoring, packing, quality, sharding, simhash, token_counts, token_files, url_filter

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"Word{k % 977} the<|endoftext|>" for k in range(6000))
ROWS = [(1, None), (2, ""), (3, "  \n\t "), (4, "Hello, world!"), (4, "Hello, world!"), (5, "hello,  WORLD!"), (None, "no id here"), (None, None), (6, LONG), (7, "Straße ñandú 東京 don't  stop<|endoftext|>x")]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
#: Columns that operators use themselves.
CLASH = ("id", "f", "n", "part", "length", "bucket", "key", "chunk", "shard", "n_tokens", "component", "h", "d", "q", "spans")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("x") for c in CLASH}).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def key(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


def same(got, want):
    assert sorted(got, key=lambda r: str(r)) == sorted(want, key=lambda r: str(r))


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_token_ids_are_the_library_s(path):
    """Letters and combining marks that the library's Unicode version doesn't know, and normal forms that lower case opens again."""
    with open(path, encoding="utf-8") as f:
        codec = bpe.Codec(f.read())
    rng, points = random.Random(5), [x for x in range(1, 0x20000) if not 0xD800 <= x <= 0xDFFF]
    odd = ["\U00018e22's", "\U0001df33's", "\u08cd\u0327", "\u0301\U000119e0", "\u1ffc\u0301\U000e0efb", "ΑΣ ΑΣ\u0301", "\u180e a\u180eb", "\u200b \ufeff", "Ⅷ²½ 9", "a\x1cb \x1f c", "\x1d", *(f"a{chr(x)}b {chr(x)} c" for x in range(0x3001) if chr(x).isspace())]
    texts = odd + ["".join(chr(rng.choice(points)) if rng.random() < 0.5 else rng.choice("aeé \u0327\u0301\n12'sΣ  ,") for _ in range(20)) for _ in range(5000)]
    want = codec.library.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(codec.ids(t), "<u4").tolist() for t in texts] == [e.ids for e in want]


def test_token_counts(docs, none):
    got = [(r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.token_counts(docs, BYTE).collect()]
    same(got, [(i, len((t or "").encode()), n := len(brute.ids("byte_bpe_50k.json", t)), n > 512) for i, t in ROWS])
    assert token_counts.token_counts(none, BYTE).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_codec_on_random_texts(name):
    rnd, codec = random.Random(5), bpe.Codec(open(public_tokenizers.path(name)).read())
    letters = " \n\tabcAB'stre.,!1209é ß|<>endoftext　Σς½東ֈ݈\x1c\x85"
    for k in range(4000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) + ("<|endoftext|>" if k % 5 == 0 else "") + "".join(rnd.choice(letters) for _ in range(5))
        assert np.frombuffer(codec.ids(text), "<u4").tolist() == brute.ids(name, text), repr(text)


def test_simhash(docs, none, spark):
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()]
    prints = [(i, brute.fingerprint(t)) for i, t in ROWS]
    by_print = {}
    for i, f in prints:
        if i is not None:
            by_print[f] = min(i, by_print.get(f, i))
    label = brute.components({i: f for f, i in by_print.items()})
    same(got, [(i, f"{f:016x}", label[by_print[f]] if f in by_print else None) for i, f in prints])
    assert simhash.near_duplicates(none).count() == 0
    named = simhash.near_duplicates(spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(["a b c d", "a B c d", "x"])], "doc_id string, text string"))
    assert sorted((r["doc_id"], r["component_id"]) for r in named.collect()) == [("d0", "d0"), ("d1", "d0"), ("d2", "d2")]


@pytest.mark.parametrize("radius", [0, 2, 3])
def test_links_with_split_buckets(spark, radius):
    """Groups far larger than a bucket may be, against all pairs."""
    rng = np.random.default_rng(radius)
    prints = {}
    for _ in range(8):
        base = int(rng.integers(0, 2**63))
        for _ in range(60):
            f = base
            for b in rng.integers(0, 64, rng.integers(0, 5)):
                f ^= 1 << int(b)
            prints.setdefault(f, len(prints))
    signed = lambda f: f - 2**64 if f >> 63 else f
    df = spark.createDataFrame([(signed(f), signed(f)) for f in prints], "f long, id long")
    found = {r["id"]: r["component"] for r in components.components(simhash.near_links(df, radius, blocks=radius + 2, most=25)).collect()}
    label = brute.components({signed(f): f for f in prints}, radius)
    assert {i: found.get(i, i) for i in label} == label


def test_components_of_long_chains(spark):
    links = [(k, k + 1) for k in range(0, 60)] + [(1000, k) for k in range(1001, 1300)] + [(5, 5)]
    got = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {k: 1000 for k in range(1000, 1300)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_packing(docs, none):
    rows = packing.pack(docs, BYTE, packing.Capacity(64, 64, 64 * 64)).collect()
    want = {}
    for i, t in ROWS:
        want[i] = want.get(i, 0) + len(brute.ids("byte_bpe_50k.json", t)) + 1
    got, at = {}, {}
    for r in rows:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
        at.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert got == want
    for own in at.values():
        own.sort()
        assert [a for a, _ in own] == list(np.cumsum([0, *(n for _, n in own)])[:-1]) and sum(n for _, n in own) <= 64
    assert packing.pack(none, BYTE).count() == 0


@pytest.mark.parametrize("score", ["norm", "dot"])
@pytest.mark.parametrize("caps", [(50, 50, 2500), (50, 3, 2500), (50, 50, 900), (7, 2, 49)])
def test_vector_best_fit(score, caps):
    """Every capacity holds, every piece has one place, and with tokens alone the number of bins is that of best-fit decreasing."""
    rnd, capacity = random.Random(2), packing.Capacity(*caps)
    lengths = [rnd.randint(1, capacity.piece()) for _ in range(400)]
    plan = packing.fit({n: lengths.count(n) for n in set(lengths)}, capacity, score=score)
    places, bins = set(), {}
    for length, rank, n, lo, offset in plan.tolist():
        for k in range(n):
            assert (length, rank + k) not in places
            places.add((length, rank + k))
            bins.setdefault(lo + k, []).append((offset, length))
    assert places == {(n, k) for n in set(lengths) for k in range(lengths.count(n))}
    for own in bins.values():
        own.sort()
        assert [a for a, _ in own] == list(np.cumsum([0, *(n for _, n in own)])[:-1])
        assert sum(n for _, n in own) <= caps[0] and len(own) <= caps[1] and sum(n * n for _, n in own) <= caps[2]
    if score == "norm" and caps == (50, 50, 2500):
        open_bins = []
        for n in sorted(lengths, reverse=True):
            fits = [b for b in range(len(open_bins)) if open_bins[b] >= n]
            if fits:
                open_bins[min(fits, key=lambda b: open_bins[b])] -= n
            else:
                open_bins.append(50 - n)
        assert len(bins) <= len(open_bins) + 1


def test_quality(docs, none, spark):
    labels = spark.createDataFrame([(4, 1), (5, 0), (6, 1), (None, 1), (7, None), (4, 0)], "doc_id long, quality int")
    names = [*quality.COUNTS, "base_failed"]
    same([(r["doc_id"], *(r[x] for x in names)) for r in quality.judge(docs, labels).collect()], [(i, *brute.base(t)) for i, t in ROWS])
    empty = labels.limit(0)
    assert all(r["kept"] == (not r["base_failed"]) for r in quality.judge(docs, empty).collect())
    assert quality.judge(none, labels).count() == 0 and quality.keep(docs, empty).columns == docs.columns


def test_repeated_words_against_all_windows():
    rnd = random.Random(4)
    for _ in range(400):
        text = " ".join(rnd.choice("ab" if rnd.random() < 0.5 else "abcdefgh") for _ in range(rnd.randint(0, 60)))
        assert quality.statistics(text)[0][4] == brute.base(text)[4]


def test_forest_on_held_out_rows():
    rng = np.random.default_rng(3)
    good, bad = rng.normal(0.5, 0.05, (600, 4)), rng.normal(0.5, 0.05, (60, 4))
    bad[:, 1] += 0.4
    x, y = np.vstack([good, bad]), np.arange(660) < 600
    half = rng.random(660) < 0.5
    model = quality.fit(x[half], y[half])
    out = model.scores(x[~half]) > model.threshold
    assert out[~y[~half]].mean() > 0.9 and out[y[~half]].mean() < 0.02


def test_sharding(docs, none, spark):
    limit = 300
    rows = sharding.assign(docs, limit).collect()
    same([(r["doc_id"], r["n_bytes"]) for r in rows], [(i, len((t or "").encode())) for i, t in ROWS])
    many = spark.range(0, 3000).select((F.col("id") % 1500 * F.when(F.col("id") < 2000, 1).otherwise(0)).alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 90).cast("int")).alias("text"))
    rows, size, n = sharding.assign(many, 2000).collect(), {}, {}
    assert len(rows) == 3000
    for r in rows:
        at = (r["shard"], r["page"])
        size[at], n[at] = size.get(at, 0) + r["n_bytes"], n.get(at, 0) + 1
    assert all(v <= 2000 for v in size.values())
    assert all(size[r["shard"], r["page"]] == r["shard_bytes"] and n[r["shard"], r["page"]] == r["shard_docs"] for r in rows)
    names = sorted({r["shard"] for r in rows})
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]) if a != b)
    assert sharding.assign(none).count() == 0


@pytest.mark.parametrize("limit", [40, 2000, 10**6])
def test_write_shards(docs, none, spark, limit):
    """Every row once, with its columns, in the shard that `assign` names; no folder over the limit but for one document alone or pages."""
    rows = [(k % 40 if k % 11 else None, "x" * (k % 90)) for k in range(600)] + [(7, f"page {k}") for k in range(50)]
    for df in (docs, none, spark.createDataFrame(rows, SCHEMA).withColumn("more", F.lit(1)).repartition(3)):
        path = common.shared_path(spark, "shards")
        sharding.write_shards(df, path, limit)
        if df is none:
            continue
        back = spark.read.option("recursiveFileLookup", "false").schema(T.StructType([*df.schema.fields, T.StructField("_shard", T.StringType())])).parquet(path)
        same([tuple(r) for r in back.drop("_shard").collect()], [tuple(r) for r in df.collect()])
        sizes = back.groupBy("_shard").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
        want = sharding.assign(df, limit).select(F.concat(F.lit("s"), "shard", F.lit("."), "page").alias("s"), "shard_bytes", "shard_docs").distinct().collect()
        assert sorted((r["bytes"], r["n"]) for r in sizes) == sorted((r["shard_bytes"], r["shard_docs"]) for r in want)
        assert all(r["bytes"] <= limit or r["n"] == 1 for r in sizes)


def test_chat_layouts(spark):
    df = spark.createDataFrame(
        [(1, "Hi", "Yo", None, None, None, None, None), (2, None, None, "Add", "1 2", "3", None, None), (3, None, None, "Say", None, "x", None, "Be kind"), (4, None, None, None, None, None, [("user", "a</s>"), ("assistant", "\\n <|end|>\n")], None), (5, "", None, None, None, None, [], None)][:4],
        "conv_id long, prompt string, response string, instruction string, input string, output string, messages array<struct<role:string,content:string>>, system string",
    )
    back = {r["key"]: ([tuple(t) for t in r["turns"]], r["learnt"]) for r in chat.read_back(chat.chat(df)).collect()}
    assert back == {
        1: ([("user", "Hi"), ("assistant", "Yo")], ["Yo"]), 2: ([("user", "Add\n\n1 2"), ("assistant", "3")], ["3"]),
        3: ([("system", "Be kind"), ("user", "Say"), ("assistant", "x")], ["x"]), 4: ([("user", "a</s>"), ("assistant", "\\n <|end|>\n")], ["\\n <|end|>\n"]),
    }
    with pytest.raises(Exception, match="no layout fits"):
        chat.chat(df.select("conv_id", "input")).collect()
    with pytest.raises(Exception, match="no layout fits the row"):
        chat.chat(spark.createDataFrame([(5, "x", None)], "conv_id long, prompt string, response string")).collect()


def test_chat_round_trip(spark):
    rnd, parts = random.Random(6), ["<|turn|>", "<|text|>", "<|end|>", "\\", "<", "[", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "\n", "a", "é", "$1", "|>", "", "\\<", "<\\"]
    text = lambda: "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12)))
    rows = [(k % 40 if k % 9 else None, k // 40 if k % 7 else None, rnd.choice(["user", "assistant", "assistant", text(), None]), text() if k % 5 else None, k) for k in range(400)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, key long")
    made = chat.chat(df)
    bad = made.select(F.regexp_replace("formatted", r"<\|(turn|text|end)\|>", "").alias("rest")).where(r"rest rlike '</?s>|\\[/?INST\\]|<</?SYS>>'")
    assert bad.count() == 0
    got = {r["key"]: ([tuple(t) for t in r["turns"]], r["learnt"]) for r in chat.read_back(made).collect()}
    moved = made.withColumn("loss", F.transform("loss", lambda s: s.withField("start", s["start"] + 1).withField("end", s["end"] + 1)))
    off = {r["key"]: r["learnt"] for r in chat.read_back(moved).collect()}
    assert all(off[k] != learnt for k, (_, learnt) in got.items() if any(learnt))  # the offsets are what is read
    want = {}
    for c, t, r, x, _ in rows:
        want.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    assert got == {c: ([(r, x) for _, _, r, x in sorted(own)], [x for _, _, r, x in sorted(own) if r == "assistant"]) for c, own in want.items()}
    assert chat.chat(df.limit(0)).count() == 0


def test_urls(spark):
    urls = [None, "", "nothing", "://", "http://", "HTTP://WWW.Example.COM", "http://www.example.com/en/x", "http://a.example.com/en/x?y#z", "http://x.net/es/?porn", "http://x.org/free-bets", "http://x.org/freebets", "http://x.org/a?u=xxx#b", "http://net/fr/", "http://y.net/FR/", "http://x.org/bet-bet", "a://b://c/d"]
    df = spark.createDataFrame([(k % 14 if k else None, u) for k, u in enumerate(urls)], "page_id long, url string").withColumns({"host": F.lit(1), "id": F.lit(2)})
    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(df).collect()]
    same(got, [(k % 14 if k else None, *brute.url(u, url_filter.STRICT, url_filter.SOFT)) for k, u in enumerate(urls)])
    assert url_filter.judge_urls(df.limit(0)).count() == 0
    assert {r["verdict"] for r in url_filter.judge_urls(df, (), (), ()).collect()} == {"allow"}


def test_urls_with_a_large_vocabulary(spark):
    """Thousands of terms with weights from a table, terms inside others, very long urls; against a plain search."""
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcde1é") for _ in range(rnd.randint(2, 5)))
    terms = [(word(), rnd.choice([1.0, 2.0, 0.5, 0.3, 0.0, None])) for _ in range(5000)] + [(None, 1.0), ("", 1.0)]
    strict, soft = url_filter.vocabulary(spark.createDataFrame(terms, "term string, weight double"))
    assert len(strict) + len(soft) > 1500 and not set(strict) & set(soft)
    kind = dict.fromkeys(soft, 0) | dict.fromkeys(strict, 1)
    urls = ["x://h.org/" + rnd.choice("-/.?").join(word() + rnd.choice(["", "zz"]) for _ in range(rnd.randint(0, 4))) for _ in range(300)] + ["x://h.org/" + "q" * 300_000 + "-" + strict[0], "x://h.org/" + "q" * 300_000]
    got = {r["page_id"]: (r["n_strict"], r["n_soft"], r["verdict"]) for r in url_filter.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), (), strict, soft).collect()}
    import re

    for k, u in enumerate(urls):
        found = {w for run in re.findall(r"[^\W_]+", u) for w in [run] if w in kind}
        s = sum(kind[w] for w in found)
        assert got[k] == (s, len(found) - s, "block" if s or len(found) - s >= 2 else "allow"), u[:80]


def test_token_files(docs, none, spark):
    path = common.shared_path(spark, "t")
    token_files.write(docs, path, WORD, shard_bytes=200)
    got = [(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_files.read_back(spark, path).orderBy("start").collect()]
    same(got, [(i, len(x := [*brute.ids("word_bpe_49k.json", t), 1]), brute.crc(x)) for i, t in ROWS])
    assert [i for i, _, _ in got] == [None, None, *sorted(i for i, _ in ROWS if i is not None)]
    starts = sorted((r["start"], r["n_tokens"]) for r in token_files.read_back(spark, path).collect())
    assert [s for s, _ in starts] == list(np.cumsum([0, *(n for _, n in starts)])[:-1])
    assert token_files.lookup(spark, path, 5) == [*brute.ids("word_bpe_49k.json", ROWS[5][1]), 1]
    assert token_files.lookup(spark, path, 4, 1) is not None and token_files.lookup(spark, path, 99) is None
    assert sorted(token_files.lookup(spark, path, None, k) for k in (0, 1)) == sorted([*brute.ids("word_bpe_49k.json", t), 1] for i, t in ROWS if i is None)
    path, texts = common.shared_path(spark, "t"), [("b", "one two"), ("a", "three"), (None, "four"), ("", "five"), ("a", "six")]
    token_files.write(spark.createDataFrame(texts, "doc_id string, text string"), path, WORD, shard_bytes=8)
    assert [r["doc_id"] for r in token_files.read_back(spark, path).orderBy("start").collect()] == [None, "", "a", "a", "b"]
    assert token_files.lookup(spark, path, "b") == [*brute.ids("word_bpe_49k.json", "one two"), 1] and token_files.lookup(spark, path, "") == [*brute.ids("word_bpe_49k.json", "five"), 1]
    path = common.shared_path(spark, "t")
    token_files.write(none, path, WORD)
    assert token_files.read_back(spark, path).count() == 0


def test_perfect_index():
    for n in (0, 1, 2, 3, 7, 50, 3000):
        keys = [f"k{k}".encode() for k in range(n)]
        index, width = token_files.PerfectIndex.load(token_files.PerfectIndex.build(keys, list(range(n)), [1] * n).dump(2))
        assert width == 2 and all(index.find(k) == (i, 1) for i, k in enumerate(keys))
        assert sum(index.find(f"no{k}".encode()) is not None for k in range(1000)) == 0


def test_decontamination(docs, none, spark):
    bench = [(1, "hello WORLD"), (2, None), (3, ""), (None, "no id"), (4, LONG[:200]), (4, LONG[50:300]), (5, "don't stop")]
    items = spark.createDataFrame(bench, "item_id long, text string")
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in decontamination.contamination(docs, items, size=500).collect()]
    want = []
    for i, t in ROWS:
        parts = [brute.contamination(t, [(k, x)]) for k, x in bench]
        whole = _union(t, bench)
        want.append((i, *whole))
        assert parts
    same(got, want)
    assert decontamination.contamination(docs, items.limit(0)).where("contaminated").count() == 0
    with pytest.MonkeyPatch.context() as m:  # several blocks
        m.setattr(decontamination, "BLOCK_BYTES", 100)
        assert len(decontamination.blocks_of(items, 10, "item_id", "text")) > 2
        same([(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in decontamination.contamination(docs, items, size=500).collect()], want)
    assert decontamination.contamination(none, items).count() == 0
    assert decontamination.decontaminate(docs, items).columns == docs.columns
    cut = decontamination.decontaminate(docs, items, "cut")
    assert cut.count() == len(ROWS) and decontamination.contamination(cut, items).where("contaminated").count() == 0


def test_memory_of_a_block():
    """A full block of other words everywhere: what the driver and a worker hold for it."""
    import tracemalloc

    rnd = random.Random(8)
    items = [(k, " ".join(f"w{rnd.randrange(200_000)}" for _ in range(200))) for k in range(decontamination.BLOCK_BYTES // 1400)]
    tracemalloc.start()
    block = decontamination.phrases(items)
    data = block.packed()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    back = decontamination.Phrases.unpacked(data)
    assert peak < 160 * 2**20 and len(data) < 16 * 2**20 and back.words == block.words and (back.rows == block.rows).all()


def _union(text, bench, window=10):
    import hashlib

    words, hit, names = brute.bench_words(text), set(), set()
    for i, t in bench:
        own = brute.bench_words(t)
        for k in range(max(1, len(own) - window + 1) if own else 0):
            w = own[k : k + window]
            for at in range(len(words) - len(w) + 1):
                if words[at] == w[0] and words[at : at + len(w)] == w:
                    hit.update(range(at, at + len(w)))
                    if i is not None:
                        names.add(str(i))
    return len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("order", [2, 3, 4])
@pytest.mark.parametrize("least", [1, 2])
@pytest.mark.parametrize("partition_rows", [10**6, 300])
def test_lm(docs, none, spark, order, least, partition_rows):
    """Also with contexts that outgrow a partition, documents shorter than a context, and a context that is a third of all."""
    rows = lm_scoring.score(docs, order, 0.4, least, partition_rows=partition_rows, chunk_words=partition_rows // 2).collect()
    same([(r["doc_id"], round(r["log_score"], 5)) for r in rows], [(i, round(x, 5)) for (i, _), x in zip(ROWS, brute.lm([t for _, t in ROWS], order, 0.4, least), strict=True)])
    assert all((r["score"] is None) == (r["n_words"] == 0) for r in rows)
    assert lm_scoring.score(none, order, 0.4, least).count() == 0
    rnd = random.Random(1)
    texts = [None, "a", "b", "a", "zz", "a b", "b a", "a b", "A  B\nc", *(" ".join(rnd.choice("abcde" if rnd.random() < 0.8 else "vwxyz") for _ in range(rnd.randint(0, 60))) for _ in range(100)), *["hot hot " * 200] * 5]
    df = spark.createDataFrame([(f"id {k}" if k % 7 else None, t) for k, t in enumerate(texts)], "doc_id string, text string").repartition(5)
    got = sorted(r["log_score"] for r in lm_scoring.score(df, order, 0.4, least, partition_rows=partition_rows, chunk_words=partition_rows // 2).collect())
    assert len(got) == len(texts) and all(abs(a - b) < 1e-6 for a, b in zip(got, sorted(brute.lm(texts, order, 0.4, least))))
