"""The methods' inner parts against brute force."""

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from eventloom.llm import common, langid, minhash, onebit, packing, quality, toxicity, winnow
from eventloom.llm.components import components

JSON = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aé ß\n\t,.'s1 <|>xＡ\u3000\u00a0")), max_size=30) | st.text(max_size=20))
def test_words_are_tokenized_as_the_whole_text(text):
    text = text.encode("utf-8", "ignore").decode()
    ids = np.frombuffer(packing.tokenizer()(text), "<u4").tolist()
    assert ids == JSON.encode(text, add_special_tokens=False).ids


def test_special_token_in_a_text():
    text = "a <|endoftext|> b"
    assert np.frombuffer(packing.tokenizer()(text), "<u4").tolist() == JSON.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("max_open", [3, 1000])
def test_packing_places_each_id_once(max_open):
    draw = random.Random(1)
    packer = packing.SumOfSquares(32, max_open)
    windows, want = [], {}
    for doc in range(500):
        ids = np.arange(draw.randint(1, 80), dtype="<u4").tobytes()
        want[doc] = ids
        for at in range(0, len(ids), 4 * 32):
            windows += packer.place((doc, at // 4, ids[at : at + 4 * 32], len(ids) // 4))
        assert packer.n_open == sum(map(len, packer.open)) == packer.count.sum() <= max_open
    windows += packer.close()
    got = {}
    for pieces in windows:
        assert sum(len(p[2]) // 4 for p in pieces) <= 32
        for doc, start, ids, _ in pieces:
            got.setdefault(doc, []).append((start, ids))
    assert {d: b"".join(i for _, i in sorted(p)) for d, p in got.items()} == want
    if max_open == 1000:
        assert sum(sum(len(p[2]) // 4 for p in w) < 32 for w in windows) <= 1


def test_sum_of_squares_grows_least():
    packer = packing.SumOfSquares(16)
    draw = random.Random(2)
    for _ in range(300):
        size = draw.randint(1, 15)

        def growth(level):
            count = packer.count[1:16].copy()
            if level:
                count[level - 1] -= 1
            if level + size < 16:
                count[level + size - 1] += 1
            return int((count**2).sum() - (packer.count[1:16] ** 2).sum())

        allowed = [h for h in range(0, 17 - size) if h == 0 or packer.count[h]]
        assert growth(packer.level_for(size)) == min(map(growth, allowed))
        packer.place((0, 0, b"\0" * 4 * size, size))


def test_sketches_estimate_similarity():
    random_ = np.random.default_rng(3)
    for n, shared in ((5, 4), (60, 45), (3000, 1500)):
        agree = []
        for _ in range(12):
            pool = random_.integers(0, 2**63, 2 * n - shared, dtype=np.uint64)
            a, b = minhash.sketch(pool[:n]), minhash.sketch(pool[n - shared :])
            assert len(a) == minhash.BANDS * minhash.ROWS
            agree.append((a == b).mean())
        assert abs(np.mean(agree) - shared / (2 * n - shared)) < 0.06


def test_near_duplicates_against_all_pairs(spark):
    draw = random.Random(4)
    base = [f"b{i}" for i in range(70)]
    texts = []
    for _ in range(120):
        words = list(base)
        for _ in range(draw.choice([0, 1, 1, 2, 3, 5])):
            words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
        texts.append(" ".join(words[: draw.choice([70, 70, 66, 60])]))
    texts += [" ".join(f"r{draw.randrange(50)}" for _ in range(30)) for _ in range(30)]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for t in texts]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs).collect()}
    assert got == {i: (len(sets[i]), root(i)) for i in range(len(texts))}
    assert len({c for _, c in got.values()}) < len(texts)


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 60), (60, 80), (200, 200), (None, 3)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {80: 60, 100: 60}


def test_winnowing_against_all_windows(spark):
    draw = random.Random(5)
    words = [f"w{i}" for i in range(12)]
    items = [" ".join(draw.choices(words, k=draw.choice([3, 9, 10, 25]))) for _ in range(15)]
    docs = []
    for _ in range(60):
        parts = draw.choices(words, k=draw.randint(0, 25))
        item = draw.choice(items).split()
        at = draw.randrange(len(item))
        docs.append(" ".join(parts + item[at : at + draw.randint(0, 20)] + draw.choices(words, k=5)))
    docs += ["w1 " * 200, ""]
    items.append("w1 " * 15)
    want = []
    for text in docs:
        d, hit, ids = text.split(), set(), set()
        for n, item in enumerate(items):
            v = item.split()
            size = min(10, len(v))
            windows = {tuple(v[i : i + size]) for i in range(len(v) - size + 1)}
            for i in range(len(d) - size + 1):
                if tuple(d[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    ids.add(str(n))
        want.append((len(d), len(hit), sorted(ids)))
    rows = winnow.contamination(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    got = {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in rows.collect()}
    assert [got[i] for i in range(len(docs))] == want
    assert sum(h > 0 for _, h, _ in want) > 10


@pytest.mark.parametrize("per_pass", [4, 1000])
def test_neighbours_against_brute_force(spark, per_pass):
    x = np.random.default_rng(6).normal(size=(900, 24)).astype(np.float32)
    x[40:80] = x[40]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(3)
    index, coder = onebit.build_index(table, bits=128)
    rows = onebit.nearest(index.where("vec_id % 40 = 0"), index, coder, k=10, per_pass=per_pass).collect()
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in rows}
    same = total = 0
    for q in range(0, 900, 40):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        d[q] = np.inf
        order = np.lexsort((np.arange(900), d))[:10]
        for rank, i in enumerate(order, 1):
            total += 1
            same += got[q, rank][0] == i
            assert got[q, rank][1] >= d[i] - 1e-9
    assert same >= 0.9 * total


def test_bounds_hold_and_estimates_are_close():
    x = np.random.default_rng(7).normal(size=(400, 48))
    coder = onebit.Coder(x.mean(0), 192, 1)
    code, length, fit = coder.encode(x)
    query_length, turned = coder.turned(x[:20])
    low = coder.bounds(code, length, fit, query_length, turned, 2.4)
    exact = ((x[:20, None] - x[None]) ** 2).sum(2)
    assert (low <= exact + 1e-6).mean() > 0.97
    assert np.abs(low - exact).mean() < 0.5 * exact.mean()


def test_isotonic_is_the_nondecreasing_least_squares_fit():
    y = np.array([0.0, 1, 0, 1, 1, 0, 1, 1])
    assert quality.isotonic(np.arange(8), y, np.ones(8)).tolist() == pytest.approx([0, 0.5, 0.5, 2 / 3, 2 / 3, 2 / 3, 1, 1])


def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.score_quality(docs, labels).join(labels, "doc_id").selectExpr("crc32(cast(doc_id as string)) % 5 = 0 as held", "predicted", "quality").where("held").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.93 * len(rows) > 0


def test_toxicity_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").selectExpr("crc32(cast(doc_id as string)) % 5 = 0 as held", "predicted", "toxic").where("held").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.9 * len(rows) > 0


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = langid.identify_languages(docs).selectExpr("crc32(cast(doc_id as string)) % 3 = 1 as held", "lang", "lang_pred").where("held").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.9 * len(rows) > 0


def test_ngram_counts_do_not_depend_on_pieces(monkeypatch):
    text = "Der Hund, the dog! 12 ñandú " * 20
    whole = langid.ngram_counts(text)
    assert whole.sum() > 0
    assert langid.ngram_counts("").sum() == 0
    monkeypatch.setattr(langid, "PIECE", 37)
    pieces = langid.ngram_counts(text)
    assert (pieces == whole).all()


def test_pooling_equals_document_by_document():
    random_ = np.random.default_rng(8)
    documents = [random_.integers(0, 2**32, n, dtype=np.uint64).astype(np.uint32) for n in (0, 1, 2, 5, 90_000, 3)]
    y = np.array([0, 1, 0, 1, 0, 1])
    network = toxicity.train_network([d[:50] for d in documents], y, epochs=1)
    together = network.pooled(documents)
    for d, row in zip(documents, together, strict=True):
        words = network.embed(d) if len(d) else np.zeros((0, toxicity.DIM), np.float32)
        want = np.hstack([c.max(0) for c in network.convolve(words)]) if len(d) else np.zeros(len(row))
        assert np.allclose(row, np.maximum(want, 0), atol=1e-5)


def test_toxicity_sample_is_bounded_by_words(spark):
    # one document in ten has nine tenths of the words
    rows = [(str(i), i % 2, np.full(900 if i % 10 == 0 else 11, i, "<u4").tobytes(), "en") for i in range(1000)]
    sample = spark.createDataFrame(rows, "doc_id string, label int, words binary, language string")
    total = sum(len(r[2]) for r in rows) // 4
    assert toxicity.thinned(sample, total, 1).count() == 1000
    kept = toxicity.thinned(sample, total // 4, 1).collect()
    assert all(bytes(r.words) == rows[int(r.doc_id)][2] for r in kept)
    assert 0.5 * total // 4 < sum(len(r.words) // 4 for r in kept) < 1.5 * total // 4
    assert toxicity.thinned(sample.limit(0), 10, 1).count() == 0


def test_toxicity_learns_from_all_labelled_rows(spark, monkeypatch):
    # two trainers; each class has more rows than a sample of 5000 would keep
    monkeypatch.setattr(toxicity, "FEW_BYTES", 200_000)
    docs = spark.range(12_400).selectExpr("id as doc_id", "concat('word', id % 37, if(id % 2 = 0, ' good', ' bad'), ' no', id) as text")
    labels = spark.range(12_400).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic")
    model = toxicity.fit_toxicity(docs, labels, langid.LanguageModel([], np.zeros(langid.BUCKETS), np.zeros((langid.BUCKETS, 0)), 1.0))
    assert sum(model.rows.values()) == 12_400
    assert 0.2 < model.rows["left out"] / 12_400 < 0.3
    assert list(model.score(["word1 good", "word2 bad"]) >= 0.5) == [False, True]


def test_toxicity_trainers_average_their_changes(spark):
    words = {0: [1, 2, 3], 1: [4, 5]}
    rows = [(i % 2, str(i), i % 2, words[i % 2]) for i in range(40)]
    schema = "trainer int, doc_id string, label int, words array<int>"
    both = toxicity.train_by_trainers(spark.createDataFrame(rows, schema), epochs=2)
    again = toxicity.train_by_trainers(spark.createDataFrame(rows[::-1], schema), epochs=2)
    assert all((x == y).all() for x, y in zip(both.kernels + [both.first, both.second], again.kernels + [again.first, again.second], strict=True))
    low, high = both.logits([np.array(words[i], np.uint32) for i in (0, 1)])
    assert low < 0 < high


def test_bits_tell_all_wanted_rows(spark):
    rows = spark.range(5000)
    for most_bits in (1 << 15, 1 << 27):
        told = common.maybe_in(rows, rows.where("id % 50 = 7"), "id", most_bits).where("maybe")
        assert told.where("id % 50 = 7").count() == 100
        assert told.count() < 300
    assert common.maybe_in(rows, rows.limit(0), "id").where("maybe").count() == 0


def test_dedup_stage_does_not_exchange_the_texts_that_stay(spark):
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(3, text), (1, text), (1, text), (2, "another text of some six words"), (None, text), (4, ""), (4, "")], "doc_id long, text string")
    docs = docs.selectExpr("doc_id", "text", "'en' as lang", "'web' as source", "length(text) as n_chars")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = corpus_pipeline.dedup_stage(spark, docs, "")
        assert "SortMergeJoin" not in kept._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, text), (2, "another text of some six words"), (4, ""), (4, "")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_threshold_has_least_error():
    s, y = np.array([-2.0, -1, 0, 1, 2]), np.array([0, 0, 1, 0, 1])
    cut = toxicity.threshold(s, y, np.ones(5))
    assert ((s > cut) != y).sum() == 1
