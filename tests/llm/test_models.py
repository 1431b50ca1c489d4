"""Learned operators on held-out rows, searches against brute force, and files that are read back."""

import functools
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from cohortwave.llm import decontaminate, langid, toxicity, training_order, vptree
from cohortwave.session import work_dir
from tests.llm.conftest import SCHEMA, odd_rows, text

DOCS = "/root/testdata/sf0.01/documents.parquet"
LABELS = "/root/testdata/sf0.01/labels.parquet"


# toxicity


@pytest.fixture(scope="module")
def plain():
    rng = random.Random(1)
    bad = "idiot moron pathetic worthless".split()
    texts, labels = [], []
    for i in range(160):
        words = text(rng, 2 * rng.randrange(1, 8)).split(" ")
        if i % 2:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        texts.append(" ".join(words))
        labels.append(i % 2)
    return texts, labels, toxicity.fit(texts[:120], labels[:120])


def score(model, t):
    table = toxicity.TypeTable(model.per_type)
    return model.score(table.look_up([toxicity.words_of(t)])[0], table.rows)


def test_toxicity_held_out(plain):
    texts, labels, model = plain
    got = [score(model, t) >= 0.5 for t in texts[120:]]
    assert np.mean([g == bool(y) for g, y in zip(got, labels[120:])]) >= 0.95
    assert score(model, "alpha beta gamma delta pathetics idiots epsilon zeta") >= 0.5  # unseen spellings
    long = text(random.Random(9), 400)
    assert score(model, long) < 0.5 and score(model, long + " idiot moron ") >= 0.5


def plain_score(model, t):
    """Bags, subwords, averages and the softmax of two labels written out, a word at a time."""
    wrap, base = (1 << 64) - 1, 0x9E3779B97F4A7C15
    found, best = re.findall(r"\w+", t.lower()), -math.inf
    for start in range(0, max(1, len(found) - 16 + 8), 8):
        total, number = 0.0, 0
        for i in range(start, min(start + 16, len(found))):
            w = f"<{found[i]}>"
            for n in range(3, 7):
                for j in range(len(w) - n + 1):
                    h = 0
                    for c in w[j : j + n]:
                        h = (h * base + ord(c)) & wrap
                    number += 1
                    if found[i] not in found[max(0, i - 8) : i]:
                        total += model.gain[((h ^ (h >> 29)) * base & wrap) >> (64 - model.bits)]
        best = max(best, total / (number + 40) + model.bias)
    one, other = math.exp(best), 1.0
    return one / (one + other)


def test_scores_equal_bags_written_out(plain):
    texts, _, model = plain
    rng = random.Random(4)
    cases = ["", " .,!", "a", "idiot", "idiot " * 40, "Idiot! É moron-pathetic_1 ß \u4e2d\u6587 \U0001f600", text(rng, 100), text(rng, 60) + " worthless moron " + text(rng, 23), *texts[:40]]
    assert [score(model, t) for t in cases] == pytest.approx([plain_score(model, t) for t in cases], abs=1e-9)


def test_gradient_steps_lower_the_loss_of_each_label(plain):
    """Both labels weigh the same, however few texts one has."""
    texts, labels, _ = plain
    few = [(t, y) for i, (t, y) in enumerate(zip(texts[:120], labels)) if y == 0 or i % 12 == 1]
    got = toxicity.fit([t for t, _ in few], [y for _, y in few])
    assert np.mean([plain_score(got, t) >= 0.5 for t, y in few if y == 1]) == 1 and np.mean([plain_score(got, t) < 0.5 for t, y in few if y == 0]) >= 0.95


def test_toxicity_of_odd_rows(spark, plain, odd_clashing, nothing):
    model = plain[2]
    out = {(r.doc_id, r.score) for r in toxicity.scores(odd_clashing, model).withColumnRenamed("doc_id", "doc_id").collect()}
    assert len(toxicity.scores(odd_clashing, model).collect()) == len(odd_rows()) and all(0 <= s <= 1 for _, s in out)
    want = Counter((r[0], r[1]) for r in odd_rows() if score(model, r[1] or "") < 0.5)
    kept = toxicity.keep_clean(odd_clashing, model)
    assert kept.columns == odd_clashing.columns and Counter((r.doc_id, r.text) for r in kept.collect()) == want
    assert toxicity.scores(nothing, model).count() == 0
    labels = spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    assert score(toxicity.train(nothing, labels), "anything") < 0.5
    some = spark.createDataFrame([(i, 1, t) for i, t in [(104, 1), (105, 0), (101, 0), (100, 1), (None, 1), (5, None)]], "doc_id BIGINT, quality INT, toxic INT")
    assert 0 <= score(toxicity.train(odd_clashing, some), "") <= 1


def test_toxicity_learns_from_the_other_rows_only(spark):
    labels = spark.read.parquet(LABELS)
    flipped = labels.withColumn("toxic", F.when(toxicity.remainder("doc_id", 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    docs = spark.read.parquet(DOCS)
    a, b = toxicity.train(docs, labels, rounds=3), toxicity.train(docs, flipped, rounds=3)
    assert a.bias == b.bias and np.array_equal(a.gain, b.gain)


# language


@pytest.fixture(scope="module")
def languages(spark):
    return langid.train(spark.read.parquet(DOCS), most=60)


def test_language_held_out(spark, languages):
    docs = spark.read.parquet(DOCS).where(langid.remainder("doc_id", 4) == 2)
    got = langid.predictions(docs, languages).join(docs.select("doc_id", "lang"), "doc_id")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.97
    assert got.where("score < 0 or score > 1").count() == 0


def test_forward_sums_all_segmentations(languages):
    prob = dict(zip(languages.pieces, languages.prob))

    def brute(w):
        if not w:
            return np.ones(len(languages.langs))
        total = np.zeros(len(languages.langs))
        for n in range(1, min(len(w), 40) + 1):
            p = prob.get(w[:n]) if w[:n] in prob else (languages.prob[-1] if n == 1 else None)
            if p is not None:
                total = total + p * brute(w[n:])
        return total

    brute = functools.cache(brute)
    long = "▁" + "the漢ciónschaft" * 4  # 60 letters
    words = [long, "▁the", "▁und", "▁größe", "漢", "▁a", "▁ciónla", "xq漢z"]
    assert np.allclose(languages.per_type(words), [np.log(brute(w)) for w in words])
    assert np.isfinite(languages.per_type(["▁" + "漢" * 2000])).all()


def test_expectation_equals_enumeration():
    """Counts of pieces over all segmentations of words, by their probability; scaling on the way changes nothing."""
    rng = np.random.default_rng(5)
    pieces = sorted({"a", "b", "ab", "ba", "aab", "bb", "▁", "▁a"})
    m = langid.Model(["x", "y"], np.array([0.5, 0.5]), pieces, rng.uniform(0.05, 0.3, (len(pieces) + 1, 2)))

    def segmentations(w):
        return [[]] if not w else [[w[:n], *rest] for n in range(1, len(w) + 1) if w[:n] in pieces or n == 1 for rest in segmentations(w[n:])]

    words, count, want = ["▁abbaabab", "▁aczb", "▁a"], np.array([[3.0, 1], [1, 2], [0, 5]]), np.zeros((len(pieces) + 1, 2))
    for w, c in zip(words, count):
        ways = [[pieces.index(p) if p in pieces else len(pieces) for p in s] for s in segmentations(w)]
        weight = np.array([m.prob[s].prod(axis=0) for s in ways])
        for s, share in zip(ways, weight / weight.sum(axis=0) * c):
            np.add.at(want, s, share)
    assert np.allclose(m.expected(words, count), want)


def test_languages_are_all_learned_and_letters_are_letters(spark):
    rows = [(i, f"wort{'abcdefgh'[i % 8]} und satz", f"l{i % 130}", None, 1) for i in range(520)] + [(600, "¿qué? " * 6000, "only_long", None, 1)]
    model = langid.train(spark.createDataFrame(rows, SCHEMA), most=5, rounds=1)
    learned = {r[2] for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2}
    assert set(model.langs) == learned and len(learned) > 110
    odd = spark.createDataFrame([(1, "½ ² ①", None, None, 1), (2, "Ⅷ 12", None, None, 1), (3, "½ é", None, None, 1)], SCHEMA)
    got = {r.doc_id: r.lang_pred for r in langid.predictions(odd, model).collect()}
    assert got[1] == got[2] == "und" and got[3] != "und"


def test_language_of_odd_rows(languages, odd_clashing, nothing):
    rows = {(r.doc_id, r.lang_pred) for r in langid.predictions(odd_clashing, languages).collect()}
    assert {(100, "und"), (101, "und"), (102, "und"), (103, "und"), (111, "und")} <= rows
    assert all(p in languages.langs for i, p in rows if i in (104, 106, 108, 109, 110))
    assert langid.predictions(nothing, languages).count() == 0
    empty = langid.train(nothing)
    assert {r.lang_pred for r in langid.predictions(odd_clashing, empty).collect()} == {"und"}


# decontamination


def brute_distance(pattern, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_bit_parallel_distance():
    rng = random.Random(3)
    for _ in range(1500):
        p, t = "".join(rng.choices("abc", k=rng.randint(1, 12))), "".join(rng.choices("abc", k=rng.randint(1, 20)))
        want = brute_distance(p, t)
        assert decontaminate.distance(p, t, 99)[0] == want if want < len(p) else decontaminate.distance(p, t, 99)[0] >= want


def brute_within(pattern, t):
    """As brute_distance, a row of numpy at a time."""
    row, at = np.zeros(len(t) + 1, dtype=np.int64), np.arange(len(t) + 1)
    letters = np.array(list(t))
    for i, c in enumerate(pattern, 1):
        step = np.concatenate([[i], np.minimum(row[1:] + 1, row[:-1] + (letters != c))])
        row = np.minimum.accumulate(step - at) + at
    return row.min()


def test_items_match_whole_words_and_may_lack_an_id(spark):
    docs = spark.createDataFrame([(1, "My eyes hurt, the bone is gone!", None, None, 1), (2, "So: this one sentence is an item, yes.", None, None, 1), (3, "Nothis one sentence is an itemx", None, None, 1)], SCHEMA)
    items = [(1, "yes"), (2, "One"), (None, "This one sentence is an item"), (4, "this one SENTENCE is an item!")]
    bench = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    got = {(r.doc_id, r.item_id, r.start, r.end, r.errors) for r in decontaminate.matches(docs, bench, rate=0.0).collect()}
    assert got == {(2, None, 4, 32, 0), (2, 4, 4, 32, 0)}
    assert {r.doc_id for r in decontaminate.keep_clean(docs, bench, rate=0.0).collect()} == {1, 3}
    assert {r.doc_id for r in decontaminate.matches(docs, bench, rate=0.0, least=1).collect()} == {2, 3}  # "one"


def edited(rng, t, n):
    t = list(t)
    for _ in range(n):
        at = rng.randrange(len(t))
        rng.choice([lambda: t.pop(at), lambda: t.insert(at, "q"), lambda: t.__setitem__(at, "z")])()
    return "".join(t)


def test_decontamination(spark, odd_clashing, nothing):
    rng = random.Random(6)
    items = [(i, text(random.Random(50 + i), 4)) for i in range(12)] + [(90, None), (91, ""), (92, "?!")]
    bench = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    rows, want = [], set()
    for i in range(60):
        t = text(rng)
        if i % 3 == 0:
            item = i % 12
            norm = decontaminate.normalise(items[item][1])
            k = int(decontaminate.RATE * len(norm))
            t = f"{t}\nSee: {edited(rng, items[item][1].upper() if i % 2 else items[item][1], rng.randrange(k // 2))} !! {text(rng, 2)}"
            want.add((i, item))
        rows.append((i, t, None, None, None))
    docs = spark.createDataFrame(rows, SCHEMA)
    for most in (decontaminate.BLOCK_BYTES, 300):  # one block, and several
        got = decontaminate.matches(docs, bench, most=most).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want
    for r in got:
        found = decontaminate.normalise(rows[r.doc_id][1][r.start : r.end])
        assert brute_distance(decontaminate.normalise(items[r.item_id][1]), found) <= r.errors + 8
    clean = decontaminate.keep_clean(docs, bench, most=300)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == set(range(60)) - {i for i, _ in want}
    # every window of every document by plain edit distance, blanks at either end
    for r in rows[:12]:
        norm = f" {decontaminate.normalise(r[1])} "
        held = {i for i, t in items[:12] if brute_within(f" {decontaminate.normalise(t)} ", norm) <= int(decontaminate.RATE * len(decontaminate.normalise(t)))}
        assert held == {item for d, item in want if d == r[0]}
    assert decontaminate.matches(odd_clashing, bench).count() == 0
    assert decontaminate.keep_clean(odd_clashing, bench).count() == len(odd_rows())
    assert decontaminate.matches(nothing, bench).count() == 0
    assert decontaminate.matches(docs, bench.limit(0)).count() == 0 and decontaminate.keep_clean(docs, bench.limit(0)).count() == 60


# nearest neighbours


def brute_nearest(rows, k=20):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for i, q in good:
        if i % 20 == 0:
            near = sorted((-float((x * q).sum()), j) for j, x in good if j != i and len(x) == len(q))
            out[i] = [(j, -s) for s, j in near[:k]]
    return out


def vectors(spark, n, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(int(i), (rng.normal(size=dim) * rng.uniform(0.2, 3)).astype(np.float32).tolist()) for i in range(n)]
    rows[40:70] = [(i, rows[3][1]) for i in range(40, 70)]  # ties
    nan, inf = float("nan"), float("inf")
    rows += [(1000, None), (1020, [0.0] * dim), (1040, [nan] + [1.0] * (dim - 1)), (1060, [inf] + [1.0] * (dim - 1)), (1080, [None] + [1.0] * (dim - 1)), (1100, [1.0, 2.0]), (1120, []), (None, [1.0] * dim), (1121, [2.0, 1.0])]
    return rows, spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>").withColumn("score", F.lit("x")).withColumn("id", F.lit("y"))


@pytest.mark.parametrize("shard_rows", [50, 10_000])
def test_factor_one_is_exact(spark, shard_rows):
    rows, df = vectors(spark, 400)
    got = defaultdict(list)
    for r in vptree.nearest(df, F.col("id") % 20 == 0, factor=1.0, shard_rows=shard_rows, block_rows=7, leaf=8).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, pytest.approx(r.score, abs=1e-9)))
    want = brute_nearest(rows)
    assert dict(got) == {i: w for i, w in want.items() if w}


def test_an_id_of_most_rows_is_spread_over_shards(spark, monkeypatch):
    """Nine tenths of the rows share an id: their vectors still go to all shards, and what is found is exact."""
    rng = np.random.default_rng(7)
    rows = [(int(i) if i < 60 else 7, rng.normal(size=8).tolist()) for i in range(600)]
    held, write = [], vptree.keep

    def keep(df, name):
        out = write(df, name)
        held.extend([out] if name == "trees" else [])
        return out

    monkeypatch.setattr(vptree, "keep", keep)
    found = vptree.nearest(spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>"), F.col("id") % 20 == 0, factor=1.0, shard_rows=60, leaf=8)
    got = {i: [pytest.approx(s, abs=1e-9) for _, s in sorted(v)] for i, v in _by_query(found).items()}
    for i in (0, 20, 40):
        q = np.array(rows[i][1])
        assert sorted((float(np.dot(q, v)) for j, v in rows if j != i), reverse=True)[:20] == got[i]
    sizes = [len(vptree._unpack(bytes(r.tree))["ids"]) for r in held[0].collect()]
    assert sum(sizes) == 600 and max(sizes) < 120


def _by_query(found):
    out = defaultdict(list)
    for r in found.collect():
        out[r.query_id].append((r["rank"], r.score))
    return out


def test_relaxed_pruning_keeps_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = defaultdict(set)
    for r in vptree.nearest(df, F.col("id") % 20 == 0, leaf=16).collect():
        got[r.query_id].add(r.vec_id)
    want = brute_nearest(rows)
    assert np.mean([len(got[i] & {j for j, _ in w}) / len(w) for i, w in want.items()]) >= 0.9
    assert vptree.nearest(df.limit(0), F.col("id") % 20 == 0).count() == 0


# training order


@pytest.mark.parametrize("n", [1, 2, 3, 17, 256, 1000])
def test_permutation(n):
    a, b = (training_order.permute(np.arange(n), n, key) for key in (1, 2))
    assert sorted(a) == sorted(b) == list(range(n)) and (n < 17 or (a != b).any())


def plain_slot(x, n, key):
    """One number through six Feistel rounds, again as long as it lies beyond n."""
    wrap = (1 << 64) - 1
    half = next(h for h in itertools.count(1) if (1 << 2 * h) >= max(n, 2))
    while True:
        left, right = divmod(x, 1 << half)
        for r in range(1, 7):
            h = (right + key + r * 0x9E3779B97F4A7C15) & wrap
            h = (h ^ (h >> 30)) * 0xBF58476D1CE4E5B9 & wrap
            h = (h ^ (h >> 27)) * 0x94D049BB133111EB & wrap
            left, right = right, left ^ ((h ^ (h >> 31)) & ((1 << half) - 1))
        x = (left << half) | right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 5, 64, 65, 1000, 4097])
def test_slots_equal_a_plain_feistel_walk(n):
    for key in (0, 20240607, (1 << 63) + 5):
        assert training_order.permute(np.arange(n), n, key).tolist() == [plain_slot(x, n, key) for x in range(n)]


def test_shards_round_trip(spark, odd_clashing, nothing):
    path = work_dir(spark, "shards")
    layout, rows = training_order.materialise(odd_clashing, path, length=64, per_shard=100)
    held = {r.slot: r for r in rows.collect()}
    read = {r.slot: r for r in training_order.read_shards(spark, layout).collect()}
    assert sorted(held) == sorted(read) == list(range(layout.total)) and sorted(r.sequence for r in held.values()) == list(range(layout.total))
    assert all((r.shard, r.byte_offset) == layout.locate(s) for s, r in read.items())
    assert all(s == plain_slot(r.sequence, layout.total, 20240607) for s, r in held.items())
    enc = training_order.encoder(public_tokenizers.path(training_order.VOCABULARY))
    end, texts, pieces = training_order.END, Counter(), []
    for s in sorted(held, key=lambda s: held[s].sequence):  # documents follow each other in the order of the sequences
        ids, at = np.frombuffer(read[s].ids, "<u2"), 0
        for d in held[s].spans:
            pieces = [ids[at : at + d.n]] if d["at"] == 0 else [*pieces, ids[at : at + d.n]]
            at += d.n
            if pieces[-1][-1] == end:
                texts[d.doc_id, enc.decode(np.concatenate(pieces)[:-1].tolist())] += 1
        assert (ids[at:] == end).all()
    assert texts == Counter((r[0], r[1] or "") for r in odd_rows())
    later = training_order.read_shards(spark, layout, 150).collect()
    assert {r.slot: r.ids for r in later} == {s: r.ids for s, r in read.items() if s >= 150}
    listed = training_order.index(odd_clashing, length=64, per_shard=100)
    assert listed.count() == layout.total and listed.agg(F.sum("n_tokens")).first()[0] == sum(d.n for r in held.values() for d in r.spans)
    assert training_order.index(nothing).count() == 0
