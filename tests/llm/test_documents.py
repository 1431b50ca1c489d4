"""The operators on whole documents against brute-force versions, odd rows included."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cohortwave.llm import graph, linedup, mixing, passages, rendezvous, simhash
from tests.llm.conftest import SCHEMA, odd_rows, sentence, text

SPACE = r"[^\x20\x09-\x0D]+"


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def brute_fingerprint(t):
    w = re.findall(SPACE, lower(t or ""))
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    bits = Counter(b for g in grams for h in [xxhash.xxh64_intdigest(g.encode(), 42)] for b in range(64) if h >> b & 1)
    return sum(1 << b for b, n in bits.items() if 2 * n > len(grams))


def brute_components(fps, ids, radius=2, roots=False):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    names = [least.get(find(i)) for i in range(len(ids))]
    return (names, [find(i) for i in range(len(ids))]) if roots else names


def test_simhash_of_odd_rows(odd, odd_clashing):
    rows = odd_rows()
    fps = [brute_fingerprint(r[1]) for r in rows]
    want = Counter(zip([r[0] for r in rows], fps, brute_components(fps, [r[0] for r in rows])))
    for docs in (odd, odd_clashing):
        out = simhash.near_duplicates(docs, tile=4)
        assert Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in out.collect()) == want
    assert want[(100, 0, 100)] == want[(101, 0, 100)] == 1  # texts without words link to each other
    kept = simhash.keep_first(odd_clashing)
    assert kept.columns == odd_clashing.columns
    groups = set(zip(*brute_components(fps, [r[0] for r in rows], roots=True)))
    assert Counter(r.doc_id for r in kept.collect()) == Counter(c for c, _ in groups)  # one row of each component


def test_simhash_of_nothing(nothing):
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_first(nothing).count() == 0


@pytest.mark.parametrize("parts", [1, 2, 4])
def test_links_are_exact(spark, parts):
    rng = random.Random(parts)
    seeds = [rng.getrandbits(64) for _ in range(30)]
    fps = {0, (1 << 64) - 1, 1}
    for s in seeds:
        fps.add(s)
        for _ in range(8):
            fps.add(s ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))))
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp BIGINT"), 2, parts, tile=16)
    star = {r.node: r.root for r in graph.components(edges).collect()}
    got, want = defaultdict(set), defaultdict(set)
    for x, y in zip(signed, brute_components(fps, list(range(len(fps))))):
        got[star.get(x, x)].add(x)
        want[y].add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 7), (900, 901), (901, 900)]
    out = graph.components(spark.createDataFrame(edges, "u BIGINT, v BIGINT"))
    want = {i: 100 for i in range(101, 161)} | {i: 500 for i in range(501, 560)} | {901: 900}
    assert {r.node: r.root for r in out.collect()} == want
    assert graph.components(spark.createDataFrame([], "u BIGINT, v BIGINT")).count() == 0


def brute_lines(rows, least=10):
    owners = defaultdict(set)
    order = lambda i: (i is None, i or 0)
    key = lambda l: lower(l.strip(" \t\n\x0b\x0c\r"))
    for i, t, *_ in rows:
        for l in (t or "").split("\n"):
            if len(key(l)) >= least:
                owners[key(l)].add(i)
    out = []
    for i, t, *_ in rows:
        ls = (t or "").split("\n")
        kept = [l for l in ls if len(owners.get(key(l), ())) < 2 or i == min(owners[key(l)], key=order)]
        out.append((i, len(ls), len(ls) - len(kept), "\n".join(kept)))
    return Counter(out)


def test_line_bitmaps(spark, odd, odd_clashing, nothing):
    for docs in (odd, odd_clashing):
        out = linedup.apply_bitmaps(docs, linedup.keep_bitmaps(docs))
        assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in out.collect()) == brute_lines(odd_rows())
    rng = random.Random(2)
    stock = ["a very common line here", "  A VERY common line HERE\t", "short", "another stock line\x0b", "ÄÖÜ and a lot of umlauts"]
    rows = [(i, "\n".join(rng.choice([*stock, sentence(rng)]) for _ in range(rng.randrange(12))), None, None, None) for i in range(150)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = linedup.apply_bitmaps(docs, linedup.keep_bitmaps(docs))
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in out.collect()) == brute_lines(rows)
    assert linedup.apply_bitmaps(nothing, linedup.keep_bitmaps(nothing)).count() == 0


def test_a_line_in_most_documents_is_spread_over_all_ranges(spark):
    """The ranges that lines are dealt to hold even shares, hot key or not, and every key one range per slice."""
    rows = [(i, f"a line that most documents hold\nand line number {i} of them all", None, None, None) for i in range(2000)]
    key = F.md5(linedup.line_key(F.col("line")))
    lines = spark.createDataFrame(rows, SCHEMA).select("doc_id", F.explode(linedup.lines_of(F.col("text"))).alias("line"))
    dealt = lines.select(key.alias("hex"), F.pmod(F.xxhash64("doc_id"), F.lit(16)).cast("int").alias("slice")).withColumn("range", linedup._range("hex", 16))
    sizes = [r["count"] for r in dealt.groupBy("range").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 1.5 * sum(sizes) / 16
    assert dealt.groupBy("hex", "slice").agg(F.count_distinct("range").alias("n")).where("n > 1").count() == 0


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    free, rest = set(names), float(sum(sizes.values()))
    while free and rest > 1e-9:
        share = rest / sum(w[s] for s in free)
        rest = 0.0
        for s in sorted(free, key=str):
            target[s] += share * w[s]
        for s in [s for s in free if target[s] > most * sizes[s] + 1e-9]:
            rest += target[s] - most * sizes[s]
            target[s] = float(most * sizes[s])
            free.discard(s)
    return target


def test_mix(spark, odd, odd_clashing, nothing):
    for docs in (odd, odd_clashing):
        out = mixing.mix(docs).collect()
        assert Counter((r.doc_id, r.size) for r in out) == Counter((r[0], len(re.findall(SPACE, r[1] or ""))) for r in odd_rows())
        sizes = Counter()
        for r in out:
            sizes[r.source] += r["size"]
        want = brute_targets(sizes)
        for r in out:
            assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.copies <= 3
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 80)), None, rng.choice(["a"] * 6 + ["b", "c", "d", None]), None) for i in range(1500)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(docs)
    again = Counter((r.doc_id, r.copies) for r in mixing.mix(docs.repartition(7)).collect())
    out = got.collect()
    assert again == Counter((r.doc_id, r.copies) for r in out)
    taken, target = Counter(), {}
    for r in out:
        taken[r.source] += r.copies * r["size"]
        target[r.source] = r.target
    assert all(abs(taken[s] - t) <= 2 for s, t in target.items())
    made = mixing.copies(docs)
    assert made.columns == docs.columns
    assert Counter(r.doc_id for r in made.collect()) == Counter({r.doc_id: r.copies for r in out if r.copies})
    assert mixing.mix(nothing).count() == 0 and mixing.copies(nothing).count() == 0


def test_a_target_just_under_its_source_is_drawn_in_many_pieces(spark, monkeypatch):
    """With odds of 0.9998 for every row of a source, its order still falls into even pieces."""
    rows = [(i, "w " * 10, None, "a" if i % 4 else "b", None) for i in range(8000)]
    held, write = [], mixing.keep

    def keep(df, name):
        out = write(df, name)
        held.extend([out] if name == "drawn" else [])
        return out

    monkeypatch.setattr(mixing, "keep", keep)
    out = mixing.mix(spark.createDataFrame(rows, SCHEMA), weights=(0.9998 * 60_000, 20_000 + 0.0002 * 60_000), buckets=64)
    taken = {r.source: (r.n, r.t) for r in out.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("n"), F.first("target").alias("t")).collect()}
    assert all(abs(n - t) <= 5 for n, t in taken.values()) and taken["a"][1] == pytest.approx(59_988)
    sizes = [r["count"] for r in held[0].where("source = 'a'").groupBy("bucket").count().collect()]
    assert len(sizes) == 64 and max(sizes) < 2 * 6000 / 64


def test_unequal_importance(spark):
    rows = [(i, "w " * 20, None, "a" if i % 2 else "b", None) for i in range(4000)]
    out = mixing.mix(spark.createDataFrame(rows, SCHEMA), weights=(1, 3), importance=F.when(F.col("doc_id") % 4 < 2, 1.0).otherwise(3.0))
    rates = {(r.v, r.source): r.n for r in out.withColumn("v", (F.col("doc_id") % 4 < 2).cast("int")).groupBy("v", "source").agg(F.avg("copies").alias("n")).collect()}
    assert rates[0, "a"] == pytest.approx(0.75, abs=0.05) and rates[1, "a"] == pytest.approx(0.25, abs=0.05)
    assert rates[0, "b"] == pytest.approx(2.25, abs=0.05) and rates[1, "b"] == pytest.approx(0.75, abs=0.05)


def brute_shard(key, weights):
    def wait(i):
        u = (int(hashlib.md5(f"{key}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
        return -math.log(u) / weights[i]

    return min((i for i in range(len(weights)) if weights[i] > 0), key=wait)


def test_rendezvous(spark, odd, odd_clashing, nothing):
    for docs in (odd, odd_clashing):
        out = rendezvous.assign(docs, [1.0] * 16, [1.0] * 17, buckets=4).collect()
        for r in out:
            key = "" if r.doc_id is None else r.doc_id
            assert (r.shard, r.grown_shard) == (brute_shard(key, [1.0] * 16), brute_shard(key, [1.0] * 17))
            assert r.grown_shard in (r.shard, 16)
        want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in odd_rows())
        assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == want
        slots = defaultdict(list)
        for r in out:
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    wide = rendezvous.assign(spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")), [1.0, 2.0, 0.0, 3.0])
    share = {r.shard: r["count"] / 6000 for r in wide.groupBy("shard").count().collect()}
    assert share == {0: pytest.approx(1 / 6, abs=0.03), 1: pytest.approx(1 / 3, abs=0.03), 3: pytest.approx(1 / 2, abs=0.03)}
    assert rendezvous.assign(nothing, [1.0] * 4).count() == 0


def brute_passages(rows, least=passages.LEAST):
    held = defaultdict(set)
    for i, t, *_ in rows:
        for u in passages.units(t or ""):
            held[u[0]].add(i)
    keeper = {d: min(x for x in ids if x is not None) for d, ids in held.items() if len(ids) > 1}
    out = set()
    for i, t, *_ in rows:
        run, spans = [], []
        for d, a, b, n in [*passages.units(t or ""), (None, 0, 0, 0)]:
            if d in keeper and keeper[d] != i:
                run.append((a, b, n, keeper[d]))
            elif run:
                spans, run = [*spans, run], []
        for s in spans:
            by = Counter()
            for *_, n, k in s:
                by[k] += n
            if max(by.values()) >= least:
                out.add((i, s[0][0], s[-1][1], sum(x[2] for x in s), len(s), tuple(sorted(by))))
    return out


def test_passages(spark, odd, odd_clashing, nothing):
    for docs in (odd, odd_clashing):
        got = {(r.doc_id, r.start, r.end, r.words, r.units, tuple(r.kept_in)) for r in passages.repeated(docs).collect()}
        assert got == brute_passages(odd_rows())
    rng = random.Random(3)
    planted = text(rng, 8)
    rows = [(i, f"{text(rng)} Stock line of text.\n{text(rng)}", None, None, None) for i in range(60)]
    rows += [(i, f"{sentence(rng)} {planted}\n{sentence(rng)}", None, None, None) for i in range(60, 80)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = passages.repeated(docs)
    got = {(r.doc_id, r.start, r.end, r.words, r.units, tuple(r.kept_in)) for r in found.collect()}
    assert got == brute_passages(rows)
    assert {g[0] for g in got} == set(range(61, 80)) and all(60 in g[5] for g in got)
    cut = {r.doc_id: r.text for r in passages.cut_out(docs, found).collect()}
    texts = {r[0]: r[1] for r in rows}
    for i, start, end, *_ in got:
        assert cut[i] == texts[i][:start] + texts[i][end:]
    assert all(cut[i] == texts[i] for i in range(61))
    assert passages.repeated(nothing).count() == 0 and passages.cut_out(nothing, passages.repeated(nothing)).count() == 0


def test_passages_whose_keepers_scatter(spark):
    """Five sentences of 12 words, each first seen in another document: no keeper has 16 words, the run has 60."""
    rng = random.Random(8)
    parts = [sentence(rng, 12) for _ in range(5)]
    rows = [(i, f"{sentence(rng)}\n{p}\n{sentence(rng)}", None, None, None) for i, p in enumerate(parts)]
    rows.append((9, f"{sentence(rng)}\n" + " ".join(parts) + f"\n{sentence(rng)}", None, None, None))
    han = "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(40))  # one word for \w, 40 code points
    rows += [(i, f"{sentence(rng)}\n{han}\n{sentence(rng)}", None, None, None) for i in (20, 21)]
    got = {(r.doc_id, r.words, r.units, tuple(r.kept_in)) for r in passages.repeated(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(9, 60, 5, (0, 1, 2, 3, 4)), (21, 40, 1, (20,))}


def test_passages_inside_one_document(spark):
    """Further copies go, in the keeper and in a text that only repeats itself; repeated rows are no repeats."""
    rng = random.Random(9)
    once, twice, apart = (sentence(rng, 20) for _ in range(3))
    own = "\n".join([once, sentence(rng), once, once])
    rows = [(1, f"{twice}\n{sentence(rng)}\n{twice}", None, None, None), (2, f"{sentence(rng)}\n{twice}", None, None, None), (3, own, None, None, None), (4, f"{apart}\n{sentence(rng)}", None, None, None)]
    rows += [rows[-1], (5, f"{apart} {sentence(rng)}", None, None, None), (5, f"{apart} {sentence(rng)}", None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = passages.repeated(docs)
    got = Counter((r.doc_id, r.words, r.units, tuple(r.kept_in)) for r in found.collect())
    assert got == Counter({(1, 20, 1, (1,)): 1, (2, 20, 1, (1,)): 1, (3, 40, 2, (3,)): 1, (5, 20, 1, (4,)): 2})
    left = [r.text for r in passages.cut_out(docs, found).collect()]
    assert [sum(t.count(p[:-1]) for t in left) for p in (once, twice)] == [1, 1] and sum(apart[:-1] in t for t in left) == 2
