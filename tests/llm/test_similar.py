"""Near-duplicates by 5-word shingles, against all pairs."""

import random

import corpus_pipeline
from cohortwave.llm import similar, simhash
from tests.llm.conftest import SCHEMA, odd_rows, sentence


def grams(t):
    w = (t or "").encode().lower().split()
    return {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_kept(rows):
    """Ids that stay: the smallest of every group that pairs of 0.8 or more link."""
    sets, root = [grams(r[1]) for r in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append((r[0] is None, r[0]))
    return sorted(min(g) for g in groups.values())


def near_copies(rng):
    """Chains of edits, a large group of near copies, and texts that share one passage only."""
    base, passage = sentence(rng, 80).split(), sentence(rng, 30)
    rows = []
    for k in range(60):
        w = list(base)
        w[rng.randrange(80)] = f"w{k}"
        rows.append(" ".join(w))
    for k in range(40):
        w = sentence(rng, 70).split()
        rows += [" ".join(w), " ".join(w[:20] + ["new"] + w[20:]), " ".join(w[:20] + ["new"] + w[20:50] + ["x", "y"] + w[50:]), passage + " " + sentence(rng, 30)]
    rng.shuffle(rows)
    return [(i, t, None, None, None) for i, t in enumerate(rows)]


def test_stage_finds_near_copies_of_ordinary_length(spark):
    rows = near_copies(random.Random(6)) + [(1000 + (r[0] or 0) if r[0] is not None else None, *r[1:]) for r in odd_rows()]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    dedup = dict(corpus_pipeline.STAGES)["near-dedup"]
    got = sorted((r.doc_id is None, r.doc_id) for r in dedup(spark, docs, "").collect())
    assert got == brute_kept(rows)
    assert len(got) < simhash.keep_first(docs).count()


def test_similar_of_nothing(nothing):
    assert similar.keep_first(nothing).count() == 0
