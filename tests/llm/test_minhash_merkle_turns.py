"""MinHash groups, Merkle manifests and conversation repair against plain versions."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from cohortwave.llm import merkle, minhash, turns, wholesets
from tests.llm.conftest import SCHEMA, odd_rows
from tests.llm.test_similar import near_copies

BLANK = " \t\n\x0b\f\r"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


# MinHash


def grams(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t or ""))
    return {" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()


def brute_groups(rows):
    """(id is null, id, set size, component, kept) of every row, by all pairs."""
    sets, root = [grams(r[1]) for r in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        k = (r[0] is None, r[0])
        least[find(i)] = min(least.get(find(i), (True, 1 << 60) if r[0] is not None else k), k) if find(i) in least else k
    return sorted((r[0] is None, r[0] or 0, len(sets[i]), least[find(i)][1] if least[find(i)][1] is not None else -1, r[0] == least[find(i)][1]) for i, r in enumerate(rows))


def got_groups(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, -1 if r.component_id is None else r.component_id, r.kept) for r in df.collect())


@pytest.fixture(scope="module")
def copies(spark):
    rng = random.Random(11)
    rows = near_copies(rng) + [(1000 + r[0] if r[0] is not None else None, *r[1:]) for r in odd_rows()]
    # texts of one template that are close, but under the limit, so buckets stay torn; then a chain of links through them
    base = [f"w{i}" for i in range(100)]
    for k in range(30):
        w = list(base)
        for i in rng.sample(range(100), 5):
            w[i] = f"x{k}"
        rows.append((3000 + k, " ".join(w), None, None, None))
    for k in range(12):
        rows.append((4000 + k, " ".join(base[: 60 + 4 * k]), None, None, None))
    return rows


def test_minhash_groups_equal_all_pairs(spark, copies):
    docs = spark.createDataFrame(copies, SCHEMA).repartition(3)
    clashing = docs.select("*", *[F.lit("x").alias(c) for c in ("node", "band", "sig", "n", "key", "root", "at", "tile")])
    assert got_groups(minhash.near_duplicates(clashing)) == brute_groups(copies)


def test_a_bucket_left_torn_is_compared_in_tiles(spark, copies):
    """The comparison in tiles alone finds what connects the groups, whatever the tiles."""
    sets = {i: wholesets.shingle_set((r[1] or "").encode(), 3) for i, r in enumerate(copies) if r[0] is None or r[0] >= 3000 or r[0] < 60}
    held = [{"node": i, "root": i, "n": len(s), "mark": minhash.signature(s).tobytes(), "held": s.tobytes()} for i, s in sets.items() if len(s)]
    want = {(a["node"], b["node"]) for a, b in product(held, held) if a["node"] < b["node"] and wholesets.linked(sets[a["node"]], sets[b["node"]], 85)}

    def groups(links):
        root = {h["node"]: h["node"] for h in held}
        for _ in held:
            for u, v in links:
                root[u] = root[v] = min(root[u], root[v])
        return root

    tiles = [(held[:40], None), (held[:40], held[40:]), (held[40:], None)]
    found = [link for k in range(minhash.BANDS) for a, b in tiles for link in wholesets.tile_links(a, b, k, minhash.alike(85), 85)]
    assert set(found) <= want | {(v, u) for u, v in want} and groups(found) == groups(want)


def test_minhash_of_nothing(nothing):
    assert minhash.near_duplicates(nothing).count() == 0


# Merkle


def h(s):
    return hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()


def brute_tree(leaves):
    """Root, and for each leaf its siblings level by level."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for i in range(len(leaves)):
            run = at[i] // 16 * 16
            paths[i].append(("".join(level[run : at[i]]), "".join(level[at[i] + 1 : run + 16])))
        at = [a // 16 for a in at]
        level = [h("".join(level[i : i + 16])) for i in range(0, len(level), 16)]
    return level[0], paths


def leaf_of(r, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)))


def brute_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf_of(r, r[1]), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: brute_tree([m[2] for m in sorted(groups[s], key=lambda m: m[:3])]) for s in order}
    root, tops = brute_tree([trees[s][0] for s in order])
    out = []
    for s, top in zip(order, tops):
        for m, path in zip(sorted(groups[s], key=lambda m: m[:3]), trees[s][1]):
            r, steps = m[3], path + top
            fold = leaf_of(r, lower(r[1])) if r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else m[2]
            for a, b in steps:
                fold = h(a + fold + b)
            out.append((m[2], trees[s][0], root, h("".join(a + b for a, b in steps)), fold, fold == root))
    return sorted(out)


def manifest(docs):
    others = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    given = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, merkle.leaf(*others, merkle.lower_ascii(F.col("text"))))
    out = merkle.proofs(docs, "doc_id", "source", merkle.leaf(*others, F.col("text")), given=given)
    fold = merkle.folded(F.coalesce("given", "leaf"), F.col("path"))
    rows = out.select(*[merkle.as_hex(F.col(c)) for c in ("leaf", "subroot", "root")], merkle.proof_hash(F.col("path")), merkle.as_hex(fold), fold == F.col("root")).collect()
    return sorted(tuple(r) for r in rows)


@pytest.mark.parametrize("sizes", [[600, 16, 17, 1], [1], [5] * 40])
def test_manifest_equals_plain_trees(spark, sizes):
    rows = [(k * 1000 + i, f"Text {i} of É {k}", "en", f"s{k}ä" if k else None, i) for k, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), SCHEMA).repartition(3)
    got = manifest(docs)
    assert got == brute_manifest(rows) and {r[5] for r in got} <= {True, False}


def test_manifest_of_odd_rows(odd_clashing):
    assert manifest(odd_clashing) == brute_manifest(odd_rows())


def test_manifest_of_nothing(nothing):
    assert manifest(nothing) == []


# Conversations

CONV = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"


def plain_repair(rows):
    """Facts and the cheapest edits of one conversation: every state with its least (cost, audit) after every turn."""
    rows = sorted(((t is not None, t or 0, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows))
    numbers = [t for known, t, _, _ in rows if known]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    seen, marks, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, _, role, text in rows:
        shown = text.strip(BLANK)
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None
        seen.add((role, text))
        marks.append((role, text, fault))
        if fault:
            count[fault] += 1
    initials = [m[0][:1] for m in marks]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    follow = {"": "u", "s": "u", "u": "a", "a": "u"}
    full = {"u": "user", "a": "assistant"}
    best = {"": (0, "", ())}

    def better(at, state, value):
        if state not in at or value < at[state]:
            at[state] = value

    def inserted(at):
        for _ in range(3):
            for state, (cost, audit, lines) in list(at.items()):
                n = follow[state]
                better(at, n, (cost + 3, audit + "I", lines + (full[n] + ":",)))
        return at

    for role, text, fault in marks:
        new = {}
        for state, (cost, audit, lines) in inserted(best).items():
            better(new, state, (cost + 4, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more, n = 3 if fault else 0, follow[state]
            if role[:1] == n or role[:1] == "s" and state == "":
                better(new, role[:1], (cost + more, audit + "K", lines + (f"{role}:{text}",)))
            better(new, n, (cost + more + 3, audit + "R", lines + (f"{full[n]}:{text}",)))
        best = new
    cost, audit, lines = min(v for k, v in inserted(best).items() if k in ("", "a"))
    return (gaps, *count.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def brute_report(rows):
    given = {}
    for c, t, role, text in rows:
        given.setdefault(c, [])
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        given[c] += [(t, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    none = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    return sorted((c is None, c or 0, *(plain_repair(g) if g else none)) for c, g in given.items())


def got_report(df):
    return sorted((r.conv_id is None, r.conv_id or 0, r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect())


def some_turns(rng, n):
    said = ["Well.", "Is it?", "cut off", " \n", "", None, "Go!", "Ünï. ", "no end \t"]
    return [(rng.choice([None, i, i]), rng.choice(["user", "assistant", "system", "tool", "user", "assistant", None, ""]), rng.choice(said) if rng.random() < 0.6 else f"turn {i}.") for i in range(n)]


def test_repair_equals_plain_programme(spark):
    rng = random.Random(13)
    rows = [(c, *t) for c in [*range(150), None] for t in some_turns(rng, rng.randrange(1, 12))]
    rows += [(900, t, "system", "S.") for t in range(3)] + [(901, None, None, None)]
    df = spark.createDataFrame(rows, CONV).repartition(3).select("*", *[F.lit("x").alias(c) for c in ("g", "id", "pos", "n", "at", "fault", "said", "stretch", "edit", "ord")])
    assert got_report(turns.report(df, turns.damaged(df))) == brute_report(rows)


def test_a_conversation_longer_than_a_stretch(spark):
    rng = random.Random(14)
    rows = [(1, i, role, f"t{i}." if rng.random() < 0.9 else "x") for i, role in enumerate(rng.choices(["user", "assistant", "system"], [5, 4, 1], k=3 * turns.STRETCH + 5))]
    rows += [(2, i, "user", f"u{i}.") for i in range(turns.STRETCH)] + [(3, 0, "user", "a.")]
    df = spark.createDataFrame(rows, CONV).repartition(3)
    got = got_report(turns.report(df, df))
    plain = {c: [r[1:] for r in rows if r[0] == c] for c in (1, 2, 3)}
    assert got == [(False, c, *plain_repair(p)) for c, p in plain.items()]


def test_repaired_turns_are_legal(spark):
    rng = random.Random(15)
    df = spark.createDataFrame([(c, *t) for c in range(40) for t in some_turns(rng, 8)], CONV)
    out = turns.repair(df)[1].where("edit <> 'D'").collect()
    for c in {r.g for r in out}:
        roles = "".join(r.role[0] for r in sorted((r for r in out if r.g == c), key=lambda r: r.ord))
        assert re.fullmatch("(s?(ua)+)?", roles)


def test_repair_of_nothing(spark):
    nothing = spark.createDataFrame([], CONV)
    assert turns.report(nothing, turns.damaged(nothing)).count() == 0


def test_powers_of_a_run_equal_single_steps():
    for symbol, n in product("suaoSUAOx", (1, 2, 7, 40)):
        assert (turns.matrix([(symbol, n)]) == turns.matrix([(symbol, 1)] * n)).all()
