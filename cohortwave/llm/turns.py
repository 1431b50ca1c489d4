"""Repair of the role order in conversations: the cheapest edits, by a min-plus dynamic programme over runs of equal symbols.

A turn is a symbol: its role's initial (s, u, a, or o for any other) and whether it is cut short (upper case), or x where
it has to go. Between two turns a conversation is in one of four states: nothing is out yet, or the last turn out is a
system's, a user's or an assistant's. A symbol is a 4 x 4 matrix of the least cost from state to state, insertions before
it included; runs of a symbol are powers of its matrix, and stretches of a conversation are products.
"""

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cohortwave.llm.merkle import crc32_sql
from cohortwave.llm.places import placed
from cohortwave.llm.words import small_batches
from cohortwave.session import keep

KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 3, 4, 3, 3
STRETCH = 4096  # turns of a conversation that are worked on together
_ORD = 1 << 14  # numbers of edits per stretch: up to three for each turn
FAR = 1 << 40
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # what a user's or assistant's turn may come as, after each state
ENDS = np.array([0, FAR, FAR, 0], dtype=np.int64)
_INITIALS = ("", "s", "u", "a")
_BLANK = " \t\n\x0b\f\r"


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product; costs of FAR and more are no way."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), FAR)


_SAME = np.full((4, 4), FAR, dtype=np.int64)
np.fill_diagonal(_SAME, 0)
_ONE_IN = np.full((4, 4), FAR, dtype=np.int64)
for _state, _then in enumerate(NEXT):
    _ONE_IN[_state, _then] = INSERT
#: Any number of insertions; two lead from every state on to one that is met before, so more are never cheaper.
INSERTS = np.minimum(_SAME, np.minimum(_ONE_IN, times(_ONE_IN, _ONE_IN)))


@lru_cache(maxsize=None)  # nine symbols
def steps(symbol: str) -> tuple[tuple[tuple[str, int, int], ...], ...]:
    """For each state the edits of a turn (initial, cost, state after it), in ASCII order."""
    out = []
    for state in range(4):
        ways = [("D", DELETE, state)]
        if symbol != "x":
            more = CUT_SHORT if symbol.isupper() else 0
            own = _INITIALS.index(symbol.lower()) if symbol.lower() in _INITIALS else None
            if own == NEXT[state] or own == SYSTEM and state == START:
                ways.append(("K", KEEP + more, own))
            ways.append(("R", REROLE + more, NEXT[state]))
        out.append(tuple(ways))
    return tuple(out)


@lru_cache(maxsize=None)  # nine symbols, and as many powers as a length has bits
def power(symbol: str, k: int) -> np.ndarray:
    """Matrix of 2 ** k turns of a symbol."""
    if k:
        return times(power(symbol, k - 1), power(symbol, k - 1))
    one = np.full((4, 4), FAR, dtype=np.int64)
    for state, ways in enumerate(steps(symbol)):
        for _, cost, to in ways:
            one[state, to] = min(one[state, to], cost)
    return times(INSERTS, one)


def runs_of(symbols: str) -> list[tuple[str, int]]:
    return [(s, sum(1 for _ in g)) for s, g in groupby(symbols)]


def matrix(runs: list[tuple[str, int]]) -> np.ndarray:
    out = _SAME
    for symbol, n in runs:
        for k in range(n.bit_length()):
            if n >> k & 1:
                out = times(out, power(symbol, k))
    return out


def back(symbol: str, n: int, to_go: np.ndarray) -> np.ndarray:
    """Least cost from each state before n turns of a symbol, by what it is after them."""
    for k in range(n.bit_length()):
        if n >> k & 1:
            to_go = (power(symbol, k) + to_go[None, :]).min(axis=1)
    return to_go


def last_to_go() -> np.ndarray:
    return (INSERTS + ENDS[None, :]).min(axis=1)


def unroll(runs: list[tuple[str, int]], state: int, to_go: np.ndarray, ends: bool) -> tuple[str, str, int]:
    """The edits of a stretch that begins in `state` and has `to_go` from its end: their initials (the ASCII-least of
    the cheapest), the initials of the roles they put out (a blank for a deletion), and the state after them.

    At each point the least initial that is still on a cheapest way is taken; an initial leads to one state only, so
    this gives the least text. Of a run only its own costs to go are held, got back from those after it.
    """
    after = [to_go]
    for symbol, n in reversed(runs):
        after.append(back(symbol, n, after[-1]))
    edits, roles = [], []
    for (symbol, n), end in zip(runs, after[-2::-1]):
        inner = [end]
        for _ in range(n):
            inner.append((power(symbol, 0) + inner[-1][None, :]).min(axis=1))
        ways = steps(symbol)
        for here, then in zip(inner[:0:-1], inner[-2::-1]):
            left = here[state]
            while True:
                delete, *others = ways[state]
                pick = delete if delete[1] + then[state] == left else None
                if pick is None and INSERT + here[NEXT[state]] == left:
                    edits.append("I")
                    state, left = NEXT[state], left - INSERT
                    roles.append(_INITIALS[state])
                    continue
                pick = pick or next(w for w in others if w[1] + then[w[2]] == left)
                edits.append(pick[0])
                roles.append(" " if pick is delete else _INITIALS[pick[2]])
                state = pick[2]
                break
    while ends and ENDS[state]:
        edits.append("I")
        state = NEXT[state]
        roles.append(_INITIALS[state])
    return "".join(edits), "".join(roles), state


def faults(rows: DataFrame) -> DataFrame:
    """`rows` (g, pos, said, shown) with `fault`, the first of blank, duplicate, truncated, or null.

    The first place of what is said is a pre-aggregated minimum, joined back where several rows say it.
    """
    again = rows.groupBy("g", "said").agg(F.min("pos").alias("first"), F.count("*").alias("times")).where("times > 1")
    known = rows.join(again.select("g", "said", "first"), ["g", "said"], "left")
    fault = F.when(F.col("shown") == "", "blank").when(F.col("pos") > F.col("first"), "duplicate").when(~F.col("shown").isin(".", "!", "?"), "truncated")
    return known.withColumn("fault", fault).drop("said", "first", "shown")


def _symbol(role: Column, fault: Column) -> Column:
    initial = F.left(role, F.lit(1))
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return F.when(fault.isin("blank", "duplicate"), "x").when(fault == "truncated", F.upper(known)).otherwise(known)


def _stretches(marked: DataFrame) -> DataFrame:
    """(g, stretch, last, symbols): up to STRETCH turns of a conversation as one text of symbols."""
    at = marked.select("g", F.floor(F.col("pos") / STRETCH).alias("stretch"), F.floor((F.col("n") - 1) / STRETCH).alias("last"), "pos", _symbol(F.col("role"), F.col("fault")).alias("s"))
    parts = at.groupBy("g", "stretch", "last").agg(F.sort_array(F.collect_list(F.struct("pos", "s"))).alias("at"))
    return parts.select("g", "stretch", "last", F.array_join(F.transform("at", lambda x: x["s"]), "").alias("symbols"))


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


_LONGS = pa.list_(pa.int64())


def _costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [(g, k, matrix(runs_of(s)).ravel().tolist()) for g, k, s in zip(*(b.column(c).to_pylist() for c in ("g", "stretch", "symbols")))]
        yield _batch(rows, ["g", "stretch", "m"], [pa.string(), pa.int64(), _LONGS])


def _to_go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs to go from the end of each stretch, and from its start, by the matrices of a conversation's stretches."""
    for b in batches:
        rows = []
        for g, parts in zip(b.column("g").to_pylist(), b.column("parts").to_pylist()):
            to_go = last_to_go()
            for p in reversed(parts):
                before = (np.array(p["m"], dtype=np.int64).reshape(4, 4) + to_go[None, :]).min(axis=1)
                rows.append((g, p["stretch"], to_go.tolist(), int(before[START])))
                to_go = before
        yield _batch(rows, ["g", "stretch", "to_go", "cost"], [pa.string(), pa.int64(), _LONGS, pa.int64()])


def _ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state after a stretch for each state before it."""
    for b in batches:
        rows = []
        for g, k, s, to_go in zip(*(b.column(c).to_pylist() for c in ("g", "stretch", "symbols", "to_go"))):
            runs, to_go = runs_of(s), np.array(to_go, dtype=np.int64)
            rows.append((g, k, [unroll(runs, state, to_go, False)[2] for state in range(4)]))
        yield _batch(rows, ["g", "stretch", "exits"], [pa.string(), pa.int64(), _LONGS])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for g, parts in zip(b.column("g").to_pylist(), b.column("parts").to_pylist()):
            state = START
            for p in parts:
                rows.append((g, p["stretch"], state))
                state = p["exits"][state]
        yield _batch(rows, ["g", "stretch", "entry"], [pa.string(), pa.int64(), pa.int64()])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["g", "ord", "edit", "out", "pos"]
    for b in batches:
        for g, k, last, s, to_go, entry in zip(*(b.column(c).to_pylist() for c in ("g", "stretch", "last", "symbols", "to_go", "entry"))):
            edits, roles, _ = unroll(runs_of(s), entry, np.array(to_go, dtype=np.int64), k == last)
            rows, pos = [], k * STRETCH
            for i, (edit, out) in enumerate(zip(edits, roles)):
                rows.append((g, k * _ORD + i, edit, out, None if edit == "I" else pos))
                pos += edit != "I"
            yield _batch(rows, names, [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()])


def _gathered(parts: DataFrame, value: str) -> DataFrame:
    """A conversation's stretches in order; a row of a few numbers for each STRETCH turns."""
    return parts.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("stretch", value))).alias("parts"))


def mark(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(marked, turns): the turns of each conversation with their places and faults, (g, id, turn, role, pos, n, at, fault),
    and their texts (at, text), both written tables.

    `g` is the conversation's id as a text that is not null. Turns ascend (null first); rows of one turn come by role
    and text. A null role or text is one space. Other columns are not looked at.
    """
    g = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit(""))
    of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    own = rows.select(g.alias("g"), F.col(id_col).alias("id"), F.col(turn_col).alias("turn"), of(role_col).alias("role"), of(text_col).alias("text"))
    put, turns = placed(own, "g", ["turn", "role", "text"], "turns")
    said = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    shown = F.right(F.btrim("text", F.lit(_BLANK)), F.lit(1))
    marked = faults(put.select("g", "id", "turn", "role", "pos", "n", "at", said.alias("said"), shown.alias("shown")))
    return keep(marked, "marked"), turns.select("at", "text")


def edits(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(g, ord, edit, out, pos) and (g, cost) of the conversations of `mark`: the edits in order, the initial of the role
    that each puts out (a blank for a deletion), and the place of the turn that it takes (null for an insertion).

    Stretches of up to STRETCH turns are worked on by themselves, so a conversation with a third of all turns is spread:
    their matrices lead costs back from its end, then the states they turn into each other lead its start on, and at
    last each stretch is unrolled. Only a row of a few numbers for each stretch meets those of the same conversation.
    """
    parts = keep(_stretches(marked), "stretches")
    costs = keep(parts.select("g", "stretch", "symbols").mapInArrow(_costs, "g string, stretch bigint, m array<bigint>"), "matrices")
    to_go = keep(_gathered(costs, "m").mapInArrow(_to_go, "g string, stretch bigint, to_go array<bigint>, cost bigint"), "to_go")
    known = keep(parts.join(to_go, ["g", "stretch"]), "known")
    ways = keep(known.select("g", "stretch", "symbols", "to_go").mapInArrow(_ways, "g string, stretch bigint, exits array<bigint>"), "ways")
    entries = keep(_gathered(ways, "exits").mapInArrow(_entries, "g string, stretch bigint, entry bigint"), "entries")
    entered = known.join(entries, ["g", "stretch"]).select("g", "stretch", "last", "symbols", "to_go", "entry")
    return keep(entered.mapInArrow(_edits, "g string, ord bigint, edit string, out string, pos bigint"), "edits"), to_go.where("stretch = 0").select("g", "cost")


def repaired(marked: DataFrame, turns: DataFrame, done: DataFrame) -> DataFrame:
    """(g, ord, edit, turn, role, text): the edits of each conversation in order, with the turn that each puts out; role and
    text are null for a deletion. An inserted turn has no number and an empty text."""
    new = F.when(F.col("out") == "u", "user").when(F.col("out") == "a", "assistant")
    took = done.where("edit <> 'I'").join(marked.select("g", "pos", "at", "turn", F.col("role").alias("old")), ["g", "pos"])
    role = F.when(F.col("edit") == "K", F.col("old")).when(F.col("edit") == "R", new)
    own = took.select("g", "ord", "edit", "turn", role.alias("role"), "at")
    out = own.where("edit = 'D'").withColumn("text", F.lit(None).cast("string")).drop("at").unionByName(own.where("edit <> 'D'").join(turns, "at").drop("at"))
    inserted = done.where("edit = 'I'").select("g", "ord", "edit", F.lit(None).cast(marked.schema["turn"].dataType).alias("turn"), new.alias("role"), F.lit("").alias("text"))
    return out.unionByName(inserted)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows that come in order: a conversation's edits, and the SHA-256 of its lines as they stream past."""
    now, audit, sha = None, [], hashlib.sha256()
    begun = False
    names, kinds = ["g", "audit", "repaired_sha256"], [pa.string()] * 3
    for b in batches:
        rows = []
        for g, edit, role, text in zip(*(b.column(c).to_pylist() for c in ("g", "edit", "role", "text"))):
            if g != now:
                if now is not None:
                    rows.append((now, "".join(audit), sha.hexdigest()))
                now, audit, sha, begun = g, [], hashlib.sha256(), False
            audit.append(edit)
            if edit != "D":
                sha.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                begun = True
        yield _batch(rows, names, kinds)
    if now is not None:
        yield _batch([(now, "".join(audit), sha.hexdigest())], names, kinds)


def digests(done: DataFrame) -> DataFrame:
    """(g, audit, repaired_sha256) of the rows of `repaired`. A hash of a whole conversation is a sequence by its nature:
    its rows are sorted by Spark and stream past one task, which holds an initial for each edit and no texts."""
    ordered = small_batches(done.select("g", "ord", "edit", "role", "text").repartition("g").sortWithinPartitions("g", "ord"))
    return ordered.select("g", "edit", "role", "text").mapInArrow(_digests, "g string, audit string, repaired_sha256 string")


def _illegal(marked: DataFrame) -> DataFrame:
    """(g, illegal): neighbours whose initials are not su, ua or au. The last turn of a stretch is seen in the next one too."""
    own = F.floor(F.col("pos") / STRETCH)
    seen = F.when(F.col("pos") % STRETCH == STRETCH - 1, F.array(own, own + 1)).otherwise(F.array(own))
    rows = marked.select("g", "pos", own.alias("own"), F.left("role", F.lit(1)).alias("i"), F.explode(seen).alias("stretch"))
    pair = F.concat(F.lag("i").over(W.partitionBy("g", "stretch").orderBy("pos")), "i")
    wrong = rows.withColumn("bad", ~pair.isin("su", "ua", "au")).where("own = stretch").groupBy("g")
    return wrong.agg(F.sum(F.when(F.col("bad"), 1).otherwise(0)).alias("illegal"))


def repair(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(report, turns): a row per conversation of `rows`, and the edits with the turns they put out (see `repaired`).

    The report has g, the id, gaps (turn numbers missing between the least and the greatest; null turns do not count),
    the rows at fault (blank, duplicate, truncated), illegal (neighbours whose initials are not su, ua or au), the cost
    of the cheapest edits that leave role initials `(s?(ua)+)?`, audit (their initials in order, the ASCII-least of
    equal costs) and repaired_sha256. Null ids are one conversation, an empty table gives no rows.
    """
    marked, texts = mark(rows, id_col, turn_col, role_col, text_col)
    done, costs = edits(marked)
    out = repaired(marked, texts, done)
    missing = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint")
    counts = [F.count(F.when(F.col("fault") == k, 1)).alias(k) for k in ("blank", "duplicate", "truncated")]
    facts = marked.groupBy("g").agg(F.first("id").alias(id_col), missing.alias("gaps"), *counts)
    return facts.join(_illegal(marked), "g").join(costs, "g").join(digests(out), "g"), out


def damaged(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """`rows` with faults by CRC-32 of `id:turn` (null: one space) modulo 20: 0 drops a row, 1 empties its text, 2 takes
    full stops, exclamation and question marks out, 3 repeats it, 4 makes it a user's. A null role or text is one space."""
    of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(of(id_col), F.lit(":"), of(turn_col))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(of(text_col), ".!?", "")).otherwise(of(text_col))
    role = F.when(kind == 4, "user").otherwise(of(role_col))
    twice = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__copy")
    return rows.where(kind != 0).select(F.col(id_col), F.col(turn_col), role.alias(role_col), text.alias(text_col), twice).drop("__copy")


def report(rows: DataFrame, given: DataFrame, id_col: str = "conv_id", **cols: str) -> DataFrame:
    """The report of `repair` on `given` for every id of `rows`; zeros and an empty text where no row is left."""
    g = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit(""))
    every = rows.select(g.alias("g"), F.col(id_col).alias("__id")).groupBy("g").agg(F.first("__id").alias("__id"))
    out = every.join(repair(given, id_col, **cols)[0].drop(id_col), "g", "left")
    zero = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select(F.col("__id").alias(id_col), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def _ways_sql() -> str:
    """(state, symbol, ins, edit, cost, out, after): what may be done up to and with a turn, after up to two insertions."""
    rows = []
    for symbol in "suaoSUAOx":
        for first in range(4):
            state, ins, said = first, "", ""
            for n in range(3):
                for edit, cost, to in steps(symbol)[state]:
                    rows.append(f"({first}, '{symbol}', '{ins}{edit}', {INSERT * n + cost}, '{said}', '{'' if edit == 'D' else _INITIALS[to]}', {to})")
                state = NEXT[state]
                ins, said = ins + "I", said + ("user:" if state == USER else "assistant:") + "|"
    for first in range(4):
        state, ins, said = first, "", ""
        for n in range(3):
            if not ENDS[state]:
                rows.append(f"({first}, 'end', '{ins}', {INSERT * n}, '{said}', '', {state})")
            state = NEXT[state]
            ins, said = ins + "I", said + ("user:" if state == USER else "assistant:") + "|"
    return ", ".join(rows)


_TRIM = "trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
SQL = f"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM given, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos, right({_TRIM}, 1) AS shown, left(role, 1) AS i FROM damaged),
marked AS (
  SELECT *, CASE WHEN shown = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
                 WHEN shown NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         lag(i) OVER (PARTITION BY conv_id ORDER BY pos) || i AS pair FROM placed),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM marked GROUP BY conv_id),
symbols AS (
  SELECT conv_id, pos, role, text, CASE WHEN fault IN ('blank', 'duplicate') THEN 'x' WHEN fault = 'truncated' THEN upper(c) ELSE c END AS symbol
  FROM (SELECT *, CASE WHEN i IN ('s', 'u', 'a') THEN i ELSE 'o' END AS c FROM marked)
  UNION ALL SELECT conv_id, n + 1, '', '', 'end' FROM facts),
ways(state, symbol, edits, cost, said, out, after) AS (VALUES {_ways_sql()}),
best AS (
  SELECT conv_id, 0 AS pos, 0 AS state, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM facts
  UNION ALL
  SELECT conv_id, pos, state, (b).cost, (b).audit, (b).lines FROM (
    SELECT b.conv_id, s.pos, w.after AS state,
           min({{'cost': b.cost + w.cost, 'audit': b.audit || w.edits, 'lines': b.lines || list_filter(string_split(w.said, '|'), lambda x: x <> '')
               || CASE WHEN w.out = '' THEN [] WHEN w.edits LIKE '%K' THEN [s.role || ':' || s.text] WHEN w.out = 'u' THEN ['user:' || s.text] ELSE ['assistant:' || s.text] END}}) AS b
    FROM best b JOIN symbols s ON s.conv_id IS NOT DISTINCT FROM b.conv_id AND s.pos = b.pos + 1 JOIN ways w ON w.state = b.state AND w.symbol = s.symbol
    GROUP BY b.conv_id, s.pos, w.after)),
ends AS (
  SELECT conv_id, min({{'cost': cost, 'audit': audit, 'lines': lines}}) AS b FROM best JOIN facts f USING (conv_id) WHERE pos = f.n + 1 GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce((b).cost, 0)::BIGINT AS cost, coalesce((b).audit, '') AS audit, sha256(coalesce(array_to_string((b).lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts USING (conv_id) LEFT JOIN ends USING (conv_id)
"""
