"""Manifest of a table as Merkle trees: a tree per group of rows, and one over the groups.

A tree has runs of FAN consecutive nodes; the digest of a run is the SHA-256 of its members' digests as lower-case hex
text. Digests are kept as 32 bytes and turned into hex text where they are hashed.
"""

from pyspark.sql import Column, DataFrame, functions as F

from cohortwave.llm.places import placed
from cohortwave.session import keep

FAN = 16
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def sha(value: Column) -> Column:
    """SHA-256 of a text or of bytes, as 32 bytes."""
    return F.unhex(F.sha2(value, 256))


def as_hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def field(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value, so that no two rows are written alike."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return sha(F.concat(*map(field, values)))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def _siblings(level: DataFrame) -> DataFrame:
    """Nodes (g, pos, n, digest, ...) of groups with several ones, with `up`, their parent's place, and `left` and `right`,
    the digests of their run before and after them.

    These are lag and lead columns of fixed offsets, masked by the slot of the node in its run and the length of the run.
    Windows end where runs do, so a group of any size is spread over all tasks.
    """
    over = "OVER (PARTITION BY g, up ORDER BY pos)"
    before = [f"coalesce(IF(slot >= {k}, lag(digest, {k}) {over}, NULL), X'')" for k in range(FAN - 1, 0, -1)]
    after = [f"coalesce(IF(slot + {k} < length, lead(digest, {k}) {over}, NULL), X'')" for k in range(1, FAN)]
    several = level.where("n > 1").selectExpr("*", f"pos DIV {FAN} AS up", f"pos % {FAN} AS slot", f"least({FAN}, n - pos + pos % {FAN}) AS length")
    return several.selectExpr("*", f"concat({', '.join(before)}) AS left", f"concat({', '.join(after)}) AS right").drop("slot", "length")


def _levels(leaves: DataFrame) -> list[DataFrame]:
    """The nodes (g, pos, n, digest) of all levels, of all groups at once; a group ends at the level where its n is 1.

    Rows of first children hash to the parents. A level above the leaves is a written table, a sixteenth of the one below.
    The driver asks once per level whether a group is left with several nodes.
    """
    levels = [leaves]
    while not levels[-1].where("n > 1").isEmpty():
        first = _siblings(levels[-1].select("g", "pos", "n", "digest")).where(F.col("pos") % FAN == 0)
        parent = sha(as_hex(F.concat("digest", "right")))
        levels.append(keep(first.select("g", F.col("up").alias("pos"), F.ceil(F.col("n") / FAN).alias("n"), parent.alias("digest")), "nodes"))
    return levels


def _paths(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """The leaves with what `above` (g, path, ...) says of their group, and `path` led down to them: an entry
    (left, right) for each level from the leaf up."""
    told = [c for c in above.columns if c not in ("g", "path")]
    known = None
    for level in reversed(levels):
        own = [c for c in level.columns if c not in ("g", "pos", "n")]
        here = level.where("n = 1").join(above, "g").select("g", "pos", *own, *told, "path")
        if known is not None:
            up = known.select("g", F.col("pos").alias("up"), *told, F.col("path").alias("rest"))
            led = _siblings(level).join(up, ["g", "up"])
            here = here.unionByName(led.select("g", "pos", *own, *told, F.concat(F.array(F.struct("left", "right")), "rest").alias("path")))
        known = here if level is levels[0] else keep(here.drop("digest"), "paths")
    return known


def proofs(rows: DataFrame, id_col: str, group_col: str, leaf: Column, **carried: Column) -> DataFrame:
    """(id, leaf, subroot, root, path, carried columns) of every row of `rows`: its digest, that of its group's tree, that
    of the tree of groups, and the siblings that lead from it to the root (array of (left, right), bytes).

    Leaves of a group ascend by id (null first); rows that share an id by digest, equal rows are leaves of their own.
    Groups ascend bytewise by UTF-8, null is a group and the first. A group of one row has its leaf for a subroot, a
    table of one group that subroot for its root; an empty table gives no rows. Whole texts are hashed where they are
    read; later steps move digests only. Other columns of `rows` are not looked at.
    """
    g = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    named = {f"carried_{k}": v for k, v in carried.items()}
    digests = keep(rows.select(F.col(id_col).alias("id"), g.alias("g"), leaf.alias("digest"), *[v.alias(k) for k, v in named.items()]), "leaves")
    levels = _levels(placed(digests, "g", ["id", "digest"], "ranges")[0].drop("at"))
    subroots = levels[0].where("n = 1").select("g", "digest")
    for level in levels[1:]:
        subroots = subroots.union(level.where("n = 1").select("g", "digest"))
    groups = placed(keep(subroots.select(F.lit("all").alias("g"), F.col("g").alias("of"), F.col("digest"), F.col("digest").alias("subroot")), "subroots"), "g", ["of"], "groups")[0].drop("at")
    upper = _levels(groups)
    root = upper[-1].select("g", F.col("digest").alias("root"), F.expr("CAST(array() AS array<struct<left: binary, right: binary>>)").alias("path"))
    tops = keep(_paths(upper, root).select(F.col("of").alias("g"), "subroot", "root", "path"), "tops")
    return _paths(levels, tops).select(F.col("id").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root", "path", *[F.col(k).alias(k.removeprefix("carried_")) for k in named])


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda at, s: sha(as_hex(F.concat(s["left"], at, s["right"]))))


def proof_hash(path: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right, as hex text."""
    return F.sha2(F.array_join(F.transform(path, lambda s: as_hex(F.concat(s["left"], s["right"]))), ""), 256)


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text as DuckDB SQL: a byte is mixed in, then eight shifts."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    return f"xor(list_reduce(list_prepend(4294967295, {steps}), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295)"


def _field_sql(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}, '-')"


def _grow_sql(name: str, start: str) -> str:
    return f"""{name} AS (
  {start}
  UNION ALL
  SELECT level + 1, g, pos // {FAN}, sha256(string_agg(digest, '' ORDER BY pos)), (n + {FAN - 1}) // {FAN} FROM {name} WHERE n > 1 GROUP BY level, g, n, pos // {FAN}),
{name}_near AS (
  SELECT level, g, pos, coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(digest, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name} WHERE n > 1 WINDOW w AS (PARTITION BY level, g, pos // {FAN} ORDER BY pos))"""


_FIELDS = ["doc_id", "source", "lang", "n_chars"]
SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n,
         sha256({" || ".join(map(_field_sql, [*_FIELDS, "text"]))}) AS leaf,
         sha256({" || ".join(map(_field_sql, [*_FIELDS, f"CASE WHEN {crc32_sql('doc_id::VARCHAR')} % 5 = 0 THEN translate(text, '{_UPPER}', '{_UPPER.lower()}') ELSE text END"]))}) AS given
  FROM documents),
{_grow_sql("nodes", "SELECT 0 AS level, g, pos, leaf AS digest, n FROM leaves")},
subroots AS (SELECT g, digest, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
{_grow_sql("tops", "SELECT 0 AS level, 'all' AS g, pos, digest, n FROM subroots")},
walk AS (
  SELECT doc_id, 0 AS level, g, pos, given AS digest, '' AS proof FROM leaves
  UNION ALL
  SELECT doc_id, level + 1, g, pos // {FAN}, sha256(l || digest || r), proof || l || r FROM walk JOIN nodes_near USING (level, g, pos)),
over AS (
  SELECT w.doc_id, 0 AS level, s.pos, w.digest, w.proof
  FROM (SELECT doc_id, any_value(g) AS g, arg_max(digest, level) AS digest, arg_max(proof, level) AS proof FROM walk GROUP BY doc_id) w JOIN subroots s USING (g)
  UNION ALL
  SELECT doc_id, level + 1, pos // {FAN}, sha256(l || digest || r), proof || l || r FROM over JOIN tops_near USING (level, pos)),
ends AS (SELECT doc_id, arg_max(digest, level) AS folded_root, arg_max(proof, level) AS proof FROM over GROUP BY doc_id),
root AS (SELECT digest AS root FROM tops WHERE n = 1)
SELECT doc_id, leaf, s.digest AS subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN subroots s USING (g) JOIN ends USING (doc_id) CROSS JOIN root
"""
