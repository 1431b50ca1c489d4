"""Plans over stimuli: links, labels, ranking, layout and playback checks."""

from pyspark.sql import functions as F

from cohortwave.functions.scalars import safe_label as to_label, video_code
from cohortwave.operators import joins as J, layout as L, stats as A
from cohortwave.plans.registry import plan
from cohortwave.plans.views import EV, Tables
from cohortwave.sources import readers as R

ANCHOR = r'<a href="([^"]*)">([^<]*)</a>'
_LINKS = f"""WITH a AS (SELECT page_id, regexp_extract_all(html, '{ANCHOR}', 2) AS n, regexp_extract_all(html, '{ANCHOR}', 1) AS u FROM pages),
  l AS (SELECT page_id, unnest(range(len(n))) AS pos, unnest(n) AS name, unnest(u) AS url FROM a)
"""


@plan(_LINKS + "SELECT page_id, CAST(pos AS INT) AS pos, name, url FROM l")
def extract_links(d: Tables):
    return R.extract_links(d.pages, ANCHOR, name_group=2, url_group=1)


@plan(_LINKS + "SELECT name AS code, arg_max(url, (page_id, pos)) AS url FROM l WHERE name <> '' GROUP BY 1")
def last_link(d: Tables):
    links = R.extract_links(d.pages, ANCHOR, name_group=2, url_group=1)
    return R.last_link_per_code(links, F.col("name")).select("code", "url")


_CODES = """WITH l AS (SELECT page_id, 'VID_' || (page_id * 7) AS code FROM pages), p AS (SELECT 'VID_' || p_partkey AS code, lower(p_type) AS emotion FROM part WHERE p_size < 25)
"""


def _matched(d: Tables, selected=None):
    links = d.pages.select("page_id", video_code(F.concat(F.lit("clip vid-00"), F.col("page_id") * 7)).alias("code"))
    labels = R.emotion_labels(d.part.where("p_size < 25").select(F.concat(F.lit("VID_"), "p_partkey").alias("video_code"), F.col("p_type").alias("modal_emotion")))
    return J.match_files(links, labels, selected)


@plan(_CODES + "SELECT page_id, code, emotion FROM l JOIN p USING (code) WHERE emotion IN ('large', 'small', 'promo')")
def match_files(d: Tables):
    return _matched(d, ["large", "small", "promo"])[0].select("page_id", "code", "emotion")


@plan(_CODES + "SELECT count(*) AS ignored FROM l WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.code = l.code)")
def unmatched_files(d: Tables):
    return _matched(d)[1]


@plan("""SELECT doc_id, s FROM (SELECT doc_id, coalesce(nullif(regexp_replace(regexp_replace(lower(regexp_replace(text, '^\\s+|\\s+$', '', 'g')), '[^\\pL\\pN_.-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g'), ''), 'unlabelled') AS s FROM documents)""")
def safe_label(d: Tables):
    return d.documents.select("doc_id", to_label(F.col("text")).alias("s"))


@plan("""SELECT page_id, CASE WHEN m = '' THEN '' ELSE 'VID_' || CAST(CAST(m AS BIGINT) AS VARCHAR) END AS code FROM (
  SELECT page_id, regexp_extract(CASE page_id % 3 WHEN 0 THEN 'x ViD-00' || page_id || ' vid9' WHEN 1 THEN 'vid' || page_id || '.webm' ELSE 'clip ' || page_id END, '(?i)VID[_-]?(\\d+)', 1) AS m FROM pages)""")
def code_norm(d: Tables):
    raw = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("x ViD-00"), "page_id", F.lit(" vid9"))).when(F.col("page_id") % 3 == 1, F.concat(F.lit("vid"), "page_id", F.lit(".webm"))).otherwise(
        F.concat(F.lit("clip "), "page_id")
    )
    return d.pages.select("page_id", video_code(raw).alias("code"))


@plan("""WITH l AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '\\n$', ''), chr(10))) AS line FROM documents),
   b AS (SELECT doc_id, regexp_replace(split_part(line, '#', 1), '^\\s+|\\s+$', '', 'g') AS body FROM l),
   p AS (SELECT doc_id, string_split(body, ',') AS parts FROM b WHERE body <> ''),
   e AS (SELECT doc_id, CASE WHEN len(parts) <> 2 THEN 'arity' WHEN trim(parts[2]) NOT IN ('positive', 'negative', 'neutral') THEN 'group' ELSE 'fine' END AS verdict FROM p)
  SELECT doc_id, verdict, count(*) AS n FROM e GROUP BY 1, 2""")
def manual_clips(d: Tables):
    rows = R.parse_manual_clips(d.documents, "doc_id", "text")
    return rows.groupBy("doc_id", F.coalesce("error", F.lit("fine")).alias("verdict")).agg(F.count("*").alias("n"))


@plan("""SELECT p_partkey AS path, p_type AS section, 'VID_' || p_partkey AS video_code, CAST(p_size AS DOUBLE) AS duration_sec, p_size * 40 AS height, true AS picked FROM part
  UNION ALL SELECT p_partkey, p_brand, 'VID_' || (p_partkey + 1), 1.5, 720, false FROM part""")
def sectioned_picks(d: Tables):
    text = F.concat(
        F.lit("# notes\n\n["), "p_type", F.lit("]\nVID_"), "p_partkey", F.lit("\t"), "p_size", F.lit("\t1280x"), F.col("p_size") * 40, F.lit("\n\n["), "p_brand", F.lit("]\n# VID_"),
        F.col("p_partkey") + 1, F.lit("\t1.5\t1280x720  <-- low\n"),
    )
    rows = R.parse_sectioned_picks(d.part.select(F.col("p_partkey").alias("path"), text.alias("value")))
    return rows.select("path", "section", "video_code", "duration_sec", "height", "picked")


@plan("""SELECT event_id, CAST(CASE WHEN value - floor(value) = 0.5 AND floor(value) % 2 = 0 THEN floor(value) ELSE round(value) END AS INT) AS t_sec, event_type AS plugin, 'set' AS cmd,
   CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) END AS value_text FROM events""")
def scenario(d: Tables):
    line = R.scenario_line(F.col("value"), F.col("event_type"), F.lit("set"), F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("string")))
    return R.parse_scenario(d.events.select("event_id", line.alias("value")))


@plan("SELECT o_orderkey, c_acctbal AS valence_score, c_nationkey AS arousal_score FROM orders JOIN customer ON o_custkey = c_custkey")
def enrich(d: Tables):
    clips = d.orders.select("o_orderkey", F.col("o_custkey").alias("title"))
    meta = d.customer.select(F.col("c_custkey").alias("video_code"), F.col("c_acctbal").alias("valence_wsd"), F.col("c_nationkey").alias("arousal_wsd"))
    return J.enrich_clips(clips, meta)[0].drop("title")


@plan("SELECT o_orderkey, o_custkey AS title FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'FURNITURE')")
def enrich_misses(d: Tables):
    clips = d.orders.select("o_orderkey", F.col("o_custkey").alias("title"))
    c = d.customer.where("c_mktsegment <> 'FURNITURE'")
    meta = c.select(F.col("c_custkey").alias("video_code"), F.col("c_acctbal").alias("valence_wsd"), F.col("c_nationkey").alias("arousal_wsd"))
    return J.enrich_clips(clips, meta)[1]


@plan("SELECT l_orderkey AS block_index, l_linenumber AS trial_index, l_partkey AS clip_id, p_brand AS valence_group, p_type AS fine_grained_label, CAST(p_size AS DOUBLE) AS duration_sec FROM lineitem LEFT JOIN part ON l_partkey = p_partkey")
def attach_clip(d: Tables):
    return J.attach_clip(d.trials.select("block_index", "trial_index", "clip_id"), d.clips)


@plan("""WITH rest AS (SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders))
  SELECT c_custkey AS clip_id, c_mktsegment FROM customer WHERE c_custkey IN (SELECT c_custkey FROM rest) OR NOT EXISTS (SELECT 1 FROM rest)""")
def unused(d: Tables):
    return J.unused_clips(d.customer.select(F.col("c_custkey").alias("clip_id"), "c_mktsegment"), d.orders.select(F.col("o_custkey").alias("clip_id")))


@plan("SELECT c_custkey AS clip_id, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def unused_in_part(d: Tables):
    return J.unused_clips(d.customer.select(F.col("c_custkey").alias("clip_id"), "c_mktsegment"), d.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("clip_id")))


_TOP = """SELECT p_brand AS valence_group, p_partkey AS clip_id, CAST(rn AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY p_brand
   ORDER BY CASE WHEN p_brand = 'Brand#5' THEN p_retailprice ELSE -p_retailprice END, p_partkey) AS rn FROM part) WHERE rn <= 3"""


@plan(_TOP)
def top_clips(d: Tables):
    return L.top_clips(d.clips, 3, ascending_groups=("Brand#5",)).select("valence_group", "clip_id", "rank")


@plan("""SELECT p_brand AS valence_group, p_partkey AS clip_id, CAST(rn AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS rn FROM part) WHERE rn <= 4""")
def shortest_k(d: Tables):
    return L.shortest_k(d.clips, 4).select("valence_group", "clip_id", "rank")


@plan("SELECT p_brand AS valence_group, p_partkey AS clip_id FROM part WHERE p_partkey % 12 < 5 AND p_partkey % 4 <> 0")
def fixed_selection(d: Tables):
    fixed = d.clips.where("clip_id % 4 <> 0").select("valence_group", "clip_id", (F.col("clip_id") % 12).alias("pos"))
    return J.fixed_selection(d.clips, fixed, 5).select("valence_group", "clip_id")


@plan("""SELECT p_brand AS valence_group, p_partkey AS clip_id, CAST((row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) - 1 + CAST(substr(p_brand, 7) AS INT)) % 3 AS INT) AS block FROM part""")
def interleaved_blocks(d: Tables):
    c = d.clips.withColumn("group_index", F.expr("cast(substring(valence_group, 7) AS INT)"))
    return L.interleave_in_order(c, ["arousal_score", "clip_id"], 3, ["valence_group"], "group_index", d.cuts("clips", "arousal_score", "clip_id")).select("valence_group", "clip_id", "block")


@plan("SELECT p_brand AS valence_group, p_partkey AS clip_id, CAST(ntile(4) OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS INT) AS chunk FROM part")
def chunk_evenly(d: Tables):
    return L.chunk_evenly(d.clips, 4, ["valence_group"], ["clip_id"], d.cuts("clips", "clip_id", None)).select("valence_group", "clip_id", "chunk")


@plan("SELECT p_brand AS valence_group, count(*) AS n_clips, CAST(sum(p_size) AS DOUBLE) AS clip_sec FROM part GROUP BY 1")
def clip_time_budget(d: Tables):
    return A.clip_time_budget(d.clips)


@plan("""SELECT p_brand AS block, count(*) AS n_clips, CAST(sum(p_size) + (count(*) - 1 - CASE WHEN count(*) >= 2 THEN 1 ELSE 0 END) * 5 + 75 + CASE WHEN count(*) >= 2 THEN 10 ELSE 0 END AS DOUBLE) AS controlled_sec FROM part GROUP BY 1""")
def block_time_budget(d: Tables):
    out = A.block_time_budget(d.clips.withColumnRenamed("valence_group", "block"), 5.0, 60.0, 10.0, 15.0)
    return out.select("block", "n_clips", "controlled_sec")


def _participants(d: Tables):
    return d.nation.select(F.col("n_name").alias("participant_id"))


def _digest(seed: int, *cols: str) -> str:
    """The order number of `ordered.digest` in SQL."""
    return f"('0x' || substr(md5('{seed}|' || {" || '|' || ".join(cols)}), 1, 15))::BIGINT"


def _draws(n: int, seed: int, group: str) -> str:
    """`n` draws of each participant from the parts of each group, by the rounds of `permuted.place`: (who, g, clip, draw)."""
    return f"""WITH RECURSIVE pool AS (SELECT g, clip, row_number() OVER (PARTITION BY g ORDER BY clip) - 1 AS spot, count(*) OVER (PARTITION BY g) AS n FROM (SELECT {group} AS g, p_partkey AS clip FROM part)),
  rounds AS (SELECT n_name AS who, g, n, i, i AS x, 0 AS r FROM nation CROSS JOIN (SELECT DISTINCT g, n FROM pool) CROSS JOIN range({n}) t(i) WHERE i < n
    UNION ALL SELECT who, g, n, i, CASE WHEN {_digest(seed, "r", "who", "g", "greatest(x, y)")} % 2 = 1 THEN y ELSE x END, r + 1
    FROM (SELECT *, ({_digest(seed, "r", "who", "g")} % n - x + n) % n AS y FROM rounds WHERE r < 32)),
  drawn AS (SELECT who, rounds.g, clip, i + 1 AS draw FROM rounds JOIN pool ON pool.g = rounds.g AND spot = x WHERE r = 32)
"""


@plan(_draws(6, 42, "p_type") + "SELECT who AS participant_id, g AS valence_group, clip AS clip_id, CAST(draw AS INT) AS draw FROM drawn")
def seeded_sample(d: Tables):
    """Every participant draws 6 clips of each group."""
    return _six(d).select("participant_id", "valence_group", "clip_id", "draw")


def _six(d: Tables):
    types = d.clips.select(F.col("fine_grained_label").alias("valence_group"), "clip_id")
    wants = _participants(d).select("participant_id", F.explode(F.array(*[F.lit(g) for g in ("STANDARD", "ECONOMY", "MEDIUM", "PROMO", "LARGE", "SMALL")])).alias("valence_group"))
    return L.seeded_sample(wants, types, 6, 42)


_SLOTS = """WITH r AS (SELECT c_custkey AS who, k, CASE WHEN k < 3 THEN 'schulte' ELSE 'stroop' END AS game FROM customer CROSS JOIN range(6) t(k))
"""


@plan(_SLOTS + f"SELECT who AS participant_id, game, CAST(row_number() OVER (PARTITION BY who ORDER BY {_digest(7, 'who', 'k')}, k) - 1 AS INT) AS slot FROM r")
def slot_order(d: Tables):
    """Three slots of each game per participant."""
    return L.slot_order(d.customer.select(F.col("c_custkey").alias("participant_id")), ["schulte", "stroop"], 3, 7).select("participant_id", "game", "slot")


_COLORS = ["red", "green", "blue", "yellow", "purple", "pink"]


@plan(
    f"""WITH r AS (SELECT c_custkey AS who, k, k < 3 AS congruent, {_digest(8, "c_custkey", "k")} % 6 AS ink, {_digest(9, "c_custkey", "k")} % 5 + 1 AS step FROM customer CROSS JOIN range(20) t(k))
  SELECT who AS participant_id, CAST(row_number() OVER (PARTITION BY who ORDER BY {_digest(7, "who", "k")}, k) - 1 AS INT) AS trial_index, congruent,
    {_COLORS}[ink + 1] AS ink_color, {_COLORS}[(ink + CASE WHEN congruent THEN 0 ELSE step END) % 6 + 1] AS word FROM r"""
)
def stroop_stimuli(d: Tables):
    """20 stimuli with 15 % congruent: 3 match, 17 differ."""
    s = L.stroop_stimuli(d.customer.select(F.col("c_custkey").alias("participant_id")), _COLORS, 20, 0.15, 7)
    return s.select("participant_id", "trial_index", "congruent", "ink_color", "word")


_SIZES = [41.0, 61.4, 80.2, 85.3, 102.4]


@plan(
    f"""WITH r AS (SELECT n_name AS who, rep, s, n, (s - 1) * 9 + n AS k FROM nation CROSS JOIN range(3) a(rep) CROSS JOIN range(1, 6) b(s) CROSS JOIN range(1, 10) c(n)),
  o AS (SELECT n_name AS who, n FROM nation CROSS JOIN range(1, 10) c(n) QUALIFY row_number() OVER (PARTITION BY n_name ORDER BY {_digest(8, "n_name", "n")}) <= 3)
  SELECT who AS participant_id, CAST(rep * 45 + row_number() OVER (PARTITION BY who, rep ORDER BY {_digest(7, "who", "rep", "k")}, k) - 1 AS INT) AS trial_index, CAST(n AS INT) AS number,
    {_SIZES}[s]::DOUBLE AS font_size, (who, n) IN (SELECT (who, n) FROM o) AS is_omit FROM r"""
)
def sart_table(d: Tables):
    """3 repetitions of 9 numbers x 5 sizes; 3 numbers are withheld."""
    return L.sart_table(_participants(d), _SIZES, 3, 7).select("participant_id", "trial_index", "number", "font_size", "is_omit")


_GROUPS = "CASE WHEN p_type IN ('LARGE', 'PROMO') THEN 'positive' WHEN p_type IN ('SMALL', 'ECONOMY') THEN 'negative' ELSE 'neutral' END"
_CHOSEN = _draws(4, 11, _GROUPS) + """, s AS (SELECT who, g, clip, CASE g WHEN 'positive' THEN 0 WHEN 'negative' THEN 1 ELSE 2 END AS gi FROM drawn)
"""


def _schedule(d: Tables, structure: str):
    group = F.when(F.col("fine_grained_label").isin("LARGE", "PROMO"), "positive").when(F.col("fine_grained_label").isin("SMALL", "ECONOMY"), "negative").otherwise("neutral")
    s = L.clip_schedule(_participants(d), d.clips.withColumn("valence_group", group), {"positive": 4, "negative": 4, "neutral": 4}, 11, structure=structure)
    return s.select("participant_id", "valence_group", "clip_id", "block", "position")


@plan(
    _CHOSEN
    + f""", i AS (SELECT *, (row_number() OVER (PARTITION BY who, g ORDER BY {_digest(21, "who", "clip")}, clip) - 1 + gi) % 3 AS block FROM s)
  SELECT who AS participant_id, g AS valence_group, clip AS clip_id, CAST(block AS INT) AS block, row_number() OVER (PARTITION BY who, block ORDER BY {_digest(22, "who", "clip")}, clip) AS position FROM i"""
)
def cohort_interleaved(d: Tables):
    """Clip schedule of a cohort: 4 clips of 3 groups over 3 blocks."""
    return _schedule(d, "interleaved")


@plan(
    _CHOSEN
    + f""", o AS (SELECT who, g, row_number() OVER (PARTITION BY who ORDER BY {_digest(21, "who", "g")}, g) - 1 AS block FROM (SELECT DISTINCT who, g FROM s))
  SELECT s.who AS participant_id, s.g AS valence_group, clip AS clip_id, CAST(block AS INT) AS block, row_number() OVER (PARTITION BY s.who, block ORDER BY {_digest(22, "s.who", "clip")}, clip) AS position FROM s JOIN o USING (who, g)"""
)
def cohort_grouped(d: Tables):
    """The same clips with a block for each group."""
    return _schedule(d, "grouped_by_valence")


@plan("""SELECT n_name AS participant_id, p_type AS valence_group, least(count(*), 6) AS n FROM nation CROSS JOIN part GROUP BY 1, 2""")
def seeded_sample_sizes(d: Tables):
    """Every participant draws min(6, pool) clips of each group."""
    s = _six(d)
    return s.groupBy("participant_id", "valence_group").agg(F.count_distinct("clip_id").alias("n"))


@plan("SELECT c_custkey AS participant_id, 3 AS congruent, 17 AS differing, 190 AS order_sum FROM customer")
def stroop_flags(d: Tables):
    """20 stimuli with 15 % congruent: 3 match, 17 differ."""
    s = L.stroop_stimuli(d.customer.select(F.col("c_custkey").alias("participant_id")), ["red", "green", "blue", "yellow", "purple", "pink"], 20, 0.15, 7)
    return s.groupBy("participant_id").agg(
        F.count_if(F.col("congruent") & (F.col("word") == F.col("ink_color"))).cast("int").alias("congruent"), F.count_if(F.col("word") != F.col("ink_color")).cast("int").alias("differing"),
        F.sum("trial_index").cast("int").alias("order_sum"),
    )


@plan("SELECT n_name AS participant_id, 4 AS smallest, 4 AS largest, 12 AS n FROM nation")
def cohort_blocks(d: Tables):
    """Clip schedule of a cohort: 4 clips of 3 groups over 3 blocks are 4 per block."""
    clips = d.clips.withColumn("valence_group", F.when(F.col("fine_grained_label").isin("LARGE", "PROMO"), "positive").when(F.col("fine_grained_label").isin("SMALL", "ECONOMY"), "negative").otherwise("neutral"))
    s = L.clip_schedule(_participants(d), clips, {"positive": 4, "negative": 4, "neutral": 4}, 11)
    b = s.groupBy("participant_id", "block").agg(F.count("*").cast("int").alias("n"))
    return b.groupBy("participant_id").agg(F.min("n").alias("smallest"), F.max("n").alias("largest"), F.sum("n").cast("int").alias("n"))


@plan("SELECT c_custkey AS participant_id, 2 AS last_block, 1 AS groups_per_block FROM customer")
def grouped_blocks(d: Tables):
    rows = d.customer.select(F.col("c_custkey").alias("participant_id"), F.explode(F.array(*[F.lit(x) for x in ("positive", "negative", "neutral")])).alias("valence_group")).withColumn("clip_id", F.col("valence_group"))
    s = L.grouped_blocks(rows, 5)
    b = s.groupBy("participant_id", "block").agg(F.count_distinct("valence_group").cast("int").alias("g"))
    return b.groupBy("participant_id").agg(F.max("block").alias("last_block"), F.max("g").alias("groups_per_block"))


_MERGE = """WITH e AS (SELECT s_suppkey AS line_no, 'VID_' || (s_suppkey * 41) AS code, CASE s_suppkey % 3 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' ELSE 'neutral' END AS g FROM supplier),
  k AS (SELECT 'VID_' || p_partkey AS code, p_brand AS g FROM part), m AS (SELECT 'VID_' || (c_custkey * 10) AS code, c_mktsegment AS emo FROM customer),
  f AS (SELECT e.*, m.emo FROM e JOIN m USING (code) WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.code = e.code))
"""


def _merge(d: Tables):
    clips = d.clips.select(
        F.concat(F.lit("clip_"), "clip_id").alias("clip_id"), "valence_group", "fine_grained_label", F.concat(F.lit("VID_"), "clip_id").alias("title"), F.lit("none").alias("language"), F.lit("f").alias("file_path"), "duration_sec"
    )
    entries = d.supplier.select(
        F.col("s_suppkey").alias("line_no"), F.concat(F.lit("VID_"), F.col("s_suppkey") * 41).alias("video_code"),
        F.when(F.col("s_suppkey") % 3 == 0, "positive").when(F.col("s_suppkey") % 3 == 1, "negative").otherwise("neutral").alias("valence_group"),
    )
    meta = d.customer.select(
        F.concat(F.lit("VID_"), F.col("c_custkey") * 10).alias("video_code"), F.col("c_mktsegment").alias("modal_emotion"), F.lit("TRUE").alias("language_free"), F.col("c_acctbal").alias("length_s"),
        F.lit(1.0).alias("valence_wsd"), F.lit(2.0).alias("arousal_wsd"),
    )
    fixed = d.region.select(F.col("r_name").alias("valence_group"), F.lit(0).alias("pos"), F.lit("clip_0").alias("clip_id"), F.lit("VID_0").alias("title"), F.lit(1.0).alias("valence_score"), F.lit(1.0).alias("arousal_score"))
    speech = F.when(F.col("language_free") == "TRUE", "no speech").otherwise("speech")
    return J.merge_manual_clips(clips, entries, meta, fixed, speech, F.concat_ws("/", F.lit("clips"), "video_code"))


@plan(_MERGE + """SELECT 'clip_' || ((SELECT max(p_partkey) FROM part) + row_number() OVER (ORDER BY line_no)) AS clip_id, code AS title, g AS valence_group, emo AS fine_grained_label FROM f""")
def merged_clips(d: Tables):
    return _merge(d)["clips"].where("file_path <> 'f'").select("clip_id", "title", "valence_group", "fine_grained_label")


@plan(_MERGE + """, a AS (SELECT e.line_no, e.code, coalesce(k.g, e.g) AS g FROM e LEFT JOIN k USING (code) LEFT JOIN m USING (code) WHERE k.code IS NOT NULL OR m.code IS NOT NULL)
  SELECT g AS valence_group, code AS title, CAST(row_number() OVER (PARTITION BY g ORDER BY line_no) - 1 AS INT) AS pos FROM a UNION ALL SELECT r_name, 'VID_0', 0 FROM region""")
def merged_fixed_lists(d: Tables):
    return _merge(d)["fixed"].select("valence_group", "title", "pos")


@plan(_MERGE + "SELECT line_no, code AS video_code FROM e WHERE code NOT IN (SELECT code FROM k) AND code NOT IN (SELECT code FROM m)")
def merge_errors(d: Tables):
    return _merge(d)["errors"]


@plan(EV + """SELECT session_id, count(*) AS checked, count(*) FILTER (k % 7 = 0) AS bad_fit, count(*) FILTER (value < 72) AS low_res, CASE WHEN count(*) FILTER (k % 7 = 0) > 0 THEN 'bad' ELSE 'ok' END AS outcome FROM ev WHERE et = 'view' GROUP BY 1""")
def playback_audit(d: Tables):
    h = (F.col("value") * 10).cast("int")
    body = F.try_parse_json(F.to_json(F.struct(F.col("k").alias("clip_id"), h.alias("native_height"), F.when(F.col("k") % 7 == 0, "fill").otherwise("contain").alias("object_fit"), (F.col("value") < 72).alias("below_720p"))))
    return A.playback_audit(A.playback_rows(d.study({"view": "clip_video_metadata"}, body)))


@plan("SELECT o_orderkey, round(o_totalprice - l, 4) AS difference_sec, coalesce(abs(o_totalprice - l) > 300000, false) AS needs_trim_check FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice) AS l FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey")
def playback_durations(d: Tables):
    exp = d.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("expected"))
    out = A.playback_duration_audit(d.orders.join(exp, "o_orderkey", "left"), "o_totalprice", "expected", 300000.0)
    return out.select("o_orderkey", F.round("difference_sec", 4).alias("difference_sec"), "needs_trim_check")


@plan("SELECT p_type AS category, count(*) AS n, min(p_size * 40) AS lowest FROM part WHERE p_size * 40 < 720 GROUP BY 1")
def low_res_clips(d: Tables):
    return A.low_res_clips(d.part.select(F.col("p_type").alias("category"), (F.col("p_size") * 40).alias("height")))[1]
