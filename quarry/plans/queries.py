"""The curation operators as queries over the driver's tables, and the same in SQL.

The queries call the stages and sources that a whole run calls, over fixture records, scores, specs and configuration.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import crop_box, evidence, median_hash, norm_tag, output_stem, resolution_score
from ..operators.bursts import assign_bursts
from ..operators.pairs import cosine_pairs, hamming_pairs, nearest
from ..operators.ranks import robust_rank
from ..sources import capture, images, vocabulary
from ..tables import kept_table
from . import curate
from .fixtures import CFG, SPECS, SQL_BURST_IDS, SQL_RECORDS, SQL_SCORES, micros, records, scores, specs, table

FLOOR, PRESENCE, AVAILABILITY = (CFG["semantic"][k] for k in ("evidence_floor", "presence_threshold", "availability_capture"))
PENALTY_CAP = CFG["selection"]["semantic_penalty_cap"]
LEAST_SIDE, MOST_ASPECT = CFG["audit"]["min_side"], CFG["audit"]["max_aspect"]
HASH_RADIUS, PIXELS, COSINE, HASH_BESIDE = (CFG["dedup"][k] for k in ("phash_distance", "pixel_difference", "dino_similarity", "dino_phash_distance"))
GAP, SPAN = 3 * 3600 * 10**6, 6 * 3600 * 10**6

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def r9(c):
    return F.round(c, 9)


def basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).where("reject_reason = ''")


SQL_BASIC = f"basic AS (SELECT * FROM records WHERE min_side >= {LEAST_SIDE} AND aspect_ratio <= {MOST_ASPECT})"


def sql_rank(value: str, source: str, where: str = "TRUE", higher: bool = True) -> str:
    share = f"(rank() OVER (PARTITION BY ({value}) IS NULL ORDER BY {value}) - 1 + (count(*) OVER (PARTITION BY {value}) - 1) / 2.0::DOUBLE) / nullif(count({value}) OVER () - 1, 0)"
    share = share if higher else f"1 - {share}"
    return f"CASE WHEN ({value}) IS NULL OR min({value}) OVER () = max({value}) OVER () THEN 0.5::DOUBLE ELSE {share} END"


@query(f"SELECT doc_id, n_chars, CASE WHEN n_chars < 512 THEN 'small' ELSE '' END AS reject_reason FROM documents WHERE lower(source) IN ('src0', 'src1', 'src2') AND lang = 'en'")
def scan_filter_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").where(F.lower("source").isin("src0", "src1", "src2") & (F.col("lang") == "en"))
    return d.select("doc_id", "n_chars", F.when(F.col("n_chars") < 512, "small").otherwise("").alias("reject_reason"))


@query("""WITH p AS (SELECT doc_id, 1 + n_chars % 40 AS h, 1 + (n_chars * 7) % 53 AS w FROM documents)
SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN 0 ELSE w END::INT AS width, CASE WHEN doc_id % 9 = 0 THEN 0 ELSE h END::INT AS height,
  CASE WHEN doc_id % 9 = 0 THEN 'decode:Unreadable' WHEN least(h, w) < 12 THEN 'small' WHEN greatest(h, w)::DOUBLE / least(h, w) > 2 THEN 'aspect' ELSE '' END AS reject_reason FROM p""")
def audit_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The technical audit of small flat images, some of them unreadable."""
    h, w = (1 + F.col("n_chars") % 40).cast("int"), (1 + F.col("n_chars") * 7 % 53).cast("int")
    rows = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 9 == 0, -1).otherwise(h).alias("height"), w.alias("width"), F.lit(1).alias("channels"), F.repeat(F.lit("x"), h * w).cast("binary").alias("data"))
    return images.audited(rows, 12, 2.0).select("doc_id", "width", "height", "reject_reason")


@query("SELECT doc_id, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, log2(greatest(1.0::DOUBLE, n_chars::DOUBLE / 512.0::DOUBLE)) / 2)), 9) AS score FROM documents")
def resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", r9(resolution_score(F.col("n_chars"), 512)).alias("score"))


@query("SELECT p_partkey, regexp_replace(lower(trim(p_name)), '\\s+', '_', 'g') AS tag FROM part")
def tag_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", norm_tag(F.col("p_name")).alias("tag"))


@query(f"WITH {SQL_RECORDS} SELECT vec_id, phash, lower(lpad(to_hex(phash), 16, '0')) AS phash_hex FROM records")
def phash_from_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("vec_id", "phash", F.lower(F.lpad(F.hex("phash"), 16, "0")).alias("phash_hex"))


def coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", median_hash(F.col("embedding").cast("array<double>")).alias("phash"), "embedding")


SQL_CODED = "coded AS (SELECT vec_id, v, list_sum(list_transform(range(2, 65), lambda i: CASE WHEN v[i] > list_sort(v[2:64])[32] THEN 1::BIGINT << (64 - i)::BIGINT ELSE 0 END))::BIGINT AS phash FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings))"
SQL_NEAR = f"near AS (SELECT x.vec_id AS a, y.vec_id AS b, bit_count(xor(x.phash, y.phash))::INT AS distance FROM coded x JOIN coded y ON x.vec_id < y.vec_id AND bit_count(xor(x.phash, y.phash)) <= {HASH_RADIUS})"
SQL_ALIKE = f"alike AS (SELECT x.vec_id AS a, y.vec_id AS b, list_dot_product(x.v, y.v) AS similarity, bit_count(xor(x.phash, y.phash))::INT AS distance FROM coded x JOIN coded y ON x.vec_id < y.vec_id AND list_dot_product(x.v, y.v) >= {COSINE})"


@query(f"WITH {SQL_CODED}, {SQL_NEAR} SELECT a, b, distance FROM near")
def hamming_banded_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_pairs(coded(spark, sf_dir), "vec_id", "phash", HASH_RADIUS)


@query(f"WITH {SQL_CODED}, {SQL_ALIKE} SELECT a, b, round(similarity, 9) AS similarity FROM alike")
def cosine_block_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cosine_pairs(coded(spark, sf_dir), "vec_id", "embedding", COSINE).withColumn("similarity", r9(F.col("similarity")))


def sql_greedy(edges: str) -> str:
    """The sequential rule: records in order (prequality descending, record_id), each kept unless a kept one conflicts."""
    return f""",
conflicts AS (SELECT a, b FROM {edges} UNION ALL SELECT b, a FROM {edges}),
items AS (SELECT vec_id, row_number() OVER (ORDER BY label DESC, record_id) AS i, (SELECT coalesce(list(b), []) FROM conflicts WHERE a = vec_id) AS others FROM records),
walk AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS kept UNION ALL SELECT items.i, CASE WHEN list_has_any(others, kept) THEN kept ELSE list_append(kept, vec_id) END FROM walk JOIN items ON items.i = walk.i + 1)
SELECT record_id, list_contains((SELECT kept FROM walk ORDER BY i DESC LIMIT 1), vec_id) AS keep FROM records"""


def _by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).withColumn("prequality", F.col("label").cast("double"))


SQL_PIXELS = "list_sum(list_transform(range(1, 33), lambda i: abs(ord(x.thumb[i]) - ord(y.thumb[i])))) / 32.0::DOUBLE / 255.0::DOUBLE"


@query(f"""WITH RECURSIVE {SQL_RECORDS}, pairs AS (SELECT x.vec_id AS a, y.vec_id AS b FROM records x JOIN records y ON x.vec_id < y.vec_id
  AND bit_count(xor(x.phash, y.phash)) <= {HASH_RADIUS} AND {SQL_PIXELS} <= {PIXELS}){sql_greedy('pairs')}""")
def hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.hash_dedup(_by_label(spark, sf_dir), CFG)


@query(f"""WITH RECURSIVE {SQL_RECORDS}, pairs AS (SELECT x.vec_id AS a, y.vec_id AS b FROM records x JOIN records y ON x.vec_id < y.vec_id
  AND list_dot_product(x.v, y.v) >= {COSINE} AND bit_count(xor(x.phash, y.phash)) <= {HASH_BESIDE}){sql_greedy('pairs')}""")
def semantic_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _by_label(spark, sf_dir)
    return curate.vector_dedup(rows, rows.select("record_id", F.col("v").alias("vector")), CFG)


@query(f"SELECT l_orderkey, l_linenumber, round({sql_rank('l_quantity', 'lineitem')}, 9) AS r FROM lineitem")
def robust_rank_asc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return robust_rank(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), "l_quantity", "r").select("l_orderkey", "l_linenumber", r9(F.col("r")).alias("r"))


@query(f"SELECT doc_id, round({sql_rank('n_chars', 'documents', higher=False)}, 9) AS r FROM documents")
def robust_rank_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return robust_rank(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars", "r", higher=False).select("doc_id", r9(F.col("r")).alias("r"))


@query(f"SELECT d.doc_id, round({sql_rank('quality', '')}, 9) AS r FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def robust_rank_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return robust_rank(d, "quality", "r").select("doc_id", r9(F.col("r")).alias("r"))


SQL_RESOLUTION = f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, log2(greatest(1.0::DOUBLE, min_side::DOUBLE / {LEAST_SIDE}.0::DOUBLE)) / 2))"


@query(f"WITH {SQL_RECORDS}, {SQL_BASIC} SELECT record_id, round(0.65::DOUBLE * {sql_rank('laplacian', '')} + 0.25::DOUBLE * exposure + 0.10::DOUBLE * {SQL_RESOLUTION}, 9) AS prequality FROM basic")
def prequality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.with_prequality(basic(spark, sf_dir), CFG).select("record_id", r9(F.col("prequality")).alias("prequality"))


SQL_FOCUS = f"""focus AS (SELECT record_id, greatest(0.0::DOUBLE, least(1.0::DOUBLE, 0.5::DOUBLE * list_sort([a, b, c])[2] + 0.4::DOUBLE * (1 - s) + 0.1::DOUBLE * (1 - exposure))) AS focus_risk FROM
  (SELECT record_id, exposure, {sql_rank('blur_global', '')} AS a, {sql_rank('blur_center', '')} AS b, {sql_rank('blur_local', '')} AS c, {sql_rank('laplacian', '')} AS s FROM basic))"""


@query(f"WITH {SQL_RECORDS}, {SQL_BASIC}, {SQL_FOCUS} SELECT record_id, round(focus_risk, 9) AS focus_risk FROM focus")
def focus_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates(spark, sf_dir).select("record_id", r9(F.col("focus_risk")).alias("focus_risk"))


def gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.gated(basic(spark, sf_dir), scores(spark, sf_dir), specs(spark), CFG)


SQL_GATES = f"""WITH {SQL_SCORES}, {SQL_BASIC}, {SQL_FOCUS},
g AS (SELECT record_id, max(CASE WHEN spec = 'semantic_blur' THEN raw END) AS blur, bool_or(coalesce(raw >= hard, FALSE)) AS hard FROM scores GROUP BY record_id),
gates AS (SELECT record_id, focus_risk, CASE WHEN focus_risk >= 0.7 OR blur >= 0.45 OR (blur >= 0.3 AND focus_risk >= 0.55) THEN 'focus' WHEN hard THEN 'semantic_hard' ELSE '' END AS reject_reason FROM focus JOIN g USING (record_id))"""


@query(f"{SQL_GATES} SELECT record_id, reject_reason FROM gates")
def focus_and_semantic_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates(spark, sf_dir).select("record_id", "reject_reason")


@query(f"""{SQL_GATES} SELECT count(*)::BIGINT AS records, count(*) FILTER (WHERE reject_reason = 'focus')::BIGINT AS focus, count(*) FILTER (WHERE reject_reason = 'semantic_hard')::BIGINT AS semantic_hard,
  count(*) FILTER (WHERE reject_reason = '')::BIGINT AS eligible FROM gates""")
def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.stage_counts(gates(spark, sf_dir))


@query(f"""{SQL_GATES}, s AS (SELECT CASE substr(record_id, 2)::BIGINT % 10 WHEN 0 THEN 'train' WHEN 1 THEN 'validate' END AS split, focus_risk FROM gates WHERE reject_reason = '')
SELECT split, count(*)::BIGINT AS picks, round(max(focus_risk), 9) AS worst FROM s WHERE split IS NOT NULL GROUP BY split""")
def worst_risk_per_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = gates(spark, sf_dir)
    return curate.worst_risk(g, _tenth(g, 0), _tenth(g, 1)).withColumn("worst", r9(F.col("worst")))


def _tenth(gated: DataFrame, k: int) -> DataFrame:
    """Some of the eligible records, as if chosen."""
    return gated.where((F.col("reject_reason") == "") & (F.substring("record_id", 2, 9).cast("long") % 10 == k)).select("record_id")


@query(f"WITH {SQL_SCORES} SELECT record_id, spec, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, (raw - {FLOOR}::DOUBLE) / ({PRESENCE}::DOUBLE - {FLOOR}::DOUBLE))), 9) AS evidence FROM scores")
def evidence_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(spark, sf_dir).select("record_id", "spec", r9(evidence(F.col("raw"), FLOOR, PRESENCE)).alias("evidence"))


def penalties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.semantic_penalties(records(spark, sf_dir), scores(spark, sf_dir), specs(spark), CFG)


SQL_PENALTY = f"penalties AS (SELECT record_id, least({PENALTY_CAP}::DOUBLE, sum(CASE WHEN is_crop AND spec = 'cropped_extremities' THEN 0.0::DOUBLE ELSE greatest(0.0::DOUBLE, least(1.0::DOUBLE, (raw - {FLOOR}::DOUBLE) / ({PRESENCE}::DOUBLE - {FLOOR}::DOUBLE))) * weight END)) AS penalty FROM scores WHERE block = 'penalty' GROUP BY record_id)"


@query(f"WITH {SQL_SCORES}, {SQL_PENALTY} SELECT record_id, round(penalty, 9) AS penalty FROM penalties")
def semantic_penalty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return penalties(spark, sf_dir).select("record_id", r9(F.col("penalty")).alias("penalty"))


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.coverage_targets(records(spark, sf_dir), scores(spark, sf_dir), specs(spark), CFG)


SQL_TARGETS = f"targets AS (SELECT spec, grp, weight, avg((raw >= {PRESENCE})::INT) AS prevalence, least(least(greatest(any_value(target), any_value(scale) * avg((raw >= {PRESENCE})::INT)), any_value(most)) * count(*), count(*) FILTER (WHERE raw >= {PRESENCE}) * {AVAILABILITY}::DOUBLE) AS goal FROM scores WHERE block = 'category' GROUP BY spec, grp, weight)"


@query(f"WITH {SQL_SCORES}, {SQL_TARGETS} SELECT spec, round(prevalence, 9) AS prevalence, round(goal::DOUBLE, 9) AS goal FROM targets")
def prevalence_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return targets(spark, sf_dir).select("spec", r9(F.col("prevalence")).alias("prevalence"), r9(F.col("target")).alias("goal"))


SQL_EVIDENCE = f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, (raw - {FLOOR}::DOUBLE) / ({PRESENCE}::DOUBLE - {FLOOR}::DOUBLE)))"


@query(f"""WITH {SQL_SCORES}, {SQL_TARGETS}, b AS (SELECT record_id, s.grp, max({SQL_EVIDENCE} * CASE WHEN goal > 1e-6 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END * s.weight / 1.3::DOUBLE) AS best FROM scores s JOIN targets t ON t.spec = s.spec GROUP BY record_id, s.grp),
k AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY best DESC, grp) AS n FROM b)
SELECT record_id, round(coalesce(sum(best) FILTER (WHERE best > 1e-6), 0) / greatest(1, count(*) FILTER (WHERE best > 1e-6)), 9) AS coverage FROM k WHERE n <= 3 GROUP BY record_id""")
def coverage_score_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What coverage adds to a score before any pick."""
    found = curate.coverage_of(records(spark, sf_dir), scores(spark, sf_dir), specs(spark), CFG)
    return found.select("record_id", r9(F.col("coverage")).alias("coverage"))


SQL_BURSTS = f"""
e AS (SELECT event_id, user_id, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
w AS (SELECT user_id, event_id, i, t, t AS start FROM e WHERE i = 1 UNION ALL
  SELECT e.user_id, e.event_id, e.i, e.t, CASE WHEN e.t - w.t <= {GAP} AND e.t - w.start <= {SPAN} THEN w.start ELSE e.t END FROM w JOIN e ON e.user_id = w.user_id AND e.i = w.i + 1),
z AS (SELECT user_id, event_id, start AS burst_start, count(*) OVER (PARTITION BY user_id, start) AS burst_size FROM w)"""


@query(f"WITH RECURSIVE {SQL_BURSTS} SELECT user_id, event_id, burst_start, burst_size FROM z WHERE burst_size >= 2")
def bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", micros(F.col("ts")).alias("t"))
    return assign_bursts(e, ["user_id"], "t", "event_id", GAP, SPAN)


@query(f"WITH RECURSIVE {SQL_BURSTS} SELECT user_id, count(DISTINCT burst_start)::BIGINT AS bursts, max(burst_size)::BIGINT AS largest FROM z WHERE burst_size >= 2 GROUP BY user_id")
def burst_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bursts(spark, sf_dir).groupBy("user_id").agg(F.countDistinct("burst_start").alias("bursts"), F.max("burst_size").alias("largest"))


@query(f"WITH RECURSIVE {SQL_RECORDS}, {SQL_BURST_IDS} SELECT record_id, burst_id FROM burst_ids")
def burst_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.with_bursts(records(spark, sf_dir), CFG).select("record_id", "burst_id")


@query("""SELECT event_id, CASE WHEN event_id % 4 = 0 THEN epoch_us(date_trunc('second', ts)) + 250000 WHEN event_id % 4 = 1 THEN epoch_us(date_trunc('second', ts)) - 5400000000
    WHEN event_id % 11 = 0 THEN epoch_us(ts) ELSE epoch_us(date_trunc('second', ts)) END AS capture_us, CASE WHEN event_id % 4 < 2 THEN 'exif' WHEN event_id % 11 = 0 THEN 'mtime' ELSE 'filename' END AS capture_source FROM events""")
def capture_time_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture time out of metadata with a fraction or an offset, then file names; an impossible date leaves the modification time."""
    t, k = F.col("ts").cast("timestamp"), F.col("event_id") % 4
    stamp = F.date_format(t, "yyyy:MM:dd HH:mm:ss")
    name = F.when(F.col("event_id") % 11 == 0, F.concat(F.lit("/x/IMG_"), F.date_format(t, "yyyy"), F.lit("13"), F.date_format(t, "dd_HHmmss"), F.lit(".jpg"))).otherwise(F.concat(F.lit("/x/IMG_"), F.date_format(t, "yyyyMMdd_HHmmss"), F.lit(".jpg")))
    tags = F.struct(F.when(k == 0, stamp).alias("original"), F.when(k == 0, "25").alias("original_fraction"), F.when(k == 1, F.concat(stamp, F.lit("+01:30"))).alias("digitized"), F.lit(None).cast("string").alias("digitized_fraction"), F.lit(None).cast("string").alias("modified"))
    found = capture.capture_time(tags, capture.file_stem(name), t, use_mtime=True)
    return table(spark, sf_dir, "events").select("event_id", found.alias("c")).select("event_id", "c.*")


@query("""WITH f AS (SELECT * FROM lineitem WHERE 1 - l_tax >= 0.95::DOUBLE), m AS (SELECT l_orderkey, arg_max(l_linenumber, (l_quantity * (l_quantity * (1 + l_discount))) * 1000000 - l_linenumber) AS det_idx FROM f GROUP BY l_orderkey)
SELECT DISTINCT m.l_orderkey, m.det_idx FROM m JOIN f ON f.l_orderkey = m.l_orderkey AND f.l_linenumber = m.det_idx WHERE l_quantity * (1 + l_discount) >= 20""")
def largest_face(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    found = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("path"), n.alias("det_idx"), n.cast("double").alias("x"), F.lit(0.0).alias("y"), F.col("l_quantity").alias("w"), (F.col("l_quantity") * (1 + F.col("l_discount"))).alias("h"), (1 - F.col("l_tax")).alias("confidence"))
    return images.largest_detections(found, 0.95, 20).select(F.col("path").alias("l_orderkey"), F.col("x").cast("int").alias("det_idx"))


@query("""WITH b AS (SELECT p_partkey, greatest(64.0::DOUBLE, round_even((p_size * 1.1::DOUBLE) * 1.6::DOUBLE, 0)::DOUBLE) AS side, p_size::DOUBLE AS w, p_size * 1.1::DOUBLE AS h FROM part)
SELECT p_partkey, greatest(0.0::DOUBLE, least(round_even((100 + w / 2 - side / 2)::DOUBLE, 0)::DOUBLE, 640 - side))::INT AS x1, greatest(0.0::DOUBLE, least(round_even((80 + h / 2 + h * 0.15::DOUBLE - side / 2)::DOUBLE, 0)::DOUBLE, 480 - side))::INT AS y1, side::INT AS side FROM b""")
def crop_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, h = F.col("p_size").cast("double"), F.col("p_size") * 1.1
    box = crop_box(F.lit(100.0), F.lit(80.0), w, h, 640, 480, 1.6, 64)
    return table(spark, sf_dir, "part").select("p_partkey", box.alias("box")).select("p_partkey", F.col("box.x1").alias("x1"), F.col("box.y1").alias("y1"), (F.col("box.x2") - F.col("box.x1")).alias("side"))


@query(f"""WITH {SQL_RECORDS} SELECT record_id, 'original' AS kind, source_id, 0 AS detected_width, min_side::INT AS min_side FROM records WHERE NOT is_crop UNION ALL
SELECT source_id || '::face_crop:0:' || vec_id || ',0,' || (vec_id + 512) || ',512', 'face_crop', source_id, 64, min_side::INT FROM records WHERE is_crop AND min_side >= {LEAST_SIDE}""")
def virtual_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Originals, and crops as records of their own."""
    r = records(spark, sf_dir)
    good = r.where((F.col("kind") == "face_crop") & (F.col("min_side") >= LEAST_SIDE))
    crops = images.crop_columns(good.withColumnsRenamed({"detector_confidence": "confidence", "detected_width": "w", "detected_height": "h"}))
    own = r.where("kind = 'original'").select([c for c in crops.columns])
    return own.unionByName(crops).select("record_id", "kind", "source_id", "detected_width", F.col("min_side").cast("int").alias("min_side"))


#: name, tags, prefixes, exclude_tags, exclude_prefixes
_WANTED = [("warm", ["Green", "red"], ["la"], ["red"], []), ("metal", ["steel", "brushed"], ["pol", "s"], [], ["sp"]), ("broken", ["no such tag"], ["zzz"], ["nor this"], [])]
SQL_VOCABULARY = """v0 AS (SELECT DISTINCT unnest(string_split(lower(p_name || ' ' || p_type), ' ')) AS tag FROM part),
vocabulary AS (SELECT tag, row_number() OVER (ORDER BY tag) - 1 AS tag_idx FROM v0)"""
SQL_WANTED = "wanted(spec, tags, prefixes, without, without_prefixes) AS (VALUES " + ", ".join(f"('{s}', {t}::VARCHAR[], {p}::VARCHAR[], {x}::VARCHAR[], {y}::VARCHAR[])" for s, t, p, x, y in _WANTED) + ")"
SQL_HITS = """general AS (SELECT * FROM vocabulary WHERE length(tag) <> 6),
hits AS (SELECT DISTINCT spec, tag_idx FROM wanted JOIN general ON (list_contains(list_transform(tags, lambda t: lower(t)), tag) OR len(list_filter(prefixes, lambda p: starts_with(tag, p))) > 0)
  AND NOT list_contains(without, tag) AND len(list_filter(without_prefixes, lambda p: starts_with(tag, p))) = 0)"""


def _vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct words of the part table as tags; those of six letters are of another category."""
    words = table(spark, sf_dir, "part").select(F.explode(F.split(F.lower(F.concat_ws(" ", "p_name", "p_type")), " ")).alias("name")).distinct()
    return words.select((F.row_number().over(Window.orderBy("name")) - 1).alias("tag_idx"), "name", F.when(F.length("name") == 6, 4).otherwise(0).alias("category"))


def _resolved(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    wanted = spark.createDataFrame(_WANTED, "name string, tags array<string>, prefixes array<string>, exclude_tags array<string>, exclude_prefixes array<string>")
    return vocabulary.resolve(wanted, _vocabulary(spark, sf_dir))


@query(f"WITH {SQL_VOCABULARY}, {SQL_WANTED}, {SQL_HITS} SELECT spec, tag_idx::INT AS tag_idx FROM hits")
def spec_tag_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir)[0]


def _sql_missing(column: str, name: str, prefix: bool) -> str:
    given, end = f"regexp_replace(lower(x), ' ', '_', 'g')", "*" if prefix else ""
    on = f"starts_with(tag, {given})" if prefix else f"tag = {given}"
    return f"SELECT spec || '.{name}:' || x || '{end}' AS problem FROM (SELECT spec, unnest({column}) AS x FROM wanted) WHERE NOT EXISTS (SELECT 1 FROM general WHERE {on})"


@query(f"""WITH {SQL_VOCABULARY}, {SQL_WANTED}, {SQL_HITS} {_sql_missing('tags', 'tags', False)} UNION ALL {_sql_missing('prefixes', 'prefixes', True)} UNION ALL {_sql_missing('without', 'exclude_tags', False)}
UNION ALL {_sql_missing('without_prefixes', 'exclude_prefixes', True)} UNION ALL SELECT spec || ':matched_nothing' FROM wanted WHERE spec NOT IN (SELECT spec FROM hits)""")
def spec_contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resolved(spark, sf_dir)[1]


SQL_PARTS = f"0.55::DOUBLE * (1 - focus_risk) + 0.20::DOUBLE * exposure + 0.10::DOUBLE * {SQL_RESOLUTION}"


@query(f"""WITH {SQL_RECORDS}, {SQL_BASIC}, {SQL_FOCUS} SELECT record_id, round(({SQL_PARTS} + 0.15::DOUBLE * {sql_rank('brisque', '', higher=False)}) / (0.55::DOUBLE + 0.20::DOUBLE + 0.10::DOUBLE + 0.15::DOUBLE), 9) AS quality FROM basic JOIN focus USING (record_id)""")
def quality_with_brisque(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.with_quality(gates(spark, sf_dir), CFG).select("record_id", r9(F.col("quality")).alias("quality"))


@query(f"""WITH {SQL_RECORDS}, {SQL_BASIC}, {SQL_FOCUS} SELECT record_id, round(({SQL_PARTS}) / (0.55::DOUBLE + 0.20::DOUBLE + 0.10::DOUBLE), 9) AS quality FROM basic JOIN focus USING (record_id)""")
def quality_without_brisque(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.with_quality(gates(spark, sf_dir).drop("brisque"), CFG).select("record_id", r9(F.col("quality")).alias("quality"))


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN regexp_replace(n, '\\.[^.]*$', '') || '__face' || (page_id % 5) || '.png' ELSE n END AS file_name FROM (SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS n FROM pages)")
def output_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.regexp_extract("url", "([^/]*)$", 1)
    kind = F.when(F.col("page_id") % 3 == 0, "__face_").otherwise("original")
    return table(spark, sf_dir, "pages").select("page_id", output_stem(name, kind, F.col("page_id") % 5).alias("file_name"))


@query("SELECT doc_id, sha256(text) AS digest FROM documents")
def file_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.col("text").cast("binary").alias("content"))
    return images.file_digests(files).withColumnRenamed("path", "doc_id")


_V = CFG["validation"]


def sql_free(pool: str, train: str, name: str = "free") -> str:
    """Rows of pool (records' columns, burst_id) that share no source with train, are near none of it and not of one burst with one that is like them."""
    return f"""{name}_near AS (SELECT p.record_id, t.record_id AS other, list_dot_product(p.v, t.v) AS s, bit_count(xor(p.phash, t.phash)) AS d, p.burst_id <> '' AND p.burst_id = t.burst_id AS same FROM {pool} p JOIN {train} t ON TRUE),
{name} AS (SELECT p.*, (SELECT max(s) FROM {name}_near n WHERE n.record_id = p.record_id) AS similarity, (SELECT count(*) FROM {train} t WHERE t.burst_id <> '' AND t.burst_id = p.burst_id) AS uses FROM {pool} p
  WHERE source_id NOT IN (SELECT source_id FROM {train}) AND record_id NOT IN (SELECT record_id FROM {train}) AND NOT EXISTS (SELECT 1 FROM {name}_near n WHERE n.record_id = p.record_id
    AND (s >= {_V['near_duplicate_similarity']} AND d <= {_V['near_duplicate_phash_distance']} OR s >= {_V['same_burst_similarity']} AND same)))"""


@query(f"""WITH RECURSIVE {SQL_RECORDS}, {SQL_BURST_IDS}, r AS (SELECT * FROM records JOIN burst_ids USING (record_id)), train AS (SELECT * FROM r WHERE vec_id % 10 = 0), {sql_free('r', 'train')}
SELECT record_id, round(coalesce(similarity, -1), 9) AS similarity, uses FROM free""")
def validation_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that share no source with the chosen ones and are near none of them; the chosen ones number a few hundred by contract."""
    r = curate.with_bursts(records(spark, sf_dir), CFG)
    free = curate.validation_pool(r.drop("v"), r.where("vec_id % 10 = 0").select("record_id"), r.select("record_id", F.col("v").alias("vector")), CFG)
    return free.select("record_id", r9(F.col("similar")).alias("similarity"), "uses")


@query("""WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), n AS (SELECT a.vec_id, b.vec_id AS other, list_dot_product(a.v, b.v) AS s FROM v a JOIN v b ON b.vec_id % 10 = 0 AND a.vec_id <> b.vec_id)
SELECT vec_id, round(max(s), 9) AS similarity, arg_max(other, s) AS nearest FROM n GROUP BY vec_id""")
def nearest_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest chosen item of every item; the blocks of the chosen side are matrix products."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return nearest(e, e.where("vec_id % 10 = 0"), "vec_id", "v").select("vec_id", r9(F.col("similarity")).alias("similarity"), "nearest")


SQL_TAG_PROBABILITY = "least(1.0::DOUBLE, abs(v[1 + tag_idx % 64]) * 4)"


@query(f"""WITH {SQL_RECORDS}, {SQL_VOCABULARY}, {SQL_WANTED}, {SQL_HITS}
SELECT record_id, spec, round(max({SQL_TAG_PROBABILITY}), 9) AS raw FROM records CROSS JOIN hits GROUP BY record_id, spec""")
def score_max_per_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest probability of each spec's tags. The vocabulary and what specs match of it are short tables of fixed size."""
    hits = _resolved(spark, sf_dir)[0].withColumn("place", F.col("tag_idx") % 64)
    every = records(spark, sf_dir).select("record_id", F.explode(F.transform(F.col("v"), lambda x, i: F.struct(i.alias("place"), F.least(F.lit(1.0), F.abs(x) * 4).alias("prob")))).alias("p")).select("record_id", "p.*")
    probabilities = every.join(F.broadcast(hits.select("place", "tag_idx").distinct()), "place")
    return vocabulary.spec_scores(probabilities, hits.select("spec", "tag_idx")).withColumn("raw", r9(F.col("raw")))


@query(f"""WITH {SQL_SCORES}, {SQL_TARGETS}, got AS (SELECT spec, sum({SQL_EVIDENCE}) AS achieved FROM scores WHERE block = 'category' AND substr(record_id, 2)::BIGINT % 10 = 0 GROUP BY spec)
SELECT spec, round(coalesce(achieved, 0), 9) AS achieved, round(goal::DOUBLE, 9) AS goal FROM targets LEFT JOIN got USING (spec) WHERE goal >= 0.5 OR achieved >= 0.5""")
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence that the chosen records add up to, beside the targets, where either reaches a half."""
    chosen = records(spark, sf_dir).where("vec_id % 10 = 0").select("record_id")
    found = curate.coverage_report(chosen, scores(spark, sf_dir), targets(spark, sf_dir), CFG)
    return found.select("spec", r9(F.col("achieved")).alias("achieved"), r9(F.col("target")).alias("goal"))


@query(f"""{SQL_GATES}, val AS (SELECT record_id FROM gates WHERE reject_reason = '' AND substr(record_id, 2)::BIGINT % 10 = 1), train AS (SELECT record_id FROM gates WHERE reject_reason = '' AND substr(record_id, 2)::BIGINT % 10 = 0),
chosen AS (SELECT record_id FROM train UNION ALL SELECT record_id FROM val), {SQL_PENALTY},
near AS (SELECT p.record_id, arg_max(t.record_id, list_dot_product(p.v, t.v)) AS other, max(list_dot_product(p.v, t.v)) AS s FROM records p JOIN gates USING (record_id) JOIN (SELECT r.* FROM records r JOIN chosen USING (record_id)) t ON t.record_id <> p.record_id GROUP BY p.record_id)
SELECT r.record_id, CASE WHEN is_crop THEN r.record_id || '__face_crop0.png' ELSE r.record_id || '.jpg' END AS file, CASE WHEN is_crop THEN vec_id || ',0,' || (vec_id + 512) || ',512' ELSE '' END AS crop_box,
  CASE WHEN t.record_id IS NOT NULL THEN 'train' WHEN v.record_id IS NOT NULL THEN 'validate' WHEN g.reject_reason = '' THEN 'eligible_not_selected' ELSE 'rejected' END AS status,
  coalesce(g.reject_reason, CASE WHEN min_side < {LEAST_SIDE} THEN 'small' WHEN aspect_ratio > {MOST_ASPECT} THEN 'aspect' ELSE '' END) AS reject_reason, round(g.focus_risk, 9) AS focus_risk,
  CASE WHEN g.record_id IS NOT NULL THEN round(p.penalty, 9) END AS semantic_penalty, round(n.s, 9) AS nearest_selected_similarity, CASE WHEN n.other IS NULL THEN '' WHEN substr(n.other, 2)::BIGINT % 4 = 1 THEN n.other || '__face_crop0.png' ELSE n.other || '.jpg' END AS nearest_selected_file
FROM records r LEFT JOIN gates g USING (record_id) LEFT JOIN train t ON t.record_id = r.record_id LEFT JOIN val v ON v.record_id = r.record_id LEFT JOIN penalties p ON p.record_id = r.record_id LEFT JOIN near n ON n.record_id = r.record_id""")
def debug_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The debug table's main columns: what was chosen, what could have been, the first reason against the others, the nearest chosen one."""
    g = kept_table(gates(spark, sf_dir), "gates")
    every = records(spark, sf_dir).withColumn("prequality", F.lit(0.0)).withColumn("burst_id", F.lit("")).drop("v", "label", "brisque")
    every = every.withColumnRenamed("reject_reason", "first").join(g.select("record_id", F.col("reject_reason").alias("later")), "record_id", "left").withColumn("reject_reason", F.coalesce("later", "first"))
    own = g.select("record_id", "focus_risk", (F.col("reject_reason") == "").alias("eligible"), "brisque", F.lit(0.0).alias("quality"))
    vectors = records(spark, sf_dir).select("record_id", F.col("v").alias("vector"))
    shown = curate.debug_table(every, own, scores(spark, sf_dir), [(x[0], x[1]) for x in SPECS], penalties(spark, sf_dir), vectors, _tenth(g, 0), _tenth(g, 1))
    number = lambda c: r9(F.nullif(F.col(c), F.lit("")).cast("double")).alias(c)
    return shown.select("record_id", "file", "crop_box", "status", "reject_reason", number("focus_risk"), number("semantic_penalty"), number("nearest_selected_similarity"), "nearest_selected_file")


def _pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eligible records with what the selection needs."""
    eligible = curate.with_quality(kept_table(gates(spark, sf_dir).where("reject_reason = ''"), "eligible"), CFG)
    rows = curate.with_bursts(eligible, CFG).join(penalties(spark, sf_dir), "record_id")
    return kept_table(rows.select("record_id", "source_id", "phash", "quality", "focus_risk", "penalty", "burst_id", F.col("v").alias("vector")), "pool")


_S, _B, _F = CFG["selection"], CFG["burst"], CFG["audit"]["focus"]
_CATEGORIES = [x for x in SPECS if x[1] == "category"]
_GROUPS = [[i + 1 for i, x in enumerate(_CATEGORIES) if x[3] == g] for g in sorted({x[3] for x in _CATEGORIES})]
_TOP = max(x[4] for x in _CATEGORIES)
SQL_BY_CATEGORY = " ".join(f"WHEN '{x[0]}' THEN {i + 1}" for i, x in enumerate(_CATEGORIES))
#: Eligible records in the order of ties, with quality, penalty, burst and evidence by category.
SQL_POOL = f"""eligible AS (SELECT records.*, focus_risk FROM records JOIN gates USING (record_id) WHERE gates.reject_reason = ''),
rated AS (SELECT record_id, ({SQL_PARTS} + 0.15::DOUBLE * {sql_rank('brisque', '', higher=False)}) / (0.55::DOUBLE + 0.20::DOUBLE + 0.10::DOUBLE + 0.15::DOUBLE) AS quality FROM eligible),
{SQL_BURST_IDS.replace("FROM records)", "FROM eligible)").replace("FROM records LEFT", "FROM eligible LEFT")}, {SQL_PENALTY},
facts AS (SELECT record_id, list(greatest(0.0::DOUBLE, least(1.0::DOUBLE, (raw - {FLOOR}::DOUBLE) / ({PRESENCE}::DOUBLE - {FLOOR}::DOUBLE))) ORDER BY CASE spec {SQL_BY_CATEGORY} END) AS e, list(raw ORDER BY CASE spec {SQL_BY_CATEGORY} END) AS raws FROM scores WHERE block = 'category' GROUP BY record_id),
pool AS (SELECT eligible.*, quality, burst_id, penalty, e, raws FROM eligible JOIN rated USING (record_id) JOIN burst_ids USING (record_id) JOIN penalties USING (record_id) JOIN facts USING (record_id))"""


def sql_picks(pool: str, name: str, picks: int, before: bool) -> str:
    """The sequential rule, a pick per round, over pool (and similar and uses of what was chosen before): (record_id, pick)."""
    goals = ", ".join(f"least(least(greatest({x[5]}::DOUBLE, {x[6]}::DOUBLE * p[{i + 1}] / n), {x[7]}::DOUBLE) * n, p[{i + 1}] * {AVAILABILITY}::DOUBLE)" for i, x in enumerate(_CATEGORIES))
    present = ", ".join(f"count(*) FILTER (WHERE raws[{i + 1}] >= {PRESENCE})" for i in range(len(_CATEGORIES)))
    gain = [f"e[{i + 1}] * CASE WHEN goal[{i + 1}] > 1e-6 THEN greatest(goal[{i + 1}] - cov[{i + 1}], 0) / goal[{i + 1}] ELSE 0.0::DOUBLE END * {x[4]}::DOUBLE / {_TOP}::DOUBLE" for i, x in enumerate(_CATEGORIES)]
    best = ", ".join("greatest(" + ", ".join([gain[i - 1] for i in g] + ["0.0::DOUBLE"]) + ")" for g in _GROUPS)
    clip = "greatest(0.0::DOUBLE, least(1.0::DOUBLE, {}))".format
    some = f"list_filter(list_reverse_sort([{best}])[1:{_S['coverage_top_groups']}], lambda x: x > 1e-6)"
    novelty = clip(f"(1 - similarity) / (1 - {_S['novelty_similarity_start']}::DOUBLE)")
    return f"""{name}_goal AS (SELECT [{goals}] AS goal, n, known FROM (SELECT [{present}] AS p, count(*) AS n, max({'similarity' if before else '-1'}) > -0.5 AS known FROM {pool})),
{name}_w AS (SELECT 0 AS i, record_id, FALSE AS gone, {'similarity' if before else '-1.0'}::DOUBLE AS similarity, {'uses' if before else '0'}::BIGINT AS uses, list_transform(range({len(_CATEGORIES)}), lambda x: 0.0::DOUBLE) AS cov FROM {pool} UNION ALL
  SELECT i + 1, record_id, gone OR record_id = winner, greatest(similarity, list_dot_product(v, wv)), uses + (burst_id <> '' AND burst_id = wb)::BIGINT, list_transform(range(1, {len(_CATEGORIES)} + 1), lambda x: cov[x] + we[x])
  FROM (SELECT *, first_value(record_id) OVER o AS winner, first_value(v) OVER o AS wv, first_value(burst_id) OVER o AS wb, first_value(e) OVER o AS we
    FROM (SELECT *, gone OR score < max(score) FILTER (WHERE NOT gone) OVER () - 1e-8 AS worse
      FROM (SELECT w.*, p.quality, p.burst_id, p.v, p.e, {_S['quality_weight']}::DOUBLE * p.quality + {_S['coverage_weight']}::DOUBLE * coalesce(list_sum({some}), 0) / greatest(1, len({some}))
          + {_S['novelty_weight']}::DOUBLE * CASE WHEN i = 0 AND NOT known THEN 0.5::DOUBLE ELSE {novelty} END - p.penalty
          - {_S['redundancy_penalty']}::DOUBLE * pow({clip(f"(similarity - {_S['redundancy_similarity_start']}::DOUBLE) / (1 - {_S['redundancy_similarity_start']}::DOUBLE)")}, 2)
          - {_S['soft_focus_penalty']}::DOUBLE * {clip(f"(focus_risk - {_F['soft_risk_start']}::DOUBLE) / ({_F['fail_risk']}::DOUBLE - {_F['soft_risk_start']}::DOUBLE)")}
          - {_B['repeat_penalty']}::DOUBLE * CASE WHEN p.burst_id = '' THEN 0 ELSE least(3, uses) END AS score
        FROM {name}_w w JOIN (SELECT * EXCLUDE ({'similarity, uses' if before else 'label'}) FROM {pool}) p USING (record_id) CROSS JOIN {name}_goal WHERE i < least({picks}, n)))
    WINDOW o AS (ORDER BY worse, quality DESC, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))),
{name} AS (SELECT record_id, min(i)::BIGINT AS pick FROM {name}_w WHERE gone GROUP BY record_id)"""


SQL_TRAIN = f"{SQL_GATES.replace('WITH ', 'WITH RECURSIVE ', 1)}, {SQL_POOL}, {sql_picks('pool', 'train', 40, False)}"


@query(f"{SQL_TRAIN} SELECT record_id, pick FROM train")
def select_greedy_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty picks from the eligible records."""
    return curate.select(_pool(spark, sf_dir), scores(spark, sf_dir), specs(spark), 40, CFG)[0]


@query(f"{SQL_TRAIN}, chosen AS (SELECT pool.* FROM pool JOIN train USING (record_id)), {sql_free('pool', 'chosen')}, {sql_picks('free', 'validate', 8, True)} SELECT record_id, pick FROM validate")
def select_greedy_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight picks from what shares nothing with the forty; similarity and burst uses carry over."""
    pool, s = _pool(spark, sf_dir), scores(spark, sf_dir)
    train = kept_table(curate.select(pool, s, specs(spark), 40, CFG)[0], "train")
    vectors = pool.select("record_id", "vector")
    free = curate.validation_pool(pool.drop("vector"), train, vectors, CFG).join(vectors, "record_id")
    return curate.select(kept_table(free, "free"), s, specs(spark), 8, CFG)[0]
