"""Line dedup over the suffix array of line sequences, by distributed prefix doubling, in DataFrame functions only.

A document is the sequence of its lines that hold a word. Texts that occur more than once enter the suffix array as one,
the copy of least doc_id; in the others the whole text is a repeated run. Each line has 128 bits of hash; lines at two places or
more are ranked in the order of these, which makes them the line IDs. Doubling then ranks suffixes by their first 2, 4, 8, ...
lines: pairs (rank here, rank k lines on) are counted, those at two places or more are sorted by range over all tasks,
and a pair's place in that order is the rank. A suffix alone with its first 2k lines has its place in the suffix array
and leaves; doubling ends when no two suffixes share a rank.

Suffixes of one rank after k lines are an interval of the suffix array whose longest common prefix is k lines at least. Every place
of an interval but its first (by doc_id, then line) starts a run of k lines that occurs before. A maximal repeated run of
L lines, k <= L < 2k, is the union of two such windows, the first and the last k lines of it. Windows of k lines that
have MIN_WORDS words are deleted. Where a run has that many words only with lines beyond its window, which takes fewer than
MIN_WORDS lines, the run of that exact length is ranked by its first and its last k lines. From each line on these are the
shortest run of MIN_WORDS words, and the longer ones whose lines but the first have fewer than MIN_WORDS words. So all
lines of every maximal repeated run of MIN_WORDS words or more are deleted but in the run's first place.
Windows of 16 lines and more add no line to those of 8 lines; they tell how long the repeated runs are (`shared_lines`).

Pairs are aggregated before they are shuffled and ranked after, so a line that a third of all documents holds is one row
a task; the joins back to the places are by rank and Spark splits their large partitions.

Cases: a null text stays null and has no lines; an empty one stays empty; lines without a word are never deleted; a null
doc_id sorts first; rows with the same doc_id and text are one document, and each of them gets its result; an empty
table gives no rows. Columns of the input that have the names of the added ones are replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, documents

MIN_WORDS = 5
#: n_lines, n_removed: lines, deleted lines. n_runs: stretches of deleted lines. shared_lines: of a text that loses lines, the largest power of two of lines in one run that occurs before.
ADDED = ("n_lines", "n_removed", "n_runs", "shared_lines")
_PLACE = ("quarry__did", "quarry__hash", "quarry__pos")
_HAS = r"[^\x20\x09-\x0D]"


def _keys(key: str, text: str) -> list[Column]:
    return [F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("quarry__did"), F.xxhash64(F.lit(3), F.col(text)).alias("quarry__hash")]


def _full(lines: Column) -> Column:
    """Numbers of the lines that hold a word."""
    return F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.get(lines, i).rlike(_HAS))


def line_ids(df: DataFrame, key: str, text: str, min_words: int) -> DataFrame:
    """By document with a word: its key, its text's other 64 bits of hash, and its lines (128 bits of hash, words up to min_words)."""
    full = F.filter(F.split(text, "\n"), lambda x: x.rlike(_HAS))
    rows = df.where(F.col(text).rlike(_HAS)).select(*_keys(key, text), F.xxhash64(F.lit(5), F.col(text)).alias("other"), full.alias("lines"))
    line = lambda x: F.struct(
        F.xxhash64(x).alias("a"), F.xxhash64(F.lit(11), x).alias("b"),
        F.least(F.lit(min_words), F.size(F.filter(F.split(x, r"[\x20\x09-\x0D]+", min_words + 2), lambda w: F.char_length(w) > 0))).alias("w"),
    )
    return rows.select("quarry__did", "quarry__hash", "other", F.transform("lines", line).alias("lines"))


def later_copies(docs: DataFrame) -> DataFrame:
    """(quarry__did, quarry__hash, lines) of documents whose whole text a smaller doc_id has."""
    least = docs.groupBy("quarry__hash", "other").agg(F.min("quarry__did").alias("least"), F.max("quarry__did").alias("most")).where("least < most").drop("most")
    least = cut(least, "copied")  # a table, so that Spark can split a large group's partition of the join
    return docs.join(least, ["quarry__hash", "other"]).where("quarry__did > least").select("quarry__did", "quarry__hash", F.size("lines").alias("lines"), "other").distinct()


def suffixes(docs: DataFrame, min_words: int) -> DataFrame:
    """Every line of docs: its place, its hashes, its words, and the least and most lines of the short runs from there (null: none)."""

    def need(i: Column) -> Column:
        start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n"))
        return F.aggregate(
            F.slice("lines", i + 1, min_words), start,
            lambda acc, x: F.when(acc["sum"] >= min_words, acc).otherwise(F.struct((acc["sum"] + x["w"]).alias("sum"), (acc["n"] + 1).alias("n"))),
            lambda acc: F.when(acc["sum"] >= min_words, acc["n"]),
        )

    def reach(i: Column) -> Column:
        start = F.struct(F.lit(0).alias("sum"), F.lit(1).alias("n"))
        after = F.aggregate(
            F.slice("lines", i + 2, min_words - 1), start,
            lambda acc, x: F.struct((acc["sum"] + x["w"]).alias("sum"), F.when(acc["sum"] + x["w"] < min_words, acc["n"] + 1).otherwise(acc["n"]).alias("n")),
            lambda acc: acc["n"],
        )
        return F.when(need(i).isNotNull(), F.greatest(need(i), after))

    each = F.transform("lines", lambda x, i: F.struct(x["a"].alias("a"), x["b"].alias("b"), x["w"].alias("words"), need(i).alias("need"), reach(i).alias("reach")))
    return docs.select("quarry__did", "quarry__hash", F.posexplode(each).alias("quarry__pos", "x")).select(*_PLACE, "x.*")


def ranks(rows: DataFrame, name: list[str]) -> DataFrame:
    """(name, rank, first) of the names at two places or more: rank grows with the name, first is the least place. Aggregates before it shuffles."""
    place = F.struct(*_PLACE)
    found = rows.groupBy(*name).agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").drop("last")
    # ids go up with the partition and within it; the table keeps them, so that a lost task can't number anew what others have read
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = found.repartitionByRange(n, *name).sortWithinPartitions(*name)
    return cut(ordered.select(*name, F.monotonically_increasing_id().alias("rank"), "first"), "ranks")


def _double(left: DataFrame, right: DataFrame, step: Column) -> DataFrame:
    """left's suffixes with right's rank and words, as `rank2` and `words2`, of the suffix `step` lines on."""
    there = right.select(*[F.col(c).alias("r" + c) for c in _PLACE], F.col("rank").alias("rank2"), F.col("words").alias("words2"))
    return left.join(there, (F.col("quarry__did") == F.col("rquarry__did")) & (F.col("quarry__hash") == F.col("rquarry__hash")) & (F.col("quarry__pos") + step == F.col("rquarry__pos"))).drop(*["r" + c for c in _PLACE])


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """Later places of repeated runs: (place, n) for n lines to delete from there on; and (quarry__did, quarry__hash, shared_lines).

    docs is as line_ids gives it, each text once.
    """
    every = suffixes(docs, min_words)
    level = cut(every.join(ranks(every, ["a", "b"]), ["a", "b"]).drop("a", "b"), "suffixes")
    later = F.struct(*_PLACE) != F.col("first")
    n = lambda k: F.lit(k).alias("n")
    runs, shared = [], []
    k = 1
    while True:
        found = level.where(later)
        shared.append(found.select("quarry__did", "quarry__hash", F.lit(k).alias("shared_lines")).distinct())
        if k < 2 * min_words:
            runs.append(found.where(F.col("words") >= min_words).select(*_PLACE, n(k)))
        here = level.drop("first")
        if k < min_words:
            # runs of k + 1 to 2k lines, by the first k and the last k
            open_ = here.where((F.col("reach") > k) & (F.col("need") <= 2 * k))
            open_ = open_.withColumn("n", F.explode(F.sequence(F.greatest("need", F.lit(k + 1)), F.least("reach", F.lit(2 * k)))))
            short = _double(open_, here, F.col("n") - k)
            name = ["n", "rank", "rank2"]
            first = short.groupBy(*name).agg(F.min(F.struct(*_PLACE)).alias("first"))
            runs.append(short.join(first, name).where(later).select(*_PLACE, "n"))
        pairs = _double(here, here, F.lit(k)).withColumn("words", F.least(F.lit(min_words), F.col("words") + F.col("words2"))).withColumnRenamed("rank", "rank1").drop("words2")
        found = ranks(pairs, ["rank1", "rank2"])
        if found.isEmpty():
            break
        level = cut(pairs.join(found, ["rank1", "rank2"]).drop("rank1", "rank2"), "suffixes")
        k *= 2
    longest = reduce(DataFrame.unionAll, shared).groupBy("quarry__did", "quarry__hash").agg(F.max("shared_lines").alias("shared_lines"))
    return reduce(DataFrame.unionAll, runs), longest


def dedup_lines(df: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """df with later copies of maximal repeated runs deleted from its text, and the columns ADDED."""
    docs = cut(line_ids(df, key, text, min_words), "line-ids")
    copies = cut(later_copies(docs), "copies")
    one = docs.join(copies.select("quarry__did", "quarry__hash", "other"), ["quarry__did", "quarry__hash", "other"], "left_anti").dropDuplicates(["quarry__did", "quarry__hash", "other"])
    runs, shared = repeated_runs(one, min_words)
    each = runs.select("quarry__did", "quarry__hash", F.explode(F.sequence(F.col("quarry__pos"), F.col("quarry__pos") + F.col("n") - 1)).alias("quarry__pos"))
    gone = each.groupBy("quarry__did", "quarry__hash").agg(F.array_sort(F.collect_set("quarry__pos")).alias("quarry__gone")).join(shared, ["quarry__did", "quarry__hash"], "left")
    # a text of enough words that is a copy goes entirely
    enough = docs.select("quarry__did", "quarry__hash", F.aggregate("lines", F.lit(0), lambda s, x: s + x["w"]).alias("words")).where(F.col("words") >= min_words).distinct()
    power = F.pow(F.lit(2.0), F.floor(F.log2(F.col("lines") + F.lit(0.5)))).cast("int")
    whole = copies.join(enough, ["quarry__did", "quarry__hash"]).select("quarry__did", "quarry__hash", F.sequence(F.lit(0), F.col("lines") - 1).alias("quarry__gone"), power.alias("shared_lines"))
    gone = gone.unionByName(whole)
    columns = [c for c in df.columns if c not in ADDED]
    packed = F.struct(*[c for c in columns if c != text], F.lit(0).alias(text)).alias("quarry__row")  # so that no column's name can clash
    rows = df.select(packed, F.col(text).alias("quarry__text"), *_keys(key, text)).join(gone, ["quarry__did", "quarry__hash"], "left")
    old = F.col("quarry__text")
    lines = F.col("quarry__lines")
    rows = rows.withColumn("quarry__lines", F.when(F.col("quarry__gone").isNotNull(), F.split(old, "\n")))
    rows = rows.withColumn("quarry__full", _full(lines)).withColumn("quarry__out", F.transform("quarry__gone", lambda p: F.get(F.col("quarry__full"), p)))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "quarry__out")
    new = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    count = F.when(old.isNull(), 0).otherwise(F.char_length(old) - F.char_length(F.replace(old, F.lit("\n"))) + 1)
    first = F.size(F.array_except("quarry__gone", F.transform("quarry__gone", lambda p: p + 1)))
    none = F.col("quarry__gone").isNull()
    out = F.struct(
        count.cast("long").alias("n_lines"), F.when(none, 0).otherwise(F.size("quarry__gone")).cast("long").alias("n_removed"),
        F.when(none, 0).otherwise(first).cast("long").alias("n_runs"), F.coalesce("shared_lines", F.lit(0)).cast("long").alias("shared_lines"),
        F.when(none, old).otherwise(new).alias("text"),
    )
    # a generator, so that conditions on the new text are not computed inside the join, line by line
    rows = rows.select("quarry__row", F.explode(F.array(out)).alias("quarry__out"))
    return rows.select(*[F.col("quarry__out")["text"].alias(c) if c == text else F.col("quarry__row")[c].alias(c) for c in columns], *[F.col("quarry__out")[c].alias(c) for c in ADDED])


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", *ADDED, F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


#: r: every run that must be compared, by its lines; u: windows of 1, 2, 4, ... lines, by digest.
ORACLE_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS no FROM d),
f AS (SELECT doc_id, no, line, row_number() OVER (PARTITION BY doc_id ORDER BY no) - 1 AS pos, len(regexp_extract_all(line, '{_HAS}+')) AS w FROM l WHERE regexp_matches(line, '{_HAS}')),
r AS (SELECT doc_id, pos, 1 AS need, line AS run, w AS total, 0 AS rest FROM f
  UNION ALL SELECT r.doc_id, r.pos, r.need + 1, r.run || chr(10) || f.line, r.total + f.w, r.rest + f.w FROM r JOIN f ON f.doc_id = r.doc_id AND f.pos = r.pos + r.need
    WHERE r.total < {MIN_WORDS} OR r.rest + f.w < {MIN_WORDS}),
s AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS k FROM r WHERE total >= {MIN_WORDS}),
g AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + need)) AS pos FROM s WHERE k > 1),
h AS (SELECT g.doc_id, g.pos, f.no, lag(g.pos) OVER (PARTITION BY g.doc_id ORDER BY g.pos) AS before FROM g JOIN f ON f.doc_id = g.doc_id AND f.pos = g.pos),
n AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE before IS NULL OR before <> pos - 1) AS n_runs FROM h GROUP BY doc_id),
u AS (SELECT doc_id, pos, 1 AS k, sha256(line) AS name FROM f
  UNION ALL SELECT u.doc_id, u.pos, 2 * u.k, sha256(u.name || v.name) FROM u JOIN u AS v ON v.doc_id = u.doc_id AND v.pos = u.pos + u.k),
x AS (SELECT doc_id, k, row_number() OVER (PARTITION BY name ORDER BY doc_id, pos) AS o FROM u),
y AS (SELECT doc_id, max(k) AS shared_lines FROM x WHERE o > 1 GROUP BY doc_id),
k AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.no) AS kept FROM l LEFT JOIN h ON h.doc_id = l.doc_id AND h.no = l.no WHERE h.no IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, len(ls)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_runs, 0)::BIGINT AS n_runs, CASE WHEN n_removed > 0 THEN shared_lines ELSE 0 END::BIGINT AS shared_lines,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN y ON y.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id
"""
