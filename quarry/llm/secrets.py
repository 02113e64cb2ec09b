"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Candidates are the matches of three patterns; their values' hashes are counted over the corpus by distinct repositories
and distinct owners. A value that at least COPIED_OWNERS owners hold, or COPIED_REPOSITORIES repositories of more than one
owner, is a widely copied example (kind `copied`); one that belongs to fewer and looks live, by length and variety of
characters and by not holding a placeholder word, is an owner's credential (kind `live`), however often that owner
repeats it. Either adds a span over the value to the base spans.

Positions are code points: the texts between matches and the matches themselves are measured in turn.

Cases: a null text counts as empty; a null owner or repository counts as one owner or repository of its own; a text
without a match has empty spans; repeated rows give repeated rows, and count once; an empty table gives no rows. Counting
aggregates before it shuffles, so a value that a third of all rows hold sends a row a task; the lookup is a join whose
large partitions Spark splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, documents

ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs are maximal, so a least length in the pattern finds what a filter after `+` would.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
COPIED_OWNERS = 3
COPIED_REPOSITORIES = 10
#: Matches whose ends are added up at a time: an array grows by one for each, so their number is kept short.
BLOCK = 256
LIVE_CHARS = 16
LIVE_KINDS = 8
PLACEHOLDER = "example|changeme|placeholder|dummy|sample|your|xxxx|test|1234567"


def _spans(text: Column, pattern: str, order: int, kind: str) -> Column:
    """Matches as structs (start, order, end, kind, value), value by code points up to the match's end."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pairs = F.arrays_zip(F.slice(between, 1, F.size(found)).alias("gap"), found.alias("found"))
    blocks = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / BLOCK).cast("int"))
    start = lambda at: F.struct(at.alias("at"), F.array().cast("array<struct<start:int,order:int,end:int,kind:string,value:string>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        a = acc["at"] + F.char_length(x["gap"])
        b = a + F.char_length(x["found"])
        value = F.regexp_extract(x["found"], pattern, 2) if order == 0 else x["found"]
        one = F.struct(a.alias("start"), F.lit(order).alias("order"), b.alias("end"), F.lit(kind).alias("kind"), value.alias("value"))
        return F.struct(b.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    def part(b: Column) -> Column:
        return F.slice(pairs, b * BLOCK + 1, BLOCK)

    # where each block of matches starts, then the matches of each block from there
    size = lambda b: F.aggregate(part(b), F.lit(0), lambda n, x: n + F.char_length(x["gap"]) + F.char_length(x["found"]))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    starts = F.aggregate(blocks, begin, lambda acc, b: F.struct((acc["at"] + size(b)).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])
    long = F.flatten(F.zip_with(blocks, starts, lambda b, at: F.aggregate(part(b), start(at), step, lambda acc: acc["out"])))
    short = F.aggregate(pairs, start(F.lit(0)), step, lambda acc: acc["out"])
    return F.when(F.size(between) <= 1, start(F.lit(0))["out"]).when(F.size(found) <= BLOCK, short).otherwise(long)


def candidates(df: DataFrame, text: str = "text") -> DataFrame:
    """df without its text, with `base`: the sorted base spans of every text."""
    t = F.coalesce(F.col(text), F.lit(""))
    assign = F.filter(_spans(t, ASSIGN, 0, "assign"), lambda x: F.char_length(x["value"]) >= ASSIGN_LEAST)
    base = F.array_sort(F.concat(assign, _spans(t, ACCESS, 1, "access"), _spans(t, HEX, 2, "hex")))
    return df.select(*[c for c in df.columns if c != text], base.alias("base"))


def ownership(found: DataFrame, owner: str, repository: str) -> DataFrame:
    """By value hash: how many distinct repositories and owners hold it; a repository under several owners counts once, null as one."""
    each = lambda c, n: found.select("value_hash", F.col(c).alias("x")).distinct().groupBy("value_hash").agg(F.count("*").alias(n))
    return each(repository, "n_repositories").join(each(owner, "n_owners"), "value_hash")


def _live(value: Column) -> Column:
    kinds = F.size(F.array_distinct(F.split(value, "")))
    return (F.char_length(value) >= LIVE_CHARS) & (kinds >= LIVE_KINDS) & value.rlike("[0-9]") & ~F.lower(value).rlike(PLACEHOLDER)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def marked(df: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of df: doc_id, `base` and `added` spans, and the columns to carry."""
    columns = [F.col(key).alias("doc_id"), F.col(owner).cast("string").alias("owner"), F.col(repository).cast("string").alias("repository"), F.col(text).alias("text")]
    base = candidates(df.select(*columns, *carry))
    base = base.withColumn("row_key", F.when(F.size("base") > 0, F.sha2(F.to_json(F.struct("doc_id", "owner", "repository", "base")), 256)))
    base = cut(base, "secrets")
    found = base.where(F.size("base") > 0).select("row_key", "owner", "repository", F.explode("base").alias("span"))
    found = found.select("row_key", "owner", "repository", "span", F.sha2(F.col("span.value"), 256).alias("value_hash"))
    known = ownership(found, "owner", "repository")
    copied = (F.col("n_owners") >= COPIED_OWNERS) | (F.col("n_owners") > 1) & (F.col("n_repositories") >= COPIED_REPOSITORIES)
    kind = F.when(copied, "copied").when(_live(F.col("span.value")), "live")
    added = F.struct(
        (F.col("span.end") - F.char_length("span.value")).alias("start"), F.when(kind == "copied", 3).otherwise(4).alias("order"),
        F.col("span.end").alias("end"), kind.alias("kind"), F.lit("").alias("value"),
    )
    spans = found.join(known, "value_hash").where(kind.isNotNull()).groupBy("row_key").agg(F.collect_set(added).alias("added"))
    with_some = base.where(F.size("base") > 0).join(spans, "row_key", "left")
    none = F.array().cast(spans.schema["added"].dataType)
    every = with_some.unionByName(base.where(F.size("base") == 0).withColumn("added", none))
    return every.select("doc_id", "base", F.coalesce("added", none).alias("added"), *carry)


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """One row per row of df: key, counts by base kind, digest of the base spans, all spans, and counts of added kinds."""

    def count(name: str, where: str = "base") -> Column:
        return F.size(F.filter(where, lambda x: x["kind"] == name)).cast("long")

    return marked(df, key, text, owner, repository).select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "added"))).alias("spans"), *[count(k, "added").alias(f"n_{k}") for k in ("copied", "live")],
    )


def redact(df: DataFrame, key: str = "doc_id", text: str = "text", owner: str = "source", repository: str = "doc_id", mark: str = "<secret>") -> DataFrame:
    """df with every owner-specific live-looking value in its text replaced; copied examples stay as they are.

    Rows with equal key, owner, repository and text have the same values, so they are looked up once.
    """
    packed = F.struct(*[c for c in df.columns if c != text], F.lit(0).alias(text)).alias("quarry__row")  # so that no column's name can clash
    own = {"quarry__id": key, "quarry__text": text, "quarry__owner": owner, "quarry__repository": repository}
    named = df.select(packed, *[F.col(c).alias(n) for n, c in own.items()])
    named = named.withColumn("quarry__hash", F.xxhash64(F.lit(5), "quarry__text", "quarry__owner", "quarry__repository"))
    spans = F.array_sort(F.transform(F.filter("added", lambda x: x["kind"] == "live"), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))))
    live = marked(named, "quarry__id", "quarry__text", "quarry__owner", "quarry__repository", ("quarry__hash",)).select(F.col("doc_id").alias("quarry__key"), "quarry__hash", spans.alias("quarry__spans"))
    live = live.where(F.size("quarry__spans") > 0).groupBy("quarry__key", "quarry__hash").agg(F.first("quarry__spans").alias("quarry__spans"))
    rows = named.join(live, F.col("quarry__id").eqNullSafe(F.col("quarry__key")) & (named["quarry__hash"] == live["quarry__hash"]), "left").drop(live["quarry__hash"])

    def step(acc: Column, x: Column) -> Column:
        before = F.col("quarry__text").substr(acc["at"] + 1, x["start"] - acc["at"])
        new = F.struct(x["end"].alias("at"), F.concat(acc["out"], before, F.lit(mark)).alias("out"))
        longer = F.struct(F.greatest(acc["at"], x["end"]).alias("at"), acc["out"].alias("out"))
        return F.when(x["start"] >= acc["at"], new).otherwise(longer)

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    new = F.aggregate("quarry__spans", start, step, lambda acc: F.concat(acc["out"], F.col("quarry__text").substr(acc["at"] + 1, F.char_length("quarry__text"))))
    new = F.when(F.col("quarry__spans").isNull(), F.col("quarry__text")).otherwise(new)
    return rows.select(*[new.alias(text) if c == text else F.col("quarry__row")[c].alias(c) for c in df.columns])


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


def _sql_spans(pattern: str, name: str, order: int) -> str:
    p = pattern.replace("'", "''")
    value = f"regexp_extract(f[i], '{p}', 2)" if order == 0 else "f[i]"
    return f"""{name} AS (SELECT n, list_transform(range(1, len(f) + 1), lambda i: {{'start': (list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0))::INT,
      'order': {order}, 'end': list_sum(list_transform(list_concat(g[1:i], f[1:i]), lambda x: length(x)))::INT, 'kind': '{name}', 'value': {value}}}) AS s
      FROM (SELECT n, regexp_extract_all(t, '{p}') AS f, string_split_regex(t, '{p}') AS g FROM d))"""


def _sql_joined(spans: str) -> str:
    return f"array_to_string(list_transform({spans}, lambda x: x.kind || ':' || x.start || ':' || x.\"end\"), ',')"


ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, source, coalesce(text, '') AS t FROM documents),
{_sql_spans(ASSIGN, "assign", 0)}, {_sql_spans(ACCESS, "access", 1)}, {_sql_spans(HEX, "hex", 2)},
b AS (SELECT d.n, doc_id, source, list_sort(list_concat(list_filter(a.s, lambda x: length(x.value) >= {ASSIGN_LEAST}), c.s, h.s)) AS base
      FROM d JOIN assign a ON a.n = d.n JOIN access c ON c.n = d.n JOIN hex h ON h.n = d.n),
e AS (SELECT n, doc_id, source, unnest(base) AS x FROM b),
k AS (SELECT x.value AS value, count(DISTINCT doc_id) + max((doc_id IS NULL)::INT) AS n_repositories, count(DISTINCT source) + max((source IS NULL)::INT) AS n_owners FROM e GROUP BY 1),
m AS (SELECT n, x."end" AS e, length(x.value) AS w, CASE WHEN n_owners >= {COPIED_OWNERS} OR n_owners > 1 AND n_repositories >= {COPIED_REPOSITORIES} THEN 'copied'
        WHEN length(value) >= {LIVE_CHARS} AND len(list_distinct(string_split(value, ''))) >= {LIVE_KINDS} AND regexp_matches(value, '[0-9]') AND NOT regexp_matches(lower(value), '{PLACEHOLDER}') THEN 'live' END AS kind
      FROM e JOIN k ON k.value = e.x.value),
a AS (SELECT n, list(DISTINCT {{'start': (e - w)::INT, 'order': CASE kind WHEN 'copied' THEN 3 ELSE 4 END, 'end': e, 'kind': kind, 'value': ''}}) AS added FROM m WHERE kind IS NOT NULL GROUP BY n)
SELECT doc_id, len(list_filter(base, lambda x: x.kind = 'assign'))::BIGINT AS n_assign, len(list_filter(base, lambda x: x.kind = 'access'))::BIGINT AS n_access,
  len(list_filter(base, lambda x: x.kind = 'hex'))::BIGINT AS n_hex, sha256({_sql_joined("base")}) AS base_sha256,
  {_sql_joined("list_sort(list_concat(base, coalesce(added, [])))")} AS spans,
  len(list_filter(coalesce(added, []), lambda x: x.kind = 'copied'))::BIGINT AS n_copied, len(list_filter(coalesce(added, []), lambda x: x.kind = 'live'))::BIGINT AS n_live
FROM b LEFT JOIN a ON a.n = b.n
"""
