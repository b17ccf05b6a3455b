"""Operator 11: a Merkle manifest of a table, climbed by a recursive query.

H is the lowercase hex SHA-256 of its inputs' text.  A row's leaf is H of its
fields (``-`` for NULL, else ``byte count:value``).  Per group (``source``) the
leaves ascend by id; while several nodes remain, every ``FANOUT`` neighbours
become their H; what remains is the group's subroot.  The subroots, ordered by
group (NULL first, bytewise), give the root likewise.

Built levels are stored as node rows: the digests of a node's children side by
side (its run), its own digest, and the link to its parent.  One
``WITH RECURSIVE`` query then ascends.  A row of the recursion holds the leaves
of one lowest run, at most FANOUT: each leaf's folded hash, and the siblings
above the run, which they share and every step appends to.  A step joins the
parent's row, puts each folded hash in its place in the parent's run, and hashes.

Scale.  Nothing is numbered in one task per group: rows are sorted by range,
and the places before a (range, group) come from a table with one row for each.
A run is at most FANOUT rows.  High nodes are joined by every run below them,
so they are stored in copies, one for each ``FANOUT`` runs below (at most
``MOST_COPIES``; beyond that Spark may split the join).  Levels, nodes and the
ascent are written tables, so lost executors cost only their own tasks.

Edge cases: rows that repeat an id are all leaves, ordered by leaf hash; equal
rows are interchangeable; a NULL id sorts first and is never tampered with by
``tampered_text``; a NULL group is a group of its own; the empty text is ``0:``;
an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import write_table

FANOUT = 16
MOST_COPIES = 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DIGEST = 32  # bytes
ROW_LIMIT, LEVEL_LIMIT = "spark.sql.cteRecursionRowLimit", 64


def leaf_hash(fields: list[Column]) -> Column:
    """H of the fields, as 32 bytes."""
    parts = []
    for value in fields:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def tampered_text(text: Column, row_id: Column, every: int = 5) -> Column:
    """The text with A-Z in lower case where ``every`` divides the CRC-32 of the decimal id."""
    chosen = F.crc32(row_id.cast("string").cast("binary")) % every == 0
    return F.when(chosen, F.translate(text, UPPER, LOWER)).otherwise(text)


def _hash(run: str) -> str:
    return f"unhex(sha2(lower(hex({run})), 256))"


def _numbered(spark: SparkSession, rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``idx`` (from 0) and ``m`` (how many) within the group."""
    by = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    ranged = write_table(spark, rows.orderBy(*by).withColumn("_at", F.monotonically_increasing_id()), "merkle-sorted")
    ranged = ranged.withColumn("_part", F.shiftright("_at", 33))
    held = ranged.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(*group)
    before = F.sum("n").over(whole.orderBy("_part")) - F.col("n")
    held = held.select(
        *[F.col(c).alias(f"_{c}") for c in group], F.col("_part").alias("_in"), (before - F.col("_first")).alias("_shift"), F.sum("n").over(whole).alias("m")
    )
    same = F.col("_part") == F.col("_in")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return ranged.join(held, same).withColumn("idx", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_in", "_shift", *[f"_{c}" for c in group])


def _levels(spark: SparkSession, items: DataFrame, level: int, fanout: int) -> list[DataFrame]:
    """Node rows of all levels above ``items`` (top, source, idx, m, digest, below), each a written table."""
    out = []
    while (items.agg(F.max("m")).first()[0] or 0) > 1:
        level += 1
        up = items.where("m > 1").groupBy("top", "source", F.expr(f"idx div {fanout}").alias("up")).agg(
            F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("items"), F.sum("below").alias("below"), F.max(F.expr(f"(m + {fanout - 1}) div {fanout}")).alias("m")
        )
        up = up.withColumn("run", F.expr("unhex(array_join(transform(items, x -> hex(x.digest)), ''))"))
        up = up.select("top", "source", F.lit(level).alias("level"), F.col("up").alias("idx"), "m", "below", "run", F.expr(_hash("run")).alias("digest"))
        items = write_table(spark, up, "merkle-level")
        out.append(items)
    return out


def _linked(nodes: DataFrame, subroots: DataFrame, fanout: int, several: bool) -> DataFrame:
    """``nodes`` with the place of each in its parent (up_...; NULL at the root) and the parent's number of copies."""
    top = subroots.select(F.col("source").alias("_source"), F.col("idx").alias("_number"))
    nodes = nodes.join(top, (F.col("top") == 0) & (F.col("m") == 1) & F.col("source").eqNullSafe(F.col("_source")), "left")
    inner, crossing = F.col("m") > 1, (F.col("top") == 0) & (F.col("m") == 1) & F.lit(several)
    at = F.when(inner, F.col("idx")).when(crossing, F.col("_number"))
    return nodes.withColumns({
        "up_top": F.when(inner, F.col("top")).when(crossing, F.lit(1)),
        "up_source": F.when(inner, F.col("source")),
        "up_level": F.when(inner, F.col("level") + 1).when(crossing, F.lit(1)),
        "up_idx": F.floor(at / fanout).cast("bigint"),
        "up_place": F.pmod(at, F.lit(fanout)).cast("int"),
    }).drop("_source", "_number")


ASCENT = """
WITH RECURSIVE ascent (source, idx, salt, up_top, up_source, up_level, up_idx, up_place, up_copies, folded, siblings, subroot, root)
MAX RECURSION LEVEL {levels} AS (
  SELECT source, idx, salt, up_top, up_source, up_level, up_idx, up_place, up_copies, folded, siblings, subroot, root FROM {{base}}
  UNION ALL
  SELECT a.source, a.idx, a.salt, n.up_top, n.up_source, n.up_level, n.up_idx, n.up_place, n.up_copies,
         transform(a.folded, f -> {fold}),
         concat(a.siblings, substring(n.run, 1, a.up_place * {digest}), substring(n.run, (a.up_place + 1) * {digest} + 1)),
         CASE WHEN n.top = 1 THEN a.subroot ELSE n.digest END, n.digest
  FROM ascent a JOIN {{nodes}} n
    ON a.up_top = n.top AND a.up_source <=> n.source AND a.up_level = n.level AND a.up_idx = n.idx AND pmod(a.salt, a.up_copies) = n.copy
)
SELECT source, idx, folded, siblings, subroot, root FROM ascent WHERE up_level IS NULL
"""


def _ascend(spark: SparkSession, base: DataFrame, nodes: DataFrame) -> DataFrame:
    """The recursive query, written; its row limit is lifted meanwhile, since it returns a row for each run."""
    fold = _hash(f"overlay(n.run PLACING f FROM a.up_place * {DIGEST} + 1 FOR {DIGEST})")
    before = spark.conf.get(ROW_LIMIT, None)
    spark.conf.set(ROW_LIMIT, "-1")
    try:
        return write_table(spark, spark.sql(ASCENT.format(levels=LEVEL_LIMIT, digest=DIGEST, fold=fold), base=base, nodes=nodes), "merkle-ascent")
    finally:
        if before is None:
            spark.conf.unset(ROW_LIMIT)
        else:
            spark.conf.set(ROW_LIMIT, before)


def manifest(
    spark: SparkSession, docs: DataFrame, tampered: dict[str, Column] | None = None, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "source", fanout: int = FANOUT
) -> DataFrame:
    """One row per row of ``docs``: id, group, leaf, subroot, root, siblings, folded_root (digests as bytes).

    ``tampered`` names fields whose value differs when a row is checked; the
    folded root comes from that leaf and the stored siblings.
    """
    tampered = tampered or {}
    leaves = docs.select(
        F.col(id_col).alias("id"),
        F.col(group_col).cast("string").alias("source"),
        leaf_hash([F.col(c) for c in fields]).alias("leaf"),
        leaf_hash([tampered.get(c, F.col(c)) for c in fields]).alias("checked"),
    ).withColumn("checked", F.when(F.col("checked") != F.col("leaf"), F.col("checked"))).withColumn("row", F.monotonically_increasing_id())
    leaves = write_table(spark, leaves, "merkle-leaves")

    # lowest runs: at most fanout rows each; a lone leaf is its own subroot
    numbered = _numbered(spark, leaves, ["source"], ["id", "leaf", "row"])
    runs = numbered.groupBy("source", F.expr(f"idx div {fanout}").alias("idx")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("idx").alias("at"), "id", "leaf", "checked"))).alias("leaves"), F.max("m").alias("rows")
    )
    runs = runs.withColumn("run", F.expr("unhex(array_join(transform(leaves, x -> hex(x.leaf)), ''))"))
    runs = runs.withColumns({
        "digest": F.expr(f"CASE WHEN rows = 1 THEN run ELSE {_hash('run')} END"),
        "m": F.expr(f"(rows + {fanout - 1}) div {fanout}"),
        "top": F.lit(0), "level": F.lit(1), "below": F.lit(1).cast("bigint"),
    })
    runs = write_table(spark, runs, "merkle-runs")

    node = ["top", "source", "level", "idx", "m", "below", "run", "digest"]
    levels = _levels(spark, runs, 1, fanout)
    within = runs.select(*node)
    for rows in levels:
        within = within.union(rows.select(*node))
    subroots = within.where("m = 1").select(F.lit(1).alias("top"), "source", "digest", "below")
    subroots = write_table(spark, _numbered(spark, subroots, ["top"], ["source"]), "merkle-subroots")
    above = _levels(spark, subroots.withColumn("source", F.lit(None).cast("string")), 0, fanout)

    nodes = within
    for rows in above:
        nodes = nodes.union(rows.select(*node))
    nodes = write_table(spark, _linked(nodes, subroots, fanout, bool(above)), "merkle-nodes")
    copies = F.least(F.lit(MOST_COPIES), F.ceil(F.col("below") / fanout)).cast("int")
    parents = nodes.select(F.col("top").alias("p_top"), F.col("source").alias("p_source"), F.col("level").alias("p_level"), F.col("idx").alias("p_idx"), copies.alias("up_copies"))
    parents = parents.where("p_top = 1 OR p_level > 1")
    match = (F.col("up_top") == F.col("p_top")) & F.col("up_source").eqNullSafe(F.col("p_source")) & (F.col("up_level") == F.col("p_level")) & (F.col("up_idx") == F.col("p_idx"))
    linked = nodes.join(parents, match, "left").drop("p_top", "p_source", "p_level", "p_idx")
    linked = write_table(spark, linked, "merkle-linked")

    link = ["up_top", "up_source", "up_level", "up_idx", "up_place", "up_copies"]
    lowest = linked.where("top = 0 AND level = 1").select(F.col("source").alias("_source"), F.col("idx").alias("_idx"), *link)
    fold = _hash(f"overlay(run PLACING coalesce(x.checked, x.leaf) FROM i * {DIGEST} + 1 FOR {DIGEST})")
    base = runs.join(lowest, F.col("source").eqNullSafe(F.col("_source")) & (F.col("idx") == F.col("_idx"))).select(
        "source", "idx", F.xxhash64("source", "idx").alias("salt"), *link,
        F.expr(f"transform(leaves, (x, i) -> CASE WHEN rows = 1 THEN coalesce(x.checked, x.leaf) ELSE {fold} END)").alias("folded"),
        F.expr("CAST('' AS BINARY)").alias("siblings"), F.col("digest").alias("subroot"), F.col("digest").alias("root"),
    )
    stored = linked.where("top = 1 OR level > 1").withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    ascent = _ascend(spark, base, stored)

    end = ascent.select(F.col("source").alias("_source"), F.col("idx").alias("_idx"), "folded", "siblings", "subroot", "root")
    done = runs.join(end, F.col("source").eqNullSafe(F.col("_source")) & (F.col("idx") == F.col("_idx")))
    done = done.select("source", "run", "siblings", "subroot", "root", "folded", F.posexplode("leaves").alias("i", "x"))
    beside = F.expr(f"concat(substring(run, 1, i * {DIGEST}), substring(run, (i + 1) * {DIGEST} + 1), siblings)")
    return done.select(F.col("x.id").alias("id"), "source", F.col("x.leaf").alias("leaf"), "subroot", "root", beside.alias("siblings"), F.expr("folded[i]").alias("folded_root"))


def digest_rows(proofs: DataFrame) -> DataFrame:
    """Hex digests of ``manifest``'s rows, with the siblings hashed."""
    text = lambda c: F.lower(F.hex(c))
    return proofs.select(
        F.col("id").alias("doc_id"), text("leaf").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"),
        F.sha2(text("siblings"), 256).alias("proof_sha256"), text("folded_root").alias("folded_root"), (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def oracle(fanout: int = FANOUT) -> str:
    """DuckDB SQL for the digests over ``documents``, trees and ascents as recursive queries."""
    fields = lambda text: " || ".join(
        f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
    )
    low = f"translate(text, '{UPPER}', '{LOWER}')"
    place = f"a.idx % {fanout}"
    beside = f"(run[:{place}] || run[{place} + 2:])"
    folded = f"sha256(array_to_string(run[:{place}] || [f] || run[{place} + 2:], ''))"
    grown = f"sha256(string_agg(digest, '' ORDER BY idx)), max((m + {fanout - 1}) // {fanout})"
    return f"""
    WITH RECURSIVE
    bits AS (SELECT list(c ORDER BY n) AS tab FROM (
        SELECT n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM range(256) r(n))),
    d AS (SELECT row_number() OVER () AS k, *, CASE WHEN doc_id IS NOT NULL THEN
              xor(4294967295, list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda c, x: xor(tab[(xor(c, x) & 255) + 1], c >> 8))) END AS crc
          FROM documents, bits),
    h AS (SELECT k, doc_id, source, sha256({fields("text")}) AS leaf, sha256(CASE WHEN crc % 5 = 0 THEN {fields(low)} ELSE {fields("text")} END) AS checked FROM d),
    leaves AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, k) - 1 AS idx, count(*) OVER (PARTITION BY source) AS m FROM h),
    grow(source, level, idx, digest, m) AS (
        SELECT source, 0, idx, leaf, m FROM leaves
        UNION ALL SELECT source, level + 1, idx // {fanout}, {grown} FROM grow WHERE m > 1 GROUP BY source, level, idx // {fanout}),
    runs AS (SELECT source, level, idx // {fanout} AS up, list(digest ORDER BY idx) AS run FROM grow WHERE m > 1 GROUP BY ALL),
    subs AS (SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS m FROM grow WHERE m = 1),
    grow_top(level, idx, digest, m) AS (
        SELECT 0, idx, subroot, m FROM subs
        UNION ALL SELECT level + 1, idx // {fanout}, {grown} FROM grow_top WHERE m > 1 GROUP BY level, idx // {fanout}),
    runs_top AS (SELECT level, idx // {fanout} AS up, list(digest ORDER BY idx) AS run FROM grow_top WHERE m > 1 GROUP BY ALL),
    climb(k, source, level, idx, m, f, sib) AS (
        SELECT k, source, 0, idx, m, checked, '' FROM leaves
        UNION ALL SELECT k, a.source, a.level + 1, a.idx // {fanout}, (a.m + {fanout - 1}) // {fanout}, {folded}, sib || array_to_string({beside}, '')
        FROM climb a JOIN runs r ON r.source IS NOT DISTINCT FROM a.source AND r.level = a.level AND r.up = a.idx // {fanout} WHERE a.m > 1),
    climb_top(k, subroot, level, idx, m, f, sib) AS (
        SELECT k, subroot, 0, s.idx, s.m, f, sib FROM climb c JOIN subs s ON s.source IS NOT DISTINCT FROM c.source WHERE c.m = 1
        UNION ALL SELECT k, a.subroot, a.level + 1, a.idx // {fanout}, (a.m + {fanout - 1}) // {fanout}, {folded}, sib || array_to_string({beside}, '')
        FROM climb_top a JOIN runs_top r ON r.level = a.level AND r.up = a.idx // {fanout} WHERE a.m > 1)
    SELECT doc_id, leaf, subroot, root, sha256(sib) AS proof_sha256, f AS folded_root, f = root AS verified
    FROM climb_top c JOIN leaves USING (k), (SELECT digest AS root FROM grow_top WHERE m = 1) WHERE c.m = 1"""
