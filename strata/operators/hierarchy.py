"""Adjacency lists: level extraction, parent lookup and hierarchy flattening."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.keys import key_text
from strata.operators.star import HOT_KEY_ROWS, SALT_BUCKETS, salted_left_join, spread_nulls
from strata.session import scratch_path

# Parent/hop tables up to this many rows are broadcast (checked by a count).
PARENT_BROADCAST_ROWS = 5_000_000


def level_rows(nodes: DataFrame, level_col: str, level: str) -> DataFrame:
    """Rows of one hierarchy level (a filter the scan can push down)."""
    return nodes.filter(F.col(level_col) == level)


def split_roots(df: DataFrame, parent_col: str, date_cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(groups, members): a row with no parent and no dates is a group row.
    One predicate, evaluated once per side; no set difference (and so no
    de-duplicating shuffle)."""
    is_root = F.col(parent_col).isNull()
    for c in date_cols:
        is_root = is_root & F.col(c).isNull()
    return df.filter(is_root), df.filter(~is_root)


def lookup_parent(child: DataFrame, parent: DataFrame, on: Sequence[tuple[str, str]],
                  parent_cols: dict[str, str], default: str | None = "Unknown") -> DataFrame:
    """Left join child -> parent attributes; a missing parent yields ``default``.

    ``on`` pairs (child column, parent column); ``parent_cols`` maps parent
    column -> output name.  The parent side is reduced to one row per key
    first, so the lookup can never fan out the child rows."""
    first = F.min(F.struct(*[F.col(c) for c in parent_cols]))
    p = stored(parent.groupBy(key_text(*[pc for _, pc in on]).alias("_pk")).agg(first.alias("_p")),
               "parents")
    keyed = child.withColumn("_ck", key_text(*[cc for cc, _ in on]))
    out = left_lookup(keyed, "_ck", p, "_pk", child.columns)
    extra = []
    for c, name in parent_cols.items():
        v = F.col(f"_p.{c}")
        extra.append((F.coalesce(v, F.lit(default)) if default is not None else v).alias(name))
    return out.select(*child.columns, *extra)


def stored(parents: DataFrame, name: str) -> DataFrame:
    """The reduced parent table, written once to the shared scratch: every hop
    reads it, and counting it reads file footers only."""
    spark = parents.sparkSession
    path = scratch_path(spark, name)
    parents.write.parquet(path)
    return spark.read.schema(parents.schema).parquet(path)


def left_lookup(rows: DataFrame, key: str, parents: DataFrame, parent_key: str,
                identity: Sequence[str], broadcast_rows: int | None = None) -> DataFrame:
    """Left join of ``rows`` with a stored one-row-a-key table: broadcast up to
    ``broadcast_rows`` parents, beyond that a shuffle join in which null keys are
    spread and hot keys (one pack under a third of all SKUs) are salted; AQE
    cannot split them when a side is an aggregate."""
    if parents.count() <= (PARENT_BROADCAST_ROWS if broadcast_rows is None else broadcast_rows):
        return rows.join(F.broadcast(parents), rows[key] == parents[parent_key], "left").drop(parent_key)
    spread, jk = spread_nulls(rows, key, identity)
    out = salted_left_join(spread, jk, parents, parent_key, identity, HOT_KEY_ROWS, SALT_BUCKETS).drop(parent_key)
    return out if jk == key else out.drop(jk)


def flatten_hierarchy(leaves: DataFrame, nodes: DataFrame, id_col: str, parent_col: str,
                      levels: Sequence[str], attrs: dict[str, str],
                      incomplete_col: str = "incomplete_at",
                      level_col: str | None = None,
                      expected_levels: dict[str, str] | None = None) -> DataFrame:
    """Walk each leaf up ``len(levels)`` parents and return one wide row.

    For level ``L`` every node attribute ``a`` in ``attrs`` (node column ->
    suffix) becomes column ``L + suffix``.  The walk is a left-join chain, so a
    leaf whose chain breaks is kept and ``incomplete_at`` names the first level
    that could not be reached (null when the chain is complete).  The parent
    table holds only referenced nodes, projected to four columns, reduced to one
    row per id and written once; see ``left_lookup`` for the join of a hop.
    By default a hop accepts any parent node, as the reference does; with
    ``level_col`` and ``expected_levels`` (level name -> level value) a parent
    of the wrong level counts as missing, so the chain is reported incomplete
    at that level."""
    cols = list(attrs) + ([level_col] if level_col and level_col not in attrs else [])
    # Only nodes that some node names as its parent can be reached by a hop:
    # restricting to them is exact and keeps the hop table to the inner levels
    # (packs, brands, ...), which is small enough to broadcast even when the
    # leaves number in the millions.
    referenced = (nodes.select(F.col(parent_col).alias("_pid"))
                  .filter(F.col("_pid").isNotNull()).distinct())
    inner = nodes.join(referenced, nodes[id_col] == referenced["_pid"], "left_semi")
    parents = (inner.groupBy(F.col(id_col).alias("_id"))
               .agg(F.min(F.struct(*[F.col(c) for c in cols + [parent_col]])).alias("_n")))
    parents = stored(parents, "inner-nodes")
    identity = leaves.columns
    cur = leaves.withColumn("_next", F.col(parent_col)) \
                .withColumn(incomplete_col, F.lit(None).cast("string"))
    for level in levels:
        src = parents
        if level_col and expected_levels and level in expected_levels:
            src = parents.filter(F.col(f"_n.{level_col}") == expected_levels[level])
        step = src.select(F.col("_id").alias(f"_id_{level}"),
                          *[F.col(f"_n.{c}").alias(f"{level}{suf}") for c, suf in attrs.items()],
                          F.col(f"_n.{parent_col}").alias(f"_up_{level}"))
        step = step.withColumn("_found", F.lit(True))
        cur = left_lookup(cur, "_next", step, f"_id_{level}", identity)
        cur = cur.withColumn(
            incomplete_col,
            F.coalesce(F.col(incomplete_col),
                       F.when(F.col("_found").isNull(), F.lit(level)))
        ).withColumn("_next", F.col(f"_up_{level}")).drop("_found", f"_up_{level}")
    return cur.drop("_next")


# Parents of a walk up to this many are broadcast; their rows hold whole ways, and a
# broadcast passes the driver.
WALK_BROADCAST_ROWS = 10_000

# The outcomes of ``walk_to_root``.
COMPLETE, PARENT_MISSING, CYCLE, BELOW_CYCLE = "complete", "parent missing", "cycle", "below a cycle"


def walk_to_root(nodes: DataFrame, id_col: str, parent_col: str, separator: str = "/") -> DataFrame:
    """Every node of a ragged adjacency list with its way up, whatever its depth:
    ``node``, ``root``, ``depth`` (0 at a root), ``path`` (from the root down) and ``outcome``.

    By pointer doubling: after round r every open node knows its ancestor 2^r
    steps up and the ids between, so a list of depth d takes log2(d) rounds, each
    one join with the nodes that are a parent (see ``_walk_lookup``) whose result
    is stored.  As long as a chain reaches a root, each round closes some node;
    when none closes, all that are open lead to a cycle.

    Outcomes: ``complete``; ``parent missing`` (the topmost known node names a
    parent that is not in the list; it counts as the root); ``cycle`` (the node is
    its own ancestor) and ``below a cycle``, both without root, depth and path.
    An id given several times counts once, with its smallest parent; a node that
    names itself is a cycle; rows without id are left out."""
    spark = nodes.sparkSession
    listed = nodes.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("node")).agg(
        F.min(parent_col).alias("parent"))
    known = stored(listed, "walk-nodes")
    named = _reached(known, "parent")
    inner = known.join(named.hint("merge"), known["node"] == named["_r"], "left_semi").select(F.col("node").alias("_known"))
    start = _walk_lookup(known, "parent", stored(inner.withColumn("_is", F.lit(True)), "walk-parents"), "_known", named)
    orphan = F.col("parent").isNotNull() & F.col("_is").isNull()
    # up: the ancestor reached (null at the top), way: the ids from there down to the node.
    now = stored(start.select(
        "node", F.when(~orphan, F.col("parent")).alias("up"), F.array("node").alias("way"),
        F.when(orphan, PARENT_MISSING).otherwise(COMPLETE).alias("outcome")), "walk")
    open_before = -1
    while (open_now := now.where("up is not null").count()) not in (0, open_before):
        now, open_before = stored(_doubled(now), "walk"), open_now
    done = now.where("up is null").select(
        "node", F.element_at("way", 1).alias("root"), (F.size("way") - 1).alias("depth"),
        F.array_join("way", separator).alias("path"), "outcome")
    if not open_now:
        return done
    # The nodes reached by 2^r steps lie within those reached by half as many; once they
    # are as many, the steps permute them, so they are the nodes of the cycles.
    left = now.where("up is not null").select("node", "up")
    reached, reached_before = _reached(left, "up"), -1
    while (reached_now := reached.count()) != reached_before:
        ups = left.select(F.col("node").alias("_n"), F.col("up").alias("_u"))
        left = stored(_walk_lookup(left, "up", ups, "_n", reached).select("node", F.col("_u").alias("up")), "walk-cycles")
        reached, reached_before = _reached(left, "up"), reached_now
    on_cycle = reached.select(F.col("_r").alias("_c"))
    stuck = left.join(on_cycle.hint("merge"), left["node"] == on_cycle["_c"], "left")
    nothing = F.lit(None).cast(nodes.schema[id_col].dataType)
    return done.unionByName(stuck.select(
        "node", nothing.alias("root"), F.lit(None).cast("int").alias("depth"), F.lit(None).cast("string").alias("path"),
        F.when(F.col("_c").isNotNull(), CYCLE).otherwise(BELOW_CYCLE).alias("outcome")))


def _reached(rows: DataFrame, key: str) -> DataFrame:
    """The values of ``key`` (``_r``) with their rows, stored: who is looked up, and
    which of them are hot."""
    return stored(rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_r")).agg(
        F.count(F.lit(1)).alias("_times")), "walk-reached")


def _walk_lookup(rows: DataFrame, key: str, parents: DataFrame, parent_key: str, reached: DataFrame) -> DataFrame:
    """``left_lookup`` of a walk's rows.  Rows of a walk hold whole ways, of which a
    small file may hold many: beyond ``WALK_BROADCAST_ROWS`` they are merged, and
    nothing of them passes the driver.  Salted only where ``reached`` has hot keys."""
    if parents.count() <= WALK_BROADCAST_ROWS:
        return left_lookup(rows, key, parents, parent_key, ["node"], WALK_BROADCAST_ROWS)
    spread, jk = spread_nulls(rows, key, ["node"])
    hot = reached.where(F.col("_times") >= HOT_KEY_ROWS).select(F.col("_r").alias("_hk"))
    merged = parents.hint("merge")
    if hot.count():
        out = salted_left_join(spread, jk, merged, parent_key, ["node"], HOT_KEY_ROWS, SALT_BUCKETS, hot)
    else:
        out = spread.join(merged, spread[jk] == merged[parent_key], "left")
    return out.drop(parent_key) if jk == key else out.drop(parent_key, jk)


def _doubled(now: DataFrame) -> DataFrame:
    """One round: open ways are continued by the way of the node they reached."""
    closed, going = now.where("up is null"), now.where("up is not null")
    reached = _reached(going, "up")
    above = stored(now.join(reached.hint("merge"), now["node"] == reached["_r"], "left_semi").select(
        F.col("node").alias("_n"), F.struct("up", "way", "outcome").alias("_a")), "walk-above")
    joined = _walk_lookup(going, "up", above, "_n", reached)
    return closed.unionByName(joined.select(
        "node", F.col("_a.up").alias("up"), F.concat("_a.way", "way").alias("way"), F.col("_a.outcome").alias("outcome")))


def root_report(walked: DataFrame) -> DataFrame:
    """Per root (and per outcome without one): nodes and greatest depth."""
    return walked.groupBy("root", "outcome").agg(
        F.count(F.lit(1)).cast("bigint").alias("n_nodes"), F.max("depth").alias("max_depth"))
