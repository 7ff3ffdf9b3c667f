"""Equi-joins that hold when a table grows or one key dominates.

Two cases occur. A look-up table is broadcast while Spark's own size estimate
and the files it is read from prove it small; past that limit, and for joins of
two large tables, the join shuffles. A key held by a large share of the rows is
then split over several tasks: by adaptive execution where both sides come
straight from a shuffle, else by a salt. Nothing is dropped, capped or sampled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest look-up table, in estimated stored bytes, that is sent to every
# executor; unpacked in memory it may take several times that.
BROADCAST_LIMIT = 32 * 1024 * 1024

_KEY = "_join_key"
_SALT = "_join_salt"


def estimated_bytes(frame: DataFrame) -> int | None:
    """Size estimate from the optimizer's statistics; runs no job.

    None on a remote session, which does not expose them.
    """
    plan = getattr(frame, "_jdf", None)
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def stored_bytes(frame: DataFrame) -> int | None:
    """Bytes in the files below a frame, listed now; 0 without files.

    Statistics of a catalog table stay as they were when another writer adds to it.
    None when a table's place is not known.
    """
    leaves = frame._jdf.queryExecution().optimizedPlan().collectLeaves()
    hadoop = frame.sparkSession.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        kind = leaf.getClass().getSimpleName()
        if kind == "HiveTableRelation":
            return None
        if kind != "LogicalRelation":
            continue
        if leaf.relation().getClass().getSimpleName() != "HadoopFsRelation":
            return None
        roots = leaf.relation().location().rootPaths()
        for j in range(roots.size()):
            root = roots.apply(j)
            total += root.getFileSystem(hadoop).getContentSummary(root).getLength()
    return total


def surely_within(frame: DataFrame, limit: int) -> bool:
    """Whether both the estimate and the files below stay within ``limit`` bytes."""
    estimate = estimated_bytes(frame)
    if estimate is None or estimate > limit:
        return False
    stored = stored_bytes(frame)
    return stored is not None and stored <= limit


def salted_join(
    large: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    salts: int = 1,
    spread: Sequence[str] = (),
) -> DataFrame:
    """Join ``large`` to ``small`` on equal columns, a key spread over ``salts`` tasks.

    Every row of ``large`` gets one salt, every row of ``small`` a copy per
    salt, so each pair meets exactly once; ``how`` may be inner or left. The
    salt depends on the ``spread`` columns and on the input partition, never on
    row order or chance: a lost task that runs again assigns the same salts,
    and identical rows from different partitions still separate.

    With one salt this is a plain join, and splitting a dominant key is left to
    adaptive execution. That needs no copies, but it cannot split a join that uses
    the partitioning of an aggregate; more salts give such a side its own shuffle.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    if salts <= 1:
        return large.join(small, list(on), how)
    row_salt = F.spark_partition_id().cast("bigint")
    if spread:
        row_salt = row_salt + F.xxhash64(*spread) % salts
    salted = large.withColumn(_SALT, F.pmod(row_salt, F.lit(salts)).cast("int"))
    copies = small.withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    return salted.join(copies, [*on, _SALT], how).drop(_SALT)


def lookup_join(
    facts: DataFrame,
    fact_key: Column,
    lookup: DataFrame,
    lookup_key: Column,
    *,
    limit: int = BROADCAST_LIMIT,
    salts: int = 1,
    spread: Sequence[str] = (),
) -> DataFrame:
    """Inner join of a large table with a look-up table on two key expressions.

    The result has the columns of both sides. Rows whose key is NULL or has no
    partner drop out; several partners multiply the row. A look-up beyond
    ``limit`` bytes is shuffled; ``salts`` is for sessions that do not split skewed
    partitions by themselves.
    """
    keyed = facts.withColumn(_KEY, fact_key)
    keyed_lookup = lookup.withColumn(_KEY, lookup_key)
    if surely_within(keyed_lookup, limit):
        joined = keyed.join(F.broadcast(keyed_lookup), [_KEY])
    else:
        joined = salted_join(keyed, keyed_lookup, [_KEY], salts=salts, spread=spread)
    return joined.drop(_KEY)
