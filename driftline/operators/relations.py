"""Joins between parents, children and keyed changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.operators.keyed import DEFAULT_POLICY, SkewPolicy, over_key
from driftline.session import BROADCAST_BYTES, estimated_bytes, if_small, stored


def parents_without_children(parents: DataFrame, key: str, children: DataFrame, child_key: str) -> DataFrame:
    """Parents that no child refers to. Child keys are reduced before the shuffle, so a parent
    with very many children costs one row per task."""
    used = children.select(F.col(child_key).alias("_used")).distinct()
    return parents.join(used, F.col(key) == F.col("_used"), "left_anti")


def orphans(
    children: DataFrame, child_key: str, parents: DataFrame, key: str, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Children whose non-null reference names no parent.

    Parent keys of a checked small size are broadcast. Beyond it, the distinct references are
    checked first: they are reduced before the shuffle, however often one repeats. The lost
    ones, few in any table worth checking, are stored, and the children then meet them
    without being shuffled unless the lost ones are many.
    """
    known = parents.select(F.col(key).alias("_known"))
    present = children.filter(F.col(child_key).isNotNull())
    size = estimated_bytes(known)
    if size is not None and size <= broadcast_bytes:
        return present.join(F.broadcast(known), F.col(child_key) == F.col("_known"), "left_anti")
    references = present.select(F.col(child_key).alias("_lost")).distinct()
    lost = stored(references.join(known, F.col("_lost") == F.col("_known"), "left_anti"), "lost")
    return present.join(if_small(lost), F.col(child_key) == F.col("_lost"), "left_semi")


def cascade_delete(
    deleted: DataFrame,
    key: str,
    children: DataFrame,
    child_key: str,
    child_id: str,
    grandchildren: DataFrame,
    grandchild_key: str,
) -> tuple[DataFrame, DataFrame]:
    """Children and grandchildren that remain once the deleted parents' rows went with them."""
    gone = deleted.select(F.col(key).alias("_gone")).distinct()
    gone_children = children.join(gone, F.col(child_key) == F.col("_gone"), "left_semi").select(
        F.col(child_id).alias("_gone_child")
    )
    kept_children = children.join(gone, F.col(child_key) == F.col("_gone"), "left_anti")
    kept_grandchildren = grandchildren.join(
        gone_children, F.col(grandchild_key) == F.col("_gone_child"), "left_anti"
    )
    return kept_children, kept_grandchildren


def apply_patch(target: DataFrame, patch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Set the patch's columns on the rows whose key it names, nulls included.

    The patch has at most one row per key; reduce it with `latest_per_key` first.
    """
    columns = [c for c in patch.columns if c not in keys]
    marked = patch.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    joined = target.join(marked, list(keys), "left")
    picked = [
        F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
        for c in target.columns
    ]
    return joined.select(*picked)


def running_adjustments(
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    amounts: Mapping[str, Column],
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Level of each amount after every increment to its key."""
    return over_key(changes, keys, order, running=amounts, policy=policy)


def set_in_struct(df: DataFrame, struct: str, values: Mapping[str, Column]) -> DataFrame:
    """Set fields inside a struct column; a null struct stays null."""
    updated = F.col(struct)
    for name, value in values.items():
        updated = updated.withField(name, value)
    return df.withColumn(struct, updated)


def tagged_counts(tables: Mapping[str, DataFrame], label: str = "table_name") -> DataFrame:
    """Row counts of several tables side by side, one row per table."""
    frames = [t.agg(F.count("*").alias("row_count")).select(F.lit(n).alias(label), "row_count") for n, t in tables.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def classify_tables(tables: DataFrame, name: str = "table_name", tracking: str = "migration_status") -> DataFrame:
    """Role of a table from its name. In a LIKE pattern `_` stands for any one character."""
    role = (
        F.when(F.col(name).like("target_%"), "target")
        .when(F.col(name) == tracking, "tracking")
        .otherwise("other")
    )
    return tables.withColumn("role", role)


@dataclass(frozen=True)
class Reference:
    """`child`'s column names rows of `parent` by its column, and goes with them."""

    child: str
    child_column: str
    parent: str
    parent_column: str


def cascade_graph(
    tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], references: Sequence[Reference], deleted: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """The keys of all rows that go, by table, when the rows named in `deleted` do, along any graph of references.

    References may form cycles and point to their own table. Each round takes the children of the rows found in the round before and
    leaves out those known already, so it ends when nothing new is found: after as many rounds as the longest chain has links. A
    round's rows are stored, and only they meet the next tables. Null references name nothing.
    """
    needed = {t: list(dict.fromkeys([*keys[t], *[r.parent_column for r in references if r.parent == t]])) for t in tables}

    def hit(table: str, column: str, values: DataFrame) -> DataFrame:
        return tables[table].join(if_small(values), F.col(column) == F.col("_gone"), "left_semi").select(*needed[table])

    gone: dict[str, DataFrame] = {}
    new: dict[str, DataFrame] = {}
    for t, rows in deleted.items():
        wanted = rows.select(*[F.col(k).alias(f"_d_{k}") for k in keys[t]]).distinct()
        same = reduce(lambda acc, k: acc & F.col(k).eqNullSafe(F.col(f"_d_{k}")), keys[t], F.lit(True))
        new[t] = stored(tables[t].join(if_small(wanted), same, "left_semi").select(*needed[t]).distinct(), "gone")
        gone[t] = new[t]
    while new:
        found: dict[str, DataFrame] = {}
        for r in references:
            if r.parent in new:
                values = stored(new[r.parent].select(F.col(r.parent_column).alias("_gone")).filter("_gone IS NOT NULL").distinct(), "gone")
                rows = hit(r.child, r.child_column, values)
                found[r.child] = rows if r.child not in found else found[r.child].unionByName(rows)
        new = {}
        for t, rows in found.items():
            rows = rows.distinct()
            if t in gone:
                known = gone[t].select(*[F.col(k).alias(f"_d_{k}") for k in keys[t]])
                same = reduce(lambda acc, k: acc & F.col(k).eqNullSafe(F.col(f"_d_{k}")), keys[t], F.lit(True))
                rows = rows.join(known, same, "left_anti")
            rows = stored(rows, "gone")
            if not rows.isEmpty():
                new[t] = rows
                gone[t] = rows if t not in gone else stored(gone[t].unionByName(rows), "gone")
    return {t: rows.select(*keys[t]) for t, rows in gone.items()}
