"""Depth of dependency trees in long token tables, for annotators whose sentences do not come in one row."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import materialise

#: Groups of up to so many tokens are measured in one row each; larger ones are joined with themselves.
ROW_TOKENS = 4096


def _depths(nodes: pd.Series, heads: pd.Series) -> np.ndarray:
    """The depth of every group of a batch: 0 without a root, -1 where one node has several heads."""
    group = np.repeat(np.arange(len(nodes)), nodes.map(len).to_numpy(np.int64))
    rows = np.stack([group, np.concatenate([*nodes, []]).astype(np.int64), np.concatenate([*heads, []]).astype(np.int64)], axis=1)
    rows = np.unique(rows, axis=0)
    depth = np.zeros(len(nodes), np.int64)
    if not len(rows):
        return depth
    group, node, head = rows.T
    twice = group[1:][(group[1:] == group[:-1]) & (node[1:] == node[:-1])]
    # a head is looked for among the nodes of its group: all keys are put in order, a node before those that ask for it
    order = np.lexsort((np.repeat([0, 1], len(rows)), np.concatenate([node, head]), np.concatenate([group, group])))
    isnode = order < len(rows)
    last = np.maximum.accumulate(np.where(isnode, order, -1))
    at = np.full(len(rows), -1)
    at[order[~isnode] - len(rows)] = last[~isnode]
    known = (at >= 0) & (group[at] == group) & (node[at] == head)
    jump = np.where(known, at, len(rows))  # the place behind all rows stands for a head that is missing
    root = np.append(node == head, False)
    jump, far = np.append(jump, len(rows)), np.append((node != head).astype(np.int64), 0)
    for _ in range(max(1, int(np.bincount(group).max()).bit_length())):
        far, jump = far + far[jump], jump[jump]
    reached = np.flatnonzero(root[jump])
    first = np.full(len(nodes), len(rows))
    np.minimum.at(first, group[reached], jump[reached])
    own = reached[jump[reached] == first[group[reached]]]
    np.maximum.at(depth, group[own], far[own] + 1)
    depth[twice] = -1
    return depth


def tree_depths(tokens: DataFrame, by: list[str], node: str = "token_idx", head: str = "head_idx") -> DataFrame:
    """(by..., depth): levels of the tree under the first root of each group; a root is its own head.

    Pointer doubling: in each round every token that has not reached a root jumps as far as its target
    jumps, so a chain of 100,000 heads takes 17 rounds. Groups of up to ``ROW_TOKENS`` tokens are gathered by one shuffle
    and doubled as arrays, many in a batch; in larger ones a round is one join and is written. Tokens whose heads form a
    circle or are missing stay out, and a group without a root has no row. ``node`` is unique in its group.
    """
    rows = tokens.select(*by, F.col(node).alias("_node"), F.col(head).alias("_jump"))
    rows = materialise(rows.where("_node IS NOT NULL AND _jump IS NOT NULL"), "heads")
    keys = [F.col(c).alias(f"_{c}") for c in by]
    own = lambda few, how: rows.join(few, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by], how)
    large = materialise(rows.groupBy(*by).agg(F.count("*").alias("n")).where(F.col("n") > ROW_TOKENS).select(*keys), "large-groups")
    small = rows if large.isEmpty() else own(large, "left_anti")

    @F.pandas_udf("long")
    def measured(nodes: pd.Series, heads: pd.Series) -> pd.Series:
        return pd.Series(_depths(nodes, heads))

    gathered = small.groupBy(*by).agg(F.collect_list("_node").alias("_nodes"), F.collect_list("_jump").alias("_heads"))
    found = materialise(gathered.select(*by, measured("_nodes", "_heads").alias("depth")), "depths")
    rest = large.unionByName(found.where("depth < 0").select(*keys))
    parts = [found.where("depth > 0")] + ([] if rest.isEmpty() else [_joined_depths(own(rest, "left_semi"), by)])
    return reduce(DataFrame.unionByName, parts)


def _joined_depths(tokens: DataFrame, by: list[str]) -> DataFrame:
    """(by..., depth) of groups of any size, from rows (by..., _node, _jump)."""
    rows = tokens.withColumn("_far", (F.col("_node") != F.col("_jump")).cast("long"))
    rows = materialise(rows.withColumn("_done", F.col("_far") == 0), "jumps")
    size = rows.groupBy(*by).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    same = lambda a, b: [a[c].eqNullSafe(b[f"_{c}"]) for c in by]
    for _ in range(math.ceil(math.log2(size + 1)) if size else 0):
        open_ = rows.where("NOT _done")
        if open_.isEmpty():
            break
        target = rows.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("_node").alias("_at"), F.col("_jump").alias("_next"),
                             F.col("_far").alias("_more"), F.col("_done").alias("_there"))
        moved = open_.join(target, [*same(open_, target), open_["_jump"] == target["_at"]]).select(
            *[open_[c] for c in by], "_node", F.col("_next").alias("_jump"), (F.col("_far") + F.col("_more")).alias("_far"), F.col("_there").alias("_done"))
        rows = materialise(rows.where("_done").unionByName(moved), "jumps")
    reached = rows.where("_done").groupBy(*by, "_jump").agg((F.max("_far") + 1).alias("depth"))
    return reached.groupBy(*by).agg(F.min_by("depth", "_jump").alias("depth"))
