"""The pinned forest as SQL text, for checking scores in another engine.

Repeats the forest's arithmetic step by step (per-tree class shares, summed in
tree order, then normalised), so the doubles agree to the last bit.

    python -m riskstream.plans.forest_sql   # rewrites artifacts/risk_forest.sql
"""

from __future__ import annotations

import glob
import os

import pyarrow.parquet as pq

from riskstream import schema
from riskstream.operators.model import FEATURE_ORDER, PINNED

RENDERED = f"{PINNED}.sql"


def _rows(stage: str, folder: str) -> list[dict]:
    (path,) = glob.glob(os.path.join(PINNED, "stages", f"*_{stage}_*", folder, "*.parquet"))
    return pq.read_table(path).to_pylist()


def labels() -> dict[str, list[str]]:
    found = _rows("StringIndexer", "data")[0]["labelsArray"]
    return dict(zip(schema.CATEGORY_INPUTS, found))


def index_sql(field: str) -> str:
    """A category's ordinal; unseen and null share the last one."""
    known = labels()[field]
    cases = " ".join(f"WHEN '{label}' THEN {i}e0" for i, label in enumerate(known))
    return f"(CASE {field} {cases} ELSE {len(known)}e0 END)"


def _node_sql(nodes: dict[int, dict], at: int, cls: int) -> str:
    node = nodes[at]
    if node["leftChild"] < 0:
        counts = node["impurityStats"]
        return f"{counts[cls]!r}e0/{sum(counts)!r}e0"
    split = node["split"]
    feature = FEATURE_ORDER[split["featureIndex"]]
    if split["numCategories"] == -1:
        test = f"{feature} <= {split['leftCategoriesOrThreshold'][0]!r}e0"
    else:
        inside = ", ".join(f"{c!r}e0" for c in split["leftCategoriesOrThreshold"])
        test = f"{feature} IN ({inside})"
    left, right = (_node_sql(nodes, node[side], cls) for side in ("leftChild", "rightChild"))
    return f"CASE WHEN {test} THEN {left} ELSE {right} END"


def votes_sql(cls: int) -> str:
    trees: dict[int, dict[int, dict]] = {}
    for row in _rows("RandomForestClassifier", "data"):
        trees.setdefault(row["treeID"], {})[row["nodeData"]["id"]] = row["nodeData"]
    return "\n + ".join(f"({_node_sql(trees[t], 0, cls)})" for t in sorted(trees))


def render() -> str:
    """A query over ``tx`` that adds ``fraud_probability``."""
    indexes = ", ".join(f"{index_sql(f)} AS {f}_idx" for f in schema.CATEGORY_INPUTS)
    return (
        "SELECT * EXCLUDE (v0, v1, location_idx, merchant_category_idx),"
        " v1 / (v0 + v1) AS fraud_probability\n"
        f"FROM (SELECT *,\n {votes_sql(0)} AS v0,\n {votes_sql(1)} AS v1\n"
        f"FROM (SELECT *, {indexes} FROM tx))\n"
    )


if __name__ == "__main__":
    with open(RENDERED, "w") as out:
        out.write(render())
