"""Fitted ``pyspark.ml`` models as one Catalyst expression.

``model_sql`` writes a fitted regression model as Spark SQL text over given
feature expressions: trees as nested CASE over their splits, forests and
boosted trees as weighted sums of trees, linear models as arithmetic.  A model
in this form scores inside any projection, with no vector column, no
``transform`` job and no Python, so it can stand inside the recursion of a
forecast (``forecast.recursive_forecast_ml``), where every step needs the
prediction of the step before.

Trees are read from the model's public ``toDebugString``, which prints every
threshold, category set and leaf value in full double precision.

Semantics equal ``model.transform``: continuous splits send ``x <= t`` to the
left; categorical splits send the listed codes to the left.  Spark keeps the
smaller side of a categorical split, so a code beyond the feature's arity goes
to the other side; ``arity`` (feature index -> number of categories, from the
vector's metadata) keeps that rule.  NULL features are not defined for
``transform`` (it raises); here a NULL compares as false and goes right, so
callers fill features first.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_IF = re.compile(r"If \(feature (\d+) (<=|in) (.+)\)$")
_TREE = re.compile(r"Tree (\d+) \(weight ([^)]+)\):$")
_LEAF = re.compile(r"Predict: (.+)$")


@dataclass(frozen=True)
class Leaf:
    value: float


@dataclass(frozen=True)
class Split:
    feature: int
    threshold: float | None      # continuous: left is x <= threshold
    left_codes: tuple | None     # categorical: left is x in these codes
    left: "Split | Leaf"
    right: "Split | Leaf"


def _parse(lines: list[str], at: int) -> tuple[Split | Leaf, int]:
    """One node of a debug string, and the line after it."""
    leaf = _LEAF.match(lines[at])
    if leaf:
        return Leaf(float(leaf[1])), at + 1
    test = _IF.match(lines[at])
    if not test:
        raise ValueError(f"not a tree line: {lines[at]!r}")
    left, at = _parse(lines, at + 1)
    if not lines[at].startswith("Else "):
        raise ValueError(f"no right branch: {lines[at]!r}")
    right, at = _parse(lines, at + 1)
    if test[2] == "<=":
        return Split(int(test[1]), float(test[3]), None, left, right), at
    codes = tuple(float(c) for c in test[3].strip("{}").split(",") if c)
    return Split(int(test[1]), None, codes, left, right), at


def trees(model) -> list[tuple[float, Split | Leaf]]:
    """(weight, tree) of a fitted decision tree, random forest or GBT model."""
    lines = [x.strip() for x in model.toDebugString.splitlines() if x.strip()][1:]
    out: list[tuple[float, Split | Leaf]] = []
    at, weight = 0, 1.0
    while at < len(lines):
        head = _TREE.match(lines[at])
        if head:
            weight, at = float(head[2]), at + 1
        tree, at = _parse(lines, at)
        out.append((weight, tree))
    return out


def number(x: float) -> str:
    """A double literal that reads back exactly."""
    if x != x or x in (float("inf"), float("-inf")):
        return f"CAST('{x}' AS DOUBLE)"
    return f"{x!r}D"


def tree_sql(node: Split | Leaf, features: Sequence[str], arity: Mapping[int, int] | None = None) -> str:
    if isinstance(node, Leaf):
        return number(node.value)
    x = features[node.feature]
    if node.left_codes is None:
        test = f"{x} <= {number(node.threshold)}"
    else:
        codes, word = set(node.left_codes), "IN"
        n = (arity or {}).get(node.feature)
        if n is not None and 2 * len(codes) > n:
            codes, word = {float(c) for c in range(n)} - codes, "NOT IN"
        listed = ", ".join(number(c) for c in sorted(codes))
        test = f"{x} {word} ({listed})" if codes else ("false" if word == "IN" else "true")
    return (f"CASE WHEN {test} THEN {tree_sql(node.left, features, arity)} "
            f"ELSE {tree_sql(node.right, features, arity)} END")


def _total(terms: list[str]) -> str:
    """A sum as one fold over an array: thousands of terms stay flat for the
    parser and the analyzer, and are added in their order."""
    return f"aggregate(array({', '.join(terms)}), 0D, (s, z) -> s + z)"


def _linear_sql(model, features: Sequence[str]) -> str:
    terms = [number(float(model.intercept))]
    terms += [f"{number(float(c))} * {x}" for c, x in zip(model.coefficients, features) if float(c) != 0.0]
    return _total(terms)


#: Inverse link functions of generalized linear models.
_INVERSE = {"identity": "{0}", "log": "exp({0})", "sqrt": "pow({0}, 2)", "inverse": "1D / ({0})",
            "logit": "1D / (1D + exp(-({0})))"}


def model_sql(model, features: Sequence[str], arity: Mapping[int, int] | None = None,
              first: int | None = None) -> str:
    """Spark SQL text of a fitted regression model over feature expressions.

    ``first``: only that many trees of a boosted model (its best round).

    Supported: decision tree, random forest, GBT, linear regression, and
    generalized linear models with an identity, log, sqrt, inverse or logit
    link (no offset).  Other models raise ``TypeError``.
    """
    kind = type(model).__name__
    if kind in ("DecisionTreeRegressionModel", "RandomForestRegressionModel", "GBTRegressionModel"):
        boosted = kind == "GBTRegressionModel"
        parts = [(w, tree_sql(t, features, arity)) for w, t in trees(model)[:first if boosted else None]]
        if kind == "DecisionTreeRegressionModel":
            return parts[0][1]
        if kind == "RandomForestRegressionModel":
            return f"{_total([t for _, t in parts])} / {number(float(len(parts)))}"
        return _total([f"{number(w)} * {t}" for w, t in parts])
    if kind == "LinearRegressionModel":
        return _linear_sql(model, features)
    if kind == "GeneralizedLinearRegressionModel":
        link = model.getOrDefault("link") if model.isDefined("link") else {
            "gaussian": "identity", "poisson": "log", "gamma": "inverse", "binomial": "logit"}.get(
            model.getOrDefault("family"))
        if link in _INVERSE:
            return _INVERSE[link].format(_linear_sql(model, features))
    raise TypeError(f"no expression form for {kind}")


def model_column(model, columns: Sequence[str], arity: Mapping[int, int] | None = None,
                 first: int | None = None) -> Column:
    """The prediction over named columns of a frame, as one column."""
    quoted = [f"CAST(`{c.replace('`', '``')}` AS DOUBLE)" for c in columns]
    return F.expr(model_sql(model, quoted, arity, first))


def nominal_arity(df, features_col: str = "features") -> dict[int, int]:
    """Feature index -> number of categories, from the vector's metadata."""
    attrs = df.schema[features_col].metadata.get("ml_attr", {}).get("attrs", {})
    return {a["idx"]: len(a["vals"]) if "vals" in a else int(a["num_vals"]) for a in attrs.get("nominal", [])
            if "vals" in a or "num_vals" in a}


def let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``, evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"
