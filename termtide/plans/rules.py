"""Configured rules as one CASE expression."""

from __future__ import annotations

import ast
import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from ..config import UNMATCHED_ACTION, ActionRule

RULE_COLUMNS = (
    "opportunity_score", "relevance_score", "question_intent_score", "search_volume", "content_available",
)
_COMPARE = {
    ast.Lt: lambda a, b: a < b, ast.LtE: lambda a, b: a <= b, ast.Gt: lambda a, b: a > b, ast.GtE: lambda a, b: a >= b,
    ast.Eq: lambda a, b: a == b, ast.NotEq: lambda a, b: a != b,
}
# a division by zero is no number, and a rule without a number does not hold
_COMPUTE = {ast.Add: lambda a, b: a + b, ast.Sub: lambda a, b: a - b, ast.Mult: lambda a, b: a * b, ast.Div: F.try_divide}


def _column(node: ast.expr) -> Column:
    if isinstance(node, ast.BoolOp):
        first, *rest = map(_column, node.values)
        for other in rest:
            first = first & other if isinstance(node.op, ast.And) else first | other
        return first
    if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.Not):
        return ~_column(node.operand)
    if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.USub):
        return -_column(node.operand)
    if isinstance(node, ast.BinOp) and type(node.op) in _COMPUTE:
        return _COMPUTE[type(node.op)](_column(node.left), _column(node.right))
    if isinstance(node, ast.Compare) and all(type(op) in _COMPARE for op in node.ops):
        sides = [_column(n) for n in (node.left, *node.comparators)]
        holds = F.lit(True)
        for op, left, right in zip(node.ops, sides, sides[1:]):
            holds = holds & _COMPARE[type(op)](left, right)
        return holds
    if isinstance(node, ast.Name) and node.id in RULE_COLUMNS:
        return F.col(node.id)
    if isinstance(node, ast.Constant) and isinstance(node.value, (bool, int, float)):
        return F.lit(node.value)
    raise ValueError("not part of a rule")


def condition(rule: ActionRule) -> Column | None:
    """The rule's condition over scored columns, numbers and logic; None for anything else."""
    spelled = re.sub(r"(?i)\b(and|or|not)\b", lambda m: m[0].lower(), rule.when)
    spelled = re.sub(r"(?i)\b(true|false)\b", lambda m: m[0].capitalize(), spelled)
    try:
        tree = ast.parse(re.sub(r"(?<![<>=!])=(?!=)", "==", spelled).strip(), mode="eval")
        return _column(tree.body)
    except (SyntaxError, ValueError):
        return None


def compile_actions(rules: Iterable[ActionRule]) -> Column:
    """First rule whose condition holds; conditions that are none are skipped, null is false."""
    action = F.when(F.lit(False), "")
    for rule in rules:
        holds = condition(rule)
        if holds is not None:
            action = action.when(F.coalesce(holds.cast("boolean"), F.lit(False)), rule.action)
    return action.otherwise(UNMATCHED_ACTION)
