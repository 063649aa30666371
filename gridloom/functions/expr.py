"""User value transforms: Python expressions in ``x`` turned into Columns.

Configurations carry strings such as ``"x - 273.15"`` or ``"x * 3600"``.  They
are compiled with :mod:`ast` against a whitelist into a Spark Column, so the
transform runs inside whole-stage codegen.  Nothing is evaluated with
``eval``.  Python/numpy semantics that differ from Spark are made explicit:

* ``/``  → ``try_divide`` (division by zero is missing, numpy gives inf/NaN)
* ``//`` → ``floor(a / b)``, ``%`` → ``a - b * floor(a / b)`` (Python floors)
* ``log``/``sqrt`` of values outside their domain → missing
* comparisons give 1.0/0.0 (numpy booleans in arithmetic); a missing value compares
  False, but for ``!=``, which is True as for NaN; ``&``, ``|``, ``^`` and ``~`` combine
  comparisons
* ``np.nan`` is missing, ``np.inf`` infinite; ``clip`` keeps a missing value missing
"""

from __future__ import annotations

import ast
import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import nan_to_null

_NUMPY_NAMES = {"np", "numpy"}


def _div(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def _floordiv(a: Column, b: Column) -> Column:
    return F.floor(F.try_divide(a, b)).cast("double")


def _mod(a: Column, b: Column) -> Column:
    return a - b * F.floor(F.try_divide(a, b))


def _log(a: Column) -> Column:
    return F.when(a > 0, F.ln(a))


def _log1p(a: Column) -> Column:
    return F.when(a > -1, F.log1p(a))


def _log10(a: Column) -> Column:
    return F.when(a > 0, F.log10(a))


def _log2(a: Column) -> Column:
    return F.when(a > 0, F.log2(a))


def _sqrt(a: Column) -> Column:
    return F.when(a >= 0, F.sqrt(a))


def _where(cond: Column, a: Column, b: Column) -> Column:
    return F.when(cond != 0, a).otherwise(b)


def _clip(a: Column, lo: Column, hi: Column) -> Column:
    return _minimum(_maximum(a, lo), hi)


def _minimum(a: Column, b: Column) -> Column:
    # numpy propagates missing values through minimum/maximum
    return F.when(a.isNull() | b.isNull(), F.lit(None)).otherwise(F.least(a, b))


def _maximum(a: Column, b: Column) -> Column:
    return F.when(a.isNull() | b.isNull(), F.lit(None)).otherwise(F.greatest(a, b))


# name → (arity, builder)
_FUNCTIONS: dict[str, tuple[int, Callable[..., Column]]] = {
    "log": (1, _log),
    "log1p": (1, _log1p),
    "log10": (1, _log10),
    "log2": (1, _log2),
    "exp": (1, F.exp),
    "expm1": (1, F.expm1),
    "sqrt": (1, _sqrt),
    "abs": (1, F.abs),
    "absolute": (1, F.abs),
    "fabs": (1, F.abs),
    "sin": (1, F.sin),
    "cos": (1, F.cos),
    "tan": (1, F.tan),
    "arctan": (1, F.atan),
    "tanh": (1, F.tanh),
    "floor": (1, lambda a: F.floor(a).cast("double")),
    "ceil": (1, lambda a: F.ceil(a).cast("double")),
    "sign": (1, F.signum),
    "square": (1, lambda a: a * a),
    "minimum": (2, _minimum),
    "maximum": (2, _maximum),
    "power": (2, F.pow),
    "arctan2": (2, F.atan2),
    "clip": (3, _clip),
    "where": (3, _where),
}

_BUILTINS: dict[str, tuple[int, Callable[..., Column]]] = {
    "abs": (1, F.abs),
}

_CONSTANTS = {"pi": math.pi, "e": math.e, "inf": math.inf, "nan": math.nan}
# Operators on truth values; both sides must be comparisons or combinations of them.
_LOGIC: dict[type, Callable[[Column, Column], Column]] = {
    ast.BitAnd: lambda a, b: (a != 0) & (b != 0),
    ast.BitOr: lambda a, b: (a != 0) | (b != 0),
    ast.BitXor: lambda a, b: (a != 0) != (b != 0),
}

_BINOPS: dict[type, Callable[[Column, Column], Column]] = {
    ast.Add: lambda a, b: a + b,
    ast.Sub: lambda a, b: a - b,
    ast.Mult: lambda a, b: a * b,
    ast.Div: _div,
    ast.FloorDiv: _floordiv,
    ast.Mod: _mod,
    ast.Pow: F.pow,
}

_CMPOPS: dict[type, Callable[[Column, Column], Column]] = {
    ast.Lt: lambda a, b: a < b,
    ast.LtE: lambda a, b: a <= b,
    ast.Gt: lambda a, b: a > b,
    ast.GtE: lambda a, b: a >= b,
    ast.Eq: lambda a, b: a == b,
    ast.NotEq: lambda a, b: a != b,
}


def is_truth(node: ast.AST) -> bool:
    """Whether a node has truth values: a comparison, or such combined by ``&``, ``|``, ``^``, ``~``."""
    if isinstance(node, ast.Compare):
        return True
    if isinstance(node, ast.BinOp):
        return type(node.op) in _LOGIC and is_truth(node.left) and is_truth(node.right)
    return isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.Invert) and is_truth(node.operand)


class _Compiler:
    def __init__(self, x: Column, source: str):
        self.x = x
        self.source = source

    def fail(self, node: ast.AST, what: str) -> ValueError:
        return ValueError(f"unsupported {what} in transform {self.source!r}")

    def visit(self, node: ast.AST) -> Column:
        if isinstance(node, ast.Expression):
            return self.visit(node.body)
        if isinstance(node, ast.Constant):
            if isinstance(node.value, bool) or not isinstance(node.value, (int, float)):
                raise self.fail(node, "constant")
            return F.lit(float(node.value))
        if isinstance(node, ast.Name):
            if node.id == "x":
                return self.x
            raise NameError(f"name {node.id!r} is not defined in transform {self.source!r}")
        if isinstance(node, ast.Attribute):
            if isinstance(node.value, ast.Name) and node.value.id in _NUMPY_NAMES \
                    and node.attr in _CONSTANTS:
                value = _CONSTANTS[node.attr]
                return F.lit(None).cast("double") if math.isnan(value) else F.lit(value)
            raise self.fail(node, "attribute")
        if isinstance(node, ast.UnaryOp):
            v = self.visit(node.operand)
            if isinstance(node.op, ast.Invert) and is_truth(node.operand):
                return (v == 0).cast("double")
            if isinstance(node.op, ast.USub):
                return -v
            if isinstance(node.op, ast.UAdd):
                return v
            raise self.fail(node, "unary operator")
        if isinstance(node, ast.BinOp):
            if type(node.op) in _LOGIC and is_truth(node.left) and is_truth(node.right):
                return _LOGIC[type(node.op)](self.visit(node.left), self.visit(node.right)).cast("double")
            op = _BINOPS.get(type(node.op))
            if op is None:
                raise self.fail(node, "operator")
            return op(self.visit(node.left), self.visit(node.right))
        if isinstance(node, ast.Compare):
            left = self.visit(node.left)
            out = None
            for op_node, right_node in zip(node.ops, node.comparators):
                op = _CMPOPS.get(type(op_node))
                if op is None:
                    raise self.fail(node, "comparison")
                right = self.visit(right_node)
                term = F.coalesce(op(left, right), F.lit(isinstance(op_node, ast.NotEq)))
                out = term if out is None else (out & term)
                left = right
            return out.cast("double")
        if isinstance(node, ast.Call):
            return self.call(node)
        raise self.fail(node, type(node).__name__)

    def call(self, node: ast.Call) -> Column:
        if node.keywords:
            raise self.fail(node, "keyword argument")
        f = node.func
        table = None
        name = None
        if isinstance(f, ast.Attribute) and isinstance(f.value, ast.Name) \
                and f.value.id in _NUMPY_NAMES:
            table, name = _FUNCTIONS, f.attr
        elif isinstance(f, ast.Name):
            table, name = _BUILTINS, f.id
        if table is None or name not in table:
            raise self.fail(node, "function")
        arity, builder = table[name]
        if len(node.args) != arity:
            raise ValueError(f"{name} takes {arity} arguments in transform {self.source!r}")
        return builder(*[self.visit(a) for a in node.args])


def trial_value(tree: ast.AST, x: float = 1.0):
    """Evaluate the whitelisted expression once at a Python float ``x``.

    Mirrors the configuration check of the original pipeline: arithmetic on
    Python floats raises (``1 / (x - 1)`` → ZeroDivisionError) while numpy
    calls return numpy scalars and only warn.  Errors propagate unchanged.
    """
    import numpy as np

    def ev(node):
        if isinstance(node, ast.Expression):
            return ev(node.body)
        if isinstance(node, ast.Constant):
            return node.value
        if isinstance(node, ast.Name):
            return x
        if isinstance(node, ast.Attribute):
            return _CONSTANTS[node.attr]
        if isinstance(node, ast.UnaryOp):
            v = ev(node.operand)
            if isinstance(node.op, ast.Invert):
                return not v
            return -v if isinstance(node.op, ast.USub) else +v
        if isinstance(node, ast.BinOp):
            a, b = ev(node.left), ev(node.right)
            op = type(node.op)
            return {ast.Add: lambda: a + b, ast.Sub: lambda: a - b, ast.Mult: lambda: a * b,
                    ast.Div: lambda: a / b, ast.FloorDiv: lambda: a // b,
                    ast.Mod: lambda: a % b, ast.Pow: lambda: a ** b,
                    ast.BitAnd: lambda: a and b, ast.BitOr: lambda: a or b,
                    ast.BitXor: lambda: bool(a) != bool(b)}[op]()
        if isinstance(node, ast.Compare):
            left, out = ev(node.left), True
            for op_node, rn in zip(node.ops, node.comparators):
                right = ev(rn)
                out = out and {ast.Lt: left < right, ast.LtE: left <= right, ast.Gt: left > right,
                               ast.GtE: left >= right, ast.Eq: left == right,
                               ast.NotEq: left != right}[type(op_node)]
                left = right
            return out
        if isinstance(node, ast.Call):
            args = [ev(a) for a in node.args]
            if isinstance(node.func, ast.Name):
                return abs(*args)
            with np.errstate(all="ignore"):
                # names were checked against the whitelist by the compiler
                return getattr(np, node.func.attr)(*args)
        raise ValueError(f"unsupported {type(node).__name__}")

    return ev(tree)


def compile_transform(source: str, x: Column) -> Column:
    """Compile one transform string into a Column over ``x``.

    Raises SyntaxError for invalid Python, NameError for unknown names and
    ValueError for constructs outside the whitelist; the expression is then
    tried once at ``x = 1.0`` and any error of that trial (for example
    ZeroDivisionError) propagates as it is.
    """
    try:
        tree = ast.parse(source.strip(), mode="eval")
    except SyntaxError as exc:
        raise SyntaxError(f"{source!r} does not parse as a Python expression") from exc
    column = _Compiler(x, source).visit(tree)     # validates names first
    trial_value(tree, 1.0)
    return column


def transform_column(x: Column, transforms: list[str]) -> Column:
    """Apply transforms in order; NaN results (e.g. 0/0 paths) become NULL."""
    out = x.cast("double")
    for t in transforms:
        out = nan_to_null(compile_transform(t, out))
    return out
