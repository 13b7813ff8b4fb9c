"""Small Arrow helpers for texts only Python can read or print exactly.

Each handles one cell at a time inside a task. Callers pass NULL for rows the
native expressions already settled, so these see only the remainder.
"""

from __future__ import annotations

import ast
import json
import math
import operator
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT = T.StringType()
MESSAGES = T.ArrayType(T.StructType().add("role", TEXT).add("content", TEXT))
BOXES = T.ArrayType(T.StructType().add("bbox", T.ArrayType(T.DoubleType())).add("label", TEXT))
ROLES = ("user", "assistant", "system")


def _storable(text: str) -> str:
    """The text with a "?" for each half of a surrogate pair, as native JSON reading gives it."""
    try:
        text.encode()
        return text
    except UnicodeEncodeError:
        return text.encode(errors="replace").decode()


def _json_or_literal(cell: str):
    try:
        return json.loads(cell)
    except ValueError:
        return ast.literal_eval(cell)


def _messages(cell):
    if cell is None:
        return None
    try:
        value = _json_or_literal(cell)
    except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
        return []
    if not isinstance(value, list):
        return []
    kept = []
    for entry in value:
        if isinstance(entry, dict) and entry.get("role", "") in ROLES and entry.get("content", ""):
            kept.append({"role": entry["role"], "content": _storable(str(entry["content"]))})
    return kept


@F.pandas_udf(MESSAGES)
def messages_from_text(cells: pd.Series) -> pd.Series:
    """Role/content pairs of a JSON or Python-literal cell, [] when unreadable."""
    return cells.map(_messages)


LOG_MESSAGES = T.ArrayType(T.StructType().add("role", TEXT).add("content", TEXT).add("as_is", TEXT))


def _written(cell):
    """Every message; text of the three roles as content, any other as its own literal.

    An assistant's text comes in the tagged format. None when the cell is no
    readable list of messages.
    """
    if cell is None:
        return None
    try:
        found = []
        for m in ast.literal_eval(cell):
            role, content = m.get("role", ""), m.get("content", "")
            if role in ROLES and isinstance(content, str):
                text = _answer_text(content) if role == "assistant" else _storable(content)
                found.append({"role": role, "content": text, "as_is": None})
            elif role == "system":
                return None  # its sections can only be cut from text
            else:
                found.append({"role": _storable(str(role)), "content": None, "as_is": _storable(repr(m))})
        return found
    except Exception:  # noqa: BLE001  unreadable cells stay as they are
        return None


LOG_MESSAGES_ARROW = pa.list_(pa.struct([("role", pa.string()), ("content", pa.string()), ("as_is", pa.string())]))


@F.arrow_udf(LOG_MESSAGES)
def messages_as_written(cells: pa.Array) -> pa.Array:
    """All messages of a Python-literal cell, NULL when unreadable."""
    return pa.array(map(_written, cells.to_pylist()), LOG_MESSAGES_ARROW)


def _strings(cell):
    if cell is None:
        return None
    if cell[:1] == "[" and cell[-1:] == "]":
        try:
            value = ast.literal_eval(cell)
            return [_storable(str(v)) for v in value]
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return None
    return [cell]


@F.pandas_udf(T.ArrayType(TEXT))
def strings_from_literal(cells: pd.Series) -> pd.Series:
    """List cell as strings; a plain cell is a list of one; NULL when malformed."""
    return cells.map(_strings)


def _literal_boxes(cell):
    """All or nothing, except that boxes without four numbers are passed over."""
    if cell is None:
        return None
    try:
        found = []
        for entry in ast.literal_eval(cell):
            box = entry.get("bbox_2d", [])
            if len(box) != 4:
                continue
            label = entry["label"]
            if not isinstance(label, str):
                raise TypeError("label")
            found.append({"bbox": [float(v) for v in box], "label": _storable(label)})
        return found
    except Exception:  # noqa: BLE001  any fault empties the answer
        return []


@F.pandas_udf(BOXES)
def boxes_from_literal(cells: pd.Series) -> pd.Series:
    return cells.map(_literal_boxes)


def _answer_text(cell):
    if cell is None:
        return None
    whole = f"<thinking>\n{cell}\n</thinking>"
    try:
        fields = json.loads(cell)
        if isinstance(fields, (list, str)):  # neither holds answer fields, unless by chance as items
            fields = {k: None for k in ANSWER_FIELDS if k in fields}
            if fields:
                raise TypeError("fields")
        parts = [fields["thinking"]] if "thinking" in fields else []
        parts += [f"\n\n{title}: {fields[key]}" for key, title in ANSWER_TITLES if key in fields]
        thinking = "".join(parts)
        calls = []
        actions = fields.get("action")
        if isinstance(actions, list):
            for action in actions:
                if isinstance(action, dict):
                    calls += [f"{n}({json.dumps(a, ensure_ascii=False)})" for n, a in action.items()]
    except Exception:  # noqa: BLE001  unreadable answers are kept as reasoning
        return whole
    blocks = []
    if thinking:
        blocks.append(f"<thinking>\n{thinking}\n</thinking>")
    if calls:
        blocks.append("<tool_call>\n" + "\n".join(calls) + "\n</tool_call>")
    return _storable("\n\n".join(blocks))


# Reasoning fields after "thinking", in order, with their titles.
ANSWER_TITLES = (
    ("evaluation_previous_goal", "Evaluation of Previous Goal"),
    ("memory", "Memory"),
    ("next_goal", "Next Goal"),
)
ANSWER_FIELDS = ("thinking", *(key for key, _ in ANSWER_TITLES), "action")


@F.pandas_udf(TEXT)
def tagged_answer(cells: pd.Series) -> pd.Series:
    """Reasoning and tool-call blocks of a JSON answer."""
    return cells.map(_answer_text)


@F.arrow_udf(TEXT)
def messages_to_literal(rows: pa.Array) -> pa.Array:
    """Python text of a message list, as log cells hold it."""
    def printed(m):
        return m["as_is"] if m["as_is"] is not None else repr({"role": m["role"], "content": m["content"]})

    return pa.array((None if row is None else "[" + ", ".join(map(printed, row)) + "]" for row in rows.to_pylist()), pa.string())


PARAMETERS = T.ArrayType(T.MapType(TEXT, T.StructType().add("default", TEXT).add("low", TEXT).add("high", TEXT)))


def _parameters(cell):
    if cell is None:
        return None
    try:
        shown = lambda v: None if v is None else _storable(str(v))
        return [
            {_storable(name): {
                "default": shown(p.get("default")), "low": shown(p.get("minimum") or p.get("minLength")),
                "high": shown(p.get("maximum") or p.get("maxLength"))} for name, p in (tool.get("params") or {}).items()}
            for tool in json.loads(cell)["tools"]]
    except Exception:  # noqa: BLE001  an unreadable catalogue has no text
        return None


@F.pandas_udf(PARAMETERS)
def printed_parameters(cells: pd.Series) -> pd.Series:
    """Defaults and bounds of each tool's parameters as Python prints them."""
    return cells.map(_parameters)


VALUE_TOLERANCE = 1e-6
BINARY = {ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv,
          ast.FloorDiv: operator.floordiv, ast.Mod: operator.mod}
UNARY = {ast.UAdd: operator.pos, ast.USub: operator.neg}


def _power(base, exponent):
    """Exact for whole numbers within a double's range, else as floats; raises beyond it."""
    if isinstance(base, int) and isinstance(exponent, int) and exponent >= 0 and abs(base) > 1:
        if exponent * math.log2(abs(base)) > sys.float_info.max_exp:
            raise OverflowError("beyond a double")
        return base**exponent
    if isinstance(base, int) and isinstance(exponent, int) and exponent >= 0:
        return base ** (exponent % 2 or min(exponent, 2))
    return float(base) ** exponent


def _value(tree: ast.Expression):
    """Value of a tree of numbers and arithmetic signs, without recursion; raises for anything else."""
    todo, values = [(tree.body, False)], []
    while todo:
        node, ready = todo.pop()
        if isinstance(node, ast.Constant) and type(node.value) in (int, float):
            values.append(node.value)
        elif isinstance(node, ast.UnaryOp) and not ready:
            todo += [(node, True), (node.operand, False)]
        elif isinstance(node, ast.BinOp) and not ready:
            todo += [(node, True), (node.right, False), (node.left, False)]
        elif isinstance(node, ast.UnaryOp):
            values.append(UNARY[type(node.op)](values.pop()))
        elif isinstance(node, ast.BinOp):
            right, left = values.pop(), values.pop()
            values.append(_power(left, right) if isinstance(node.op, ast.Pow) else BINARY[type(node.op)](left, right))
        else:
            raise ValueError("no arithmetic")
    return values.pop()


def _arithmetic(text):
    """Number of a plain arithmetic text of any length, None for anything else or beyond a double."""
    if text is None:
        return None
    try:
        value = float(_value(ast.parse(text.strip(), mode="eval")))
    except Exception:  # noqa: BLE001
        return None
    return value if math.isfinite(value) else None


def _numbers(texts: pa.Array) -> np.ndarray:
    """Numbers of arithmetic texts, NaN for others; a text that repeats in the batch is read once."""
    coded = texts.dictionary_encode()
    values = [math.nan if v is None else v for v in map(_arithmetic, coded.dictionary.to_pylist())]
    return np.array(values, float)[coded.indices.to_numpy(zero_copy_only=False)]


@F.arrow_udf(T.BooleanType())
def same_value(left: pa.Array, right: pa.Array) -> pa.Array:
    """Whether two arithmetic texts have the same value; NULL where either is none."""
    asked = left.is_valid().to_numpy(zero_copy_only=False) & right.is_valid().to_numpy(zero_copy_only=False)
    places = np.flatnonzero(asked)
    same, none = np.zeros(len(left), bool), np.ones(len(left), bool)
    if len(places):
        a, b = (_numbers(side.take(pa.array(places))) for side in (left, right))
        same[places], none[places] = np.abs(a - b) < VALUE_TOLERANCE, np.isnan(a) | np.isnan(b)
    return pa.array(same, mask=none)


# Kept in its projection: filters on the outcome must not pull the call down.
same_value = same_value.asNondeterministic()
