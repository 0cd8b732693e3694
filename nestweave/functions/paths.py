"""Paths into documents of any depth, compiled to nested higher-order functions.

``departments[].teams{}.members[].memberId`` names the field ``memberId`` of every struct in the array
``members`` of every value of the map ``teams`` of every element of the array ``departments``. A name goes on
with ``[]`` if it is an array, with ``{}`` if it is a map, and with neither if it is a struct. A name with other
characters than letters, digits and ``_`` stands in backquotes. Everything becomes ``transform``, ``transform_values`` and
``withField``: no explode, no shuffle, no Python in the executors.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from nestweave.functions.nested import column

_STEP = re.compile(r"(?:`((?:[^`]|``)+)`|(\w+))(\[\]|\{\})?(\.|$)")


@dataclass(frozen=True)
class Step:
    """A field, and what it holds: ``[]`` an array, ``{}`` a map, or a single value."""

    name: str
    kind: str = ""


def parse_path(path: str) -> tuple[Step, ...]:
    steps, at = [], 0
    while at < len(path):
        found = _STEP.match(path, at)
        if not found:
            raise ValueError(f"{path!r} can't be read from {path[at:]!r} on")
        steps.append(Step(found[1].replace("``", "`") if found[1] else found[2], found[3] or ""))
        at = found.end()
    if not steps or path.endswith("."):
        raise ValueError(f"{path!r} ends in no field")
    return tuple(steps)


def _inside(step: Step, value: Column) -> Column:
    """The elements of an array or the values of a map; of a single value an array of it."""
    if step.kind == "{}":
        return F.map_values(value)
    return value if step.kind == "[]" else F.array(value)


def values_at(path: str) -> Column:
    """All values at ``path`` of a row in one array, in order, nulls among them; never null.

    What is below a null array, map or struct is left out.
    """
    steps = parse_path(path)

    def below(value: Column, rest: tuple[Step, ...]) -> Column:
        """An array of the values at ``rest`` below ``value``, a struct."""
        head, *tail = rest
        own = value.getField(head.name)
        if not tail:
            return _inside(head, own)
        deeper = F.transform(_inside(head, own), lambda x: F.when(x.isNotNull(), below(x, tuple(tail))))
        return F.flatten(F.filter(deeper, lambda x: x.isNotNull()))

    first, *rest = steps
    top = column(first.name)
    if not rest:
        return F.coalesce(_inside(first, top), F.array())
    every = F.transform(_inside(first, top), lambda x: F.when(x.isNotNull(), below(x, tuple(rest))))
    return F.coalesce(F.flatten(F.filter(every, lambda x: x.isNotNull())), F.array())


def with_value(path: str, key_path: str, value: Callable[[Column], Column]) -> tuple[str, Column]:
    """(name, column) of the top-level column of ``path`` with ``value(key)`` set at the end of ``path``.

    The key is what ``key_path`` names; but for its last field it must be a beginning of ``path``, so that one
    key stands above everything that its value is written to, and it is computed once there. Nulls, empty arrays and
    maps stay as they are, and so do other fields.
    """
    steps, keys = parse_path(path), parse_path(key_path)
    if keys[:-1] != steps[: len(keys) - 1] or len(steps) < len(keys) or keys[-1].kind or steps[-1].kind:
        raise ValueError(f"{key_path!r} must name a field of a struct on the way to {path!r}")
    if len(keys) < 2:
        raise ValueError(f"{key_path!r} must be inside an array, a map or a struct")

    def changed(step: Step, own: Column, write: Callable[[Column], Column]) -> Column:
        """``own`` with ``write`` applied to the structs that it holds."""
        if step.kind == "[]":
            return F.transform(own, lambda x: F.when(x.isNotNull(), write(x)))
        if step.kind == "{}":
            return F.transform_values(own, lambda _, x: F.when(x.isNotNull(), write(x)))
        return F.when(own.isNotNull(), write(own))

    def inside(struct: Column, depth: int, found: Column | None) -> Column:
        """``struct``, which the steps before ``depth`` lead to, with the value set below."""
        if found is None and depth == len(keys) - 1:
            # The value is looked up once, however many structs below receive it.
            looked_up = value(struct.getField(keys[-1].name))
            return F.get(F.transform(F.array(F.struct(looked_up.alias("value"))), lambda x: inside(struct, depth, x["value"])), F.lit(0))
        step = steps[depth]
        if depth == len(steps) - 1:
            return struct.withField(_quoted(step.name), found)
        own = struct.getField(step.name)
        return struct.withField(_quoted(step.name), changed(step, own, lambda x: inside(x, depth + 1, found)))

    first = steps[0]
    return first.name, changed(first, column(first.name), lambda x: inside(x, 1, None))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
