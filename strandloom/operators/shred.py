"""Columnar shredding of deeply nested JSON with repetition and definition levels.

``shred`` turns whole records into column chunks. A leaf path such as ``data[].positions[].sstart`` has one entry for every
place where the value could stand, with two numbers: the repetition level says which repeated step of the path began anew
(0: a new record), the definition level how many optional steps of the path are there. ``assemble`` rebuilds a flat table for
any repeated ancestor from these sequences alone, and never looks at the JSON again.

Levels: a repeated step counts two definitions (the slot exists; its element isn't null), any other step one. Every repeated
step has a place column, written ``path[].#``, whose value is the 0-based place of the element.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = T.StructType([
    T.StructField("keys", T.ArrayType(T.LongType())),
    T.StructField("columns", T.ArrayType(T.StructType([
        T.StructField("path", T.StringType()),
        T.StructField("reps", T.BinaryType()),
        T.StructField("defs", T.BinaryType()),
        T.StructField("vals", T.ArrayType(T.StringType())),
    ]))),
])
CHUNK_ARROW = pa.schema([
    ("keys", pa.list_(pa.int64())),
    ("columns", pa.list_(pa.struct([("path", pa.string()), ("reps", pa.binary()), ("defs", pa.binary()), ("vals", pa.list_(pa.string()))]))),
])


class Placed(list):
    """Elements with places of their own, from an object whose keys are places."""

    def __init__(self, pairs):
        super().__init__(v for _, v in pairs)
        self.places = [k for k, _ in pairs]


def latest(df: DataFrame, key: str, order: str, payload: str, also: Sequence[str] = ()) -> DataFrame:
    """The payload, and the columns ``also``, of the row of the latest ``order`` for each key; exact copies are one.

    Rows with a NULL key are left out. A NULL ``order`` comes before any other; between different payloads of one time the
    greater string wins, NULL being the least, then the greater of ``also``. The aggregate combines on the map side, so copies
    of a hot key don't travel.
    """
    best = F.max(F.struct(F.col(order).isNotNull().alias("a"), F.col(order).alias("b"), F.col(payload).isNotNull().alias("c"), F.col(payload).alias("d"), *[F.col(c).alias(f"e{i}") for i, c in enumerate(also)]))
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(best.alias("__best")).select(key, F.col("__best.d").alias(payload), *[F.col(f"__best.e{i}").alias(c) for i, c in enumerate(also)])


def _refuse(token: str):
    raise ValueError(token)


class Digits:
    """An integer of more digits than Python reads, as it is written."""

    def __init__(self, text: str):
        self.text = text


def _integer(digits: str):
    return int(digits) if len(digits) < 4000 else Digits(digits)


def parse(text):
    """The JSON value of a text, through strings that hold JSON; None where it is no complete JSON."""
    try:
        while isinstance(text, str):
            text = json.loads(text, parse_constant=_refuse, parse_int=_integer)
    except (ValueError, RecursionError):
        return None
    return text


def _elements(value):
    """A repeated group from any of its shapes: list, single object, object keyed by places, or a string of JSON.

    Places have up to 18 digits, as a bigint holds; an object with longer keys is a single object.
    """
    if isinstance(value, str):
        value = parse(value)
    if isinstance(value, dict):
        if not value:
            return None
        if all(k.isascii() and k.isdigit() and len(k) <= 18 for k in value):
            by_place = {int(k): v for k, v in value.items()}  # of "1" and "01" the last counts
            return Placed([(k, by_place[k]) for k in sorted(by_place)])
        return [value]
    return value if isinstance(value, list) and value else None


def _text(value) -> str:
    if isinstance(value, str):
        return value.encode("utf-8", "replace").decode() if not value.isascii() else value
    if value is True or value is False:
        return "true" if value else "false"
    return value.text if isinstance(value, Digits) else repr(value)


def normalise(value, groups: Sequence[str], wrappers: Sequence[str]):
    """The record as an object whose paths in ``groups`` are lists; None where the record is no object.

    A first step of ``groups`` that is absent at the top is looked for in the objects named by ``wrappers``.
    """
    if not isinstance(value, dict):
        return None
    value = dict(value)
    for path in groups:
        if path.count(".") == 0 and value.get(path) is None:
            for wrapper in wrappers:
                inner = value.get(wrapper)
                if isinstance(inner, dict) and inner.get(path) is not None:
                    value[path] = inner[path]
                    value[wrapper] = {k: v for k, v in inner.items() if k != path}
                    break

    def fix(node, steps):
        if not isinstance(node, dict) or steps[0] not in node:
            return node
        node = dict(node)
        if len(steps) == 1:
            node[steps[0]] = _elements(node[steps[0]])
        elif isinstance(inner := node[steps[0]], list):
            fixed = [fix(x, steps[1:]) for x in inner]
            if isinstance(inner, Placed):
                fixed = Placed(list(zip(inner.places, fixed, strict=True)))
            node[steps[0]] = fixed
        return node

    for path in sorted(groups, key=lambda p: p.count(".")):
        value = fix(value, path.split("."))
    return value


def _grow(schema: dict, node: dict) -> None:
    """Add the fields of an object to a schema: name -> {'obj': schema, 'rep': element schema, 'leaf': True}."""
    for name, value in node.items():
        kinds = schema.setdefault(name, {})
        _grow_value(kinds, value)


def _grow_value(kinds: dict, value) -> None:
    if isinstance(value, dict):
        _grow(kinds.setdefault("obj", {}), value)
    elif isinstance(value, list):
        inner = kinds.setdefault("rep", {})
        for x in value:
            _grow_value(inner, x)
    elif value is not None:
        kinds["leaf"] = True


def stripe(records: Sequence[dict | None], wanted: set[str] | None = None) -> dict[str, tuple[list, list, list]]:
    """Columns of a chunk of normalised records: path -> (repetition levels, definition levels, values)."""
    schema: dict = {}
    for r in records:
        if r is not None:
            _grow(schema, r)
    out: dict[str, tuple[list, list, list]] = {}

    def writer(kinds: dict, path: str, depth: int, level: int):
        """A function that writes a value (None: absent) of these kinds; depth: repeated steps so far, level: definitions so far."""
        parts = []
        if kinds.get("leaf") and (wanted is None or path in wanted):
            reps, defs, vals = out.setdefault(path, ([], [], []))

            def leaf(value, rep, reached):
                there = value is not None and not isinstance(value, dict | list)
                reps.append(rep)
                defs.append(level + 1 if there else reached)
                vals.append(_text(value) if there else None)

            parts.append(leaf)
        if "obj" in kinds:
            fields = [(n, w) for n, k in kinds["obj"].items() if (w := writer(k, f"{path}.{n}" if path else n, depth, level + 1))]

            def group(value, rep, reached):
                if isinstance(value, dict):
                    for n, w in fields:
                        w(value.get(n), rep, level + 1)
                else:
                    for _, w in fields:
                        w(None, rep, reached)

            if fields:
                parts.append(group)
        if "rep" in kinds:
            inner = writer(kinds["rep"], f"{path}[]", depth + 1, level + 1)
            place = out.setdefault(f"{path}[].#", ([], [], [])) if wanted is None or f"{path}[].#" in wanted else None

            def repeated(value, rep, reached):
                if not isinstance(value, list) or not value:
                    if place:
                        place[0].append(rep)
                        place[1].append(reached)
                        place[2].append(None)
                    if inner:
                        inner(None, rep, reached)
                    return
                places = value.places if isinstance(value, Placed) else range(len(value))
                for at, x in zip(places, value, strict=True):
                    if place:
                        place[0].append(rep)
                        place[1].append(level + 1 if x is None else level + 2 if isinstance(x, dict) else level + 3)
                        place[2].append(str(at))
                    if inner:
                        inner(x, rep, level + 1)
                    rep = depth + 1

            if place or inner:
                parts.append(repeated)
        if not parts:
            return None
        if len(parts) == 1:
            return parts[0]

        def several(value, rep, reached):
            for p in parts:
                p(value, rep, reached)

        return several

    writers = [(n, w) for n, k in schema.items() if (w := writer(k, n, 0, 0))]
    for r in records:
        for n, w in writers:
            w(r.get(n) if r is not None else None, 0, 0)
    return out


def shred(df: DataFrame, key: str, payload: str, groups: Sequence[str] = (), wrappers: Sequence[str] = (), columns: Sequence[str] | None = None, chunk: int = 256) -> DataFrame:
    """Column chunks of the JSON texts in ``payload``, up to ``chunk`` records in each; a map over partitions, no shuffle.

    ``groups`` names repeated groups that may come in several shapes (see ``_elements``), ``wrappers`` objects that may hold
    the first of them. ``columns`` prunes to these paths. A text that is NULL, blank, cut off or no object gives a record of
    which nothing is defined. Whole texts are read however long they are, one record at a time.
    """
    wanted = None if columns is None else set(columns)
    groups, wrappers = tuple(groups), tuple(wrappers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                part = batch.slice(at, chunk)
                keys, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                found = stripe([normalise(parse(t), groups, wrappers) for t in texts], wanted)
                yield pa.RecordBatch.from_pylist([{
                    "keys": keys,
                    "columns": [{"path": p, "reps": bytes(r), "defs": bytes(d), "vals": v} for p, (r, d, v) in found.items()],
                }], schema=CHUNK_ARROW)

    return df.select(F.col(key).cast("bigint"), F.col(payload)).mapInArrow(run, CHUNK)


def _levels(column: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(column["reps"], np.uint8), np.frombuffer(column["defs"], np.uint8)


def _depth(path: str) -> int:
    return path.count("[]")


def _definitions(path: str) -> int:
    """The definition level at which the element of a repeated ancestor (a path that ends in ``[]``) is not null."""
    return sum(1 + step.endswith("[]") for step in path.split("."))


def _ancestors(path: str) -> list[str]:
    steps = path.split(".")
    return [".".join(steps[: i + 1]) for i, s in enumerate(steps) if s.endswith("[]")]


def assemble(chunks: DataFrame, key: str, ancestor: str, fields: Mapping[str, str] | None = None, places: Sequence[str] | None = None) -> DataFrame:
    """The flat table of a repeated ancestor (``data[]``, ``data[].positions[]``, ...): one row for each element that is an object.

    Columns: the record's key, the place in each repeated step (``places`` names them), and the scalar fields named in ``fields``
    (name below the ancestor -> Spark type; a value that doesn't fit its type gives NULL). Parents are found by counting in
    the level sequences: an entry of the ancestor whose repetition level is at most the parent's depth begins a new parent.
    """
    up = _ancestors(ancestor)
    fields = dict(fields or {})
    names = list(places or [f"ix{i}" for i in range(len(up))])
    depth, full = _depth(ancestor), _definitions(ancestor)
    arrow = pa.schema([(key, pa.int64()), *[(n, pa.int64()) for n in names], *[(f, pa.string()) for f in fields]])

    def run(batches):
        for batch in batches:
            for chunk in batch.to_pylist():
                by = {c["path"]: c for c in chunk["columns"]}
                own = by.get(f"{ancestor}.#")
                if own is None:
                    continue
                reps, defs = _levels(own)
                rows = np.flatnonzero(defs == full)
                at = [np.array([-1 if v is None else int(v) for v in own["vals"]], np.int64)[rows]]
                entry, above = rows, reps
                for parent in reversed(up[:-1]):
                    entry = (np.cumsum(above <= _depth(parent)) - 1)[entry]
                    column = by[f"{parent}.#"]
                    above = _levels(column)[0]
                    at.insert(0, np.array([-1 if v is None else int(v) for v in column["vals"]], np.int64)[entry])
                record = (np.cumsum(above == 0) - 1)[entry]
                out = [pa.array(np.asarray(chunk["keys"], np.int64)[record]), *map(pa.array, at)]
                instance = np.flatnonzero(np.ones(len(reps), bool))
                for f in fields:
                    column = by.get(f"{ancestor}.{f}")
                    if column is None:
                        out.append(pa.nulls(len(rows), pa.string()))
                        continue
                    first = np.flatnonzero(_levels(column)[0] <= depth)
                    vals = column["vals"]
                    out.append(pa.array([vals[first[i]] for i in instance[rows]], pa.string()))
                yield pa.RecordBatch.from_arrays(out, schema=arrow)

    schema = T.StructType([T.StructField(key, T.LongType()), *[T.StructField(n, T.LongType()) for n in names], *[T.StructField(f, T.StringType()) for f in fields]])
    flat = chunks.mapInArrow(run, schema)
    return flat.select(key, *names, *[F.expr(f"try_cast(`{f}` as {kind})").alias(f) for f, kind in fields.items()])


def assemble_values(chunks: DataFrame, key: str, ancestor: str, arrays: Sequence[str], places: Sequence[str] | None = None) -> DataFrame:
    """The values of little arrays below a repeated ancestor: key, places, field, value_ix, value (as text).

    A null element keeps its place and gives no row.
    """
    up = _ancestors(ancestor)
    names = list(places or [f"ix{i}" for i in range(len(up))])
    depth = _depth(ancestor)
    arrow = pa.schema([(key, pa.int64()), *[(n, pa.int64()) for n in names], ("field", pa.string()), ("value_ix", pa.int64()), ("value", pa.string())])

    def run(batches):
        for batch in batches:
            for chunk in batch.to_pylist():
                by = {c["path"]: c for c in chunk["columns"]}
                for f in arrays:
                    path = f"{ancestor}.{f}[]"
                    column, own = by.get(path), by.get(f"{path}.#")
                    if column is None or own is None:
                        continue
                    reps, _ = _levels(own)
                    vals = column["vals"]
                    rows = np.array([i for i, v in enumerate(vals) if v is not None], np.int64)
                    if not len(rows):
                        continue
                    at = [np.array([-1 if v is None else int(v) for v in own["vals"]], np.int64)[rows]]
                    entry = (np.cumsum(reps <= depth) - 1)[rows]
                    for i, parent in enumerate(reversed(up)):
                        column = by[f"{parent}.#"]
                        at.insert(0, np.array([-1 if v is None else int(v) for v in column["vals"]], np.int64)[entry])
                        entry = (np.cumsum(_levels(column)[0] <= depth - 1 - i) - 1)[entry]
                    keys = pa.array(np.asarray(chunk["keys"], np.int64)[entry])
                    yield pa.RecordBatch.from_arrays([keys, *map(pa.array, at[:-1]), pa.array([f] * len(rows)), pa.array(at[-1]), pa.array([vals[i] for i in rows])], schema=arrow)

    schema = T.StructType([T.StructField(key, T.LongType()), *[T.StructField(n, T.LongType()) for n in names], T.StructField("field", T.StringType()), T.StructField("value_ix", T.LongType()), T.StructField("value", T.StringType())])
    return chunks.mapInArrow(run, schema)
