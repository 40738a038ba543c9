"""Nested payload records as flat tables: a parent, and a child for every array at any depth."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from landfall.sinks.layer import write_layer

KEY = "row_key"
PARENT = "parent_key"
POSITION = "position"
VALUE = "value"


@dataclass(frozen=True)
class Node:
    """One table of the tree: its columns as paths into the record, and the arrays that become its children."""

    name: str
    kind: T.DataType
    columns: tuple[tuple[str, tuple[str, ...]], ...]
    flags: tuple[tuple[str, tuple[str, ...]], ...]
    children: tuple[tuple[str, tuple[str, ...], Node], ...] = field(default=())


def tree(record: T.DataType, name: str = "root") -> Node:
    """How a record type falls into tables.

    Structs are flattened into their parent, their fields named ``outer_inner``, with ``outer_present`` to tell a null struct
    from one of nulls. An array becomes a child table ``name_array``, and a column ``array_count`` of its parent, which
    is null for a null array. An array of anything but structs has a child with one column ``value``; an array of
    arrays a child with its own child. Raises ``ValueError`` if two columns get one name.
    """
    columns, flags, children = [], [], []

    def walk(fields: list[T.StructField], path: tuple[str, ...]) -> None:
        for f in fields:
            at = (*path, f.name)
            flat = "_".join(at)
            if isinstance(f.dataType, T.StructType):
                flags.append((f"{flat}_present", at))
                walk(f.dataType.fields, at)
            elif isinstance(f.dataType, T.ArrayType):
                children.append((f"{flat}_count", at, tree(f.dataType.elementType, f"{name}_{flat}")))
            else:
                columns.append((flat, at))

    if isinstance(record, T.StructType):
        flags.append(("present", ()))
        walk(record.fields, ())
    elif isinstance(record, T.ArrayType):
        children.append((f"{VALUE}_count", (), tree(record.elementType, f"{name}_{VALUE}")))
    else:
        columns.append((VALUE, ()))
    names = [KEY, PARENT, POSITION, *(n for n, _ in columns), *(n for n, _ in flags), *(n for n, _, _ in children)]
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"columns of {name} collide: {sorted(n for n in names if [x.lower() for x in names].count(n.lower()) > 1)}")
    return Node(name, record, tuple(columns), tuple(flags), tuple(children))


def inside(value: Column, path: tuple[str, ...]) -> Column:
    for step in path:
        value = value.getField(step)
    return value


def flatten(parsed: DataFrame, column: str, work: str) -> dict[str, DataFrame]:
    """The tables of an array-of-structs column ``column``, by name; the other columns stay with the root.

    A root row is one array element, with a ``row_key`` and its ``position``; other tables have their parent's key as
    ``parent_key``, the ``position`` in its array, and a key of their own: the parent's and the positions on the way, as
    text. Rows of ``parsed`` whose array is null or empty have no row. A null element is a row of nulls, ``present`` false.

    Keys are given once, in a copy of the records below ``work`` that all tables are read from, so that tables written one by
    one agree even if tasks run again. Each table is one pass over the columns it needs, without a shuffle.
    """
    node = tree(parsed.schema[column].dataType.elementType)
    rest = [c for c in parsed.columns if c != column]
    taken = {n.lower() for n, _ in (*node.columns, *node.flags)} | {n.lower() for n, _, _ in node.children} | {KEY, POSITION, "record"}
    if clash := [c for c in rest if c.lower() in taken]:
        raise ValueError(f"columns of the payload's row are named as those of its records: {clash}")
    numbered = parsed.select(*rest, F.monotonically_increasing_id().cast("string").alias("number"), column)
    exploded = numbered.select(*rest, "number", F.posexplode(column).alias(POSITION, "record"))
    keyed = exploded.select(F.concat_ws(".", "number", POSITION).alias(KEY), POSITION, *rest, "record")
    write_layer(keyed, f"{work}/records")
    staged = parsed.sparkSession.read.schema(keyed.schema).parquet(f"{work}/records")
    tables = {node.name: _columns(staged, node, [KEY, POSITION, *rest])}
    _children(staged, node, tables)
    return tables


def _columns(rows: DataFrame, node: Node, keys: list[str]) -> DataFrame:
    record = F.col("record")
    return rows.select(
        *keys,
        *[inside(record, path).isNotNull().alias(n) for n, path in node.flags],
        *[inside(record, path).alias(n) for n, path in node.columns],
        *[F.size(inside(record, path)).alias(n) for n, path, _ in node.children],
    )


def _children(rows: DataFrame, node: Node, tables: dict[str, DataFrame]) -> None:
    for _, path, child in node.children:
        one = rows.select(F.col(KEY).alias(PARENT), F.posexplode(inside(F.col("record"), path)).alias(POSITION, "record"))
        own = one.select(F.concat_ws(".", PARENT, F.lit(path[-1] if path else VALUE), POSITION).alias(KEY), PARENT, POSITION, "record")
        tables[child.name] = _columns(own, child, [KEY, PARENT, POSITION])
        _children(own, child, tables)


def rebuild(tables: dict[str, DataFrame], record: T.DataType) -> DataFrame:
    """``(row_key, record)``: the records again, from the tables; one join per child table, on its parent's key."""
    return _rebuilt(tables, tree(record))


def _rebuilt(tables: dict[str, DataFrame], node: Node) -> DataFrame:
    rows = tables[node.name]
    built: dict[tuple[str, ...], Column] = {}
    for n, (count, path, child) in enumerate(node.children):
        below = _rebuilt(tables, child).join(tables[child.name].select(KEY, PARENT, POSITION), KEY)
        packed = F.array_sort(F.collect_list(F.struct(POSITION, F.col("record").alias("record"))))
        lists = below.groupBy(F.col(PARENT).alias(KEY)).agg(packed.alias(f"packed_{n}"))
        rows = rows.join(lists, KEY, "left")
        empty = F.lit([]).cast(T.ArrayType(child.kind))
        listed = F.transform(f"packed_{n}", lambda x: x["record"])
        built[path] = F.when(F.col(count) >= 0, F.coalesce(listed, empty))
    built |= {path: F.col(name) for name, path in node.columns}
    flags = {path: F.col(name) for name, path in node.flags}

    def value(kind: T.DataType, path: tuple[str, ...]) -> Column:
        if path in built:
            return built[path]
        fields = F.struct(*[value(f.dataType, (*path, f.name)).alias(f.name) for f in kind.fields])
        return F.when(flags[path], fields)

    return rows.select(KEY, value(node.kind, ()).alias("record"))
