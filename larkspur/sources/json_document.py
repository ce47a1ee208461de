"""One JSON document of any size: read by many tasks, written in parts by many tasks.

The form is an envelope with nested arrays of objects, such as documents with pages. What is
wanted are the objects of the innermost array, each with the fields of the objects around it.

Reading. A file is read in splits by Spark's text source, with the closing brace as the line
end, so that a document on a single line is split too (parts of a document, by line breaks). Brackets count only outside strings,
and whether a split starts inside of one takes the whole file before it to tell; so a split is
first followed from both states. That gives its end state, the brackets it closes and those it
leaves open. Window functions over one small row per split put these together: how each split
starts, how deep, and where the brackets around it were opened. Then the splits are read again
and cut. An object within a split leaves its task whole; pieces of objects that run over splits
meet by the place where the object starts. The text between objects is the skeleton of the one
around them, and is parsed with an empty array in their place.

Writing. Rows are range partitioned in order and written as text parts, brackets and
commas between them; all parts in the order of their names are one JSON text.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larkspur.functions.text import BOM
from larkspur.operators.bounds import checked_small, local_copy, quoted
from larkspur.session import durable, stored
from larkspur.sources.records import with_start_bit

SPLIT = ["document", "part", "block"]
BREAK = "}"

_REST = re.compile(r'(?:[^"\\]++|\\.)*+"', re.S)
_TOKEN = re.compile(r'"(?:[^"\\]++|\\.)*+"|["{}\[\]]', re.S)
_FILLER = re.compile(r"[\s,]*")
#: The end of a skeleton's text that has opened the array of a name.
_OPENS = r'"((?:[^"\\]|\\.)*)"\s*:\s*\[\s*$'

Batches = Iterator[pa.RecordBatch]


def brackets(text: str, in_string: bool) -> tuple[list[tuple[int, str]], bool]:
    """(place, character) of the brackets outside strings, and whether the text ends inside a string."""
    at = 0
    if in_string:
        rest = _REST.match(text)
        if not rest:
            return [], True
        at = rest.end()
    found = []
    for token in _TOKEN.finditer(text, at):
        mark = token.group()
        if mark == '"':
            return found, True
        if mark[0] != '"':
            found.append((token.start(), mark))
    return found, False


class Side:
    """A split followed from one assumed state: what it closes of before, and leaves open."""

    def __init__(self, in_string: bool):
        self.in_string, self.closed = in_string, 0
        self.left: list[tuple[int, int, str]] = []

    def take(self, line: int, text: str) -> None:
        found, self.in_string = brackets(text, self.in_string)
        for place, mark in found:
            if mark in "{[":
                self.left.append((line, place, mark))
            elif self.left:
                self.left.pop()
            else:
                self.closed += 1


def _lines(batches: Batches) -> Iterator[tuple[tuple, int, str, pa.RecordBatch, int]]:
    """(split, line, text, batch, row) of every line."""
    for batch in batches:
        keys = zip(*[batch.column(c).to_pylist() for c in SPLIT])
        for row, (key, line, text) in enumerate(zip(keys, batch.column("line").to_pylist(), batch.column("value").to_pylist())):
            yield key, line, text, batch, row


_LEFT = "array<struct<line: bigint, place: bigint, mark: string>>"
_OUTCOME = f"document string, part string, block long, end0 boolean, closed0 long, left0 {_LEFT}, end1 boolean, closed1 long, left1 {_LEFT}"


def _outcomes(batches: Batches) -> Batches:
    found: dict[tuple, tuple[Side, Side]] = {}
    for key, line, text, _, _ in _lines(batches):
        for side in found.setdefault(key, (Side(False), Side(True))):
            side.take(line, text)
    left = pa.list_(pa.struct([("line", pa.int64()), ("place", pa.int64()), ("mark", pa.string())]))
    types = [pa.string(), pa.string(), pa.int64(), *[pa.bool_(), pa.int64(), left] * 2]
    rows = [(*key, *[v for side in sides for v in (side.in_string, side.closed, side.left)]) for key, sides in found.items()]
    names = [*SPLIT, *[f"{n}{i}" for i in (0, 1) for n in ("end", "closed", "left")]]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def place_key(part: str, block: int, line: int, place: int) -> str:
    """A place as a text that sorts as places do."""
    return f"{part}|{block:019d}|{line:019d}|{place:010d}"


def _place_key(part: Column, block: Column, line: Column, place: Column) -> Column:
    return F.concat_ws("|", part, *[F.lpad(c.cast("string"), n, "0") for c, n in ((block, 19), (line, 19), (place, 10))])


def split_states(lines: DataFrame, levels: int) -> DataFrame:
    """Per split: ``opened`` (it starts inside a string), ``depth``, and ``around``: places and marks of the outer ``2 * levels + 1`` brackets."""
    known = with_start_bit(durable(lines.mapInArrow(_outcomes, _OUTCOME)), ["document"], ["part", "block"])
    chosen = [F.when(F.col("opened"), F.col(f"{n}1")).otherwise(F.col(f"{n}0")).alias(n) for n in ("closed", "left")]
    before = Window.partitionBy("document").orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)
    deep = known.select(*SPLIT, "opened", *chosen)
    deep = deep.withColumn("depth", F.coalesce(F.sum(F.size("left") - F.col("closed")).over(before), F.lit(0)))
    around = []
    for level in range(1, 2 * levels + 2):
        at = F.lit(level) - (F.col("depth") - F.col("closed"))  # which of those left open is at this level
        here = F.get("left", (at - 1).cast("int"))
        own = F.struct(_place_key(F.col("part"), F.col("block"), here["line"], here["place"]).alias("key"), here["mark"].alias("mark"))
        has = (at >= 1) & (at <= F.size("left"))
        around.append(F.when(F.col("depth") >= level, F.last(F.when(has, own), ignorenulls=True).over(before)))
    return deep.select(*SPLIT, "opened", "depth", F.array(*around).alias("around"))


_PIECE = "document string, level int, keys array<string>, place string, text string, whole boolean"


def _cut(levels: int):
    """Objects of the innermost array, and the skeletons around them, as pieces per split."""
    last = 2 * levels + 1

    def level_of(marks: list[str]) -> int:
        level = 0
        while level < levels and marks[2 * level : 2 * level + 3] == ["{", "[", "{"]:
            level += 1
        return level

    def run(batches: Batches) -> Batches:
        rows: list[tuple] = []
        split, opened, depth = None, False, 0
        marks: list[str] = []  # of the outer brackets around, and where they were opened
        keys: list[str] = []
        level, held, at = 0, [], ""  # the piece at hand
        begun = inside = False  # whether it starts with its object, and lies within the document

        def close(whole: bool) -> None:
            text = "".join(held)
            if inside and (level == levels or not _FILLER.fullmatch(text)):
                rows.append((split[0], level, keys[2 : 2 * level + 1 : 2], at, text, whole))
            held.clear()

        def emitted() -> pa.RecordBatch:
            types = [pa.string(), pa.int32(), pa.list_(pa.string()), pa.string(), pa.string(), pa.bool_()]
            names = ["document", "level", "keys", "place", "text", "whole"]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
            rows.clear()
            return batch

        for key, line, text, batch, row in _lines(batches):
            if key != split:
                if held:
                    close(False)
                split = key
                opened, depth = batch.column("opened")[row].as_py(), batch.column("depth")[row].as_py()
                around = [a for a in batch.column("around")[row].as_py() if a is not None]
                marks, keys = [a["mark"] for a in around], [a["key"] for a in around]
                level, at, begun, inside = level_of(marks), place_key(key[1], key[2], line, 0), False, depth > 0
            start = 0
            found, opened = brackets(text, opened)
            for place, mark in found:
                if mark in "{[":
                    depth += 1
                    if depth > last:
                        continue
                    here = place_key(key[1], key[2], line, place)
                    marks.append(mark)
                    keys.append(here)
                    now = level_of(marks)
                    if now > level or not inside:
                        held.append(text[start:place])
                        close(False)  # by its level, the piece before has the keys of the object around
                        level, start, at, begun, inside = now, place, here, True, True
                    continue
                depth -= 1
                if depth >= last or not marks:
                    continue
                marks.pop()
                now = level_of(marks)
                if now < level or not marks:
                    held.append(text[start : place + 1])
                    close(begun and level == levels)
                    level, start, begun, inside = now, place + 1, False, bool(marks)
                    at = place_key(key[1], key[2], line, place + 1)
                keys.pop()
            held.append(text[start:])
            if len(rows) >= 2000:
                yield emitted()
        if held:
            close(False)
        if rows:
            yield emitted()

    return run


def read_document(spark: SparkSession, path: str, arrays: list[str], schemas: list[str], in_parts: bool = False) -> DataFrame:
    """The objects of the innermost of the nested ``arrays``, with those around them.

    ``schemas`` has one schema for the envelope and one for the objects of each array; the
    result has a struct for each: ``r0`` for the envelope up to ``rN``, and the document's path.
    Every file is one document, or with ``in_parts`` the files of a folder in the order of
    their names. Objects of arrays of other names are left out, and so are missing fields.
    A text that is no JSON object is an error.
    """
    levels = len(arrays)
    name = F.col("_metadata.file_path")
    ending = "\n" if in_parts else BREAK
    lines = spark.read.option("lineSep", ending).text(path).select(
        (F.regexp_replace(name, "/[^/]*$", "") if in_parts else name).alias("document"),
        (F.regexp_extract(name, "([^/]*)$", 1) if in_parts else F.lit("")).alias("part"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        # The end is put back, also where the last line has none: after the document it counts for nothing.
        F.concat(F.replace("value", F.lit(BOM), F.lit("")), F.lit(ending)).alias("value"),
    )
    states = durable(split_states(lines, levels))
    small = local_copy(states)
    if small is not None:
        told = lines.join(F.broadcast(small), SPLIT)  # keeps the order of the scan
    else:
        told = lines.join(states, SPLIT).repartition(*SPLIT).sortWithinPartitions(*SPLIT, "line")
    pieces = told.select(*SPLIT, "line", "value", "opened", "depth", "around").mapInArrow(_cut(levels), _PIECE)
    pieces = stored(pieces, "json-pieces")  # every level reads them

    whole = pieces.where((F.col("level") == levels) & F.col("whole")).select("document", "keys", "text")
    apart = pieces.where((F.col("level") == levels) & ~F.col("whole")).groupBy("document", "keys").agg(_in_order().alias("runs"))
    found = whole.unionByName(apart.select("document", "keys", _text("runs").alias("text")))
    found = found.select("document", "keys", _parsed("text", schemas[levels]).alias(f"r{levels}"))
    for level in range(levels - 1, -1, -1):
        around = pieces.where(F.col("level") == level).groupBy("document", "keys").agg(_in_order().alias("runs"))
        around = around.select("document", F.col("keys").alias("outer"), "runs", _parsed(_text("runs"), schemas[level]).alias(f"r{level}"))
        within = found.withColumn("outer", F.slice("keys", 1, level)).withColumn("at", F.element_at("keys", level + 1))
        joined = within.join(checked_small(around), ["document", "outer"])
        upto = F.array_join(F.transform(F.filter("runs", lambda r: r["place"] < F.col("at")), lambda r: r["text"]), "")
        named = F.from_json(F.concat(F.lit('{"n":"'), F.regexp_extract(upto, _OPENS, 1), F.lit('"}')), "n string")["n"]
        found = joined.where(named == arrays[level]).select("document", "keys", *[c for c in found.columns if c.startswith("r")], f"r{level}")
    return found.select("document", *[f"r{i}" for i in range(levels + 1)])


def _in_order() -> Column:
    return F.array_sort(F.collect_list(F.struct("place", "text")))


def _text(runs: str) -> Column:
    return F.array_join(F.transform(runs, lambda r: r["text"]), "")


def _parsed(text: str | Column, schema: str) -> Column:
    return F.from_json(text, schema, {"mode": "FAILFAST"})


def _object(fields: list[Column]) -> Column:
    """An object's text without its closing brace, and with a comma if it has fields."""
    body = F.regexp_replace(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), r"\}$", "") if fields else F.lit("{")
    return F.concat(body, F.lit(", ")) if fields else body


def write_document(
    rows: DataFrame, path: str, arrays: list[str], envelope: list[Column], order: list[str], outer: list[str] | None = None,
    outer_fields: DataFrame | None = None,
) -> None:
    """Write rows as the objects of one document, in parts that follow each other by name.

    With one array the rows are its objects, in the order of the columns ``order``, which must
    tell them apart. With two, the objects of the outer one are told apart by the columns
    ``outer`` (the first of ``order``), which are written there and not in the rows, with the
    further fields of ``outer_fields``. ``envelope`` are literal columns.
    """
    outer = outer or []
    keys = [quoted(c) for c in order]
    inner = F.to_json(F.struct(*[quoted(c) for c in rows.columns if c not in outer]), {"ignoreNullFields": "false"})
    spark = rows.sparkSession
    opening, closing = F.concat(_object(envelope), F.lit(f'"{arrays[0]}": [')), F.lit("]}")
    first = rows.agg(F.min(F.struct(*keys)).alias("first")).first()["first"]
    texts = rows.select(*keys, inner.alias("text"))
    is_first = F.lit(first is not None)
    for c in order if first is not None else []:
        is_first = is_first & quoted(c).eqNullSafe(F.lit(first[c]))
    if outer:
        groups = [quoted(c) for c in outer]
        ends = rows.groupBy(*groups).agg(F.min(F.struct(*keys)).alias("from"), F.max(F.struct(*keys)).alias("upto"))
        more = [c for c in outer_fields.columns if c not in outer] if outer_fields is not None else []
        described = ends.join(outer_fields, outer, "left") if outer_fields is not None else ends
        title = F.concat(_object([*groups, *[quoted(c) for c in more]]), F.lit(f'"{arrays[1]}": ['))
        described = described.select(*groups, "from", "upto", title.alias("title"))
        texts = texts.join(checked_small(described), outer)
        begins, ends_here = F.struct(*keys) == F.col("from"), F.struct(*keys) == F.col("upto")
        text = F.concat(
            F.when(is_first, "").otherwise(","), F.when(begins, F.col("title")).otherwise(""), F.col("text"), F.when(ends_here, "]}").otherwise("")
        )
    else:
        text = F.concat(F.when(is_first, "").otherwise(","), F.col("text"))
    body = texts.select(F.lit(1).alias("kind"), F.struct(*keys).alias("key"), text.alias("value"))
    bare = spark.range(1).select(
        F.explode(F.array(F.struct(F.lit(0).alias("kind"), opening.alias("value")), F.struct(F.lit(2).alias("kind"), closing.alias("value")))).alias("e")
    ).select("e.kind", F.lit(None).cast(body.schema["key"].dataType).alias("key"), "e.value")
    body.unionByName(bare).orderBy("kind", "key").select("value").write.mode("overwrite").text(path)


# Task functions of this module travel with the job, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
