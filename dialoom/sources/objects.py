"""One JSON object of any size as rows, read by as many tasks as its bytes need."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What changes the state of a scan outside of a string, and the rest of a string from inside.
MARKS = re.compile(r'["{}\[\],]')
STRING_END = re.compile(r'(?:[^"\\]|\\.)*?"', re.S)
#: Files are read in pieces that end with this, which no escape does.
PIECE = "}"
DEEPER, HIGHER = "{[", "}]"


def scanned(piece: str, inside: bool, depth: int) -> Iterator[tuple[int, str, bool, int]]:
    """(place, mark, whether inside a string after it, depth after it) for each mark of a piece outside of strings, and for the ends of strings."""
    at = 0
    while at < len(piece):
        if inside:
            end = STRING_END.match(piece, at)
            if end is None:
                return
            at, inside = end.end(), False
            yield at - 1, '"', False, depth
            continue
        found = MARKS.search(piece, at)
        if found is None:
            return
        mark, at = found[0], found.end()
        inside = mark == '"'
        depth += (mark in DEEPER) - (mark in HIGHER)
        yield found.start(), mark, inside, depth


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The pieces of a file in their order within (file, block): a block is what one task reads of a file."""
    read = spark.read.option("lineSep", PIECE).text(path)
    return read.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
    for batch in batches:
        yield from zip(batch.column("file").to_pylist(), batch.column("block").to_pylist(), batch.column("value").to_pylist(), strict=True)


def read_object(spark: SparkSession, path: str) -> DataFrame:
    """The entries of a JSON object (of each file of a path): key, value (JSON), and `place`, which grows in their order in a file.

    Blocks of the file are scanned twice. First each block says, for both ways it can begin (inside a string or not), how it
    ends and how deep; from this, a few numbers for each block, follows where each block begins. Then each block gives the entries
    that are whole in it, and what it has of those that began before or end later, which are put together from their parts.
    What is no object has no entries. A key that is there twice has two rows.
    """
    source = pieces(spark, path)

    def measure(batches):
        state: dict[tuple[str, int], list[list[int]]] = {}
        for file, block, piece in by_block(batches):
            ends = state.setdefault((file, block), [[0, 0], [1, 0]])
            for end in ends:
                inside, depth = bool(end[0]), end[1]
                for _, _, inside, depth in scanned(piece + PIECE, inside, depth):  # noqa: B007
                    pass
                end[0], end[1] = int(inside), depth
        rows = [(f, b, *x, *y) for (f, b), (x, y) in state.items()]
        names = ["file", "block", "inside_0", "depth_0", "inside_1", "depth_1"]
        yield pa.RecordBatch.from_pydict({n: [r[i] for r in rows] for i, n in enumerate(names)}, schema=pa.schema([("file", pa.string()), *((n, pa.int64()) for n in names[1:])]))

    found = source.mapInArrow(measure, "file string, block long, inside_0 long, depth_0 long, inside_1 long, depth_1 long").collect()
    begins: dict[tuple[str, int], tuple[bool, int]] = {}
    file, inside, depth = "", 0, 0
    for r in sorted(found, key=lambda r: (r.file, r.block)):
        if r.file != file:
            file, inside, depth = r.file, 0, 0
        begins[r.file, r.block] = (bool(inside), depth)
        inside, depth = (r.inside_1, depth + r.depth_1) if inside else (r.inside_0, depth + r.depth_0)
    shared = spark.sparkContext.broadcast(begins)

    def cut(batches):
        at, inside, depth, open_text, number = None, False, 0, [], 0
        out: list[tuple] = []

        def end_block() -> None:
            if at is not None:
                out.append((*at, number, "".join(open_text), number == 0, True))

        for file, block, piece in by_block(batches):
            if at != (file, block):
                end_block()
                at, open_text, number = (file, block), [], 0
                inside, depth = shared.value[file, block]
            text, start = piece + PIECE, 0
            for place, mark, inside, depth in scanned(text, inside, depth):
                opens, closes = mark in DEEPER and depth == 1, mark in HIGHER and depth == 0
                if opens or closes or mark == "," and depth == 1:  # an entry ends before this, and another begins after it
                    open_text.append(text[start:place])
                    out.append((file, block, number, "".join(open_text), number == 0, False))
                    start, open_text, number = place + 1, [], number + 1
            open_text.append(text[start:])
            if len(out) >= 1000:
                yield rows_of(out)
                out = []
        end_block()
        yield rows_of(out)

    def rows_of(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else [[]] * 6
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["file", "block", "number", "text", "head", "tail"])

    parts = source.mapInArrow(cut, "file string, block long, number long, text string, head boolean, tail boolean")
    whole = parts.where("not head and not tail").select("file", "block", "number", "text")
    # heads and tails, at most two for each block: a head goes on with what was open before its block
    order = Window.partitionBy("file").orderBy("block", "number")
    edges = parts.where("head or tail").withColumn("chain", F.sum(F.when(F.col("head"), 0).otherwise(1)).over(order))
    joined = edges.groupBy("file", "chain").agg(F.min(F.struct("block", "number")).alias("p"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "number", "text"))), lambda x: x["text"]), "").alias("text"))
    every = whole.unionByName(joined.select("file", "p.block", "p.number", "text")).where(F.col("text").rlike(r'^\s*"'))
    entry = F.regexp_extract("text", r'(?s)^\s*("(?:[^"\\]|\\.)*")\s*:\s*(.*?)\s*$', 1)
    value = F.regexp_extract("text", r'(?s)^\s*("(?:[^"\\]|\\.)*")\s*:\s*(.*?)\s*$', 2)
    key = F.from_json(F.concat(F.lit('{"k":'), entry, F.lit("}")), "k string")["k"]
    return every.select(key.alias("key"), value.alias("value"), F.struct("file", "block", "number").alias("place")).where("key is not null")
